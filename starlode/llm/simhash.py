"""SimHash near-dedup with bit-sliced comparison.

Fingerprints that differ in at most ``radius`` bits agree in all but ``radius`` of their
blocks, so each is sent once per choice of blocks to leave out, keyed by the others: no link
is missed. With eight blocks and radius two a key fixes 48 bits, which bounds a key's distinct
fingerprints by 65,536, whatever the input. Inside a key, 64 fingerprints at a time are kept
as vertical bit planes; the distances of a query to all of them are added up by carry-save
counters, and a block is abandoned once all its lanes are beyond the radius. A key reports
its components as stars, not as pairs; stars are merged by a distributed union-find.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlode.llm.components import components
from starlode.llm.text import fresh
from starlode.llm.units import Units, give_back
from starlode.sources import materialize

SHINGLE = 3
RADIUS = 2
BLOCKS = 8
SEED = 42
_PIECE = 1 << 20  # bytes of text that are turned into arrays at a time
_PAIRS = 1 << 18  # comparisons of a query with a block at a time
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def pieces(batch: pa.RecordBatch, column: str, limit: int = _PIECE) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` bytes in ``column``, or of a single row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    begin, held = 0, 0
    for i, n in enumerate(sizes.to_pylist()):
        if i > begin and held + n > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def fingerprints(texts: pa.Array, shingle: int) -> np.ndarray:
    """A bit is set if it is set in over half of the shingles' hashes."""
    u = Units.of_words(texts)
    raw = _LOWER[u.data].tobytes()
    n = u.counts()
    many = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), many)
    first = u.offsets[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    last = np.minimum(first + shingle, u.offsets[1:][doc]) - 1
    out = np.zeros(len(n), np.uint64)
    if not len(doc):
        return out
    h = xxhash.xxh64_intdigest
    spans = zip(u.begin[first].tolist(), u.end[last].tolist(), strict=True)
    hashes = np.array([h(raw[b:e], SEED) for b, e in spans], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    some = np.flatnonzero(many)
    ones = np.add.reduceat(bits, (np.cumsum(many) - many)[some], axis=0, dtype=np.int64)
    majority = (2 * ones > many[some][:, None]).astype(np.uint8)
    out[some] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, digest (hash of the text), fingerprint (64 bits as a signed long)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                prints = fingerprints(piece.column("text"), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("digest"), pa.array(prints)],
                    ["doc_id", "digest", "fingerprint"],
                )
        give_back()

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"), text.alias("text")
    ).mapInArrow(sign, "doc_id long, digest long, fingerprint long")


def near(planes: np.ndarray, lanes: np.ndarray, prints: np.ndarray, block: np.ndarray, radius: int) -> np.ndarray:
    """For query i against ``block[i]``: the lanes at most ``radius`` bits away, as a mask.

    ``planes[b]`` holds 64 bit planes of block b, ``lanes[b]`` the lanes in use. Sums are kept
    in carry-save form: counter j holds bit j of all 64 distances; what reaches the last
    counter's carry is beyond the radius for good.
    """
    n_counters = (radius + 1).bit_length()
    out = np.zeros(len(prints), np.uint64)
    live = np.arange(len(prints))
    counters = [np.zeros(len(prints), np.uint64) for _ in range(n_counters)]
    beyond = ~lanes[block]
    for bit in range(64):
        carry = planes[block[live], bit] ^ (np.uint64(0) - ((prints[live] >> np.uint64(bit)) & np.uint64(1)))
        for c in counters:
            held = c & carry
            c ^= carry
            carry = held
        beyond |= carry
        if bit % 8 == 7:
            over = _above(counters, radius)
            keep = (beyond | over) != np.uint64(0xFFFFFFFFFFFFFFFF)
            if not keep.all():
                live, beyond, counters = live[keep], beyond[keep], [c[keep] for c in counters]
            if not len(live):
                return out
    out[live] = ~(beyond | _above(counters, radius))
    return out


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counters read more than ``radius``, compared from the highest bit down."""
    more = np.zeros_like(counters[0])
    equal = ~more
    for j in reversed(range(len(counters))):
        if radius >> j & 1:
            equal &= counters[j]
        else:
            more |= equal & counters[j]
            equal &= ~counters[j]
    return more


def sliced(prints: np.ndarray, starts: np.ndarray, lane: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit planes and used lanes of the blocks that begin at ``starts``."""
    planes = np.empty((len(starts), 64), np.uint64)
    for bit in range(64):
        planes[:, bit] = np.bitwise_or.reduceat(((prints >> np.uint64(bit)) & np.uint64(1)) << lane, starts)
    return planes, np.bitwise_or.reduceat(np.uint64(1) << lane, starts)


def _small_stars(prints: np.ndarray, starts: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """(member, centre) of the components of keys with at most 64 fingerprints each."""
    sizes = np.diff(np.r_[starts, len(prints)])
    block = np.repeat(np.arange(len(starts)), sizes)
    lane = (np.arange(len(prints)) - np.repeat(starts, sizes)).astype(np.uint64)
    planes, lanes = sliced(prints, starts, lane)
    masks = near(planes, lanes, prints, block, radius)
    linked = np.add.reduceat((masks != np.uint64(1) << lane).astype(np.int64), starts) > 0
    out = []
    for s, n in zip(starts[linked].tolist(), sizes[linked].tolist(), strict=True):
        own, todo = masks[s : s + n].tolist(), (1 << n) - 1
        while todo:
            low = todo & -todo
            reached, frontier = low, low
            while frontier:
                bit = frontier & -frontier
                frontier ^= bit
                new = own[bit.bit_length() - 1] & ~reached
                reached |= new
                frontier |= new
            todo &= ~reached
            rest, centre = reached ^ low, s + low.bit_length() - 1
            while rest:
                bit = rest & -rest
                rest ^= bit
                out.append((s + bit.bit_length() - 1, centre))
    return out


def _large_stars(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """The same for one key with many fingerprints: breadth first, each is a query once."""
    n = len(prints)
    starts = np.arange(0, n, 64)
    lane = (np.arange(n) % 64).astype(np.uint64)
    planes, left = sliced(prints, starts, lane)
    out = []
    while True:
        open_blocks = np.flatnonzero(left)
        if not len(open_blocks):
            return out
        lowest = int(left[open_blocks[0]])
        seed = int(open_blocks[0]) * 64 + (lowest & -lowest).bit_length() - 1
        left[seed // 64] &= ~(np.uint64(1) << np.uint64(seed % 64))
        frontier = np.array([seed])
        while len(frontier):
            found = np.zeros(len(left), np.uint64)
            open_blocks = np.flatnonzero(left)
            step = max(1, _PAIRS // max(len(open_blocks), 1))
            for i in range(0, len(frontier), step):
                q = frontier[i : i + step]
                block = np.tile(open_blocks, len(q))
                masks = near(planes, left, np.repeat(prints[q], len(open_blocks)), block, radius)
                found[open_blocks] |= np.bitwise_or.reduce(masks.reshape(len(q), -1), axis=0)
            left &= ~found
            bits = np.unpackbits(found.view(np.uint8), bitorder="little")
            frontier = np.flatnonzero(bits)
            out.extend((int(i), seed) for i in frontier)


def stars(keys: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and the centre they are linked with, per run of equal keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    small = np.repeat((sizes > 1) & (sizes <= 64), sizes)
    member, centre = [], []
    if small.any():
        own, k = prints[small], keys[small]
        found = np.array(_small_stars(own, np.flatnonzero(np.r_[True, k[1:] != k[:-1]]), radius), np.int64).reshape(-1, 2)
        member.append(own[found[:, 0]])
        centre.append(own[found[:, 1]])
    for s, n in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
        own = prints[s : s + n]
        found = np.array(_large_stars(own, radius), np.int64).reshape(-1, 2)
        member.append(own[found[:, 0]])
        centre.append(own[found[:, 1]])
    if not member:
        return prints[:0], prints[:0]
    return np.concatenate(member), np.concatenate(centre)


def linked(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """member, centre: links that connect all of the distinct ``fingerprint`` within ``radius``."""
    width = 64 // blocks
    masks = []
    for left_out in itertools.combinations(range(blocks), radius):
        mask = (1 << 64) - 1
        for b in left_out:
            mask &= ~(((1 << (width if b < blocks - 1 else 64 - width * b)) - 1) << (width * b))
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.explode(
        F.array(
            *(
                F.struct(F.lit(i).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("key"))
                for i, m in enumerate(masks)
            )
        )
    )
    dealt = prints.select("fingerprint", keys.alias("k")).select("k.t", "k.key", "fingerprint")
    dealt = dealt.repartition("t", "key").sortWithinPartitions("t", "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_t, held_k, held_p = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def done(t: np.ndarray, k: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
            run = np.cumsum(np.r_[0, (t[1:] != t[:-1]) | (k[1:] != k[:-1])])
            member, centre = stars(run, p.view(np.uint64), radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(member.view(np.int64)), pa.array(centre.view(np.int64))], ["member", "centre"]
            )

        for batch in batches:
            t = np.r_[held_t, batch.column(0).to_numpy()]
            k = np.r_[held_k, batch.column(1).to_numpy()]
            p = np.r_[held_p, batch.column(2).to_numpy()]
            if not len(t):
                continue
            # the last key may go on in the next batch
            other = np.flatnonzero((t != t[-1]) | (k != k[-1]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield done(t[:cut], k[:cut], p[:cut])
            held_t, held_k, held_p = t[cut:], k[cut:], p[cut:]
        if len(held_t):
            yield done(held_t, held_k, held_p)
        give_back()

    return dealt.mapInArrow(compare, "member long, centre long")


def near_documents(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, digest, fingerprint, component_id, is_kept: one row per row of ``docs``.

    ``component_id`` is the smallest id among the documents reachable over links. Null and
    empty texts have fingerprint 0 and are linked like any other. Null ids stand after all
    others: a component of null ids alone has a null id. ``is_kept`` holds for the rows with
    the smallest id, and of those for the ones with the least ``digest`` (the text's hash), so
    only rows equal in id and text can share it. Long texts are hashed whole; an empty table
    gives no rows. Only the two named columns are read.
    """
    signed = materialize(with_fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    prints = signed.groupBy("fingerprint").agg(F.min(order).alias("first"))
    prints = materialize(prints, "distinct-fingerprints")
    group = components(linked(prints.select("fingerprint"), radius), "member", "centre")
    rooted = prints.join(group, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("root"), "first"
    )
    rooted = materialize(rooted, "roots")
    best = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("best"))
    named = rooted.join(best, F.col("root") == F.col("_root")).select(
        F.col("fingerprint").alias("_print"), "best"
    )
    named = materialize(named, "components")
    return signed.join(named, F.col("fingerprint") == F.col("_print")).select(
        "doc_id",
        "digest",
        "fingerprint",
        F.col("best.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("digest") == F.col("best.digest"))).alias("is_kept"),
    )


def hex_fingerprint(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def one_per_group(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, all columns as they are.

    It is the row with the smallest id (null ids come last), of those the one whose text has the
    least hash; of rows equal in id and text any one stays. Null and empty texts are a group, and
    so may long texts be; an empty table stays empty. Extra columns may have any names.
    """
    kept = near_documents(docs, shingle, radius, id_col, text_col).where("is_kept")
    kept = kept.groupBy("doc_id", "digest").agg(F.count("*").alias("copies"))
    kept = materialize(kept.withColumnsRenamed({"doc_id": "_kept_id", "digest": "_kept_digest"}), "kept")
    mark = fresh(docs, "text_hash")
    marked = docs.withColumn(mark, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_kept_id")) & (F.col(mark) == F.col("_kept_digest"))
    left = marked.join(kept.drop("copies"), same, "left_semi")
    if not kept.where("copies > 1").isEmpty():  # rows equal in id and text
        left = left.dropDuplicates([id_col, mark])
    return left.drop(mark)
