"""Fuzzy line dedup by MinHash: one line stays of every group of near-equal lines.

Lines are compared by their sets of character shingles. Signatures are cut into bands; a
census of band keys (see :mod:`starlode.llm.superkmers`) finds those that several lines have
and tells each chunk their places, so that lines are hashed once. Only lines with such a key are
shipped, once per chunk and text. Lines that differ and share a key meet in the key's bucket, where
the exact Jaccard similarity decides; texts go where a pair of lines is not left to another key. Buckets report links of spanning trees, a distributed
union-find merges them, and each chunk learns which place of a group is the one to keep.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starlode.llm.components import components
from starlode.llm.superkmers import NO_ID, PACKET, bucket_of, groups, only, pack, packets, to_six, unpack
from starlode.llm.text import fresh
from starlode.llm.units import give_back, gram_hash, mixed, prefix_hash, tidy
from starlode.sources import materialize

SHINGLE = 9
SIMILARITY = 0.8
ROWS = 4
BANDS = 12  # recall at similarity 0.8: 1 - (1 - 0.8 ** 4) ** 12 = 0.998
BLOCK = 4096  # lines of one key that are compared in one go
_FEW = 32  # lines of a key that leave pairs to other keys
_PIECE = 1 << 15  # characters whose signatures are computed at a time
_WIDTH = 32  # shingles of a line that are hashed side by side with those of others
_HELD = 1 << 20  # characters of lines whose shingles are packed at a time
_BLANK = " \t\n\x0b\f\r"


def _factors() -> np.ndarray:
    """An odd factor per hash function, from a fixed rule."""
    return (mixed(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _least(grams: np.ndarray, heads: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Least value of every hash function over each run of grams, one row per run.

    Runs are cut into pieces of one width, the last one moved back to the end of its run: a gram
    that counts twice changes no minimum. Pieces stand side by side, so that whole rows of them
    are multiplied and compared at once.
    """
    pieces = -(-counts // _WIDTH)
    first = np.cumsum(pieces) - pieces
    run = np.repeat(np.arange(len(counts)), pieces)
    step = (np.arange(len(run)) - first[run]) * _WIDTH
    start = heads[run] + np.minimum(step, np.maximum(counts[run] - _WIDTH, 0))
    last = heads[run] + counts[run] - 1
    table = grams[np.minimum(start + np.arange(_WIDTH)[:, None], last)]
    factors = _factors()
    least = np.empty((len(factors), len(run)), np.uint32)
    hashed = np.empty_like(table)  # stays in the cache for all functions
    for j, factor in enumerate(factors):
        np.multiply(table, factor, out=hashed)
        np.minimum.reduce(hashed, axis=0, out=least[j])
    return np.minimum.reduceat(least, first, axis=1).T


def band_keys(lines: list[str], shingle: int) -> np.ndarray:
    """48-bit keys, one row of ``BANDS`` per line; a short line is its own only shingle."""
    least = np.empty((len(lines), BANDS * ROWS), np.uint32)
    sizes = np.array([len(x) for x in lines], np.int64)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(lines):
        before = ends[begin] - sizes[begin]
        end = max(begin + 1, int(np.searchsorted(ends, before + _PIECE, side="right")))
        n = sizes[begin:end]
        # blanks fill short lines up to one shingle
        text = "".join(x if len(x) >= shingle else x.ljust(shingle, "\n") for x in lines[begin:end])
        n = np.maximum(n, shingle)
        values = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        grams = (gram_hash(prefix_hash(values), shingle) >> np.uint64(32)).astype(np.uint32)
        least[begin:end] = _least(grams, np.cumsum(n) - n, n - shingle + 1)
        begin = end
    keys = np.empty((len(lines), BANDS), np.uint64)
    keys[:] = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + least[:, r::ROWS])
    return keys >> np.uint64(16)


class Lines:
    """The distinct lines of a chunk: text, digest, first place; and the place of each line."""

    def __init__(self, table: pa.Table, names: dict[str, str]):
        ids = table.column(names["id"]).fill_null(NO_ID).to_pylist()
        digests = table.column(names["digest"]).to_pylist()
        texts = table.column(names["text"]).to_pylist()
        self.rows: list[list[tuple[str, bytes | None]]] = []
        self.first: dict[bytes, tuple[int, int, int]] = {}
        self.text: dict[bytes, str] = {}
        self.several: set[bytes] = set()
        for i, d, text in zip(ids, digests, texts, strict=True):
            own: list[tuple[str, bytes | None]] = []
            for n, line in enumerate((text or "").split("\n")):
                if not line.strip(_BLANK):
                    own.append((line, None))
                    continue
                name = xxhash.xxh3_128_digest(line.encode())
                place = (i, d, n)
                known = self.first.get(name)
                if known is None:
                    self.first[name], self.text[name] = place, line
                elif known != place:
                    self.several.add(name)
                    if place < known:
                        self.first[name] = place
                own.append((line, name))
            self.rows.append(own)

    def names(self) -> list[bytes]:
        """The digests in an order of their own: rows of a chunk come in any order each time it is read."""
        return sorted(self.text)

    def keys(self, shingle: int) -> np.ndarray:
        """One row per digest: the keys of its bands, and one of the digest itself."""
        names = self.names()
        own = np.array([int.from_bytes(x[:6], "little") for x in names], np.uint64)
        return np.column_stack([band_keys([self.text[x] for x in names], shingle), own])


def _payloads(keys: np.ndarray, places: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """One payload per run of keys and their places, which ascend in a run.

    Differences of places are sent, and bytes of one weight side by side: high ones are mostly zero.
    """
    steps = np.diff(places, prepend=0)
    steps[starts] = places[starts]
    both = np.column_stack([to_six(keys), steps.astype(np.uint32).view(np.uint8).reshape(-1, 4)])
    return [pack(both[s:e].T.ravel()) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def _opened(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and places of all payloads, and how many each has."""
    parts = [unpack(p)[0].reshape(10, -1).T for p in payloads]
    sizes = np.array([len(p) for p in parts])
    both = np.concatenate(parts)
    wide = np.zeros((len(both), 8), np.uint8)
    wide[:, :6] = both[:, :6]
    total = np.r_[0, np.cumsum(np.ascontiguousarray(both[:, 6:]).view(np.uint32).ravel(), dtype=np.int64)]
    before = total[np.cumsum(sizes) - sizes]
    return wide.view(np.uint64).ravel(), total[1:] - np.repeat(before, sizes), sizes


def _census(names: dict[str, str], shingle: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    """Every key goes to its bucket with its place among the chunk's keys, line by line."""

    def ask(table: pa.Table) -> pa.Table:
        lines = Lines(table, names)
        again = np.array([x in lines.several for x in lines.names()], bool)
        keys = lines.keys(shingle).ravel()
        place = 2 * np.arange(len(keys)) + np.repeat(again, BANDS + 1)
        bucket = bucket_of(keys, buckets)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        starts, ends = groups(bucket)
        rows = zip(bucket[starts].tolist(), _payloads(keys[order], place[order], starts, ends), strict=True)
        return packets(only(table, names["chunk"]), list(rows))

    return ask


def _answer(table: pa.Table) -> pa.Table:
    """Those keys of each chunk that several lines have, or one line several times."""
    chunks = table.column("chunk").to_numpy()
    keys, places, sizes = _opened(table.column("payload").to_pylist())
    order = np.argsort(keys, kind="stable")
    starts, ends = groups(keys[order])
    shared = np.empty(len(keys), bool)
    again = np.add.reduceat(places[order] & 1, starts) > 0
    shared[order] = np.repeat((ends - starts > 1) | again, ends - starts)
    row = np.repeat(np.arange(len(chunks)), sizes)[shared]
    starts, ends = groups(row)
    payloads = _payloads(keys[shared], places[shared] >> 1, starts, ends)
    return packets(only(table, "bucket"), list(zip(chunks[row[starts]].tolist(), payloads, strict=True)), "chunk")


_SHIPPED = (
    "chunk long, line binary, text string, doc_id long, digest long, place int, keys array<long>"
)


def _ship(names: dict[str, str]) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def ship(_key, table: pa.Table, replies: pa.Table) -> pa.Table:
        known: list[bytes] = []
        texts: list[str] = []
        first: list[tuple[int, int, int]] = []
        keys, offsets = np.zeros(0, np.int64), np.zeros(1, np.int32)
        if table.num_rows and replies.num_rows:
            found, place, _ = _opened(replies.column("payload").to_pylist())
            order = np.argsort(place)
            line, band = np.divmod(place[order], BANDS + 1)
            keys = found[order].astype(np.int64) * 16 + band
            starts, _ = groups(line)
            banded = band < BANDS
            offsets = np.r_[0, np.cumsum(np.add.reduceat(banded.astype(np.int32), starts))].astype(np.int32)
            keys = keys[banded]
            lines = Lines(table, names)
            every = lines.names()
            known = [every[i] for i in line[starts].tolist()]
            texts, first = [lines.text[x] for x in known], [lines.first[x] for x in known]
        docs, digests, numbers = zip(*first, strict=True) if first else ((), (), ())
        chunk = [only(table, names["chunk"])] * len(known) if known else []
        columns = {
            "chunk": pa.array(chunk, pa.int64()),
            "line": pa.array(known, pa.binary()),
            "text": pa.array(texts, pa.string()),
            "doc_id": pa.array(docs, pa.int64()),
            "digest": pa.array(digests, pa.int64()),
            "place": pa.array(numbers, pa.int32()),
            "keys": pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys, pa.int64())),
        }
        return pa.table(columns)

    return ship


def shingles(line: str, n: int) -> set[str]:
    return {line[i : i + n] for i in range(max(len(line) - n, 0) + 1)}


def shared(a: set | np.ndarray, b: set | np.ndarray) -> int:
    """How many shingles two lines have in common; both are sets, or both ascending numbers."""
    if isinstance(a, set):
        return len(a & b)
    return int(np.count_nonzero(a.take(a.searchsorted(b), mode="clip") == b))


def similar(a: set | np.ndarray, b: set | np.ndarray, least: float) -> bool:
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = shared(a, b)
    return both >= least * (len(a) + len(b) - both)


class Shingles:
    """The distinct shingles of some lines, as numbers where that is exact, made when first asked for.

    Characters are numbered by what stands in these lines; as long as a shingle's numbers fit 64
    bits, they are the shingle. Lines of more kinds of characters keep shingles as text.
    """

    def __init__(self, lines: dict[bytes, str], n: int):
        self.lines, self.n, self.sets = lines, n, {}
        sizes = np.array([len(x) for x in lines.values()], np.int64)
        text = "".join(x if len(x) >= n else x.ljust(n, "\0") for x in lines.values())
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        there = np.zeros(int(codes.max(initial=0)) + 1, bool)
        there[codes] = True
        bits = int(there.sum()).bit_length()
        self.packed = None
        if bits * n <= 64 and not any("\0" in x for x in lines.values()):
            numbers = np.cumsum(there).astype(np.uint64)
            number = numbers[codes] - np.uint64(1)
            count = max(len(number) - n + 1, 0)
            self.packed = np.zeros(count, np.uint64)
            for i in range(n):
                self.packed <<= np.uint64(bits)
                self.packed |= number[i : i + count]
            heads = np.cumsum(np.maximum(sizes, n)) - np.maximum(sizes, n)
            ends = heads + np.maximum(sizes - n, 0) + 1
            self.spans = dict(zip(lines, zip(heads.tolist(), ends.tolist(), strict=True), strict=True))

    def of(self, name: bytes) -> set | np.ndarray:
        found = self.sets.get(name)
        if found is None:
            if self.packed is None:
                found = shingles(self.lines[name], self.n)
            else:
                head, end = self.spans[name]
                found = np.sort(self.packed[head:end])
                new = np.ones(len(found), bool)
                np.not_equal(found[1:], found[:-1], out=new[1:])
                found = found[new]
            self.sets[name] = found
        return found


def _trees(
    key: int,
    names: list[bytes],
    keys: list[list[int]],
    of: Callable[[bytes], set | np.ndarray],
    least: float,
    apart: list[bool] | None = None,
) -> Iterator[tuple[bytes, bytes]]:
    """Links of spanning trees of the lines that share ``key``, breadth first.

    Few lines leave a pair to the first key it has in common, which saves nine checks in ten.
    Many lines are mostly one group; there a line is settled at its first link, and leaving
    pairs to other keys would keep all of them waiting. ``of`` gives the shingles of a line.
    ``apart`` tells two blocks of one key: then only lines of different blocks are compared.
    """
    few = len(names) <= _FEW
    owned = [frozenset(k) for k in keys] if few else []
    # lines yet to be settled, by the side that compares with them
    left: dict[bool, list[int]] = {True: [], False: []}
    for i in range(len(names)):
        left[apart is not None and not apart[i]].append(i)
    if apart is None:
        left[True] = left[False]
    while left[True] and left[False]:
        first = left[False].pop(0)
        frontier = [first]
        while frontier and (left[True] or left[False]):
            i, rest = frontier.pop(), []
            side = apart is not None and apart[i]
            for j in left[side]:
                if (not few or min(owned[i] & owned[j]) == key) and similar(of(names[i]), of(names[j]), least):
                    yield names[i], names[j]
                    frontier.append(j)
                else:
                    rest.append(j)
            left[side][:] = rest


def _paired(key: np.ndarray, heads: np.ndarray, ends: np.ndarray, keys: pa.ListArray) -> np.ndarray:
    """Which rows have, in their run, a row whose first key in common with them is the run's ``key``.

    Runs of more than ``_FEW`` rows, which leave no pairs to other keys, have all their rows kept.
    """
    values, bounds = keys.flatten().to_numpy(), np.diff(keys.offsets.to_numpy())
    table = np.full((len(key), 16), -1, np.int64)  # the band is the last four bits of a key
    table[np.repeat(np.arange(len(key)), bounds), values & 15] = values
    sizes = ends - heads
    keep = np.repeat(sizes > _FEW, sizes)
    size, head = np.repeat(sizes, sizes), np.repeat(heads, sizes)
    at = np.arange(len(key))
    for step in range(1, min(_FEW, int(sizes.max(initial=1)))):
        a = at[(size <= _FEW) & (at - head + step < size)]
        b = a + step
        common = (table[a] == table[b]) & (table[a] >= 0)
        own = np.where(common, table[a], np.iinfo(np.int64).max).min(axis=1) == key[a]
        keep[a[own]] = keep[b[own]] = True
    return keep


def _with_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by meeting, that have a pair to compare there; so texts travel to no meeting in vain."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        meeting = [table.column(c).to_numpy() for c in ("key", "block", "other")]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.any([x[1:] != x[:-1] for x in meeting], axis=0)
        heads = np.flatnonzero(new)
        # the last meeting may go on in the next batch
        rest = table.slice(heads[-1]) if len(heads) else None
        if len(heads) > 1:
            yield from _kept(table.slice(0, heads[-1]), heads[:-1])
    if rest is not None:
        yield from _kept(rest, np.zeros(1, np.int64))


def _kept(table: pa.Table, heads: np.ndarray) -> list[pa.RecordBatch]:
    table = table.combine_chunks()
    keys = table.column("keys").combine_chunks()
    keep = _paired(table.column("key").to_numpy(), heads, np.r_[heads[1:], table.num_rows], keys)
    return table.drop_columns("keys").filter(pa.array(keep)).combine_chunks().to_batches()


def _links(lines: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """a, b: digests of similar lines. ``lines`` has one row per distinct line."""
    narrow = materialize(lines.select(F.explode("keys").alias("key"), "line", "keys"), "band-keys")
    counted = narrow.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    counted = materialize(counted, "shared-keys").withColumnRenamed("key", "_key")
    dealt = (
        narrow.join(counted, F.col("key") == F.col("_key"))
        .select("key", "line", "keys", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
        .withColumn("side", F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int"))
    )
    # a key with more lines than a block holds is dealt in blocks, and each block meets each
    places = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("side", "other").alias("block"), F.greatest("side", "other").alias("other"), "side", "line", "keys"
    )
    met = ("key", "block", "other")
    places = places.repartition(*met).sortWithinPartitions(*met)
    kinds = "key long, block int, other int, side int, line binary"
    places = materialize(places.mapInArrow(_with_pairs, kinds), "meetings").withColumnRenamed("line", "_line")
    full = places.join(lines.select("line", "text", "keys"), F.col("_line") == F.col("line")).drop("_line")
    full = full.repartition(*met).sortWithinPartitions(*met)

    wanted = ("key", "block", "other", "side", "line", "text", "keys")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # groups that wait for their shingles, and the one whose lines are still coming in
        waiting: list[list[tuple]] = []
        group: list[tuple] = []
        held = 0

        def done() -> pa.RecordBatch:
            of = Shingles({row[4]: row[5] for rows in waiting for row in rows}, shingle).of
            pairs: list[tuple[bytes, bytes]] = []
            for rows in waiting:
                key, block, other = rows[0][:3]
                *_, sides, names, _, keys = zip(*rows, strict=True)
                apart = None if block == other else [x == block for x in sides]
                pairs += _trees(key, list(names), list(keys), of, similarity, apart)
            waiting.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["a", "b"]
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in wanted)
            for row in zip(*columns, strict=True):
                if group and group[0][:3] != row[:3]:
                    if len(group) > 1:
                        waiting.append(group)
                        held += sum(len(x[5]) for x in group)
                    group = []
                    if held > _HELD:
                        yield done()
                        held = 0
                group.append(row)
        if len(group) > 1:
            waiting.append(group)
        yield done()
        del group
        give_back()

    return full.select(*wanted).mapInArrow(verify, "a binary, b binary")


def line_dedup(
    docs: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = 2 << 20,
    n_lines: str = "n_lines",
    n_removed: str = "n_removed",
) -> DataFrame:
    """``docs`` with similar lines removed from ``text_col``, and two counts per row.

    Lines lie between line feeds; those of blanks alone are kept and not counted. A group holds
    lines linked by a Jaccard similarity of ``similarity`` or more of their sets of ``shingle``
    characters (a shorter line is one shingle). Its line in the document with the smallest id
    stays, there the first; equal ids are told apart by the text's hash, null ids come last.
    Rows equal in id and text are one document and keep the same lines. Null texts stay null,
    empty ones empty; very long lines are compared whole, and an empty table stays empty.
    All columns of ``docs`` are returned; the names of the counts must be free.
    """
    spark = docs.sparkSession
    if {n_lines, n_removed} & set(docs.columns):
        raise ValueError(f"{n_lines} or {n_removed} is a column already")
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(least, -(-size // chunk_bytes))
    names = {k: fresh(docs, f"{k}_of_lines") for k in ("chunk", "digest", "id")} | {"text": text_col}
    spread = docs.withColumns(
        {
            names["chunk"]: F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(chunks)),
            names["digest"]: F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))),
            names["id"]: F.col(id_col).cast("long"),
        }
    )
    by_chunk = spread.groupBy(names["chunk"])
    asked = by_chunk.applyInArrow(tidy(_census(names, shingle, chunks)), PACKET)
    known = asked.groupBy("bucket").applyInArrow(tidy(_answer), PACKET)
    found = by_chunk.cogroup(known.groupBy("chunk")).applyInArrow(tidy(_ship(names)), _SHIPPED)
    found = materialize(found, "shared-lines")
    place = F.struct("doc_id", "digest", F.col("place").alias("line"))
    lines = found.groupBy("line").agg(
        F.min(place).alias("place"), F.first("text").alias("text"), F.first("keys").alias("keys")
    )
    lines = materialize(lines, "distinct-lines")
    group = components(_links(lines, shingle, similarity), "a", "b")
    rooted = lines.select("line", "place").join(group, F.col("line") == F.col("node"), "left")
    rooted = materialize(rooted.select("line", "place", F.coalesce("component", "line").alias("root")), "roots")
    best = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("place").alias("best"))
    chosen = rooted.join(best, F.col("root") == F.col("_root")).select(F.col("line").alias("_line"), "best")
    chosen = materialize(chosen, "kept-places")
    told = found.select("chunk", "line").join(chosen, F.col("line") == F.col("_line")).select("chunk", "line", "best.*")
    told = told.toDF("chunk", "name", "doc_id", "digest", "line")
    told = materialize(told, "told")
    schema = T.StructType([*docs.schema.fields, T.StructField(n_lines, T.LongType()), T.StructField(n_removed, T.LongType())])

    def finish(_key, table: pa.Table, replies: pa.Table) -> pa.Table:
        columns = (replies.column(c).to_pylist() for c in ("name", "doc_id", "digest", "line"))
        keep = {name: tuple(best) for name, *best in zip(*columns, strict=True)}
        own = Lines(table, names)
        ids = table.column(names["id"]).fill_null(NO_ID).to_pylist()
        digests = table.column(names["digest"]).to_pylist()
        texts, total, gone = [], [], []
        for i, d, row in zip(ids, digests, own.rows, strict=True):
            stay = [x for n, (x, name) in enumerate(row) if name is None or keep.get(name, (i, d, n)) == (i, d, n)]
            total.append(sum(name is not None for _, name in row))
            gone.append(len(row) - len(stay))
            texts.append("\n".join(stay))
        old = table.column(text_col)
        texts = pa.array(texts, pa.string(), mask=old.is_null().to_numpy())
        made = {n_lines: pa.array(total, pa.int64()), n_removed: pa.array(gone, pa.int64()), text_col: texts}
        return pa.table({f.name: made[f.name] if f.name in made else table.column(f.name) for f in schema})

    return by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(tidy(finish), schema)
