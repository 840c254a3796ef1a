"""Repeated windows between documents, found through super-k-mers.

A window is ``k`` consecutive units (bytes or words) of one document. Its minimiser is the
least hash among its grams of ``m`` units; consecutive windows with one minimiser form a
super-k-mer, which is shipped as one string. All equal windows have equal minimisers, so they
meet in the minimiser's bucket, whatever document they come from.

Three passes over documents that were shuffled once, by chunk:

1. Census: each chunk sends the distinct minimisers it has; the buckets answer which of them
   are shared by documents, and which are hot, i.e. have more super-k-mers than one bucket
   should take.
2. Super-k-mers of shared minimisers travel, once per chunk and text, with the least and the
   greatest document of the chunk that has them: a bucket has at most one row per chunk and
   text, however many documents repeat it. Those of hot minimisers are cut into single windows
   and dealt by the window, so that no bucket grows with one common gram. The places they stand
   at go to a bucket of the chunk's own, which hands them on.
3. Buckets answer with the least document of each window, where the chunk has a later one, and
   the chunk applies that to its own places.

Rows are packets (chunk, bucket, bytes); chunks and buckets hold a bounded number of bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlode.llm.units import Units, gram_hash, prefix_hash, sliding_min, span_hash, tidy

PACKET = "chunk long, bucket long, payload binary"
NO_ID = np.iinfo(np.int64).max  # null ids come after all others
_PACKET = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("payload", pa.binary())])


@dataclass(frozen=True)
class Plan:
    """k, m: units of a window and of a gram; words or bytes; hot: super-k-mers of one key.

    ``places``: buckets get every place of a string instead of answering to its chunk.
    """

    k: int
    m: int
    words: bool
    chunks: int
    buckets: int
    hot: int
    places: bool = False

    def units(self, texts: pa.Array) -> Units:
        return Units.of_words(texts) if self.words else Units.of_bytes(texts)


_KINDS = {np.dtype(t).num: np.dtype(t) for t in (np.uint8, np.uint32, np.int64, np.uint64, np.bool_)}


@cache
def _zstd() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray) -> bytes:
    parts = ((np.array([len(a), a.dtype.num], np.int64).tobytes(), a.tobytes()) for a in arrays)
    return _zstd()[0].compress(b"".join(x for part in parts for x in part))


def unpack(payload: bytes) -> list[np.ndarray]:
    data, at, out = _zstd()[1].decompress(payload), 0, []
    while at < len(data):
        n, num = np.frombuffer(data, np.int64, 2, at).tolist()
        out.append(np.frombuffer(data, _KINDS[num], n, at + 16))
        at += 16 + n * _KINDS[num].itemsize
    return out


def packets(chunk: int, rows: list[tuple[int, bytes]], other: str = "bucket") -> pa.Table:
    """Rows for many buckets of one chunk, or for many chunks of one bucket."""
    one, many = [chunk] * len(rows), [r[0] for r in rows]
    chunks, buckets = (one, many) if other == "bucket" else (many, one)
    return pa.table([pa.array(chunks, pa.int64()), pa.array(buckets, pa.int64()), pa.array([r[1] for r in rows], pa.binary())], _PACKET)


class Chunk:
    """The distinct documents of a chunk in a fixed order, as units and super-k-mers."""

    def __init__(self, table: pa.Table, plan: Plan):
        keys = table.column("row_key").to_numpy()
        ids = table.column("doc_id").fill_null(NO_ID).to_numpy()
        _, first = np.unique(keys, return_index=True)
        self.order = first[np.lexsort((keys[first], ids[first]))]
        place = {int(keys[i]): n for n, i in enumerate(self.order)}
        self.place = np.array([place[int(k)] for k in keys], np.int64)  # of each row
        self.ids = ids[self.order]
        texts = table.column("text").cast(pa.large_string()).combine_chunks()
        texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
        self.units = plan.units(texts.take(pa.array(self.order)))
        self.plan = plan

    def super_kmers(self) -> None:
        """start, count, key of every run of windows with one minimiser."""
        u, k, m = self.units, self.plan.k, self.plan.m
        self.sums = prefix_hash(u.values)
        least = sliding_min(gram_hash(self.sums, m), k - m + 1)
        least = least[: max(len(u) - k + 1, 0)] >> np.uint64(16)
        inside = np.zeros(len(least) + 1, bool)
        heads, tails = u.offsets[:-1], u.offsets[1:] - k + 1
        step = np.zeros(len(least) + 1, np.int64)
        full = tails > heads
        np.add.at(step, heads[full], 1)
        np.add.at(step, tails[full], -1)
        inside = np.cumsum(step)[:-1] > 0
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (least[1:] != least[:-1])
        end = inside.copy()
        end[:-1] &= ~inside[1:] | (least[1:] != least[:-1])
        self.start = np.flatnonzero(new)
        self.count = np.flatnonzero(end) + 1 - self.start
        self.key = least[self.start]
        self.owner = np.searchsorted(u.offsets, self.start, side="right") - 1

    def dealt(self, hot: np.ndarray, shared: np.ndarray) -> None:
        """Keep what is shared, and cut what is hot into windows keyed by themselves."""
        k = self.plan.k
        is_hot = _member(self.key, hot)
        keep = _member(self.key, shared) & ~is_hot
        single = np.repeat(self.start[is_hot], self.count[is_hot])
        first = np.cumsum(self.count[is_hot]) - self.count[is_hot]
        single = single + np.arange(len(single)) - np.repeat(first, self.count[is_hot])
        own = span_hash(self.sums, single, single + k) >> np.uint64(16)
        owner = np.repeat(self.owner[is_hot], self.count[is_hot])
        self.start = np.concatenate([self.start[keep], single])
        self.count = np.concatenate([self.count[keep], np.ones(len(single), self.count.dtype)])
        self.key = np.concatenate([self.key[keep], own])
        self.owner = np.concatenate([self.owner[keep], owner])


def _member(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """``known`` is sorted."""
    if not len(known):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the remainder: keys are minima of hashes and so cluster at the lower end."""
    return (keys % np.uint64(buckets)).astype(np.int64)


def groups(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs and their ends."""
    if not len(sorted_values):
        return np.zeros(0, int), np.zeros(0, int)
    starts = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return starts, np.r_[starts[1:], len(sorted_values)].astype(int)


def only(table: pa.Table, column: str) -> int:
    return table.column(column)[0].as_py()


def key_packets(chunk: int, key: np.ndarray, n: np.ndarray, several: np.ndarray, buckets: int) -> pa.Table:
    """Distinct keys of a chunk, how many things have each, and if these already meet in the chunk."""
    bucket = bucket_of(key, buckets)
    order = np.argsort(bucket, kind="stable")
    key, n, several, bucket = key[order], n[order], several[order], bucket[order]
    six = to_six(key)
    info = np.minimum(2 * n + several, 0xFFFFFFFF).astype(np.uint32)
    runs = zip(*groups(bucket), strict=True)
    return packets(chunk, [(int(bucket[s]), pack(six[s:e].T.ravel(), info[s:e])) for s, e in runs])


def _census(plan: Plan) -> Callable[[pa.Table], pa.Table]:
    def ask(table: pa.Table) -> pa.Table:
        c = Chunk(table, plan)
        c.super_kmers()
        text = span_hash(c.sums, c.start, c.start + c.count + (plan.k - 1))
        order = np.lexsort((text, c.key))
        key, text, owner = c.key[order], text[order], c.ids[c.owner[order]]
        starts, _ = groups(key)
        if not len(starts):
            return packets(0, [])
        fresh = np.r_[True, (key[1:] != key[:-1]) | (text[1:] != text[:-1])]
        n = np.add.reduceat(fresh.astype(np.int64), starts)
        several = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
        key = key[starts]
        return key_packets(only(table, "chunk"), key, n, several, plan.buckets)

    return ask


def to_six(keys: np.ndarray) -> np.ndarray:
    """The six low bytes of each key; transposed, equal ones stand together."""
    return keys.view(np.uint8).reshape(-1, 8)[:, :6]


def _from_six(six: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(six) // 6, 8), np.uint8)
    wide[:, :6] = six.reshape(6, -1).T
    return wide.view(np.uint64).ravel()


def census_answer(hot_over: int) -> Callable[[pa.Table], pa.Table]:
    def answer(table: pa.Table) -> pa.Table:
        chunks = table.column("chunk").to_pylist()
        parts = [unpack(p) for p in table.column("payload").to_pylist()]
        keys = np.concatenate([_from_six(p[0]) for p in parts])
        info = np.concatenate([p[1] for p in parts]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        starts, ends = groups(keys[order])
        some = np.add.reduceat(info[order] & 1, starts) > 0
        shared = some | (ends - starts > 1)
        hot = shared & (np.add.reduceat(info[order] >> 1, starts) > hot_over)
        shared_row, hot_row = np.empty(len(keys), bool), np.empty(len(keys), bool)
        shared_row[order] = np.repeat(shared, ends - starts)
        hot_row[order] = np.repeat(hot, ends - starts)
        rows, at = [], 0
        for i, chunk in enumerate(chunks):
            till = at + len(parts[i][1])
            s = shared_row[at:till]
            if s.any():
                rows.append((chunk, pack(keys[at:till][s], keys[at:till][hot_row[at:till]])))
            at = till
        return packets(only(table, "bucket"), rows, "chunk")

    return answer


def _ship(plan: Plan) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def ship(_key, table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows or not replies.num_rows:
            return packets(0, [])
        parts = [unpack(p) for p in replies.column("payload").to_pylist()]
        shared = np.sort(np.concatenate([p[0] for p in parts]))
        hot = np.sort(np.concatenate([p[1] for p in parts]))
        del parts
        c = Chunk(table, plan)
        c.super_kmers()
        c.dealt(hot, shared)
        u = c.units
        begin, end = u.begin[c.start], u.end[c.start + c.count + (plan.k - 2)]
        raw = u.data.tobytes()
        strings = pa.array([raw[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True)], pa.large_binary())
        code = strings.dictionary_encode().indices.to_numpy()
        bucket = bucket_of(c.key, plan.buckets)
        order = np.lexsort((code, bucket))
        place = c.start - u.offsets[c.owner]
        rows = []
        for s, e in zip(*groups(bucket[order]), strict=True):
            at = order[s:e]
            heads, tails = groups(code[at])
            texts = [raw[begin[i] : end[i]] for i in at[heads].tolist()]
            ids = c.ids[c.owner[at]]
            parts = [
                np.frombuffer(b"".join(texts), np.uint8),
                np.array([len(t) for t in texts], np.uint32),
                np.minimum.reduceat(ids, heads),
                np.maximum.reduceat(ids, heads),
                code[at[heads]].astype(np.uint32),
            ]
            if plan.places:
                parts += [(tails - heads).astype(np.uint32), ids, place[at].astype(np.uint32)]
            rows.append((int(bucket[at[0]]), pack(*parts)))
        chunk = only(table, "chunk")
        if rows and not plan.places:
            by = np.argsort(c.start, kind="stable")
            rows.append((plan.buckets + chunk, pack(code[by].astype(np.uint32), c.start[by].astype(np.uint32))))
        return packets(chunk, rows)

    return ship


@dataclass
class Bucket:
    """The distinct super-k-mers of a bucket and the chunks that have them.

    String i is ``data[offsets[i]:offsets[i + 1]]``; row j says that ``chunk[j]`` has string
    ``string[j]``, there number ``code[j]``, in documents from ``doc[j]`` to ``last[j]``.
    """

    data: np.ndarray
    offsets: np.ndarray
    string: np.ndarray
    doc: np.ndarray
    last: np.ndarray
    chunk: np.ndarray
    code: np.ndarray

    @classmethod
    def of(cls, chunks: list[int], parts: list[list[np.ndarray]]) -> Bucket:
        blob = np.concatenate([p[0] for p in parts])
        lens = np.concatenate([p[1] for p in parts]).astype(np.int64)
        offsets = np.r_[0, np.cumsum(lens)].astype(np.int64)
        strings = pa.Array.from_buffers(
            pa.large_binary(), len(lens), [None, pa.py_buffer(offsets), pa.py_buffer(blob)]
        ).dictionary_encode()
        data, offsets = (a for a in _dictionary(strings.dictionary))
        return cls(
            data,
            offsets,
            strings.indices.to_numpy(),
            np.concatenate([p[2] for p in parts]),
            np.concatenate([p[3] for p in parts]),
            np.repeat(np.array(chunks, np.int64), [len(p[1]) for p in parts]),
            np.concatenate([p[4] for p in parts]),
        )

    def first_doc(self) -> np.ndarray:
        """The least document id of each string."""
        out = np.full(len(self.offsets) - 1, NO_ID, np.int64)
        np.minimum.at(out, self.string, self.doc)
        return out


def _dictionary(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2], np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def counter(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. size - 1 for each size."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def window_runs(b: Bucket, first: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, from window, to window, least document) of runs that some document of the row is after.

    Window w of string i has the number ``first[i] + w``; ``least`` is its least document.
    """
    new = np.zeros(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    new[first[:-1]] = True  # a string has one window at least
    heads = np.flatnonzero(new)
    tails = np.r_[heads[1:], len(least)].astype(np.int64)
    till = np.searchsorted(heads, first)
    n = np.diff(till)[b.string]
    row = np.repeat(np.arange(len(n)), n)
    run = till[b.string[row]] + counter(n)
    late = least[heads[run]] < b.last[row]
    row, run = row[late], run[late]
    base = first[b.string[row]]
    return row, heads[run] - base, tails[run] - base, least[heads[run]]


def answer_spans(
    plan: Plan, least_of: Callable[[Bucket, int], tuple[np.ndarray, np.ndarray]]
) -> Callable[[pa.Table], pa.Table]:
    """``least_of(bucket, k)`` numbers the windows and gives the least document of each."""

    def answer(table: pa.Table) -> pa.Table:
        bucket = only(table, "bucket")
        if bucket >= plan.buckets:
            return table.select(["chunk", "bucket", "payload"])
        b = Bucket.of(table.column("chunk").to_pylist(), [unpack(p) for p in table.column("payload").to_pylist()])
        row, begin, end, least = window_runs(b, *least_of(b, plan.k))
        order = np.argsort(b.chunk[row], kind="stable")
        row, begin, end, least = row[order], begin[order], end[order], least[order]
        rows = []
        for s, e in zip(*groups(b.chunk[row]), strict=True):
            spans = (a[s:e].astype(np.uint32) for a in (b.code[row], begin, end))
            rows.append((int(b.chunk[row[s]]), pack(*spans, least[s:e])))
        return packets(bucket, rows, "chunk")

    return answer


def removed(c: Chunk, replies: pa.Table) -> np.ndarray:
    """Which units of the chunk a window covers that also stands in an earlier document."""
    own = replies.column("bucket").to_numpy() >= c.plan.buckets
    parts = [unpack(p) for p in replies.column("payload").to_pylist()]
    spans = [p for p, mine in zip(parts, own, strict=True) if not mine]
    if not spans:
        return np.zeros(len(c.units), bool)
    code, start = (a.astype(np.int64) for a in next(p for p, mine in zip(parts, own, strict=True) if mine))
    doc = c.ids[np.searchsorted(c.units.offsets, start, side="right") - 1]
    order = np.argsort(code, kind="stable")
    code, start, doc = code[order], start[order], doc[order]
    string, begin, end, least = (np.concatenate([p[i] for p in spans]).astype(np.int64) for i in range(4))
    head = np.searchsorted(code, string)
    n = np.searchsorted(code, string, side="right") - head
    span = np.repeat(np.arange(len(n)), n)
    place = head[span] + counter(n)
    late = least[span] < doc[place]
    span, place = span[late], place[late]
    base, size = start[place], len(c.units) + 1
    step = np.bincount(base + begin[span], minlength=size)
    step -= np.bincount(base + end[span] + c.plan.k - 1, minlength=size)
    return np.cumsum(step)[:-1] > 0


@dataclass
class Shipment:
    """The chunked documents and the packets of super-k-mers on their way to the buckets."""

    plan: Plan
    docs: DataFrame
    packets: DataFrame


def ship(
    docs: DataFrame,
    k: int,
    m: int,
    words: bool,
    doc_id: Column,
    text: Column,
    chunk_bytes: int = 2 << 20,
    buckets_per_chunk: int = 1,
    hot: int = 20_000,
    places: bool = False,
) -> Shipment:
    """Census and shipping. ``docs`` is read once for its size and once more, whole."""
    spark = docs.sparkSession
    rows = docs.select(doc_id.cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(least, -(-size // chunk_bytes))
    plan = Plan(k, m, words, chunks, buckets_per_chunk * chunks, hot, places)
    # by id and text: neither null ids nor an id that repeats makes a large chunk
    spread = rows.withColumn("row_key", F.xxhash64("doc_id", "text")).select(
        F.pmod("row_key", F.lit(plan.chunks)).alias("chunk"), "row_key", "doc_id", "text"
    )
    asked = spread.groupBy("chunk").applyInArrow(tidy(_census(plan)), PACKET)
    known = asked.groupBy("bucket").applyInArrow(tidy(census_answer(plan.hot)), PACKET)
    shipped = spread.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(tidy(_ship(plan)), PACKET)
    return Shipment(plan, spread, shipped)


def repeated(
    shipment: Shipment,
    least_of: Callable[[Bucket, int], tuple[np.ndarray, np.ndarray]],
    result: Callable[[Chunk, np.ndarray], pa.Table],
    schema: str,
) -> DataFrame:
    """``result(chunk, removed units)`` of each chunk; one row per row of the documents."""
    plan = shipment.plan

    def finish(_key, table: pa.Table, replies: pa.Table) -> pa.Table:
        c = Chunk(table, plan)
        return result(c, removed(c, replies)).take(pa.array(c.place))

    spans = shipment.packets.groupBy("bucket").applyInArrow(tidy(answer_spans(plan, least_of)), PACKET)
    return shipment.docs.groupBy("chunk").cogroup(spans.groupBy("chunk")).applyInArrow(tidy(finish), schema)


def per_document(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums per document; empty ones are 0."""
    sums = np.r_[0, np.cumsum(values.astype(np.int64))]
    return sums[offsets[1:]] - sums[offsets[:-1]]


def each(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    return zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
