"""Suffix-array dedup: maximal repeats of bytes between documents, with all occurrences.

Equal windows of 50 bytes meet in a bucket (see :mod:`starlode.llm.superkmers`). There the
suffixes of the strings are sorted by prefix doubling, common prefixes of neighbours give the
enhanced suffix array, and its tree of common-prefix intervals follows. An interval
whose suffixes differ in the byte before them is a maximal repeat and is put out with all its
occurrences; one that could be extended to the left as a whole is left out, as a longer repeat
covers it. A repeat is maximal within the strings of its bucket; longer ones between documents
appear as repeats that overlap by 49 bytes. What to remove follows from the roots of the tree,
for which an array of the suffixes of 50 bytes or more, sorted by these bytes, is enough.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlode.llm.superkmers import NO_ID, Bucket, Chunk, counter, each, per_document, repeated, ship, unpack

LENGTH = 50
GRAM = 24
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
_STEPS = 200  # steps that all values go at once
_STEP = 7  # bytes of a sort key; its last byte holds how many are real


def _keys(data: np.ndarray, ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Seven bytes from each position on, cut at the end of its string, and their number."""
    padded = np.r_[data, np.zeros(_STEP, np.uint8)]
    real = np.minimum(ends - at, _STEP)
    key = np.zeros(len(at), np.uint64)
    everywhere = len(at) == len(data)  # then ``at`` counts on from 0
    for i in range(_STEP):
        byte = padded[i : i + len(at)] if everywhere else padded[np.minimum(at + i, len(data))]
        byte = byte.astype(np.uint64)
        byte[real <= i] = 0
        key = (key << np.uint64(8)) | byte
    return (key << np.uint64(8)) | real.astype(np.uint64)


def suffix_array(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Positions in the order of their suffixes, which stop at the ends of their strings.

    Also (length, ranks) per round of the doubling: positions of equal rank have the same
    ``length`` bytes, or the same suffix if that is shorter.
    """
    n = len(data)
    key = _keys(data, ends, np.arange(n))
    order = np.argsort(key, kind="stable")
    length, slots, rounds = _STEP, np.arange(n), []
    rank = np.zeros(n, np.int32)
    key = key[order]
    while len(slots):
        new = np.r_[True, key[1:] != key[:-1]]
        head = np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))
        at = order[slots]
        rank[at] = slots[head]
        rounds.append((length, rank.copy()))
        tied = ~(new & np.r_[new[1:], True]) & (ends[at] - at >= length)
        # members that end before this length all do, at the same place: they are equal
        slots = slots[tied]
        at = order[slots]
        further = at + length
        second = np.where(further < ends[at], rank[np.minimum(further, n - 1)] + 1, 0)
        # the pair as one number: ranks are slots, so both parts are below n + 1
        key = rank[at].astype(np.uint64) * np.uint64(n + 1) + second.astype(np.uint64)
        by = np.argsort(key, kind="stable")
        order[slots], key = at[by], key[by]
        length *= 2
    return order, rounds


def common_prefixes(
    data: np.ndarray, ends: np.ndarray, order: np.ndarray, rounds: list[tuple[int, np.ndarray]], least: int
) -> np.ndarray:
    """Bytes each suffix shares with the one before it; 0 where that is under ``least``."""
    out = np.zeros(len(order), np.int64)
    a, b = order[:-1], order[1:]
    most = np.minimum(ends[a] - a, ends[b] - b)
    some = np.flatnonzero(most >= least)
    a, b, most = a[some], b[some], most[some]
    depth = np.zeros(len(some), np.int64)
    for length, rank in reversed(rounds):
        inside = depth < most
        x, y = np.where(inside, a + depth, 0), np.where(inside, b + depth, 0)
        depth += length * (inside & (rank[x] == rank[y]))
    rest = np.flatnonzero(depth < most)
    x, y = (_keys(data, ends[p[rest]], p[rest] + depth[rest]) for p in (a, b))
    differ = x ^ y
    for i in range(_STEP):
        depth[rest] += differ >> np.uint64(8 * (_STEP - i)) == 0
    depth = np.minimum(depth, most)
    out[some + 1] = np.where(depth >= least, depth, 0)
    return out


def _nearest(values: np.ndarray, equal: bool) -> np.ndarray:
    """For each value the place of the nearest before it that is less (or ``equal``), else -1.

    All values look at once. One that looks at a greater value goes on to where that one looks, as
    all between are greater still. Few steps are enough unless intervals are nested deep, as in
    periodic text; what is open then is left to a scan with a stack, which is linear.
    """
    padded = np.r_[-1, values]
    at = np.arange(len(values) + 1, dtype=np.int32) - 1
    at[0] = 0
    open_ = np.arange(1, len(padded), dtype=np.int32)
    for _ in range(_STEPS):
        seen, own = padded[at[open_]], padded[open_]
        open_ = open_[seen > own if equal else seen >= own]
        if not len(open_):
            return at[1:] - 1
        at[open_] = at[at[open_]]
    found, stack, plain = [], [0], padded.tolist()
    for i, own in enumerate(plain[1:], 1):
        while plain[stack[-1]] > own or (not equal and plain[stack[-1]] == own):
            stack.pop()
        found.append(stack[-1] - 1)
        stack.append(i)
    return np.array(found, np.int32)


def intervals(lcp: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Rows (length, first slot, last slot, left-diverse, outermost) of the interval tree.

    A slot's interval reaches to the nearest smaller prefixes on both sides; the first slot of
    equal ones stands for it.
    ``left`` is the byte before a suffix, or -1 at the start of a string, which differs from all.
    """
    if not lcp.any():
        return np.zeros((0, 5), np.int64)
    # prefixes of length 0 part the tree into runs, and nothing of them is in it
    before = _nearest(lcp, True)
    chosen = np.flatnonzero((lcp > 0) & (before >= 0) & (lcp[before] < lcp))
    after = len(lcp) - 1 - _nearest(lcp[::-1], False)[::-1]
    first, behind = before[chosen].astype(np.int64), after[chosen].astype(np.int64)
    # a run of equal bytes has no change in it, and no start of a string
    change = np.r_[0, np.cumsum((left[1:] != left[:-1]) | (left[1:] == -1))]
    diverse = (change[behind - 1] > change[first]) | (left[first] == -1)
    outermost = (lcp[first] == 0) & (np.r_[lcp, 0][behind] == 0)
    return np.column_stack([lcp[chosen], first, behind - 1, diverse, outermost]).astype(np.int64)


class Repeats:
    """The enhanced suffix array of a bucket and its tree of common-prefix intervals."""

    def __init__(self, b: Bucket, k: int):
        n = np.diff(b.offsets)
        self.owner = np.repeat(np.arange(len(n), dtype=np.int32), n)
        ends = np.repeat(b.offsets[1:].astype(np.int32), n)
        self.order, rounds = suffix_array(b.data, ends)
        lcp = common_prefixes(b.data, ends, self.order, rounds, k)
        left = np.r_[-1, b.data[:-1].astype(np.int64)]
        left[b.offsets[:-1]] = -1
        self.tree = intervals(lcp, left[self.order])

    def members(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the chosen intervals: lengths, number of members, and positions of all members."""
        length, first, last = self.tree[chosen, :3].T
        sizes = last - first + 1
        return length, sizes, self.order[np.repeat(first, sizes) + counter(sizes)]


def sorted_windows(data: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``starts``, of ``k`` bytes or more, in the order of their first ``k`` bytes.

    Returns numbers into ``starts``, and where one does not share ``k`` bytes with the one before.
    Every pass sorts what is still tied by its group and the next bytes, together in one number.
    """
    padded = np.r_[data, np.zeros(8, np.uint8)]
    words = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))  # eight bytes from each place on
    n = len(starts)
    order, new, slots = np.arange(n), np.arange(n) == 0, np.arange(n)
    group, n_groups, depth = np.zeros(n, np.uint64), 1, 0
    while depth < k and len(slots):
        step = min((64 - (n_groups - 1).bit_length()) // 8, k - depth)
        own = order[slots]
        key = words[starts[own] + depth].astype(np.uint64) >> np.uint64(64 - 8 * step)
        if n_groups > 1:
            key |= group << np.uint64(8 * step)
        by = np.argsort(key)
        order[slots], key = own[by], key[by]
        heads = np.r_[True, key[1:] != key[:-1]]
        new[slots] |= heads
        tied = ~(heads & np.r_[heads[1:], True])
        slots, heads = slots[tied], heads[tied]
        n_groups = int(np.count_nonzero(heads))
        group = (np.cumsum(heads) - 1).astype(np.uint64)
        depth += step
    return order, new


def least_documents(b: Bucket, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The least document of every window.

    A window's occurrences are the members of the outermost interval of ``k`` bytes or more its
    suffix lies in; inner intervals, longer repeats, have a part of them. So the suffix array needs
    neither suffixes under ``k`` bytes nor any order beyond ``k``, and the outermost intervals are
    its runs of ``k`` equal bytes. A window alone in its run stands in one string only.
    """
    of_string = b.first_doc()
    n = np.diff(b.offsets) - k + 1
    first = np.r_[0, np.cumsum(n)]
    order, new = sorted_windows(b.data, np.repeat(b.offsets[:-1], n) + counter(n), k)
    least = np.repeat(of_string, n)
    heads, owned = np.flatnonzero(new), least[order]
    if len(heads):
        sizes = np.diff(np.r_[heads, len(order)])
        least[order] = np.repeat(np.minimum.reduceat(owned, heads), sizes)
    return first, least


def _kept_bytes(c: Chunk, gone: np.ndarray) -> pa.Table:
    u = c.units
    heads = gone.copy()
    heads[1:] &= ~gone[:-1]
    inner = u.offsets[:-1][u.counts() > 0]
    heads[inner] = gone[inner]
    kept = [u.data[s:e][~gone[s:e]].tobytes() for s, e in each(u.offsets)]
    return pa.table(
        {
            "doc_id": pa.array(c.ids, mask=c.ids == NO_ID),
            "n_bytes": pa.array(u.counts().astype(np.int64)),
            "n_removed": pa.array(per_document(gone, u.offsets)),
            "n_spans": pa.array(per_document(heads, u.offsets)),
            "kept": pa.array(kept, pa.binary()),
        }
    )


def suffix_dedup(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: one row per row of ``docs``.

    A byte goes if a string of ``length`` bytes over it also starts in a document with a
    smaller id; strings are judged on the input and may overlap. ``kept`` holds the bytes
    left, which need not be valid UTF-8. Null texts are empty, texts shorter than ``length``
    stay whole. Null ids come after all others and equal ids are one document, so neither loses
    bytes to its like; repeated rows each give a row. Very long texts are treated like others,
    whole; an empty table gives no rows. Only the two named columns are read.
    """
    shipment = ship(docs, length, gram, False, F.col(id_col), F.col(text_col), buckets_per_chunk=2)
    return repeated(shipment, least_documents, _kept_bytes, SCHEMA)


def _groups_of(k: int) -> Callable[[pa.Table], pa.Table]:
    def groups(table: pa.Table) -> pa.Table:
        parts = [unpack(p) for p in table.column("payload").to_pylist()]
        b = Bucket.of(table.column("chunk").to_pylist(), parts)
        times, docs, starts = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (5, 6, 7))
        string = np.repeat(b.string, times)
        r, bucket = Repeats(b, k), table.column("bucket")[0].as_py()
        length, sizes, at = r.members(r.tree[:, 3] == 1)
        by_string = np.argsort(string, kind="stable")
        places = np.bincount(string, minlength=len(b.offsets) - 1)
        begin = np.cumsum(places) - places
        # a string that stands at several places is a repeat, too, if no interval is as long
        long = np.repeat(length, sizes)
        full = np.zeros(len(places), bool)
        full[r.owner[at[(at == b.offsets[r.owner[at]]) & (long == np.diff(b.offsets)[r.owner[at]])]]] = True
        whole = np.flatnonzero((places > 1) & ~full)
        number = np.r_[np.repeat(np.arange(len(sizes)), sizes), len(sizes) + np.arange(len(whole))]
        length = np.r_[length, np.diff(b.offsets)[whole]]
        at = np.r_[at, b.offsets[whole]].astype(np.int64)
        owner = r.owner[at].astype(np.int64)
        times = places[owner]
        place = by_string[np.repeat(begin[owner], times) + counter(times)]
        number, start = np.repeat(number, times), np.repeat(at - b.offsets[owner], times)
        doc = docs[place]
        return pa.table(
            {
                "bucket": pa.array(np.full(len(place), bucket, np.int64)),
                "repeat": pa.array(number.astype(np.int64)),
                "length": pa.array(length[number].astype(np.int64)),
                "doc_id": pa.array(doc, mask=doc == NO_ID),
                "start": pa.array(starts[place] + start),
            }
        )

    return groups


def maximal_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """bucket, repeat, length, doc_id, start: one row per occurrence of each maximal repeat.

    (bucket, repeat) names a repeat of ``length`` bytes, ``start`` is its first byte in the
    document. Repeats within one document are listed if another document shares part of them.
    Null texts have no repeats, null ids stay null, and an empty table gives no rows.
    Periodic text has nested repeats: one of n bytes has about n of them, with n ** 2 places.
    """
    shipment = ship(docs, length, gram, False, F.col(id_col), F.col(text_col), buckets_per_chunk=2, places=True)
    schema = "bucket long, repeat long, length long, doc_id long, start long"
    return shipment.packets.groupBy("bucket").applyInArrow(_groups_of(length), schema)
