"""Lines are hashed once, and go only to meetings where they have a pair to compare."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from starlode.llm import lines

NAMES = {"id": "id", "digest": "digest", "text": "text", "chunk": "chunk"}


def _chunk(number: int, texts: list[str | None]) -> pa.Table:
    n = len(texts)
    return pa.table({"id": range(n), "digest": range(n), "text": texts, "chunk": [number] * n})


def _told(chunks: list[pa.Table]) -> dict[int, pa.Table]:
    asked = pa.concat_tables([lines._census(NAMES, lines.SHINGLE, 3)(x) for x in chunks])
    buckets = [asked.filter(pa.compute.equal(asked["bucket"], b)) for b in range(3)]
    known = pa.concat_tables([lines._answer(x) for x in buckets if x.num_rows])
    return {n: known.filter(pa.compute.equal(known["chunk"], n)) for n in range(len(chunks))}


def test_shared_keys_are_told_by_place(monkeypatch):
    long = "the quick brown fox jumps over the lazy dog, " * 4
    rows = [[f"{long}one\nown line of the first\n\n \n", None, "twice here"], [f"{long}two\nalone", "twice here\ntwice here"]]
    chunks = [_chunk(n, x) for n, x in enumerate([*rows, [None, ""]])]
    told = _told(chunks)
    every = [x for table in rows for text in table for x in (text or "").split("\n") if x.strip()]
    keys = dict(zip(every, lines.band_keys(every, lines.SHINGLE).tolist(), strict=True))
    monkeypatch.setattr(lines, "band_keys", None)  # shipping hashes no line again
    for n, table in enumerate(chunks):
        turned = table.take(list(range(table.num_rows))[::-1])  # rows may come in another order
        shipped = lines._ship(NAMES)(None, turned, told[n])
        got = {r["text"]: r["keys"] for r in shipped.to_pylist()}
        here = {x for text in table["text"].to_pylist() for x in (text or "").split("\n") if x.strip()}
        for line in here:
            others = [x for x in every if x != line]
            common = [16 * k + b for b, k in enumerate(keys[line]) if every.count(line) > 1 or k in sum((keys[x] for x in others), [])]
            assert got.get(line, []) == common
        assert set(got) <= here
    assert lines._ship(NAMES)(None, chunks[0].slice(0, 0), told[0]).num_rows == 0


def test_keys_and_places_come_back_from_payloads():
    places = np.array([0, 1, 255, 256, 70_000, 70_001, 1 << 30, 3, 1 << 31, 7])
    keys = np.arange(len(places), dtype=np.uint64) * np.uint64(0x123456789AB)
    starts = np.array([0, 7, 9])
    payloads = lines._payloads(keys, places, starts, np.array([7, 9, 10]))
    found, at, sizes = lines._opened(payloads)
    assert (found.tolist(), at.tolist(), sizes.tolist()) == (keys.tolist(), places.tolist(), [7, 2, 1])
    assert lines._payloads(keys[:0], places[:0], starts[:0], starts[:0]) == []


def test_only_lines_with_a_pair_go_to_a_meeting(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(lines, "_FEW", 6)
    owned = [[int(rng.integers(1, 6)) * 16 + int(b) for b in np.sort(rng.choice(12, 6, False))] for _ in range(60)]
    rows = sorted((k, 0, 0, 0, bytes([i]), owned[i]) for i in range(60) for k in owned[i])
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
    names = ("key", "block", "other", "side", "line", "keys")
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    want = set()
    for k, *_, line, mine in rows:
        group = [r for r in rows if r[0] == k]
        pairs = [r for r in group if r[4] != line and min({*mine} & {*r[5]}) == k]
        if pairs or len(group) > 6:
            want.add((k, line))
    for size in (1, 7, 1000):
        kept = pa.Table.from_batches(lines._with_pairs(iter(table.to_batches(size))))
        assert kept.column_names == list(names[:-1])
        got = list(zip(kept["key"].to_pylist(), kept["line"].to_pylist(), strict=True))
        assert len(got) == len(want) and set(got) == want
    assert 0 < len(want) < len(rows)
    assert not list(lines._with_pairs(iter([])))
