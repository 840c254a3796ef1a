"""The order of windows that removal is read from, against plain sorting."""

from __future__ import annotations

import numpy as np
import pytest

from starlode.llm import suffixes
from starlode.llm.superkmers import Bucket


def _bucket(strings: list[bytes], docs: list[int]) -> Bucket:
    offsets = np.r_[0, np.cumsum([len(s) for s in strings])].astype(np.int64)
    number, ids = np.arange(len(strings)), np.array(docs, np.int64)
    return Bucket(np.frombuffer(b"".join(strings), np.uint8), offsets, number, ids, ids, number, number)


@pytest.mark.parametrize("k", [3, 8, 11, 50])
def test_least_documents_sort_windows_only(monkeypatch, k):
    def whole(*_):
        raise AssertionError("suffixes under the length of a window are sorted as well")

    monkeypatch.setattr(suffixes, "suffix_array", whole)
    pick = np.random.default_rng(k)
    base = pick.choice([0, 97, 98, 255], 200).astype(np.uint8).tobytes()
    strings = [base[i : i + k + int(pick.integers(0, 30))] for i in pick.integers(0, 120, 80)]
    strings += [b"a" * (k + 40), b"ab" * k, base[:k]]
    docs = pick.permutation(len(strings)).tolist()
    least, windows = {}, []
    for s, doc in zip(strings, docs, strict=True):
        windows += [s[i : i + k] for i in range(len(s) - k + 1)]
        for w in {s[i : i + k] for i in range(len(s) - k + 1)}:
            least[w] = min(least.get(w, doc), doc)
    _, got = suffixes.least_documents(_bucket(strings, docs), k)
    assert got.tolist() == [least[w] for w in windows]


def test_sorted_windows_are_in_the_order_of_their_bytes():
    pick = np.random.default_rng(5)
    text = pick.integers(97, 99, 3000).astype(np.uint8)
    starts = np.arange(len(text) - 49)
    order, new = suffixes.sorted_windows(text, starts, 12)
    raw = text.tobytes()
    found = [raw[i : i + 12] for i in starts[order]]
    assert found == sorted(found)
    assert new.tolist() == [True] + [a != b for a, b in zip(found, found[1:], strict=False)]
    assert [len(a) for a in suffixes.sorted_windows(text, starts[:0], 12)] == [0, 0]
