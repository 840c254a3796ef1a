"""Band keys of lines against a plain computation of every minimum."""

from __future__ import annotations

import numpy as np

from starlode.llm import lines


def test_least_values_of_runs_of_every_length():
    rng = np.random.default_rng(1)
    counts = np.array([1, 2, 31, 32, 33, 64, 65, 200, 5000, 1])
    gaps = np.arange(len(counts)) % 9
    grams = rng.integers(0, 1 << 32, int((counts + gaps).sum()), np.uint32)
    heads = np.cumsum(counts + gaps) - counts - gaps  # what lies between runs takes part nowhere
    least = lines._least(grams, heads, counts)
    assert least.shape == (len(counts), lines.ROWS * lines.BANDS)
    for h, n, row in zip(heads, counts, least, strict=True):
        assert [int((grams[h : h + n] * f).min()) for f in lines._factors()] == row.tolist()


def test_keys_do_not_depend_on_the_lines_beside(monkeypatch):
    some = ["a", "kurz", "x" * 9, "zeile " * 7, "é😀" * 300, "y" * 70_000 + "z", "\ud800 lone", "b" * 40]
    together = lines.band_keys(some, lines.SHINGLE)
    monkeypatch.setattr(lines, "_PIECE", 50)
    assert np.array_equal(together, lines.band_keys(some, lines.SHINGLE))
    assert np.array_equal(together, np.vstack([lines.band_keys([x], lines.SHINGLE) for x in some]))
    assert lines.band_keys([], lines.SHINGLE).shape == (0, lines.BANDS)
