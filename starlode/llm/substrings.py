"""Substring dedup by super-k-mer partitioning: word windows that an earlier document has."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlode.llm.superkmers import NO_ID, Bucket, Chunk, each, per_document, repeated, ship

WINDOW = 13
GRAM = 5
SCHEMA = "doc_id long, n_words long, n_removed long, kept string"


def sorted_windows(b: Bucket, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``k`` words by sorting their texts; equal neighbours share the least document."""
    blank = b.data == 32
    starts = np.union1d(np.flatnonzero(blank) + 1, b.offsets[:-1])
    n_words = np.diff(np.searchsorted(starts, b.offsets))
    stops = np.r_[starts[1:] - 1, len(b.data)]
    last = np.searchsorted(starts, b.offsets[1:]) - 1
    stops[last] = b.offsets[1:]
    first = np.r_[0, np.cumsum(n_words - k + 1)]
    string = np.repeat(np.arange(len(n_words)), n_words - k + 1)
    word = np.arange(first[-1]) - first[string] + np.searchsorted(starts, b.offsets[:-1])[string]
    raw = b.data.tobytes()
    texts = pa.array(
        [raw[s:e] for s, e in zip(starts[word].tolist(), stops[word + k - 1].tolist(), strict=True)],
        pa.large_binary(),
    )
    order = pc.sort_indices(texts).to_numpy().astype(np.int64)
    inorder = texts.take(pa.array(order))
    change = pc.not_equal(inorder[1:], inorder[:-1]).to_numpy(zero_copy_only=False)
    heads = np.flatnonzero(np.r_[True, change])
    docs = b.first_doc()[string[order]]
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(docs, heads), np.diff(np.r_[heads, len(order)]))
    return first, least


def _kept_words(c: Chunk, gone: np.ndarray) -> pa.Table:
    u, texts = c.units, []
    stay = np.repeat(~gone, u.end - u.begin + 1)
    raw = u.data
    for s, e in each(u.offsets):
        part = slice(u.begin[s], u.end[e - 1] + 1) if e > s else slice(0, 0)
        texts.append(raw[part][stay[part]][:-1].tobytes().decode())
    ids = pa.array(c.ids, mask=c.ids == NO_ID)
    return pa.table(
        {
            "doc_id": ids,
            "n_words": pa.array(u.counts().astype(np.int64)),
            "n_removed": pa.array(per_document(gone, u.offsets)),
            "kept": pa.array(texts, pa.string()),
        }
    )


def substring_dedup(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, n_removed, kept: one row per row of ``docs``.

    A word goes if a window of ``window`` words that covers it also starts in a document with
    a smaller id; windows are judged on the input. ``kept`` joins the words left by blanks.
    Null texts have no words; texts shorter than a window keep all. Null ids come after all
    others and equal ids are one document, so neither loses words to its like; repeated rows
    each give a row. Very long texts are cut into the same windows as others; an empty table
    gives no rows. Only the two named columns are read.
    """
    shipment = ship(docs, window, gram, True, F.col(id_col), F.col(text_col))
    return repeated(shipment, sorted_windows, _kept_words, SCHEMA)

