"""Language ID with language-bitmask n-gram filters.

All languages share the rows of one bit-sliced Bloom filter: a row holds one bit per language,
so the conjunction of an n-gram's rows is the set of languages that (seem to) contain it. A
text's n-grams are counted per language by those bits, the counts are corrected for each
language's rate of false positives, and the largest wins.

The filter is fitted on a bounded sample of labelled rows (``sample_docs`` of each language). A language holds
the n-grams that make up at least ``share`` of its n-grams of one length, hence at most
1 / ``share`` of them: the model's size depends on the number of languages alone.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlode.llm.simhash import pieces
from starlode.llm.units import gram_hash, mixed, prefix_hash, text_bytes
from starlode.sources import materialize

SIZES = (3, 5)
SHARE = 2e-5
SAMPLE_DOCS = 5_000
ROWS = 1 << 20
HASHES = 3
UNKNOWN = "und"
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)


def grams(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length: the n-gram hashes of all texts and the text of each.

    Letters are ASCII ones in lower case and all other UTF-8 bytes; the rest reads as a
    blank, and n-grams with two blanks in a row are left out.
    """
    data, offsets = text_bytes(texts)
    owner = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    letters = _LETTERS[data]
    gaps = np.zeros(len(letters) + 1, np.int64)
    if len(letters):
        np.cumsum((letters[1:] == 32) & (letters[:-1] == 32), out=gaps[2:])
    sums = prefix_hash(letters.astype(np.uint64) + np.uint64(1))
    for n in SIZES:
        h = gram_hash(sums, n)
        whole = (owner[n - 1 :] == owner[: len(h)]) & (gaps[n:] == gaps[1 : len(h) + 1])
        yield n, h[whole] ^ np.uint64(n), owner[: len(h)][whole]


def _rows(h: np.ndarray, rows: int) -> Iterator[np.ndarray]:
    """The rows of each hash: double hashing from its halves."""
    a, b = h & np.uint64(0xFFFFFFFF), mixed(h.copy()) | np.uint64(1)
    for i in range(HASHES):
        yield ((a + np.uint64(i) * b) % np.uint64(rows)).astype(np.int64)


@dataclass
class Model:
    """``words[r, w]`` has bit l % 64 of word l // 64 set if language l uses row r."""

    languages: list[str]
    words: np.ndarray
    false_rate: np.ndarray

    @classmethod
    def of(cls, held: dict[str, np.ndarray], rows: int) -> Model:
        names = sorted(held)
        words = np.zeros((rows, -(-len(names) // 64) or 1), np.uint64)
        rate = np.zeros(len(names))
        for i, name in enumerate(names):
            for at in _rows(held[name].view(np.uint64), rows):
                words[at, i // 64] |= np.uint64(1) << np.uint64(i % 64)
            used = (words[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            rate[i] = used.mean() ** HASHES
        return cls(names, words, rate)

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text, and how many of them each language contains, corrected."""
        total = np.zeros(len(texts))
        seen = np.zeros((len(texts), len(self.languages)))
        for _, h, owner in grams(texts):
            total += np.bincount(owner, minlength=len(texts))
            for w in range(self.words.shape[1]):
                mask = np.full(len(h), 0xFFFFFFFFFFFFFFFF, np.uint64)
                for at in _rows(h, len(self.words)):
                    mask &= self.words[at, w]
                for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                    bit = (mask >> np.uint64(i % 64)) & np.uint64(1) != 0
                    seen[:, i] += np.bincount(owner[bit], minlength=len(texts))
        seen = (seen - total[:, None] * self.false_rate) / np.maximum(1 - self.false_rate, 1e-9)
        return total, np.maximum(seen, 0)


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    share: float = SHARE,
    rows: int = ROWS,
) -> Model:
    """A model from rows with text and language: at most about ``sample_docs`` of each language.

    A language with fewer rows gives all of them, however large the table is. Rows are picked by
    id and text, null ids like any other.
    """
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    usable = usable.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    # written, the counts are as small as they are, and no text is shuffled to meet them
    totals = materialize(usable.groupBy(F.col("lang").alias("_lang")).agg(F.count("*").alias("_rows")), "languages")
    share_of_rows = (F.lit(float(sample_docs)) / F.col("_rows") * (1 << 30)).cast("long")
    usable = usable.join(totals, F.col("lang") == F.col("_lang"))
    usable = usable.where(F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < share_of_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = defaultdict(list)

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            h, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return h, np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)

        for batch in batches:
            for piece in pieces(batch, "text"):
                langs = np.array(piece.column("lang").to_pylist(), object)
                for n, h, owner in grams(piece.column("text")):
                    for lang in set(langs.tolist()):
                        own, times = np.unique(h[(langs == lang)[owner]], return_counts=True)
                        parts = held[lang, n]
                        parts.append((own, times))
                        if len(parts) > 16:
                            held[lang, n] = [merged(parts)]
        for (lang, n), parts in held.items():
            h, times = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(h)), pa.array(np.full(len(h), n, np.int32)), pa.array(h.view(np.int64)), pa.array(times)],
                ["lang", "n", "gram", "times"],
            )

    counted = usable.select("lang", "text").mapInArrow(count, "lang string, n int, gram long, times long")
    counted = counted.groupBy("lang", "n", "gram").agg(F.sum("times").alias("times"))
    sums = counted.groupBy(F.col("lang").alias("_lang"), F.col("n").alias("_n")).agg(F.sum("times").alias("all"))
    often = counted.join(sums, (F.col("lang") == F.col("_lang")) & (F.col("n") == F.col("_n")))
    # at most 1 / share rows for each language and length
    often = often.where(F.col("times") >= F.lit(share) * F.col("all")).select("lang", "gram").toArrow()
    langs = np.array(often.column("lang").to_pylist(), object)
    codes = often.column("gram").to_numpy()
    return Model.of({name: codes[langs == name] for name in set(langs.tolist())}, rows)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: one row per row of ``docs``, ids as they are.

    ``und`` with score 0 is the answer to null texts, texts without a letter and an empty
    model. Ties go to the language that comes first. The score is the share of the text's
    n-grams that the language contains, of very long texts as well; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.words, model.false_rate))
    text = F.coalesce(F.col(text_col), F.lit(""))
    kind = dict(docs.dtypes)[id_col]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        names = np.array([*known.languages, UNKNOWN], object)
        for batch in batches:
            for piece in pieces(batch, "text"):
                best = np.full(piece.num_rows, len(known.languages))
                score = np.zeros(piece.num_rows)
                lettered = piece.column("lettered").to_numpy(zero_copy_only=False)
                if known.languages and lettered.any():
                    total, seen = known.counts(piece.column("text"))
                    best[lettered] = seen.argmax(axis=1)[lettered]
                    score[lettered] = np.clip(seen.max(axis=1) / np.maximum(total, 1), 0, 1)[lettered]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"],
                )

    return docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), text.rlike(r"\p{L}").alias("lettered")
    ).mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
