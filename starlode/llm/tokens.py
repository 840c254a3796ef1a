"""Token counts by a two-tier lookup in the tasks that read the texts.

The vocabulary files meant here drop white space before anything else could cross it, so the
tokens of a text are those of its pre-tokens, the runs between ASCII white space. A first pass
finds the pre-tokens that are frequent in all of the corpus: each task keeps a bounded summary
(Misra-Gries), and summaries, not pre-tokens, are merged a few at a time. Their lengths in tokens
are broadcast as one packed table. The second pass looks every pre-token up there, then in the
worker's own cache; what both lack is encoded by the vocabulary's library.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlode.llm.simhash import pieces
from starlode.llm.units import give_back, tidy
from starlode.sources import materialize

#: Pre-tokens of the broadcast table, and the bytes of one that table and caches may hold: the
#: table is 8.5 MB at most, whatever the corpus.
TABLE = 1 << 17
LONGEST = 62
#: Pre-tokens that a worker remembers besides.
CACHE = 1 << 18
LIMIT = 2048
_MERGED = 16  # summaries that are merged at a time
_SEGMENT = 1 << 20  # bytes of a long text that are cut at a time
_GAP = re.compile(rb"[\x20\x09-\x0D]")
#: Fixed value: the file's split pattern, for lower-case ASCII.
_ASCII = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0Da-z0-9]+")
_VISIBLE = re.compile(rb"[\x21-\x7E]+").fullmatch
#: Fixed value: the split pattern that makes a vocabulary file fit for this operator.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def read_definition(path: str) -> str:
    """The text of a vocabulary file, checked to be of the kind this operator can cut."""
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    parts = json.loads(definition)
    kinds = [x["type"] for x in (parts["normalizer"] or {}).get("normalizers", [])]
    cut = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    pattern = cut.get("pattern", {}).get("Regex")
    if kinds != ["NFC", "Replace", "Lowercase"] or (pattern, cut.get("behavior")) != (SPLIT, "Removed"):
        raise ValueError(f"{path} does not drop white space before it splits")
    return definition


def segments(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end at white space; a part is lower-cased if that is safe."""
    begin = 0
    while begin < len(text):
        gap = _GAP.search(text, begin + _SEGMENT) if len(text) - begin > _SEGMENT else None
        end = gap.end() if gap else len(text)
        part = text[begin:end] if end - begin < len(text) else text
        # special strings count as such only as they are spelled; other letters compose first
        yield part.lower() if part.isascii() and b"<|" not in part else part
        begin = end


class Frequent:
    """Counts of frequent pre-tokens, short of the truth by at most n / ``size`` for n in all."""

    def __init__(self, size: int):
        self.size, self.counts = size, Counter()

    def add(self, words: Iterable[bytes]) -> None:
        self.counts.update(words)
        if len(self.counts) > 4 * self.size:
            self.cut()

    def cut(self) -> None:
        for word in [w for w in self.counts if len(w) > LONGEST]:
            del self.counts[word]
        if len(self.counts) > self.size:
            n = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            less = int(np.partition(n, len(n) - self.size - 1)[len(n) - self.size - 1])
            self.counts = Counter({w: c - less for w, c in self.counts.items() if c > less})

    def packed(self) -> tuple[bytes, bytes]:
        self.cut()
        return b" ".join(self.counts), np.fromiter(self.counts.values(), np.int64, len(self.counts)).tobytes()

    def merge(self, words: bytes, counts: bytes) -> None:
        self.counts.update(dict(zip(words.split(), np.frombuffer(counts, np.int64).tolist(), strict=True)))


_SUMMARY = "number int, words binary, counts binary"


def _summary(number: int, f: Frequent) -> dict[str, pa.Array]:
    words, counts = f.packed()
    return {"number": pa.array([number], pa.int32()), "words": pa.array([words]), "counts": pa.array([counts])}


def frequent(texts: DataFrame, size: int = TABLE) -> tuple[bytes, np.ndarray]:
    """The frequent pre-tokens of the binary column ``text``, joined by blanks, with their counts.

    All that make up more than 2 / ``size`` of the corpus are among them, at most ``size`` in all.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, number = Frequent(size), 0
        for batch in batches:
            for piece in pieces(batch, "text"):
                number = piece.column("number")[0].as_py()
                for text in piece.column("text").to_pylist():
                    for part in segments(text):
                        found.add(part.split())
        yield pa.RecordBatch.from_pydict(_summary(number, found))
        del found
        give_back()

    def merge(table: pa.Table) -> pa.Table:
        found = Frequent(size)
        for words, counts in zip(*(table.column(c).to_pylist() for c in ("words", "counts")), strict=True):
            found.merge(words, counts)
        return pa.table(_summary(table.column("number")[0].as_py(), found))

    told = texts.select(F.spark_partition_id().alias("number"), "text").mapInArrow(count, _SUMMARY)
    told = materialize(told, "frequent")
    groups = max(told.count(), 2)
    while groups > 1:
        groups = -(-groups // _MERGED)
        merged = told.withColumn("of", F.pmod("number", F.lit(groups))).groupBy("of")
        told = materialize(merged.applyInArrow(tidy(merge), _SUMMARY), "frequent")
    row = told.first()
    if row is None:
        return b"", np.zeros(0, np.int64)
    return bytes(row["words"]), np.frombuffer(row["counts"], np.int64)


class Lookup:
    """Lengths of pre-tokens: the table, the cache, then the library."""

    def __init__(self, definition: str, words: bytes = b"", lengths: bytes = b""):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.table = dict(zip(words.split(), np.frombuffer(lengths, np.uint16).tolist(), strict=True))
        self.most = len(self.table) + CACHE

    def encoded(self, words: list[bytes]) -> list[int]:
        """Lengths of pre-tokens, by the library's whole way from text to tokens."""
        texts = [w.decode("utf-8", "replace") for w in words]
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: set[bytes]) -> dict[bytes, int]:
        """The lengths of pre-tokens that are not known yet.

        Those of visible ASCII are split by the file's pattern, which leaves nothing to do but the
        library's merges, since such letters stand for themselves.
        """
        table, merge = self.table, self.tokenizer.model.tokenize
        plain = [w for w in words if _VISIBLE(w) and b"<|" not in w]
        rest = list(words.difference(plain))
        known = dict(zip(rest, self.encoded(rest), strict=True))
        for w in plain:
            total = 0
            for p in _ASCII.findall(w.lower()):
                n = known.get(p) or table.get(p)
                if n is None:
                    n = known[p] = len(merge(p.decode()))
                total += n
            known[w] = total
        if len(table) > self.most:  # the cache is full: it starts anew behind the table
            for w in list(table)[self.most - CACHE :]:
                del table[w]
        table.update((w, n) for w, n in known.items() if len(w) <= LONGEST)
        return known

    def counts(self, texts: list[bytes]) -> list[int]:
        """The tokens of each text."""
        totals, missed, new = [0] * len(texts), [], set()

        def settle() -> None:
            lengths = self.learn(new)
            for i, words in missed:
                totals[i] += sum(map(lengths.__getitem__, words))
            missed.clear()
            new.clear()

        for i, text in enumerate(texts):
            for part in segments(text):
                words = part.split()
                found = list(map(self.table.get, words))
                if None in found:
                    missing = [w for w, n in zip(words, found, strict=True) if n is None]
                    missed.append((i, missing))
                    new.update(missing)
                    totals[i] += sum(n for n in found if n is not None)
                    if len(new) >= CACHE // 8:
                        settle()
                else:
                    totals[i] += sum(found)
        settle()
        return totals


def _lookup(shared: dict[str, Any]) -> Lookup:
    """The lookup of this worker; it lives as long as the broadcast value does."""
    if "lookup" not in shared:
        shared["lookup"] = Lookup(shared["definition"], shared["words"], shared["lengths"])
    return shared["lookup"]


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = TABLE,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``, ids as they are.

    ``vocabulary`` is the path of a tokenizer file on the driver; executors get its contents.
    Tokens are counted over the whole text, without added, begin or end tokens; a special string
    inside a text is one token, as by the library's default. Null and empty texts have no bytes
    and no tokens, so a corpus of them, or an empty table, broadcasts an empty table. Long texts
    are cut at white space and added up. Rows that repeat each give a row, null ids stay null, and
    only the two named columns are read.
    """
    definition = read_definition(vocabulary)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    words, _ = frequent(docs.select(text.alias("text")), size)
    known = Lookup(definition).learn(set(words.split()))
    lengths = np.array([known[w] for w in words.split()], np.uint16).tobytes()
    shared = docs.sparkSession.sparkContext.broadcast({"definition": definition, "words": words, "lengths": lengths})
    kind = dict(docs.dtypes)[id_col]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _lookup(shared.value)
        for batch in batches:
            for piece in pieces(batch, "text"):
                totals = lookup.counts(piece.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("n_bytes"), pa.array(totals, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    counted = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")
    ).mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
