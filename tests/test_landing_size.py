"""Pages that queries land take little disk, in files of bounded size."""

from __future__ import annotations

import gzip
from pathlib import Path

from pyspark.sql import functions as F

from starlode.verification import queries
from starlode.verification.frames import child_pages, pages


def test_landed_pages_are_compressed_in_files_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(queries, "FILE_RECORDS", 200)
    rows = spark.range(0, 1000, 1, 2).select(
        F.col("id").cast("string").alias("evaluationId"), F.lit("text " * 20).alias("text")
    )
    for entity, envelopes, page_rows in (
        ("evaluations", pages(rows, rows.columns), 100),
        ("evaluations_results", child_pages(rows, ["text"], "evaluationId"), 1),
    ):
        files = list(Path(queries._land(spark, envelopes, entity)).glob("part-*"))
        texts = [gzip.decompress(f.read_bytes()) for f in files]
        assert max(t.count(b"\n") for t in texts) <= 200 // page_rows
        assert b"".join(texts).count(b"text text") >= 1000
        assert 3 * sum(f.stat().st_size for f in files) < sum(map(len, texts))
