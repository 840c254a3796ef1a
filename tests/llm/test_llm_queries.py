"""Registered queries against SQL twins, brute force, held-out accuracy."""

from __future__ import annotations

import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starlode.llm.oracle import LLM_ORACLE
from starlode.llm.queries import LLM_QUERIES
from starlode.verification.compare import differences, duckdb_connection
from tests.llm import brute

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def documents():
    rows = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall()
    return [(int(i), t) for i, t in rows]


def by_id(df) -> dict:
    return {row[0]: tuple(row[1:]) for row in df.collect()}


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_equals_its_sql_twin(spark, name):
    assert not differences(LLM_QUERIES[name](spark, SF), duckdb_connection(SF), LLM_ORACLE[name])


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES)
    assert numbers == list(range(1, 14))


def test_suffix_dedup_by_brute_force(spark, documents):
    got = by_id(LLM_QUERIES["op3_suffix_dedup"](spark, SF))
    assert got == brute.suffix_dedup(documents)


def test_simhash_by_brute_force(spark, documents):
    assert by_id(LLM_QUERIES["op5_simhash"](spark, SF)) == brute.simhash(documents)


def test_line_dedup_by_brute_force(spark, documents):
    got = by_id(LLM_QUERIES["op10_line_dedup"](spark, SF))
    want = {i: (n, gone, brute.sha(text)) for i, (n, gone, text) in brute.line_dedup(documents).items()}
    # banding may miss a pair in five hundred
    assert sum(got[i] != want[i] for i in want) <= 1


def test_language_of_held_out_documents(spark):
    found = LLM_QUERIES["op8_language_id"](spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "n_chars")
    rows = found.join(truth, "doc_id").where("held_out and lang is not null and n_chars > 100").collect()
    assert rows and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.9 * len(rows)


def test_token_counts_by_brute_force(spark, documents):
    from public_tokenizers import path

    got = by_id(LLM_QUERIES["op11_token_counts"](spark, SF))
    assert got == brute.token_counts(documents, path("word_bpe_49k.json"))


def test_whitening_by_brute_force(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY 1").fetchall()
    n, deviations, whitened, explained = brute.whitening([v for _, v in rows])
    got = {(r.vec_id, r.component): r for r in LLM_QUERIES["op13_embedding_whitening"](spark, SF).collect()}
    assert len(got) == 16 * len(rows)
    for (i, _), deviation in zip(rows, deviations, strict=True):
        assert (got[i, 1].n, got[i, 1].deviation) == (n, deviation)
    for c in range(16):
        mine = np.array([got[i, c + 1].whitened for i, _ in rows])
        sign = np.sign(mine @ whitened[:, c])
        assert np.abs(mine * sign - whitened[:, c]).max() < 1e-8
        assert abs(got[rows[0][0], c + 1].explained / explained[c] - 1) < 1e-9
    assert got[rows[0][0], 1].identity_error < 1e-10


def test_mix_meets_its_targets(spark):
    rows = LLM_QUERIES["op2_mixing"](spark, SF).withColumn("source", F.col("source_size")).collect()
    taken, target = {}, {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
        target.setdefault(r.source_size, set()).add(r.target)
    for size, found in taken.items():
        assert abs(found - sum(target[size])) <= len(target[size])


def test_pipeline_by_brute_force(spark, tmp_path):
    """The same five steps, with SQL twins and plain Python."""
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality",
        "lines",
        "near_duplicates",
        "decontamination",
        "mixing",
    ]
    con = duckdb_connection(SF)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    kept = {r[0] for r in con.sql(f"SELECT doc_id FROM ({LLM_ORACLE['op4_quality']}) WHERE kept").fetchall()}
    rows = [r for r in con.sql("SELECT doc_id, text, source FROM documents").fetchall() if r[0] in kept]
    lines = brute.line_dedup([(i, t) for i, t, _ in rows])
    rows = [(i, lines[i][2], s) for i, _, s in rows]
    groups = brute.simhash([(i, t) for i, t, _ in rows])
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    con.execute("DROP VIEW documents")
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    bad = con.sql(f"SELECT doc_id FROM ({LLM_ORACLE['op1_decontamination']}) WHERE contaminated").fetchall()
    con.execute(f"DELETE FROM documents WHERE doc_id IN ({', '.join(str(r[0]) for r in bad) or 'NULL'})")
    assert bad
    assert not differences(corpus_pipeline.run(spark, SF), con, LLM_ORACLE["op2_mixing"])
