"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starlode.llm.decontamination import contamination, is_contaminated
from starlode.llm.language import fit, held_out, identify
from starlode.llm.lines import line_dedup
from starlode.llm.merkle import digest, folded, manifest, siblings
from starlode.llm.mixing import mix, n_words, quality_weights
from starlode.llm.quality import quality
from starlode.llm.secret_scan import BASE, listed, scan
from starlode.llm.simhash import hex_fingerprint, near_documents
from starlode.llm.substrings import substring_dedup
from starlode.llm.suffixes import suffix_dedup
from starlode.llm.text import lower_ascii
from starlode.llm.tokens import token_counts
from starlode.llm.warc import archive
from starlode.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Query) -> Query:
    LLM_QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(
        table(spark, sf_dir, "documents"),
        size=n_words(F.col("text")),
        quality=quality_weights(table(spark, sf_dir, "labels")),
    )


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    measures = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id", *(F.col("quality")[m].alias(m) for m in ("n_words", *measures, "base_failed", "kept"))
    )


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", hex_fingerprint(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256)
    return deduped.select("doc_id", "n_lines", "n_removed", kept.alias("kept_sha256"))


@query
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(count(rule.kind) for rule in BASE),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages"))


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return token_counts(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def leaf(text: Column) -> Column:
        return digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    checked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    leaves = table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        leaf(F.col("text")).alias("leaf"),
        F.when(checked, leaf(lower_ascii(F.col("text")))).alias("altered"),
    )
    found = manifest(leaves, "lang", "doc_id", "leaf").withColumn(
        "folded_root", folded(F.coalesce("altered", "leaf"), F.col("path"))
    )
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
