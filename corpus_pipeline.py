"""From raw documents to a mixed training corpus, one Spark job after another.

Each stage takes the documents its predecessor kept. All but the last return the columns of
``documents``, whatever else a table carries along and however it is called; the last returns what
the mix takes of each document. Empty tables pass through, and rows with null texts end at the
quality rules. Repeated rows count as one document where lines are compared, and one of them stays
in a near-duplicate group; between equal ids the text's hash decides, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlode.llm.decontamination import without_contaminated
from starlode.llm.lines import line_dedup
from starlode.llm.mixing import mix, n_words, quality_weights
from starlode.llm.quality import keep_good
from starlode.llm.simhash import one_per_group
from starlode.llm.text import fresh
from starlode.sources import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    return keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that an earlier document has as well; ``n_chars`` follows."""
    counts = {k: fresh(docs, k) for k in ("n_lines", "n_removed")}
    deduped = line_dedup(docs, **counts)
    if "n_chars" in docs.columns:
        deduped = deduped.withColumn("n_chars", F.length("text").cast("long"))
    return deduped.select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document go into the mix."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mix(docs, n_words(F.col("text")), quality_weights(labels))


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

#: Fingerprints and fuzzy lines have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
