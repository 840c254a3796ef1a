"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key divided by its quality weight; a source takes its
documents in key order. Whole epochs come first, the rest of the target is filled by the
prefix sums of the sizes, and the document at the boundary is taken in part.

Prefix sums run in two levels: a source with n documents is dealt into about sqrt(n) ranges
of the keys, whose totals are summed up per source, and inside a range over about sqrt(n)
rows. No task sees a whole source, however large it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlode.llm.text import SPACED_WORD
from starlode.sources import materialize

#: Fixed values of the mix: weights by the order of the sources, share of all sizes, epochs.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
EPOCHS = 2


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on ``key`` and ``seed`` alone."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def targets(sources: DataFrame, weights: Sequence[float], share: float, epochs: int) -> DataFrame:
    """source, source_size -> ordered by source with ``target``.

    Filling up to a cap by weight has a closed form: order the sources by size per weight;
    those that reach their cap are a prefix of that order. The level is what the first of the
    others gets per unit of weight, and levels fall from there on. One row per source, summed in windows over sources only.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    ordered = sources.withColumn(
        "weight", F.element_at(cycle, (F.pmod(F.row_number().over(place) - 1, F.lit(len(weights))) + 1).cast("int"))
    ).withColumn("cap", F.lit(float(epochs)) * F.col("source_size"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        0, Window.unboundedFollowing
    )
    everything = Window.partitionBy()
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    levels = ordered.withColumn(
        "level",
        (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest),
    ).withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    level = F.max(F.when(F.col("open"), F.col("level"))).over(everything)
    return levels.withColumn("fill", level).select(
        "source",
        "source_size",
        "n_docs",
        F.least(F.col("cap"), F.coalesce(F.col("fill") * F.col("weight"), F.col("cap"))).alias("target"),
    )


def mix(
    docs: DataFrame,
    size: Column,
    quality: DataFrame | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = 7,
    id_col: str = "doc_id",
    source_col: str = "source",
) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per row of ``docs``.

    ``quality`` maps ``doc_id`` to a positive ``weight`` (absent: 1). Null sources form one
    source, ordered last; a row with a null id draws by its place in the table, so reruns over the
    same files agree; rows with equal keys are ordered by id and size, and equal rows share what is
    left between them in either order, so reruns agree in content. An empty table gives an empty mix; documents of size zero are taken zero times; of a
    very long text only the size counts.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        size.alias("size"),
        # null ids draw by their row, or all of them would meet in one bin
        F.coalesce(
            F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.monotonically_increasing_id().cast("string"))
        ).alias("drawn_by"),
    )
    rows = materialize(rows, "mix-sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    plan = targets(per_source, weights, share, epochs).withColumns(
        {
            "whole": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
            "n_bins": F.ceil(F.sqrt("n_docs")),
        }
    )
    plan = plan.withColumn("rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size")))
    plan = materialize(plan, "mix-targets")
    if quality is not None:
        best = quality.groupBy(F.col("doc_id").alias("_labelled")).agg(F.max("weight").alias("_weight"))
        rows = rows.join(best, F.col("doc_id") == F.col("_labelled"), "left").drop("_labelled")
        rows = rows.withColumn("_weight", F.coalesce("_weight", F.lit(1.0)))
    else:
        rows = rows.withColumn("_weight", F.lit(1.0))
    key = -F.log(uniform(F.col("drawn_by"), seed)) / F.col("_weight")
    keyed = (
        rows.join(plan.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("key", key)
        .withColumn("bin", F.floor((1 - F.exp(-F.col("key"))) * F.col("n_bins")).cast("long"))
    )
    keyed = materialize(keyed.drop("_weight", "drawn_by"), "mix-keys")
    bins = keyed.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(
        F.col("source").alias("_source"),
        F.col("bin").alias("_bin"),
        F.coalesce(F.sum("bin_size").over(earlier), F.lit(0)).alias("before_bin"),
    )
    inside = Window.partitionBy("source", "bin").orderBy("key", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.join(
        bins, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bin") == F.col("_bin"))
    ).withColumn("before", F.col("before_bin") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    fraction = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("before")))
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("whole") * F.col("size") + fraction).cast("long").alias("taken"),
    )


def quality_weights(labels: DataFrame) -> DataFrame:
    """doc_id, weight of labelled documents: good ones come earlier, poor ones later."""
    return labels.where(F.col("quality").isNotNull()).select(
        "doc_id", F.when(F.col("quality") > 0, F.lit(2.0)).otherwise(F.lit(0.5)).alias("weight")
    )
