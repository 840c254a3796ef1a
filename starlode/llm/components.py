"""Connected components as a distributed union-find, in DataFrame operations.

Alternating large-star and small-star steps shrink paths until every node points to the
least node of its component. Stars are taken by joins against the least neighbour of each
node, never by collecting neighbours, so a node with very many links is split like any skewed
join key. Each step is written to the shared folder; nothing passes through the driver but a
count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlode.sources import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node, component: every node with a link, and the least node it is connected with.

    Links may repeat, go either way or join a node with itself; null ends are left out.
    """
    x, y = F.col(a), F.col(b)
    edges = (
        links.where(x.isNotNull() & y.isNotNull() & (x != y))
        .select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
        .distinct()
    )
    edges = materialize(edges, "links")
    before, now = None, _state(edges)
    while before != now:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        least = materialize(least.select("n", F.least("n", "m").alias("m")), "least")
        # large star: neighbours above a node move to its least neighbour
        large = edges.join(least, F.col("b") == F.col("n")).select("a", F.col("m").alias("b")).distinct()
        large = materialize(large, "large-star")
        least = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        least = materialize(least, "least")
        # small star: so do a node and its neighbours below
        small = large.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where(F.col("a") != F.col("b")).unionByName(least.toDF("a", "b")).distinct()
        edges = materialize(small, "small-star")
        before, now = now, _state(edges)
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.toDF("node", "component").unionByName(roots.withColumn("component", F.col("node")))
