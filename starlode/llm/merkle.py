"""Merkle manifest of a dataset, as conditional aggregates over slots.

Leaves are numbered in their group's order. Every level spreads the children of a parent into
``fanout`` columns by their slot; the columns joined and hashed are the parent, and without the
child's own column they are its siblings. Levels are built upwards until each group has one node,
its subroot; the subroots make one more tree in the same way. Then the way up is handed down level
by level, so that each leaf gets the siblings on its path to the root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from starlode.sources import materialize

FANOUT = 8
#: Nodes of a level that are broadcast with their paths, and stored in one file: a path is 10 kB at
#: most (21 steps of seven digests), so these are 10 MB.
SMALL = 1024
#: A path: at each step up the rows before and after the node within its run, joined.
_STEP = "array<struct<left:string,right:string>>"


def stored(df: DataFrame, name: str, rows: int) -> DataFrame:
    """``df`` written and read back; few rows go into one file."""
    return materialize(df.repartition(1) if rows <= SMALL else df, name)


def digest(*values: Column) -> Column:
    """Hex sha256 of the values, each ``-`` if null, else its UTF-8 length, ``:`` and itself."""
    texts = (v.cast("string") for v in values)
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``position``, 0 for the first by ``order`` (nulls first).

    Rows are dealt by range and sorted within partitions; the sizes of the partitions, one small
    row each, give the position at which each of them starts. ``order`` must tell rows apart for
    a hot value to be split.
    """
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = materialize(dealt.withColumn("_row", F.monotonically_increasing_id()), name)
    part = F.shiftright("_row", 33).alias("_part")
    sizes = dealt.groupBy(part).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("_part").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    starts = materialize(starts.repartition(1), f"{name}-starts")
    inside = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    placed = dealt.join(starts, F.shiftright("_row", 33) == F.col("_of"))
    return placed.withColumn("position", F.col("_start") + inside).drop("_row", "_of", "_start")


def _slots(fanout: int) -> list[str]:
    return [f"slot{s}" for s in range(fanout)]


def joined(slots: Sequence[str]) -> Column:
    """The digests of some slots, in order; empty slots add nothing."""
    return F.concat_ws("", *(F.col(c)["digest"] for c in slots)) if slots else F.lit("")


def runs_by_height(sizes: DataFrame, fanout: int) -> list[int]:
    """How many runs all trees have together at each height, up to the last root.

    ``sizes`` has n, the leaves of a tree: a tree of n nodes has n / fanout of them above, rounded up.
    """
    steps, most = [], 1
    while most * fanout < 1 << 62:
        below, most = most, most * fanout
        nodes, runs = (F.floor((F.col("n") + (m - 1)) / F.lit(m).cast("decimal(20,0)")).cast("long") for m in (below, most))
        steps.append(F.sum(F.when(nodes > 1, runs)).alias(f"h{len(steps)}"))
    return [n for n in sizes.agg(*steps).first() if n]


def pivoted(nodes: DataFrame, fanout: int) -> DataFrame:
    """tree, parent, n, slot0 ... : the nodes of each run of ``fanout``, a column per slot.

    ``nodes`` has tree, place, node, a struct whose field ``digest`` is hashed, and n, the nodes of
    its tree at this height; ``n`` of the result counts those one step up.
    """
    slot = F.pmod("place", F.lit(fanout))
    runs = nodes.groupBy("tree", F.floor(F.col("place") / fanout).cast("long").alias("parent"))
    return runs.agg(
        F.floor((F.first("n") + (fanout - 1)) / fanout).cast("long").alias("n"),
        *(F.any_value(F.when(slot == s, F.col("node")), F.lit(True)).alias(c) for s, c in enumerate(_slots(fanout))),
    )


def grown(nodes: DataFrame, runs: list[int], fanout: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Levels from the leaves up, and tree, height, digest of each root; a lone leaf has height 0.

    ``nodes`` is as for :func:`pivoted`, ``runs`` how many runs each level has.
    """
    levels: list[DataFrame] = []
    roots = nodes.where("n = 1").select("tree", F.lit(0).alias("height"), F.col("node")["digest"].alias("digest"))
    for height, many in enumerate(runs, 1):
        level = stored(pivoted(nodes.where("n > 1"), fanout), f"{name}-level", many)
        levels.append(level)
        top = F.sha2(joined(_slots(fanout)), 256).alias("digest")
        roots = roots.unionByName(level.where("n = 1").select("tree", F.lit(height).alias("height"), top))
        nodes = level.select("tree", F.col("parent").alias("place"), F.struct(top).alias("node"), "n")
    return levels, roots


def handed_down(
    leaves: DataFrame, levels: list[DataFrame], runs: list[int], tops: DataFrame, fanout: int, name: str
) -> DataFrame:
    """tree, place, node, path of every leaf: the siblings of each step up.

    ``tops`` has tree, height and path of each root.
    """
    slots, ups = _slots(fanout), None

    def child(s: int) -> Column:
        step = F.struct(joined(slots[:s]).alias("left"), joined(slots[s + 1 :]).alias("right"))
        path = F.concat(F.array(step).cast(_STEP), F.col("path"))
        return F.struct((F.col("parent") * fanout + s).alias("place"), F.col(slots[s]).alias("node"), path.alias("path"))

    for height in range(len(levels), 0, -1):
        here = tops.where(F.col("height") == height).select("tree", F.lit(0).cast("long").alias("place"), "path")
        ups = here if ups is None else ups.drop("node").unionByName(here)
        # one row for each run of the level
        many = runs[height - 1]
        ups = F.broadcast(ups) if many <= SMALL else materialize(ups, f"{name}-paths")
        ups = ups.withColumnsRenamed({"tree": "_tree", "place": "_place"})
        level = levels[height - 1].join(ups, (F.col("tree") == F.col("_tree")) & (F.col("parent") == F.col("_place")))
        children = F.explode(F.filter(F.array(*map(child, range(fanout))), lambda c: c["node"].isNotNull()))
        ups = level.select("tree", children.alias("child")).select("tree", "child.*")
    lone = leaves.where("n = 1").join(
        tops.where("height = 0").select(F.col("tree").alias("_tree"), "path"), F.col("tree") == F.col("_tree")
    )
    lone = lone.select("tree", "place", "node", "path")
    return lone if ups is None else ups.unionByName(lone)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings(path: Column) -> Column:
    """All siblings on a path, joined."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(leaves: DataFrame, group: str, order: str, leaf: str, fanout: int = FANOUT) -> DataFrame:
    """The columns of ``leaves``, and subroot, root and path for each of its rows.

    ``leaf`` is the digest of a row. The leaves of a ``group`` (null is one, the first) ascend by
    ``order``, nulls first and ties by digest; groups ascend bytewise. Every ``fanout``
    consecutive nodes, the last run may be shorter, become the hash of their joined digests until
    one node is left; a lone leaf is its own subroot. Repeated rows are leaves of their own. An
    empty table has no root and gives no rows. The names of all columns must differ from subroot,
    root and path, and may be any others. ``leaves`` is written once, so keep it narrow.
    """
    row = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(leaves.columns)))
    rows = leaves.select(
        F.col(group).cast("string").alias("group"),
        F.col(order).alias("order"),
        F.struct(F.col(leaf).alias("digest"), row.alias("row")).alias("node"),
        F.monotonically_increasing_id().alias("number"),
    )
    rows = materialize(rows, "leaves")  # with its number, so that a repeated task deals rows alike
    placed = numbered(rows, ["group", "order", "node.digest", "number"], "leaves-in-order")
    groups = placed.groupBy("group").agg(F.min("position").alias("first"), F.count("*").alias("n"))
    trees = numbered(materialize(groups, "groups"), ["group"], "groups-in-order")
    trees = trees.select(F.col("group").alias("_group"), F.col("position").alias("tree"), "first", "n")
    nodes = placed.join(trees, F.col("group").eqNullSafe(F.col("_group"))).select(
        "tree", (F.col("position") - F.col("first")).alias("place"), "node", "n"
    )
    runs = runs_by_height(trees, fanout)
    levels, subroots = grown(nodes, runs, fanout, "leaves")
    # the subroots are the leaves of one tree
    many = trees.count()
    upper = subroots.select(
        F.lit(0).cast("long").alias("tree"),
        F.col("tree").alias("place"),
        F.struct("digest", "tree", "height").alias("node"),
        F.lit(many).cast("long").alias("n"),
    )
    upper = stored(upper, "subroots", many)
    upper_runs = runs_by_height(upper.select("n").limit(1), fanout)
    steps, root = grown(upper, upper_runs, fanout, "groups")
    empty = root.select("tree", "height", F.array().cast(_STEP).alias("path"))
    tops = handed_down(upper, steps, upper_runs, empty, fanout, "groups").select("node.*", "path")
    tops = stored(tops, "group-paths", many)
    found = handed_down(nodes, levels, runs, tops.select("tree", "height", "path"), fanout, "leaves")
    names = tops.select(F.col("tree").alias("_tree"), F.col("digest").alias("subroot"))
    top = root.first()
    found = found.join(names, F.col("tree") == F.col("_tree"))
    found = found.withColumn("root", F.lit(top["digest"] if top else None).cast("string"))
    own = [F.col("node")["row"][f"c{i}"].alias(c) for i, c in enumerate(leaves.columns)]
    return found.select(*own, "subroot", "root", "path")
