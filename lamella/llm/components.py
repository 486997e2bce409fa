"""Consolidating pairwise matches into groups: deterministic Borůvka hooking.

In every round each component selects its smallest outgoing edge under the total order of (lower end, higher end). The
selected edges form trees, since that order admits no cycle but the edge that two components select both; its lower end
is the root and the lowest label of its tree. Trees collapse by pointer doubling, edges are relabelled and made
distinct, and the rounds end when none is left: at most log2(n) rounds, of log2(depth) doublings each.

All steps are joins and aggregations with map-side combine over tables written to the shared folder; nothing but a
row count reaches the driver. A hub's edges fold into one as soon as their other ends share a component, and joins on
a hot label are split by adaptive execution. Null ends and loops link nothing; repeated and reversed pairs count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.session import Table


def _undirected(pairs: DataFrame) -> DataFrame:
    """Distinct (a, b) with a < b."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a is not null and b is not null and a < b").distinct()


def _trees(edges: DataFrame) -> Table:
    """(node, root) after one round of hooking on ``edges``; every node of an edge is there."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # the smallest edge of a node leads to its smallest neighbour
    hook = Table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")))
    up = hook.df.select(F.col("node").alias("u"), F.col("root").alias("v"))
    # of two nodes that chose the same edge the lower one is the root
    start = hook.df.join(up, F.col("root") == F.col("u"))
    now = Table(start.select("node", F.when((F.col("v") == F.col("node")) & (F.col("node") < F.col("root")), F.col("node")).otherwise(F.col("root")).alias("root"), F.lit(True).alias("moved")))
    hook.drop()
    while True:
        up = now.df.select(F.col("node").alias("u"), F.col("root").alias("v"))
        then = Table(now.df.join(up, F.col("root") == F.col("u")).select("node", F.col("v").alias("root"), (F.col("v") != F.col("root")).alias("moved")), F.col("moved"))
        now.drop()
        now = then
        if not now.counted:
            return now


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, group_id`` for every node of a pair of different nodes; ``group_id`` is the smallest node of its group."""
    edges = Table(_undirected(pairs.select(F.col(a).alias("a"), F.col(b).alias("b"))), F.lit(True))
    maps: list[Table] = []
    while edges.counted:
        trees = _trees(edges.df)
        maps.append(trees)
        m = trees.df.select("node", "root")
        moved = edges.df.join(m.withColumnsRenamed({"node": "a", "root": "ra"}), "a").join(m.withColumnsRenamed({"node": "b", "root": "rb"}), "b")
        new = Table(_undirected(moved.select(F.col("ra").alias("a"), F.col("rb").alias("b"))), F.lit(True))
        edges.drop()
        edges = new
    if not maps:
        return edges.df.select(F.col("a").alias("node"), F.col("b").alias("group_id"))
    # later rounds' roots replace earlier ones, from the smallest map upwards
    label = maps[-1].df.select("node", F.col("root").alias("group_id"))
    for m in reversed(maps[:-1]):
        later = label.withColumnsRenamed({"node": "n", "group_id": "g"})
        label = Table(m.df.join(later, F.col("root") == F.col("n"), "left").select("node", F.coalesce("g", "root").alias("group_id"))).df
    return label


def cell_links(cells: DataFrame, edges: DataFrame, adjacency: DataFrame, longest: float = 50.0) -> DataFrame:
    """``a, b``: links of at most ``longest`` um and listed neighbours, both ends known to ``cells``."""
    known = cells.select(F.col("cell_id").alias("id")).where("id is not null")
    near = edges.where(F.col("edge_len") <= longest).select(F.col("i").alias("a"), F.col("j").alias("b"))
    listed = adjacency.select(F.col("cell_id").alias("a"), F.explode("neighbours").alias("b"))
    pairs = _undirected(near.unionByName(listed))
    return pairs.join(known, F.col("a") == F.col("id"), "left_semi").join(known, F.col("b") == F.col("id"), "left_semi")


def cell_groups(cells: DataFrame, edges: DataFrame, adjacency: DataFrame) -> DataFrame:
    """``cell_id, group_id`` of every cell in a group of at least two."""
    return components(cell_links(cells, edges, adjacency)).select(F.col("node").alias("cell_id"), "group_id")
