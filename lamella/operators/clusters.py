"""Clusters of one role: components of the graph over that role's cells alone, with hulls and their overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions import hulls
from lamella.operators.components import block_components
from lamella.operators.delaunay import Sites, delaunay
from lamella.session import Table

CLUSTER_ROLES = ("immune", "tumor", "stroma")
PAIRS = (("immune", "tumor"), ("immune", "stroma"), ("tumor", "stroma"))
MIN_CLUSTER = 5
#: Points of a cluster in one batch from which on only their corners are sent; side of a cell in which hulls are held against each other.
HULL_FROM, GRID = 60, 10_000


def tagged(cells: DataFrame, everything: bool = True) -> DataFrame:
    """Points ``slide, id, qx, qy`` of all cells and of each role's alone, under slides named ``all|slide`` and ``role|slide``."""
    own = F.when(F.col("role").isin(*CLUSTER_ROLES), F.col("role"))
    tags = F.array_compact(F.array(F.lit("all"), own) if everything else F.array(own))
    return cells.select(F.explode(tags).alias("tag"), "slide", F.col("cell_id").alias("id"), "qx", "qy").select(F.concat_ws("|", "tag", "slide").alias("slide"), "id", "qx", "qy")


def untagged(df: DataFrame, tag: str, *others: str) -> DataFrame:
    return df.select(F.substring_index("slide", "|", 1).alias(tag), F.expr("substr(slide, instr(slide, '|') + 1)").alias("slide"), *others)


def members(edges: DataFrame) -> DataFrame:
    """``role, slide, cluster, cell_id, qx, qy`` of every cell with an edge; ``edges``: those of :func:`delaunay` on tagged points."""
    ends = edges.where("slide not like 'all|%'").select("slide", "node", "i", "j", *[F.col(f"{e}{c}").alias(f"{e}q{c}") for e in "ij" for c in "xy"])
    found = block_components(ends, ["slide"], "node", ["qx", "qy"])
    return Table(untagged(found, "role", F.col("component").alias("cluster"), F.col("id").alias("cell_id"), "qx", "qy")).df


def role_clusters(cells: DataFrame, longest: int = 500, least: int = MIN_CLUSTER) -> DataFrame:
    """``slide, role, cluster, cell_id, qx, qy``: members of components of at least ``least`` cells; ``cluster`` is the lowest cell."""
    rows = members(delaunay(Sites(tagged(cells, False)), longest))
    large = rows.groupBy("slide", "role", "cluster").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return rows.join(large.drop("n"), ["slide", "role", "cluster"])


_KEY = ["slide", "role", "cluster"]


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of rows that come in the order of ``keys``, also across batches."""
    held = None
    for pdf in batches:
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        new = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(new)
        for a, b in zip(starts[:-1], starts[1:]):
            yield pdf.iloc[a:b]
        held = pdf.iloc[starts[-1] :].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _some_corners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of many points of a cluster in one batch only the corners of their hull go on; ``n`` counts those that they stand for."""
    for pdf in batches:
        pdf = pdf.sort_values(_KEY, kind="stable", ignore_index=True)
        starts = np.flatnonzero((pdf[_KEY] != pdf[_KEY].shift()).any(axis=1).to_numpy())
        ends = np.append(starts[1:], len(pdf))
        many = ends - starts > HULL_FROM
        alone = np.repeat(~many, ends - starts)
        out = [pdf[alone].assign(n=np.int64(1))]
        for a, b in zip(starts[many], ends[many]):
            ring = hulls.hull(pdf[["qx", "qy"]].to_numpy()[a:b])
            out.append(pdf.iloc[[a] * len(ring)][_KEY].assign(qx=ring[:, 0], qy=ring[:, 1], n=np.where(np.arange(len(ring)) == 0, b - a, 0)))
        yield pd.concat(out, ignore_index=True)


def cluster_hulls(rows: DataFrame, least: int = MIN_CLUSTER) -> DataFrame:
    """``slide, role, cluster, n, ring, area, perimeter`` of clusters of at least ``least`` cells; ring in grid steps, area in their squares; null when flat.

    A hull is taken of a cluster's points in each batch first and then of their corners, so no cluster is one task's work.
    """
    corners = rows.select(*_KEY, "qx", "qy").mapInPandas(_some_corners, "slide string, role string, cluster bigint, qx bigint, qy bigint, n bigint")

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for g in _groups(batches, _KEY):
            if (n := g["n"].sum()) >= least:
                ring = hulls.hull(g[["qx", "qy"]].to_numpy())
                flat = len(ring) < 3
                out.append((*g.iloc[0][_KEY], n, None if flat else ring.ravel().astype(np.int64), None if flat else hulls.area(ring), None if flat else hulls.perimeter(ring)))
        yield pd.DataFrame(out, columns=[*_KEY, "n", "ring", "area", "perimeter"])

    placed = corners.repartition(*_KEY).sortWithinPartitions(*_KEY)
    return Table(placed.mapInPandas(whole, "slide string, role string, cluster bigint, n bigint, ring array<bigint>, area double, perimeter double")).df


def cluster_summary(cells: DataFrame, hull: DataFrame) -> DataFrame:
    """Per slide and role of CLUSTER_ROLES: counts, sizes, areas (mm2) and densities (cells per um2) of clusters."""
    roles = cells.select("slide").distinct().select("slide", F.explode(F.array(*map(F.lit, CLUSTER_ROLES))).alias("role"))
    count = cells.groupBy("slide", "role").agg(F.count("*").alias("n_role"))
    um2 = F.col("area") / 100
    s = hull.groupBy("slide", "role").agg(
        F.count("*").alias("n_clusters"), F.sum("n").alias("inside"), F.avg("n").alias("mean_cluster_size"), F.max("n").alias("largest_cluster_size"),
        F.avg(um2 / 1e6).alias("mean_cluster_area_mm2"), F.avg(F.col("n") / (um2 + 1e-9)).alias("mean_cluster_density"),
        F.avg(F.when(F.col("perimeter") > 0, 4 * F.pi() * F.col("area") / F.col("perimeter") ** 2)).alias("roundness"),
        F.max(F.struct("n", (-F.col("cluster")).alias("first"), (um2 / 1e6).alias("area"))).alias("top"),
    )
    j = roles.join(count, ["slide", "role"], "left").join(s, ["slide", "role"], "left")
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return j.select(
        "slide", "role", zero("n_clusters").alias("n_clusters"), (zero("inside") / (zero("n_role") + 1e-9)).alias("clustered_frac"), "mean_cluster_size",
        zero("largest_cluster_size").alias("largest_cluster_size"), "mean_cluster_area_mm2", "mean_cluster_density", "roundness",
        F.when(F.col("top").isNull(), F.lit(0.0)).otherwise(F.col("top.area")).alias("largest_cluster_area_mm2"),
    )


_PLACE = ["slide", "a", "b", "cluster", "tx", "ty"]


def _overlap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    out = []
    for g in _groups(batches, _PLACE):
        head = g.iloc[0]
        own = np.asarray(head["ring"], dtype=float).reshape(-1, 2)
        # local coordinates keep products exact
        zero = own[0]
        x, y = head["tx"] * GRID - zero[0], head["ty"] * GRID - zero[1]
        own = hulls.clip(own - zero, np.array([[x, y], [x + GRID, y], [x + GRID, y + GRID], [x, y + GRID]]))
        parts = [hulls.clip(own, np.asarray(r, dtype=float).reshape(-1, 2) - zero) for r in g["other"]] if len(own) else []
        hit = [p for p in parts if len(p)]
        if hit:
            out.append((*head[_PLACE[:4]], head["area"], hulls.union_area(hit)))
    yield pd.DataFrame(out, columns=[*_PLACE[:4], "area", "covered"])


def cluster_overlap(hull: DataFrame) -> DataFrame:
    """Per slide and pair of roles: part of a-hulls that meet a b-hull (touching counts), mean share of their area under b-hulls.

    Null where the slide has no hull of one of the two; the ratio is 0 where none meet. An a-hull is cut by a grid of
    1 mm, and each cell's part meets the b-hulls of that cell alone, so a hull as wide as its slide is many groups.
    """
    h = hull.where("ring is not null")
    xs, ys = F.filter("ring", lambda v, i: i % 2 == 0), F.filter("ring", lambda v, i: i % 2 == 1)
    box = h.select("slide", "role", "cluster", "ring", "area", F.array_min(xs).alias("x1"), F.array_max(xs).alias("x2"), F.array_min(ys).alias("y1"), F.array_max(ys).alias("y2"))
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in PAIRS])
    tiles = lambda lo, hi: F.sequence(F.floor(F.col(lo) / GRID), F.floor(F.col(hi) / GRID))
    box = box.withColumn("p", F.explode(pairs)).where("role = p.a or role = p.b").withColumn("tx", F.explode(tiles("x1", "x2"))).withColumn("ty", F.explode(tiles("y1", "y2")))
    box = box.select("slide", "role", F.col("p.a").alias("a"), F.col("p.b").alias("b"), "cluster", "ring", "area", "tx", "ty", "x1", "x2", "y1", "y2")
    place = ["slide", "a", "b", "tx", "ty"]
    b = box.where("role = b").select(*place, F.col("ring").alias("other"), F.col("x1").alias("u1"), F.col("x2").alias("u2"), F.col("y1").alias("v1"), F.col("y2").alias("v2"))
    met = box.where("role = a").join(b, place).where("x1 <= u2 and u1 <= x2 and y1 <= v2 and v1 <= y2").select(*_PLACE, "ring", "area", "other")
    part = met.repartition(*_PLACE).sortWithinPartitions(*_PLACE).mapInPandas(_overlap, "slide string, a string, b string, cluster bigint, area double, covered double")
    each = part.groupBy("slide", "a", "b", "cluster").agg((F.sum("covered") / (F.max("area") + 1e-7)).alias("ratio"))
    got = each.groupBy("slide", "a", "b").agg(F.count("*").alias("hit"), F.avg("ratio").alias("ratio"))
    n = h.groupBy("slide", "role").agg(F.count("*").alias("n"))
    both = n.withColumnsRenamed({"role": "a", "n": "na"}).join(n.withColumnsRenamed({"role": "b", "n": "nb"}), "slide").where(" or ".join(f"(a = '{x}' and b = '{y}')" for x, y in PAIRS))
    return both.join(got, ["slide", "a", "b"], "left").select("slide", "a", "b", (F.coalesce("hit", F.lit(0)) / F.col("na")).alias("meets_frac"), F.coalesce("ratio", F.lit(0.0)).alias("overlap_ratio"))
