"""Points near other points, and points inside regions, by k-d splits with halo copies.

A slide's points are cut by k-d splits (x strips, each cut by y) whose positions are quantile sketches, so every node
holds about ``target`` points however dense or hot a slide is. One side of the distance join is copied to each node
its ``radius`` reaches; regions are copied to each node their box meets. Within a node, positions become unit vectors
on a sphere so large that the plane's distances hold to far below a grid step, a local k-d tree answers by chord
radius, and whole-number arithmetic on the grid settles each pair; regions are swept edge by edge.

Null coordinates, slides or ids are out. Equal points count as separate points; a region given twice counts once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions.kdtree import KDTree, chord, strictly_inside, unit_vectors
from lamella.functions.labels import united
from lamella.operators.units import cells_in_um, position_units
from lamella.session import cut

#: Points a node should hold, and splits of one axis at most (so up to FAN * FAN nodes a slide).
TARGET, FAN = 30_000, 256
#: Radius of the sphere in grid steps; a node's width is a tiny angle on it.
SPHERE = 1e10

QUERY, NEIGHBOUR, OTHER, REGION = 0, 1, 2, 3


def kd_splits(points: DataFrame, target: int = TARGET, fan: int = FAN) -> DataFrame:
    """``slide, xcuts, ycuts``: the cuts between strips, and for each strip those between its nodes.

    ``points``: ``slide, qx, qy``. Two aggregations of quantile sketches with map-side combine.
    """
    grid = F.array(*[F.lit(i / fan) for i in range(1, fan)])
    # a cut at the lowest value would leave an empty strip before it
    pick = lambda cuts, k, low: F.filter(F.array_sort(F.array_distinct(F.transform(F.filter(F.sequence(F.lit(0), F.lit(fan - 2)), lambda i: F.floor((i + 1) * k / fan) > F.floor(i * k / fan)), lambda i: F.get(cuts, i.cast("int"))))), lambda c: c > low)
    parts = lambda n: F.least(F.greatest(n, F.lit(1)), F.lit(fan))
    x = points.groupBy("slide").agg(F.count("*").alias("n"), F.percentile_approx("qx", grid, 2000).alias("cuts"), F.min("qx").alias("low"))
    x = x.select("slide", pick(F.col("cuts"), parts(F.ceil(F.sqrt(F.col("n") / target))), F.col("low")).alias("xcuts"))
    x = cut(x)
    y = points.join(x, "slide").groupBy("slide", strip(F.col("qx"), F.col("xcuts")).alias("strip")).agg(F.count("*").alias("n"), F.percentile_approx("qy", grid, 2000).alias("cuts"), F.min("qy").alias("low"))
    y = y.select("slide", "strip", pick(F.col("cuts"), parts(F.ceil(F.col("n") / target)), F.col("low")).alias("cuts"))
    # at most FAN strips a slide; a strip without points has no cuts
    per = y.groupBy("slide").agg(F.map_from_entries(F.collect_list(F.struct("strip", "cuts"))).alias("m"))
    none = F.array().cast("array<bigint>")
    rows = x.join(per, "slide").select("slide", "xcuts", F.transform(F.sequence(F.lit(0), F.size("xcuts")), lambda i: F.coalesce(F.try_element_at(F.col("m"), i), none)).alias("ycuts"))
    return cut(rows)


def strip(at: Column, cuts: Column) -> Column:
    """How many cuts lie at or below ``at``."""
    return F.size(F.filter(cuts, lambda c: c <= at))


def node_at(x: Column, y: Column) -> Column:
    """The node of a place, on rows joined to splits."""
    s = strip(x, F.col("xcuts"))
    return s * 1000 + strip(y, F.get(F.col("ycuts"), s))


def to_nodes(df: DataFrame, splits: DataFrame, x1: Column, x2: Column, y1: Column, y2: Column, at: tuple[Column, Column] | None = None) -> DataFrame:
    """A copy of each row for every node that its box meets: adds ``node`` and, with a place ``at``, ``home``: whether that is the place's node."""
    j = df.join(splits, "slide")
    strips = F.sequence(strip(x1, F.col("xcuts")), strip(x2, F.col("xcuts")))
    nodes = F.flatten(F.transform(strips, lambda s: F.transform(F.sequence(strip(y1, F.get(F.col("ycuts"), s)), strip(y2, F.get(F.col("ycuts"), s))), lambda t: s * 1000 + t)))
    j = j.withColumn("node", F.explode(nodes))
    return (j if at is None else j.withColumn("home", F.col("node") == node_at(*at))).drop("xcuts", "ycuts")


def home_node(df: DataFrame, splits: DataFrame) -> DataFrame:
    return df.join(splits, "slide").withColumn("node", node_at(F.col("qx"), F.col("qy"))).drop("xcuts", "ycuts")


def _starts(ring: np.ndarray) -> np.ndarray:
    """Where rings but the first begin, once the NaN between them are gone."""
    gaps = np.flatnonzero(np.isnan(ring[:, 0]))
    return gaps - np.arange(len(gaps))


def _node_worker(radius: int):
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        kind = pdf["kind"].to_numpy()
        cell = kind != REGION
        ids, x, y = pdf["id"].to_numpy(), pdf["qx"].to_numpy(), pdf["qy"].to_numpy()
        out = []
        query, other = np.flatnonzero(kind == QUERY), np.flatnonzero(kind == NEIGHBOUR)
        if len(query) and len(other):
            x0, y0 = x[cell].mean(), y[cell].mean()
            tree = KDTree(unit_vectors(x[other] - x0, y[other] - y0, SPHERE))
            for a, b in tree.within(unit_vectors(x[query] - x0, y[query] - y0, SPHERE), chord(radius, SPHERE) * (1 + 1e-6)):
                a, b = query[a], other[b]
                dx, dy = x[a] - x[b], y[a] - y[b]
                exact = dx * dx + dy * dy <= radius * radius
                a, b = ids[a[exact]], ids[b[exact]]
                out.append(pd.DataFrame({"relation": "near", "id_a": np.minimum(a, b), "id_b": np.maximum(a, b)}))
        regions = np.flatnonzero(kind == REGION)
        if len(regions):
            here = np.flatnonzero(cell & pdf["home"].to_numpy())
            hx, hy = x[here].astype(float), y[here].astype(float)
            by_y = np.argsort(hy, kind="stable")
            rings = pdf["ring"].to_numpy()
            for r in regions:
                ring = np.asarray(rings[r], dtype=float).reshape(-1, 2)
                inside = here[strictly_inside(hx, hy, by_y, *np.split(ring[~np.isnan(ring[:, 0])], _starts(ring)))]
                out.append(pd.DataFrame({"relation": "inside", "id_a": ids[r], "id_b": ids[inside]}))
        if not out:
            return pd.DataFrame({"relation": pd.Series(dtype=str), "id_a": pd.Series(dtype="int64"), "id_b": pd.Series(dtype="int64")})
        return pd.concat(out, ignore_index=True)

    return work


def near_and_inside(points: DataFrame, regions: DataFrame, radius: int, target: int = TARGET) -> DataFrame:
    """``relation, id_a, id_b``: ``near`` pairs of a query and a neighbour of one slide, and points ``inside`` regions.

    ``points``: ``slide, id, kind, qx, qy`` (``kind`` QUERY, NEIGHBOUR or OTHER; whole grid steps). ``regions``:
    ``slide, id, ring`` (``array<double>`` x0, y0, x1, y1 ... in grid steps; a pair of NaN stands between the rings of a
    region with holes or several parts). ``radius`` in grid steps, itself included.
    """
    points = cut(points)
    splits = kd_splits(points.select("slide", "qx", "qy"), target)
    none = F.lit(None).cast("array<double>")
    # neighbours go to every node within the radius, other points to their own
    x, y, r = F.col("qx"), F.col("qy"), F.when(F.col("kind") == NEIGHBOUR, radius).otherwise(0)
    copies = to_nodes(points, splits, x - r, x + r, y - r, y + r, (x, y)).select("slide", "node", "id", "kind", "qx", "qy", "home", none.alias("ring"))
    xs, ys = (F.filter("ring", lambda v, i: (i % 2 == k) & ~F.isnan(v)) for k in (0, 1))
    boxes = to_nodes(regions, splits, F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys))
    boxes = boxes.select("slide", "node", "id", F.lit(REGION).alias("kind"), F.lit(0).cast("bigint").alias("qx"), F.lit(0).cast("bigint").alias("qy"), F.lit(False).alias("home"), "ring")
    every = copies.unionByName(boxes)
    return every.groupBy("slide", "node").applyInPandas(_node_worker(radius), "relation string, id_a bigint, id_b bigint")


def on_grid(v: Column, grid: float) -> Column:
    """``v`` in steps of ``grid``, without the last digits' noise of a whole number of steps."""
    return F.when(F.abs(v / grid - F.round(v / grid)) < 1e-6, F.round(v / grid)).otherwise(v / grid)


def rings_on_grid(rois: DataFrame, grid: float = 0.1) -> DataFrame:
    """``slide, id, ring``: distinct regions in grid steps; points with a null or NaN are left out, then rings under three points."""
    p = F.filter("ring", lambda q: q.isNotNull() & q["x"].isNotNull() & q["y"].isNotNull() & ~F.isnan(q["x"]) & ~F.isnan(q["y"]))
    flat = F.flatten(F.transform(p, lambda q: F.array(on_grid(q["x"], grid), on_grid(q["y"], grid))))
    return rois.select("slide", F.col("roi_id").alias("id"), flat.alias("ring")).where("slide is not null and id is not null and size(ring) >= 6").distinct()


def cell_points(cells: DataFrame, roles: DataFrame, units: DataFrame) -> DataFrame:
    """One row per cell and position: ``slide, id, kind, qx, qy``; immune cells are queries, tumour cells neighbours.

    Rows of a cell that was delivered twice agree on the grid; a stated role goes before one by the type.
    """
    u = cells_in_um(cells.select("slide", "cell_id", "delivery_id", "cell_type", "role", "cx", "cy", "coord_unit"), units)
    by_type = roles.select(united(F.col("cell_type")).alias("__t"), united(F.col("role")).alias("__r")).where("__t is not null").groupBy("__t").agg(F.min("__r").alias("__r"))
    u = u.withColumn("__own", united(F.col("role")))
    u = u.withColumn("__k", F.when(F.col("__own").isNull(), united(F.col("cell_type")))).join(by_type, F.col("__k") == F.col("__t"), "left")
    kind = lambda r: F.when(r == "immune", QUERY).when(r == "tumor", NEIGHBOUR).otherwise(OTHER)
    code = F.when(F.col("__own").isNotNull(), kind(F.col("__own"))).when(F.col("__r").isNotNull(), 10 + kind(F.col("__r"))).otherwise(20 + OTHER)
    one = u.where("cell_id is not null and slide is not null").groupBy("slide", "cell_id", "qx", "qy").agg(F.min(code).alias("code"))
    return one.select("slide", F.col("cell_id").alias("id"), (F.col("code") % 10).alias("kind"), "qx", "qy")


def cells_near_and_inside(cells: DataFrame, deliveries: DataFrame, documents: DataFrame, slides: DataFrame, roles: DataFrame, rois: DataFrame, radius_um: float = 20.0) -> DataFrame:
    """Immune cells at most ``radius_um`` from a tumour cell of the slide, and cells strictly inside regions."""
    units = position_units(cells, deliveries, documents, slides)
    found = near_and_inside(cell_points(cells, roles, units), rings_on_grid(rois), round(radius_um * 10))
    return found.distinct()
