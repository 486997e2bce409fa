"""Cells of drawn regions, with holes and several parts, and the features of each region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.operators import features
from lamella.operators.near import OTHER, near_and_inside, on_grid
from lamella.session import Table


def regions_on_grid(regions: DataFrame, grid: float = 0.1) -> DataFrame:
    """``slide, id, ring`` as :func:`near_and_inside` takes them, of ``slide, region, rings, mpp`` with rings in px.

    ``id`` is a hash of slide and region. Points that lack a coordinate are left out, then rings of under three points,
    then regions without a ring; a region given twice counts once.
    """
    whole = F.transform("rings", lambda r: F.filter(r, lambda q: F.get(q, 0).isNotNull() & F.get(q, 1).isNotNull()))
    pairs = F.transform(F.filter(whole, lambda r: F.size(r) >= 3), lambda r: F.flatten(F.transform(r, lambda q: F.array(*[on_grid(F.get(q, k) * F.col("mpp"), grid) for k in (0, 1)]))))
    gap = F.array(F.lit(float("nan")), F.lit(float("nan")))
    joined = F.flatten(F.transform(pairs, lambda r, i: F.when(i == 0, r).otherwise(F.concat(gap, r))))
    return regions.select("slide", F.xxhash64("slide", "region").alias("id"), joined.alias("ring")).where("slide is not null and size(ring) >= 6").distinct()


def cells_in_regions(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """Cells strictly inside each of ``regions`` (``slide, id, ring`` on the grid), with the region as ``region``; rims are out."""
    points = cells.select("slide", F.col("cell_id").alias("id"), F.lit(OTHER).alias("kind"), "qx", "qy")
    found = near_and_inside(points, regions, 1).select(F.col("id_a").alias("region"), F.col("id_b").alias("cell_id")).distinct()
    return found.join(regions.select("slide", F.col("id").alias("region")), "region").join(cells, ["slide", "cell_id"])


def region_features(cells: DataFrame, regions: DataFrame) -> DataFrame:
    """The 144 features of the cells of each region as ``region, feature, value``; its graph is built anew on them."""
    # a region is a slide of its own here, so a cell may lie in several
    inside = Table(cells_in_regions(cells, regions).withColumn("slide", F.col("region").cast("string")).drop("region")).df
    return features.all_features(inside).select(F.col("slide").cast("bigint").alias("region"), "feature", "value")
