"""Queries of the cell-analytics operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions.polygons import shape
from lamella.operators import clusters, features, patches
from lamella.operators.cells import ROLES, at_least, cell_table, stored_cells
from lamella.operators.delaunay import delaunay_edges
from lamella.operators.near import near_and_inside, rings_on_grid
from lamella.operators.units import patch_units, slide_resolution
from lamella.plans import sql
from lamella.plans.shape_sql import SHAPES
from lamella.session import Table, read
from lamella.sources.cells import ring_solidity
from lamella.sources import geojson
from lamella.sources.geojson import cell_features, edge_features, hull_features, interaction_edges
from lamella.sources.masks import unified

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 5
#: Means of points often stand halfway between two last digits; this lifts them to the upper one, as their SQL does.
TIE = 1e-9


def graph_edges(cells: DataFrame) -> DataFrame:
    return delaunay_edges(cells.select("slide", F.col("cell_id").alias("id"), "qx", "qy"))


def _rounded(block: DataFrame) -> DataFrame:
    """Values to the decimals that their SQL has."""
    exact = F.col("feature").rlike("(p10|p50|p90|median)$")
    return block.select("slide", "feature", F.when(exact, F.round("value", 9)).otherwise(F.round("value", DIGITS)).alias("value"))


def _graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    cells = stored_cells(spark, d)
    return cells, graph_edges(cells)


def _block(build) -> Query:
    """A query of a block that needs the cell table only."""
    return lambda spark, d: _rounded(build(stored_cells(spark, d)))


def _graph_block(build) -> Query:
    return lambda spark, d: _rounded(build(*_graph(spark, d)))


def _node_block(build) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        cells, edges = _graph(spark, d)
        ends, nodes = features.nodes_of(cells, edges)
        return _rounded(build(cells, nodes, ends))

    return query


def cells_view(spark: SparkSession, d: str) -> DataFrame:
    return cell_table(spark, d).select("slide", "cell_id", "cell_type", "role", "qx", "qy")


def confidence_filter(spark: SparkSession, d: str) -> DataFrame:
    return at_least(cell_table(spark, d), 0.5).groupBy("slide").agg(F.count("*").alias("n_cells"))


def tissue_area(spark: SparkSession, d: str) -> DataFrame:
    return features.tissue(cell_table(spark, d)).select("slide", "n", F.round("tissue_mm2", DIGITS).alias("tissue_mm2"), *ROLES)


def delaunay(spark: SparkSession, d: str) -> DataFrame:
    return _graph(spark, d)[1].select("slide", "i", "j", F.round(F.col("steps") / 10, 4).alias("edge_len"))


def degree(spark: SparkSession, d: str) -> DataFrame:
    cells, edges = _graph(spark, d)
    n = features.directed(edges).groupBy("slide", "cell_id").agg(F.count("*").alias("n"))
    return cells.join(n, ["slide", "cell_id"], "left").select("slide", "cell_id", F.coalesce("n", F.lit(0)).alias("degree"))


def neighbor_mean(spark: SparkSession, d: str) -> DataFrame:
    cells, edges = _graph(spark, d)
    values = cells.select("slide", "cell_id", F.col("confidence").cast("double").alias("value"))
    m = features.neighbor_mean(values, edges)
    return m.select("slide", "cell_id", F.round("mean", DIGITS).alias("mean_confidence"))


def pair_distances(spark: SparkSession, d: str) -> DataFrame:
    found = features.pair_distances(stored_cells(spark, d))
    return found.select("slide", "a", "b", "cell_id", F.round("um", 4).alias("um"))


def nearest_features(spark: SparkSession, d: str) -> DataFrame:
    cells = stored_cells(spark, d)
    return _rounded(features.nearest_features(cells, Table(features.pair_distances(cells)).df))


def infiltration(spark: SparkSession, d: str) -> DataFrame:
    cells, edges = _graph(spark, d)
    return _rounded(features.infiltration(cells, features.nodes_of(cells, edges)[1], Table(features.pair_distances(cells)).df))


def role_clusters(spark: SparkSession, d: str) -> DataFrame:
    return clusters.role_clusters(stored_cells(spark, d)).select("slide", "role", "cluster", "cell_id")


def _hulls(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    cells = stored_cells(spark, d)
    return cells, clusters.cluster_hulls(clusters.role_clusters(cells))


def cluster_hull(spark: SparkSession, d: str) -> DataFrame:
    h = _hulls(spark, d)[1]
    return h.select("slide", "role", "cluster", "n", F.round(F.col("area") / 100, 3).alias("area_um2"), F.round(F.col("perimeter") / 10, 4).alias("perimeter_um"), "ring")


def cluster_sizes(spark: SparkSession, d: str) -> DataFrame:
    s = clusters.cluster_summary(*_hulls(spark, d))
    return s.select("slide", "role", "n_clusters", F.round("clustered_frac", DIGITS).alias("clustered_frac"), F.round("mean_cluster_size", DIGITS).alias("mean_cluster_size"), "largest_cluster_size")


def cluster_features(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(features.cluster_features(*_hulls(spark, d)))


def cell_measurements(spark: SparkSession, d: str) -> DataFrame:
    """Per cell what a viewer shows; values that aren't defined are 0."""
    m = features.measurements(features.nodes_of(*_graph(spark, d))[1])
    return m.select("slide", "cell_id", *[F.round(c, DIGITS).alias(c) for c in ("immune_frac", "tumor_frac", "mixedness")], *[F.round(f"{c}_local_sd", 4).alias(f"{c}_local_sd") for c in ("area", "eccentricity", "circularity")])


def interaction(spark: SparkSession, d: str) -> DataFrame:
    cells, edges = _graph(spark, d)
    return interaction_edges(cells, edges).select("slide", "i", "j")


def feature_vector(spark: SparkSession, d: str) -> DataFrame:
    """The 144 features of each slide, tall."""
    return features.all_features(stored_cells(spark, d))


def cluster_geojson(spark: SparkSession, d: str) -> DataFrame:
    return hull_features(_hulls(spark, d)[1], slide_resolution(read(spark, d, "cell_masks"), read(spark, d, "slides")))


def mask_geojson(spark: SparkSession, d: str) -> DataFrame:
    return cell_features(unified(read(spark, d, "cell_masks")))


def edge_geojson(spark: SparkSession, d: str) -> DataFrame:
    """Edges between immune and tumour cells as lines."""
    cells, edges = _graph(spark, d)
    return edge_features(interaction_edges(cells, edges), cells, slide_resolution(read(spark, d, "cell_masks"), read(spark, d, "slides")))


def detection_counts(spark: SparkSession, d: str) -> DataFrame:
    return geojson.detection_counts(unified(read(spark, d, "cell_masks")).dropDuplicates(["export_id"]))


def roi_cells(spark: SparkSession, d: str) -> DataFrame:
    """``roi_id`` and the cells strictly inside it."""
    points = cell_table(spark, d).select("slide", F.col("cell_id").alias("id"), F.lit(2).alias("kind"), "qx", "qy")
    return near_and_inside(points, rings_on_grid(read(spark, d, "rois")), 1).select(F.col("id_a").alias("roi_id"), F.col("id_b").alias("cell_id")).distinct()


def roi_features(spark: SparkSession, d: str) -> DataFrame:
    """The 144 features of the cells of each region, with the graph built anew on them."""
    inside = roi_cells(spark, d)
    # a region is a slide of its own here, so a cell may lie in several
    cells = Table(inside.join(stored_cells(spark, d), "cell_id").withColumn("slide", F.col("roi_id").cast("string")).drop("roi_id")).df
    return _rounded(features.all_features(cells))


def polygon_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Shape descriptors of every stored ring, in the ring's own units."""
    docs = unified(read(spark, d, "cell_masks")).select("export_id", F.posexplode("cell_masks").alias("tile_pos", "t"))
    masks = docs.select("export_id", "tile_pos", F.posexplode("t.masks").alias("mask_pos", "m")).where("m.coordinates is not null and size(m.coordinates) >= 3")
    s = masks.select("export_id", "tile_pos", "mask_pos", shape(F.col("m.coordinates")).alias("s")).where("s is not null")
    names = ["area", "perimeter", "centroid_x", "centroid_y", "equiv_diameter", "major_axis", "minor_axis", "eccentricity", "orientation", "circularity", "extent"]
    return s.select("export_id", "tile_pos", "mask_pos", *[F.round(F.col(f"s.{n}") + (TIE if n.startswith("centroid") else 0.0), DIGITS).alias(n) for n in names]).distinct()


def solidity(spark: SparkSession, d: str) -> DataFrame:
    """Area of each stored ring as a share of its convex hull's; null for rings without area."""
    docs = unified(read(spark, d, "cell_masks")).select("export_id", F.posexplode("cell_masks").alias("tile_pos", "t"))
    masks = docs.select("export_id", "tile_pos", F.posexplode("t.masks").alias("mask_pos", "m")).where("size(m.coordinates) >= 3")
    share = ring_solidity(F.flatten("m.coordinates"))
    return masks.select("export_id", "tile_pos", "mask_pos", F.round(F.nanvl(share, F.lit(None)), 6).alias("solidity")).distinct()


def _tiling(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = lambda n: read(spark, d, n)
    mpp = Table(slide_resolution(t("cell_masks"), t("slides"))).df
    return t("patch_diversity"), Table(patch_units(t("slides"), t("patch_diversity"), mpp).select("slide", "patch_px")).df, mpp


def tile_expand(spark: SparkSession, d: str) -> DataFrame:
    p, side, _ = _tiling(spark, d)
    return patches.covering_tiles(p.join(side, "slide").join(read(spark, d, "slides").select("slide", "level0_width", "level0_height"), "slide"))


def _mask_cells(spark: SparkSession, d: str) -> DataFrame:
    return patches.mask_cells(unified(read(spark, d, "cell_masks")))


def patch_bin(spark: SparkSession, d: str) -> DataFrame:
    p, side, _ = _tiling(spark, d)
    b = patches.binned(_mask_cells(spark, d), p, side)
    return b.groupBy("slide", F.col("patch_x_level0").isNull().alias("outside")).agg(F.count("*").alias("n_cells"))


def patch_diversity(spark: SparkSession, d: str) -> DataFrame:
    p, side, _ = _tiling(spark, d)
    v = patches.patch_diversity(_mask_cells(spark, d), p, side)
    return v.select("slide", "patch_x_level0", "patch_y_level0", "n_cells", "richness", *[F.round(c, DIGITS).alias(c) for c in ("shannon", "shannon_norm", "simpson", "inv_simpson")])


def slide_diversity(spark: SparkSession, d: str) -> DataFrame:
    v = patches.slide_diversity(_mask_cells(spark, d), *_tiling(spark, d))
    return v.select("slide", "n_patches", "n_cells", "n_outside", "richness", *[F.round(c, DIGITS).alias(c) for c in ("shannon", "shannon_norm", "simpson", "inv_simpson", "tissue_px2", "tissue_mm2", "cells_per_mm2")])


def cell_type_vocab(spark: SparkSession, d: str) -> DataFrame:
    return patches.vocabulary(_mask_cells(spark, d))


def slide_headers(spark: SparkSession, d: str) -> DataFrame:
    """Pyramid level and model resolution of each slide."""
    s = read(spark, d, "slides")
    return s.select("slide", patches.deepzoom_level(F.col("level0_width"), F.col("level0_height")).cast("int").alias("deepzoom_level"), patches.model_mpp(F.col("level0_magnification")).alias("model_mpp"))


QUERIES: dict[str, Query] = {
    "cells_view": cells_view,
    "confidence_filter": confidence_filter,
    "tissue_area": tissue_area,
    "composition": _block(features.composition),
    "morphometry": _block(features.morphometry),
    "tumor_morphometry": _block(features.tumor_morphometry),
    "polygon_shapes": polygon_shapes,
    "solidity": solidity,
    "slide_headers": slide_headers,
    "tile_expand": tile_expand,
    "patch_bin": patch_bin,
    "patch_diversity": patch_diversity,
    "slide_diversity": slide_diversity,
    "cell_type_vocab": cell_type_vocab,
    "delaunay_edges": delaunay,
    "degree": degree,
    "neighbor_mean": neighbor_mean,
    "local_sd": _node_block(lambda cells, nodes, ends: features.local_sd(cells, nodes)),
    "type_boundary": _graph_block(features.type_boundary),
    "neighborhood": _node_block(features.neighborhood),
    "same_role": _node_block(lambda cells, nodes, ends: features.same_role(cells, nodes)),
    "edge_enrichment": _graph_block(features.edge_enrichment),
    "infiltration": infiltration,
    "pair_distances": pair_distances,
    "nearest_features": nearest_features,
    "immune_dispersion": _block(features.dispersion),
    "clusters": role_clusters,
    "cluster_sizes": cluster_sizes,
    "cluster_hull": cluster_hull,
    "cluster_features": cluster_features,
    "cell_measurements": cell_measurements,
    "interaction_edges": interaction,
    "cluster_geojson": cluster_geojson,
    "mask_geojson": mask_geojson,
    "edge_geojson": edge_geojson,
    "detection_counts": detection_counts,
    "roi_cells": roi_cells,
    "roi_features": roi_features,
    "feature_vector": feature_vector,
}
SQL = sql.REFERENCE | SHAPES
