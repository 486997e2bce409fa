"""Patch grids: inference tiles that cover patches, cells binned to patches, and diversity per patch and slide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions.labels import type_name
from lamella.operators.features import entropy
from lamella.operators.flatten import flatten

#: Side of an inference tile in px (784 with an overlap of 64 on both sides).
TILE_SIDE = 784 - 2 * 64


def last_patches(patches: DataFrame, order: list[str]) -> DataFrame:
    """One row per slide and corner: of repeated patches the last in ``order``."""
    w = Window.partitionBy("slide", "patch_x_level0", "patch_y_level0").orderBy(*[F.desc_nulls_last(c) for c in order])
    return patches.where("patch_x_level0 is not null and patch_y_level0 is not null").withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def off_grid(patches: DataFrame) -> DataFrame:
    """Patches whose corner is no multiple of their side (``patch_px``): a tiling with any is not valid."""
    return patches.where("patch_x_level0 % patch_px <> 0 or patch_y_level0 % patch_px <> 0")


def deepzoom_level(width: Column, height: Column) -> Column:
    return F.ceil(F.log2(F.greatest(width, height)))


def model_mpp(magnification: Column) -> Column:
    """Resolution of the segmentation model for a slide."""
    return F.when(magnification >= 40, 0.25).otherwise(0.5)


def covering_tiles(patches: DataFrame, tile: int = TILE_SIDE) -> DataFrame:
    """``slide, col, row``: distinct tiles that meet a patch, clamped to the slide.

    ``patches``: ``slide, patch_x_level0, patch_y_level0, patch_px, level0_width, level0_height``. A patch beyond the
    slide's last tile gives none.
    """
    def span(at: str, size: str) -> Column:
        lo = F.floor(F.col(at) / tile)
        hi = F.least(F.floor((F.col(at) + F.col("patch_px") - 1) / tile), F.floor((F.col(size) + tile - 1) / tile) - 1)
        return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))

    spans = patches.select("slide", F.explode(span("patch_x_level0", "level0_width")).alias("col"), span("patch_y_level0", "level0_height").alias("rows"))
    return spans.select("slide", "col", F.explode("rows").alias("row")).distinct()


def mask_cells(documents: DataFrame, confidence: float = 0.0) -> DataFrame:
    """``slide, cell_type, x, y`` of masks with a centroid (level-0 px), repeated documents once; missing confidence counts as 1."""
    docs = flatten(documents, "masks", ("export_id", "slide")).distinct()
    kept = docs.where(F.col("centroid_x").isNotNull() & F.col("centroid_y").isNotNull() & ~(F.coalesce("confidence", F.lit(1.0)) < confidence))
    return kept.select("slide", type_name(F.col("cell_type")).alias("cell_type"), F.col("centroid_x").alias("x"), F.col("centroid_y").alias("y"))


def binned(cells: DataFrame, patches: DataFrame, side: DataFrame) -> DataFrame:
    """Cells with the corner of the patch they fall into, null outside all patches. ``side``: ``slide, patch_px``."""
    s = side.groupBy("slide").agg(F.max("patch_px").alias("patch_px"))
    c = cells.join(s, "slide").withColumn("bx", F.floor(F.col("x") / F.col("patch_px"))).withColumn("by", F.floor(F.col("y") / F.col("patch_px")))
    p = patches.select("slide", "patch_x_level0", "patch_y_level0").distinct().join(s, "slide")
    p = p.select("slide", F.floor(F.col("patch_x_level0") / F.col("patch_px")).alias("bx"), F.floor(F.col("patch_y_level0") / F.col("patch_px")).alias("by"), "patch_x_level0", "patch_y_level0")
    # of corners in one cell of the grid, which a valid grid has not, the last
    p = p.groupBy("slide", "bx", "by").agg(F.max(F.struct("patch_x_level0", "patch_y_level0")).alias("p")).select("slide", "bx", "by", "p.*")
    return c.join(p, ["slide", "bx", "by"], "left")


def diversity(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, n_cells, richness, shannon, shannon_norm, simpson, inv_simpson`` of rows ``keys, cell_type, k``; zeros where nothing counts."""
    g = counts.groupBy(*keys).agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n_cells"), F.collect_list(F.when(F.col("k") > 0, F.col("k").cast("double"))).alias("ks"))
    square = F.aggregate("ks", F.lit(0.0), lambda a, x: a + (x / F.col("n_cells")) ** 2)
    some = F.col("n_cells") > 0
    g = g.withColumn("shannon", entropy(F.array_sort("ks"))).withColumn("richness", F.size("ks"))
    return g.select(
        *keys, "n_cells", "richness", "shannon", F.when(F.col("richness") > 1, F.col("shannon") / F.log(F.col("richness").cast("double"))).otherwise(0.0).alias("shannon_norm"),
        F.when(some, 1 - square).otherwise(0.0).alias("simpson"), F.when(some, 1 / square).otherwise(0.0).alias("inv_simpson"),
    )


def patch_diversity(cells: DataFrame, patches: DataFrame, side: DataFrame) -> DataFrame:
    """Diversity of every patch, empty ones included."""
    keys = ["slide", "patch_x_level0", "patch_y_level0"]
    counts = binned(cells, patches, side).where("patch_x_level0 is not null").groupBy(*keys, "cell_type").agg(F.count("*").alias("k"))
    return diversity(patches.select(*keys).where("patch_x_level0 is not null and patch_y_level0 is not null").distinct().join(counts, keys, "left"), keys)


def slide_diversity(cells: DataFrame, patches: DataFrame, side: DataFrame, mpp: DataFrame) -> DataFrame:
    """Diversity of all cells of a slide, those outside patches too, with their number, tissue area and density."""
    d = diversity(cells.groupBy("slide", "cell_type").agg(F.count("*").alias("k")), ["slide"])
    out = binned(cells, patches, side).where("patch_x_level0 is null").groupBy("slide").agg(F.count("*").alias("n_outside"))
    n = patches.where("patch_x_level0 is not null and patch_y_level0 is not null").select("slide", "patch_x_level0", "patch_y_level0").distinct().groupBy("slide").agg(F.count("*").alias("n_patches"))
    j = n.join(side.groupBy("slide").agg(F.max("patch_px").alias("patch_px")), "slide").join(mpp, "slide", "left").join(d, "slide", "left").join(out, "slide", "left")
    mm2 = F.col("n_patches") * F.col("patch_px") ** 2 * F.col("mpp") ** 2 / 1e6
    zero = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_cells", "richness", "shannon", "shannon_norm", "simpson", "inv_simpson", "n_outside")]
    return j.select("slide", "n_patches", *zero, (F.col("n_patches") * F.col("patch_px") ** 2).alias("tissue_px2"), mm2.alias("tissue_mm2"), F.when(mm2 > 0, F.coalesce("n_cells", F.lit(0)) / mm2).alias("cells_per_mm2"))


def vocabulary(cells: DataFrame) -> DataFrame:
    """``cell_type`` of every type that occurs, each once."""
    return cells.select("cell_type").distinct()


def type_columns(counts: DataFrame, keys: list[str], types: list[str]) -> DataFrame:
    """``keys`` and one column ``n_<type>`` per type of a given vocabulary, zero where a type is absent."""
    wide = counts.groupBy(*keys).pivot("cell_type", types).agg(F.sum("k"))
    return wide.select(*keys, *[F.coalesce(F.col(f"`{t}`"), F.lit(0)).alias(f"n_{t}") for t in types])
