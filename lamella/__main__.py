"""``python -m lamella [features|export|diversity] ROOT -o OUT``: tables and overlays of all slide folders under ROOT."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.operators import features, patches
from lamella.operators.cells import at_least
from lamella.operators.clusters import cluster_hulls, members, tagged
from lamella.operators.delaunay import Sites, delaunay, delaunay_edges
from lamella.session import Table
from lamella.sources.cells import load_cells
from lamella.sources.discovery import cached, slide_files, write_features, write_patch_tables
from lamella.sources.geojson import edge_features, hull_features, interaction_edges, measured_features, write_collections
from lamella.sources.masks import read_split_documents

PATTERNS = ["cell_masks.json", "cell_masks.geojson"]


def _cells(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The cell table of all slides, kept beside the output and made anew when a file is newer."""
    files = slide_files(spark, a.root, a.pattern or PATTERNS)
    if not files:
        raise SystemExit(f"no slide folder with a cell file under {a.root}")
    paths = list(files.values())
    # a resolution given by hand isn't the files' own, so such a table isn't kept
    table = Table(load_cells(spark, paths, a.mpp)).df if a.mpp is not None else cached(spark, f"{a.out}.cells", paths, lambda: load_cells(spark, paths), a.rebuild_cache)
    return at_least(table, a.min_confidence)


def _features(spark: SparkSession, a: argparse.Namespace) -> None:
    found = features.all_features(_cells(spark, a), round(a.max_edge_um * 10), a.min_cluster, round(a.near_um * 10))
    write_features(features.wide(found, features.FEATURES), a.out)


def _export(spark: SparkSession, a: argparse.Namespace) -> None:
    """Collections by slide: cluster hulls, edges between two roles, cells with measurements."""
    if not (a.clusters or a.interactions or a.measurements):
        raise SystemExit("say at least one of --clusters, --interactions, --measurements")
    cells, longest = _cells(spark, a), round(a.max_edge_um * 10)
    mpp = cells.groupBy("slide").agg(F.max("scale").alias("mpp"))
    if a.clusters:
        hulls = cluster_hulls(members(delaunay(Sites(tagged(cells, False)), longest)), a.min_cluster)
        write_collections(hull_features(hulls, mpp), f"{a.out}/clusters")
    if a.interactions or a.measurements:
        edges = delaunay_edges(cells.select("slide", F.col("cell_id").alias("id"), "qx", "qy"), longest)
        if a.interactions:
            chosen = interaction_edges(cells, edges, *a.edge_roles, most=a.max_edges)
            write_collections(edge_features(chosen, cells, mpp, *a.edge_roles), f"{a.out}/edges")
        if a.measurements:
            write_collections(measured_features(cells, features.measurements(features.nodes_of(cells, edges)[1])), f"{a.out}/cells")


def _diversity(spark: SparkSession, a: argparse.Namespace) -> None:
    """Diversity of patches (``slide, patch_x_level0, patch_y_level0, patch_px`` as parquet) and slides, and slides without a partner."""
    files = slide_files(spark, a.root, a.pattern or PATTERNS[:1])
    folder = F.element_at(F.split("path", "/"), -2)
    headers, tiles = read_split_documents(spark, list(files.values()))
    docs = tiles.select(folder.alias("slide"), F.xxhash64("path", "tile_pos").alias("export_id"), F.array("t").alias("cell_masks"))
    grid = spark.read.parquet(a.patches)
    if patches.off_grid(grid).limit(1).count():
        raise SystemExit("patch corners that are no multiple of their side")
    found = Table(headers.select(folder.alias("slide"), F.col("inference_mpp").alias("mpp")).distinct()).df
    pairs = grid.select("slide").distinct().withColumn("patches", F.lit(True)).join(found.withColumn("cells", F.lit(True)), "slide", "full")
    pairs.select("slide", F.coalesce("patches", F.lit(False)).alias("patches"), F.coalesce("cells", F.lit(False)).alias("cells")).where("not (patches and cells)").write.mode("overwrite").option("header", True).csv(f"{a.out}/unpaired.csv")
    grid = grid.join(found.select("slide"), "slide", "left_semi")
    cells = Table(patches.mask_cells(docs, a.min_confidence).join(grid.select("slide").distinct(), "slide", "left_semi")).df
    side = grid.select("slide", "patch_px").distinct()
    # the vocabulary of types is small and one for all slides
    types = sorted(r["cell_type"] for r in patches.vocabulary(cells).collect())
    by_slide = patches.type_columns(cells.groupBy("slide", "cell_type").agg(F.count("*").alias("k")), ["slide"], types)
    rows = patches.slide_diversity(cells, grid, side, found).join(by_slide, "slide", "left").na.fill(0, [f"n_{t}" for t in types])
    rows.orderBy("slide").write.mode("overwrite").option("header", True).csv(f"{a.out}/slide_diversity.csv")
    keys = ["slide", "patch_x_level0", "patch_y_level0"]
    by_patch = patches.type_columns(patches.binned(cells, grid, side).where("patch_x_level0 is not null").groupBy(*keys, "cell_type").agg(F.count("*").alias("k")), keys, types)
    table = patches.patch_diversity(cells, grid, side).join(by_patch, keys, "left").na.fill(0, [f"n_{t}" for t in types])
    write_patch_tables(table, f"{a.out}/patch_diversity")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="lamella", description=__doc__)
    p.add_argument("command", nargs="?", choices=["features", "export", "diversity"], default="features")
    p.add_argument("root")
    p.add_argument("-o", "--out", required=True)
    p.add_argument("--pattern", action="append", help="file patterns of a slide folder, the first that fits is taken")
    p.add_argument("--min-confidence", type=float, default=0.0)
    p.add_argument("--max-edge-um", type=float, default=50.0)
    p.add_argument("--min-cluster", type=int, default=5)
    p.add_argument("--near-um", type=float, default=20.0)
    p.add_argument("--mpp", type=float)
    p.add_argument("--rebuild-cache", action="store_true")
    p.add_argument("--clusters", action="store_true")
    p.add_argument("--interactions", action="store_true")
    p.add_argument("--measurements", action="store_true")
    p.add_argument("--edge-roles", nargs=2, default=("immune", "tumor"))
    p.add_argument("--max-edges", type=int, help="draw so many edges by hash")
    p.add_argument("--patches", help="patch grid of diversity")
    a = p.parse_args(argv)
    {"features": _features, "export": _export, "diversity": _diversity}[a.command](SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main()
