"""Cell tables from cell-mask files: one document a slide, rings in px, shapes in um."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from lamella.functions import hulls
from lamella.functions.labels import type_name, with_role
from lamella.functions.polygons import shape
from lamella.sources.discovery import read_head
from lamella.sources.masks import open_ring, read_geojson, read_split_documents

#: Roles of the cell types a segmentation model may give.
DEFAULT_ROLES = {
    "Lymphocytes": "immune", "Plasmocytes": "immune", "Macrophages": "immune", "Neutrophils": "immune", "Eosinophils": "immune",
    "Cancer cell": "tumor", "Mitotic Figures": "tumor", "Epithelial": "epithelial", "Fibroblasts": "stroma", "Minor Stromal Cell": "stroma",
    "Muscle Cell": "stroma", "Endothelial Cell": "endothelium", "Apoptotic Body": "other", "Red blood cell": "other",
}


@pandas_udf(DoubleType())
def ring_solidity(flat: pd.Series) -> pd.Series:
    return pd.Series(hulls.solidity(list(flat)), index=flat.index).astype(float)


def sibling_mpp(spark: SparkSession, path: str) -> float | None:
    """``inference_mpp`` in the head of the cell-mask document beside a file."""
    for name in ("cell_masks.json", "cell_masks.geojson"):
        m = re.search(r'"inference_mpp"\s*:\s*([0-9.eE+-]+)', read_head(spark, f"{path.rsplit('/', 1)[0]}/{name}"))
        if m:
            return float(m[1])
    return None


def _rings(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, pos, cell_type, confidence, ring, mpp`` of documents of both kinds."""
    geo = [p for p in paths if p.endswith(".geojson")]
    own = [p for p in paths if not p.endswith(".geojson")]
    parts = []
    if own:
        files, tiles = read_split_documents(spark, own)
        t = tiles.join(files, "path").select("path", F.col("inference_mpp").alias("mpp"), F.col("tile_pos").alias("ti"), "t")
        m = t.select("path", "mpp", "ti", F.col("t.x").alias("x"), F.col("t.y").alias("y"), F.col("t.width").alias("w"), F.col("t.height").alias("h"), F.posexplode("t.masks").alias("mi", "m")).where("size(m.coordinates) >= 3")
        moved = F.transform(open_ring(F.col("m.coordinates")), lambda p: F.array(F.col("x") * F.col("w") + F.get(p, 0), F.col("y") * F.col("h") + F.get(p, 1)))
        parts.append(m.select("path", F.struct("ti", "mi").alias("pos"), F.coalesce("m.cell_type", F.lit("Unknown")).alias("cell_type"), F.coalesce("m.confidence", F.lit(1.0)).alias("confidence"), moved.alias("ring"), "mpp"))
    if geo:
        g = read_geojson(spark, geo)
        beside = [(p.rsplit("/", 2)[-2] if "/" in p else "", m) for p in geo if (m := sibling_mpp(spark, p)) is not None]
        known = spark.createDataFrame(beside, "folder string, mpp double")
        g = g.withColumn("folder", F.element_at(F.split("path", "/"), -2)).join(known, "folder", "left")
        parts.append(g.select("path", F.struct(F.lit(0).alias("ti"), F.col("feature_pos").alias("mi")).alias("pos"), "cell_type", "confidence", "ring", "mpp"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_cells(spark: SparkSession, paths: str | list[str], mpp: float | None = None, roles: dict[str, str] | None = None, min_confidence: float = 0.0) -> DataFrame:
    """The cell table of cell-mask (``.json``) and FeatureCollection (``.geojson``) files, keyed by slide folder and ``cell_id``.

    ``mpp`` overrides the documents' own, for GeoJSON that of a cell-mask document in the same folder; a document
    without any is an error. ``cell_id`` is the mask's place in its document, unique within a slide. Coordinates and shapes are floats in
    um; ``qx, qy`` are the steps of 0.1 um that the graph operators take. Rings of under three points are left out.
    """
    rows = _rings(spark, [paths] if isinstance(paths, str) else paths)
    scale = F.lit(mpp).cast("double") if mpp is not None else F.coalesce("mpp", F.raise_error(F.concat(F.lit("no resolution known for "), F.col("path"))).cast("double"))
    s = rows.withColumn("scale", scale).withColumn("s", shape(F.col("ring"), F.col("scale")))
    table = spark.createDataFrame(list((roles or DEFAULT_ROLES).items()), "cell_type string, role string")
    folder = F.element_at(F.split("path", "/"), -2)
    place = F.shiftleft(F.col("pos.ti").cast("bigint"), 32) + F.col("pos.mi")
    named = s.select(folder.alias("slide"), place.alias("cell_id"), "cell_type", F.lit(None).cast("string").alias("role"), F.col("confidence").cast("float").alias("confidence"), "s", "ring", "scale")
    out = with_role(named, table).where(F.col("confidence") >= F.lit(min_confidence).cast("float")) if min_confidence > 0 else with_role(named, table)
    floats = [F.col(f"s.{c}").cast("float").alias(c) for c in ("area", "perimeter", "equiv_diameter", "major_axis", "minor_axis", "eccentricity", "orientation", "circularity", "extent")]
    at = lambda c: F.col(f"s.centroid_{c}").cast("float")
    return out.select("slide", "cell_id", type_name(F.col("cell_type")).alias("cell_type"), F.col("role_u").alias("role"), "confidence", at("x").alias("cx"), at("y").alias("cy"), F.round(at("x").cast("double") * 10).cast("bigint").alias("qx"), F.round(at("y").cast("double") * 10).cast("bigint").alias("qy"), *floats, F.when(F.col("s.area").isNotNull(), ring_solidity(F.flatten("ring"))).cast("float").alias("solidity"), "ring", "scale")
