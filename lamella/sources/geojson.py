"""GeoJSON features as rows of text, and collections of them as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions.labels import type_name
from lamella.sources.masks import open_ring

# Display colours of cluster hulls by role, of edges by pair of roles, of cells by type; other things are grey.
ROLE_COLORS = {"immune": (27, 158, 138), "tumor": (224, 123, 57), "stroma": (122, 122, 122)}
EDGE_COLORS = {("immune", "tumor"): (155, 93, 229), ("immune", "stroma"): (0, 187, 249), ("stroma", "tumor"): (181, 201, 40)}
TYPE_COLORS = {
    "Lymphocytes": (0, 128, 255), "Plasmocytes": (128, 0, 255), "Macrophages": (255, 0, 128), "Neutrophils": (255, 255, 0), "Eosinophils": (255, 64, 64),
    "Cancer cell": (220, 20, 60), "Epithelial": (200, 200, 200), "Fibroblasts": (255, 165, 0), "Minor Stromal Cell": (160, 120, 90), "Muscle Cell": (128, 64, 0),
    "Endothelial Cell": (0, 200, 200), "Apoptotic Body": (80, 80, 80), "Red blood cell": (180, 0, 0), "Mitotic Figures": (255, 0, 0),
}
GREY = (150, 150, 150)


def color(key: Column, table: dict[str, tuple[int, int, int]]) -> Column:
    out = F.array(*map(F.lit, GREY))
    for k, rgb in table.items():
        out = F.when(key == k, F.array(*map(F.lit, rgb))).otherwise(out)
    return out


def type_color(cell_type: Column) -> Column:
    """The colour of a type in any spelling."""
    return color(type_name(cell_type), {k.lower(): v for k, v in TYPE_COLORS.items()})


def _feature(kind: str, geometry: Column, name: Column, rgb: Column, measurements: Column) -> Column:
    properties = F.struct(F.lit(kind).alias("objectType"), F.struct(name.alias("name"), rgb.alias("color")).alias("classification"), measurements.alias("measurements"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")))


def hull_features(hulls: DataFrame, mpp: DataFrame) -> DataFrame:
    """``slide, role, cluster, feature``: cluster hulls as closed polygons in px; hulls without area are left out."""
    points = F.transform(F.sequence(F.lit(0), (F.size("ring") / 2 - 1).cast("int")), lambda i: F.array(*[F.round(F.get("ring", (2 * i + k).cast("int")) / 10 / F.col("mpp"), 2) for k in (0, 1)]))
    h = hulls.where("ring is not null and area > 0").join(mpp, "slide").withColumn("pts", points)
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(F.concat("pts", F.slice("pts", 1, 1))).alias("coordinates"))
    m = F.struct(F.col("n").alias("n_cells"), F.round(F.col("area") / 100, 3).alias("area_um2"))
    return h.select("slide", "role", "cluster", _feature("annotation", geometry, F.concat("role", F.lit("_cluster")), color(F.col("role"), ROLE_COLORS), m).alias("feature"))


def interaction_edges(cells: DataFrame, edges: DataFrame, role_a: str = "immune", role_b: str = "tumor", most: int | None = None) -> DataFrame:
    """``slide, i, j, steps`` of edges between two roles in either order; ``most`` draws a fixed uniform sample by hash."""
    role = cells.select("slide", "cell_id", "role")
    e = edges.join(role.withColumnsRenamed({"cell_id": "i", "role": "ri"}), ["slide", "i"]).join(role.withColumnsRenamed({"cell_id": "j", "role": "rj"}), ["slide", "j"])
    e = e.where(((F.col("ri") == role_a) & (F.col("rj") == role_b)) | ((F.col("ri") == role_b) & (F.col("rj") == role_a))).select("slide", "i", "j", "steps")
    return e if most is None else e.orderBy(F.xxhash64(F.lit(0), "i", "j")).limit(most)


def edge_features(edges: DataFrame, cells: DataFrame, mpp: DataFrame, role_a: str = "immune", role_b: str = "tumor") -> DataFrame:
    """``slide, i, j, feature``: edges between two roles as lines in px."""
    at = cells.select("slide", "cell_id", "qx", "qy")
    e = edges.join(at.withColumnsRenamed({"cell_id": "i", "qx": "ix", "qy": "iy"}), ["slide", "i"]).join(at.withColumnsRenamed({"cell_id": "j", "qx": "jx", "qy": "jy"}), ["slide", "j"]).join(mpp, "slide")
    px = lambda c: F.round(F.col(c) / 10 / F.col("mpp"), 2)
    geometry = F.struct(F.lit("LineString").alias("type"), F.array(F.array(px("ix"), px("iy")), F.array(px("jx"), px("jy"))).alias("coordinates"))
    rgb = F.array(*map(F.lit, EDGE_COLORS.get(tuple(sorted((role_a, role_b))), GREY)))
    return e.select("slide", "i", "j", _feature("annotation", geometry, F.lit(f"{role_a}_{role_b}_edge"), rgb, F.struct(F.round(F.col("steps") / 10, 3).alias("length_um"))).alias("feature"))


def cell_features(documents: DataFrame) -> DataFrame:
    """``export_id, tile_pos, mask_pos, feature``: masks as detections with closed rings offset by their tile; under three points none."""
    t = documents.select("export_id", F.posexplode("cell_masks").alias("tile_pos", "t"))
    m = t.select("export_id", "tile_pos", F.col("t.x").alias("x"), F.col("t.y").alias("y"), F.col("t.width").alias("w"), F.col("t.height").alias("h"), F.posexplode("t.masks").alias("mask_pos", "m"))
    m = m.withColumn("ring", open_ring(F.col("m.coordinates"))).where("size(ring) >= 3")
    moved = F.transform("ring", lambda p: F.array(F.col("x") * F.col("w") + F.get(p, 0), F.col("y") * F.col("h") + F.get(p, 1)))
    m = m.withColumn("moved", moved)
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(F.concat("moved", F.slice("moved", 1, 1))).alias("coordinates"))
    name = F.coalesce("m.cell_type", F.lit("Unknown"))
    return m.select("export_id", "tile_pos", "mask_pos", _feature("detection", geometry, name, type_color(name), F.struct(F.coalesce("m.confidence", F.lit(0.0)).alias("confidence"))).alias("feature"))


def measured_features(cells: DataFrame, measured: DataFrame) -> DataFrame:
    """``slide, cell_id, feature``: cells of :func:`lamella.sources.cells.load_cells` as detections with eleven measurements.

    ``measured``: ``slide, cell_id`` and the neighbourhood's six. Rings go back to px; values that aren't defined are 0.
    """
    zero = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(0.0))
    names = {"confidence": "confidence", "area_um2": "area", "eccentricity": "eccentricity", "circularity": "circularity", "solidity": "solidity"}
    names |= {"neighborhood_immune_frac": "immune_frac", "neighborhood_tumor_frac": "tumor_frac", "neighborhood_mixedness": "mixedness", "area_local_sd_um2": "area_local_sd"}
    names |= {f"{c}_local_sd": f"{c}_local_sd" for c in ("eccentricity", "circularity")}
    c = cells.join(measured.select("slide", "cell_id", "immune_frac", "tumor_frac", "mixedness", "area_local_sd", "eccentricity_local_sd", "circularity_local_sd"), ["slide", "cell_id"], "left")
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(F.concat("ring", F.slice("ring", 1, 1))).alias("coordinates"))
    return c.select("slide", "cell_id", _feature("detection", geometry, F.col("cell_type"), type_color(F.col("cell_type")), F.struct(*[zero(v).alias(k) for k, v in names.items()])).alias("feature"))


def detection_counts(documents: DataFrame) -> DataFrame:
    """``export_id, cell_type, n, skipped``: masks that become detections and those of too few points, per type as stored."""
    m = documents.select("export_id", F.explode("cell_masks").alias("t")).select("export_id", F.explode("t.masks").alias("m")).where("m is not null")
    drawn = F.coalesce(F.size(open_ring(F.col("m.coordinates"))) >= 3, F.lit(False))
    return m.groupBy("export_id", F.coalesce("m.cell_type", F.lit("Unknown")).alias("cell_type")).agg(F.sum(drawn.cast("int")).alias("n"), F.sum((~drawn).cast("int")).alias("skipped"))


def write_collections(features: DataFrame, path: str) -> None:
    """Write ``feature`` texts as FeatureCollections: every partition is one complete, readable file of its own; with a
    column ``slide`` a partition holds one slide's features after the other's, each a collection in a folder of its slide."""
    named = "slide" in features.columns
    rows = features.select("slide", "feature").repartition("slide").sortWithinPartitions("slide") if named else features.select(F.lit("").alias("slide"), "feature")

    def work(batches):
        import pandas as pd

        held, begun, slide = None, False, None
        head = '{"type":"FeatureCollection","features":[\n'
        for pdf in batches:
            out = []
            for s, f in zip(pdf["slide"], pdf["feature"]):
                if held is not None:
                    out.append((slide, ("" if begun else head) + held + ("," if s == slide else "]}")))
                    begun = s == slide
                held, slide = f, s
            yield pd.DataFrame(out, columns=["slide", "value"])
        if held is not None or not named:
            yield pd.DataFrame({"slide": [slide or ""], "value": [("" if begun else head) + (held or "") + "]}"]})

    texts = rows.mapInPandas(work, "slide string, value string")
    writer = texts.write if named else texts.select("value").write
    (writer.partitionBy("slide") if named else writer).mode("overwrite").text(path)
