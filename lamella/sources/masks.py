"""Cell-mask export documents: nested arrays, or the same as JSON text with small differences in form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamella.session import cut

MASK = "struct<cell_type:string,confidence:double,centroid:array<double>,coordinates:array<array<double>>>"
TILE = f"struct<x:bigint,y:bigint,width:bigint,height:bigint,masks:array<{MASK}>>"
#: Coordinates stay text at first: their points are pairs or objects with x and y.
TEXT_TILE = TILE.replace("coordinates:array<array<double>>", "coordinates:string")
TEXT_DOCUMENT = f"struct<inference_mpp:double,cell_masks:array<{TEXT_TILE}>,payload:struct<inference_mpp:double,cell_masks:array<{TEXT_TILE}>>>"


def _points(text: Column) -> Column:
    pairs = F.from_json(text, "array<array<double>>")
    objects = F.transform(F.from_json(text, "array<struct<x:double,y:double>>"), lambda p: F.when(p.isNotNull(), F.array(p["x"], p["y"])))
    return F.when(F.rlike(text, F.lit(r"^\s*\[\s*(null\s*,\s*)*\{")), objects).otherwise(pairs)


def _mask(m: Column) -> Column:
    full = F.struct(m["cell_type"].alias("cell_type"), m["confidence"].alias("confidence"), m["centroid"].alias("centroid"), _points(m["coordinates"]).alias("coordinates"))
    return F.when(m.isNotNull(), full)


def _tile(t: Column) -> Column:
    full = F.struct(t["x"].alias("x"), t["y"].alias("y"), t["width"].alias("width"), t["height"].alias("height"), F.transform(t["masks"], _mask).alias("masks"))
    return F.when(t.isNotNull(), full)


def json_tiles(text: Column) -> Column:
    """Tiles of a document in JSON text, wrapped in ``payload`` or not; text that isn't such a document gives null."""
    doc = F.from_json(text, TEXT_DOCUMENT)
    return F.transform(F.coalesce(doc["cell_masks"], doc["payload"]["cell_masks"]), _tile).cast(f"array<{TILE}>")


def unified(documents: DataFrame) -> DataFrame:
    """``documents`` with ``cell_masks`` filled from ``raw_json`` where it is null. Positions in arrays don't change."""
    return documents.withColumn("cell_masks", F.coalesce(F.col("cell_masks").cast(f"array<{TILE}>"), F.when(F.col("cell_masks").isNull() & F.col("raw_json").isNotNull(), json_tiles(F.col("raw_json"))))).drop("raw_json")


def read_json_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Cell-mask files, one document a file, as ``path``, ``inference_mpp``, ``cell_masks``.

    A file is one row of one task, whatever its form; :func:`read_split_documents` reads files of any size.
    """
    texts = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    doc = F.from_json("value", TEXT_DOCUMENT)
    known = F.rlike(F.col("value"), F.lit('"cell_masks"'))
    checked = F.when(known, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("not a cell-mask document: "), F.col("path"))))
    return texts.withColumn("value", checked).select("path", F.coalesce(doc["inference_mpp"], doc["payload"]["inference_mpp"]).alias("inference_mpp"), json_tiles(F.col("value")).alias("cell_masks"))


#: What stands between the tiles' masks; a file is cut at every such key, so its parts are read by many tasks.
MASKS_KEY = '"masks"'
#: At the end of a piece: tiles without masks, and the fields that the next tile has before its masks.
NEXT_TILE = r"((?:(?:null|\{[^{}]*\})\s*,\s*)*)\{([^{}]*)$"
STATED_MPP = r'"inference_mpp"\s*:\s*([-+0-9.eE]+)'


def read_split_documents(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Cell-mask files of any size: ``path, inference_mpp`` of every file, and ``path, tile_pos, t`` of its tiles with masks.

    Spark's text source cuts a file at each ``"masks"`` key, and large files are split as any text is. A piece then
    begins with a tile's masks and ends with the fields of the next tile that come before its masks. Those are handed on
    within a split of the file by a window; between splits, and for the tiles' numbers, by a table of one row per split.
    ``tile_pos`` counts all tiles, null ones and those without masks too. Order of fields and white space are free; the
    fields of a tile other than ``masks`` must be plain values. A file that isn't such a document is an error.
    """
    pieces = spark.read.option("lineSep", MASKS_KEY).text(paths)
    tail = F.substring_index("value", "]", -1)
    more = F.rlike(tail, F.lit(NEXT_TILE))
    pieces = pieces.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("k"), "value",
        F.when(more, F.regexp_extract(tail, NEXT_TILE, 2)).alias("lead"), (F.regexp_count(F.regexp_extract(tail, NEXT_TILE, 1), F.lit(r"(null|\})\s*,")) + 1).cast("bigint").alias("step"),
    )
    opens = (F.col("part") == 0) & F.contains("value", F.lit('"cell_masks"'))
    stated = F.when(opens | F.col("lead").isNull(), F.regexp_extract("value", STATED_MPP, 1))
    parts = cut(pieces.groupBy("path", "part").agg(F.max_by("lead", "k").alias("lead"), F.sum("step").alias("steps"), F.max(F.nullif(stated, F.lit(""))).alias("mpp"), F.bool_or(opens).alias("opens")))
    files = parts.groupBy("path").agg(F.max("mpp").cast("double").alias("inference_mpp"), F.bool_or("opens").alias("opens"))
    files = files.withColumn("inference_mpp", F.when(F.col("opens"), F.col("inference_mpp")).otherwise(F.raise_error(F.concat(F.lit("not a cell-mask document: "), F.col("path"))).cast("double"))).drop("opens")
    # one row per split of a file
    through = Window.partitionBy("path").orderBy("part")
    bounds = parts.select("path", "part", F.lag("lead").over(through).alias("handed"), F.coalesce(F.sum("steps").over(through.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = Window.partitionBy("path", "part").orderBy("k")
    own = pieces.withColumns({"nth": F.row_number().over(inside), "before": F.lag("lead").over(inside), "since": F.coalesce(F.sum("step").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    # the piece before the first key holds no masks
    head = (F.col("part") == 0) & (F.col("nth") == 1)
    own = own.where(~head).join(bounds, ["path", "part"])
    front = F.from_json(F.concat(F.lit("{"), F.regexp_replace(F.when(F.col("nth") == 1, F.col("handed")).otherwise(F.col("before")), r",\s*$", ""), F.lit("}")), "x bigint, y bigint, width bigint, height bigint")
    # filters may be put together in any order, so the first piece must not fail here
    clean = F.when(head | F.rlike("value", F.lit(r"^\s*:")), F.col("value")).otherwise(F.raise_error(F.concat(F.lit('"masks" is no key in '), F.col("path"))))
    # whatever follows the tile's end is not looked at
    rows = own.select("path", (F.col("base") + F.col("since") - 1).cast("int").alias("tile_pos"), front.alias("f"), _tile(F.from_json(F.concat(F.lit("{" + MASKS_KEY), clean), TEXT_TILE)).alias("t"))
    t = F.struct(*[F.coalesce(f"t.{c}", f"f.{c}").alias(c) for c in ("x", "y", "width", "height")], F.col("t.masks").alias("masks")).cast(TILE)
    return files, rows.select("path", "tile_pos", t.alias("t"))


def read_tile_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Tiles as JSON lines ``{slide, x, y, width, height, masks}``: splittable, so a slide of any size is many tasks."""
    return spark.read.schema("slide string, x bigint, y bigint, width bigint, height bigint, masks array<" + MASK + ">").json(paths)


GEOJSON = "struct<type:string,features:array<struct<geometry:struct<type:string,coordinates:string>,properties:struct<classification:struct<name:string>,measurements:struct<confidence:double>>>>>"


def read_geojson(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Polygons of FeatureCollections: ``path, feature_pos, cell_type, confidence, ring`` (exterior ring only).

    Features of other geometry are left out; a missing type is ``Unknown``, a missing confidence 1.0; a closing vertex
    is stripped and rings of fewer than three vertices are left out after that.
    """
    doc = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", GEOJSON).alias("d"))
    checked = doc.withColumn("d", F.when(F.col("d.type") == "FeatureCollection", F.col("d")).otherwise(F.raise_error(F.concat(F.lit("not a FeatureCollection: "), F.col("path")))))
    features = checked.select("path", F.posexplode("d.features").alias("feature_pos", "f")).where("f.geometry.type = 'Polygon'")
    rings = features.select(
        "path",
        "feature_pos",
        F.coalesce("f.properties.classification.name", F.lit("Unknown")).alias("cell_type"),
        F.coalesce("f.properties.measurements.confidence", F.lit(1.0)).alias("confidence"),
        open_ring(F.element_at(F.from_json("f.geometry.coordinates", "array<array<array<double>>>"), 1)).alias("ring"),
    )
    return rings.where(F.size("ring") >= 3)


def read_regions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Polygons and multipolygons of FeatureCollections with all of their rings: ``path, region, rings``, in px.

    ``region`` is the feature's place. Exteriors and holes of all parts stand in one list, as parity tells them apart.
    """
    doc = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", GEOJSON).alias("d"))
    shapes = doc.select("path", F.posexplode("d.features").alias("region", "f")).select("path", "region", "f.geometry.type", "f.geometry.coordinates")
    rings = F.when(F.col("type") == "Polygon", F.from_json("coordinates", "array<array<array<double>>>"))
    rings = rings.when(F.col("type") == "MultiPolygon", F.flatten(F.from_json("coordinates", "array<array<array<array<double>>>>")))
    return shapes.select("path", "region", rings.alias("rings")).where("rings is not null")


def open_ring(points: Column) -> Column:
    """Points without nulls and without one closing point that repeats the first."""
    whole = F.filter(points, lambda p: p.isNotNull())
    closed = (F.size(whole) > 1) & (F.element_at(whole, 1) == F.element_at(whole, -1))
    return F.when(closed, F.slice(whole, 1, F.size(whole) - 1)).otherwise(whole)
