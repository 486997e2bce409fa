"""Deeply nested export documents as four flat tables that keep parent-child links.

Higher-order projection only: nested ``transform`` calls attach the keys of all ancestors and the positions in them,
``flatten`` joins the arrays of one level, and one ``inline`` per table emits its rows. No join and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TABLES = ("documents", "tiles", "masks", "points")


def _rows(array: Column, make) -> Column:
    """An array of what ``make`` gives for each element and its position; null elements keep their position but give no row."""
    rows = F.transform(array, lambda x, i: F.when(x.isNotNull(), make(x, i)))
    return F.filter(rows, lambda r: r.isNotNull())



def point_count(coordinates: Column) -> Column:
    """Points of a ring, null points left out, less one if the last equals the first."""
    points = F.filter(coordinates, lambda p: p.isNotNull())
    closed = (F.size(points) > 1) & (F.element_at(points, 1) == F.element_at(points, -1))
    return F.when(coordinates.isNotNull(), F.size(points) - F.when(closed, 1).otherwise(0))


def _kept(x: Column, rows: Column, kind: str) -> Column:
    """``rows`` for a present parent; an empty array for a null one, which has no children."""
    return F.coalesce(F.when(x.isNotNull(), rows), F.array().cast(kind))


TILE_ROW = "array<struct<tile_pos:int,x:bigint,y:bigint,width:bigint,height:bigint,n_masks:int>>"
MASK_ROW = "array<struct<tile_pos:int,mask_pos:int,cell_type:string,confidence:double,centroid_x:double,centroid_y:double,n_stored:int,n_points:int>>"
POINT_ROW = "array<struct<tile_pos:int,mask_pos:int,point_pos:int,px:double,py:double>>"


def tile_rows(tiles: Column) -> Column:
    def make(t, i):
        return F.struct(i.cast("int").alias("tile_pos"), t["x"].alias("x"), t["y"].alias("y"), t["width"].alias("width"), t["height"].alias("height"), F.when(t["masks"].isNotNull(), F.size(t["masks"])).otherwise(0).alias("n_masks"))

    return _rows(tiles, make).cast(TILE_ROW)


def mask_rows(tiles: Column) -> Column:
    def one(t, i):
        def make(m, j):
            points = F.filter(m["coordinates"], lambda p: p.isNotNull())
            return F.struct(
                i.cast("int").alias("tile_pos"), j.cast("int").alias("mask_pos"), m["cell_type"].alias("cell_type"), m["confidence"].alias("confidence"),
                F.get(m["centroid"], 0).alias("centroid_x"), F.get(m["centroid"], 1).alias("centroid_y"),
                F.when(m["coordinates"].isNotNull(), F.size(points)).otherwise(0).alias("n_stored"), F.coalesce(point_count(m["coordinates"]), F.lit(0)).alias("n_points"),
            )

        return _kept(t["masks"], _rows(t["masks"], make), MASK_ROW)

    return F.flatten(F.transform(tiles, one)).cast(MASK_ROW)


def point_rows(tiles: Column) -> Column:
    def tile(t, i):
        def mask(m, j):
            def make(p, k):
                return F.struct(i.cast("int").alias("tile_pos"), j.cast("int").alias("mask_pos"), k.cast("int").alias("point_pos"), F.get(p, 0).alias("px"), F.get(p, 1).alias("py"))

            return _kept(m["coordinates"], _rows(m["coordinates"], make), POINT_ROW)

        return _kept(t["masks"], F.flatten(F.transform(t["masks"], mask)), POINT_ROW)

    return F.flatten(F.transform(tiles, tile)).cast(POINT_ROW)


def flatten(documents: DataFrame, table: str, keys: tuple[str, ...] = ("export_id",)) -> DataFrame:
    """One flat table of export documents (see :func:`lamella.sources.masks.unified`).

    ``documents``: the keys, every other column that isn't nested, ``n_tiles``. ``tiles``, ``masks``, ``points``: the
    keys, the positions in all ancestors (from 0, null elements counted) and the element's own fields. A null or empty
    array at any level gives no rows below it, a null element none for itself; documents repeated in the input are
    repeated in the output. ``n_stored`` counts the non-null points of a mask, ``n_points`` one less for a closed ring.
    """
    if table == "documents":
        plain = [c for c, kind in documents.dtypes if not kind.startswith(("array", "struct", "map"))]
        return documents.select(*plain, F.coalesce(F.when(F.col("cell_masks").isNotNull(), F.size("cell_masks")), F.lit(0)).alias("n_tiles"))
    rows = {"tiles": tile_rows, "masks": mask_rows, "points": point_rows}[table](F.col("cell_masks"))
    return documents.select(*keys, F.inline(rows))


def masks_found(documents: DataFrame) -> DataFrame:
    """One distinct row per non-null mask whose coordinates hold at least three points."""
    return flatten(documents, "masks").where("n_stored >= 3").select("export_id", "tile_pos", "mask_pos", "n_points").distinct()
