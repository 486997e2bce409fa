"""Queries of the general training-data problems (p1, p2, p3, p5) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions.labels import type_name
from lamella.operators.flatten import flatten, masks_found
from lamella.operators.near import cells_near_and_inside
from lamella.operators.skew import dominant_types, key_statistics, ordered_runs
from lamella.operators.units import cells_in_um, export_resolutions, patch_units, position_units, rings_in_px, slide_resolution, units_found
from lamella.plans.sql import CELLS, MPP, NOTE, SIDE
from lamella.session import cut, read
from lamella.sources.masks import unified

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return unified(read(spark, d, "cell_masks"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: read(spark, d, n)
    return cells_near_and_inside(t("cells"), t("deliveries"), _documents(spark, d), t("slides"), t("roles"), t("rois"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: read(spark, d, n)
    return units_found(t("cells"), t("deliveries"), _documents(spark, d), t("slides"), t("patch_diversity"))


def p2_cells_um(spark: SparkSession, d: str) -> DataFrame:
    """Every located cell in um, from whatever unit it came in."""
    t = lambda n: read(spark, d, n)
    cells = t("cells").select("cell_id", "slide", "delivery_id", "cx", "cy", "coord_unit")
    u = cells_in_um(cells, position_units(cells, t("deliveries"), _documents(spark, d), t("slides")))
    return u.select("cell_id", "slide", (F.col("qx") / 10).alias("x_um"), (F.col("qy") / 10).alias("y_um")).distinct()


def p2_resolutions(spark: SparkSession, d: str) -> DataFrame:
    """um per px of every export that tells a resolution, in its column or in its header text."""
    r = export_resolutions(_documents(spark, d), read(spark, d, "slides"))
    return r.where("export_id is not null").select("export_id", F.round("mpp", 6).alias("um_per_px")).distinct()


def p2_ring_points(spark: SparkSession, d: str) -> DataFrame:
    """Every ring point in level-0 px from its tile's corner, from whatever unit its export has."""
    docs, slides = _documents(spark, d).where("export_id is not null"), read(spark, d, "slides")
    points = rings_in_px(docs, slides, cut(slide_resolution(docs, slides)))
    return points.select("export_id", "tile_pos", "mask_pos", "point_pos", *[(F.round(c, 6) + 0.0).alias(c) for c in ("px", "py")])


def p2_patch_sizes(spark: SparkSession, d: str) -> DataFrame:
    """The patch size of every slide that has one, in level-0 px."""
    slides = read(spark, d, "slides")
    mpp = cut(slide_resolution(read(spark, d, "cell_masks"), slides))
    return patch_units(slides, read(spark, d, "patch_diversity"), mpp).select("slide_id", "slide", F.round("patch_px").alias("patch_px"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return dominant_types(read(spark, d, "cells"), _documents(spark, d))


def p3_type_statistics(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "cells").select(type_name(F.col("cell_type")).alias("cell_type"), F.col("area").cast("double").alias("area"))
    s = key_statistics(rows, ["cell_type"], "area")
    return s.select("cell_type", "n", "n_valid", F.round("mean", 4).alias("mean_area"), F.round("std", 4).alias("std_area"), F.col("low").alias("min_area"), F.col("high").alias("max_area"))


def p3_source_runs(spark: SparkSession, d: str) -> DataFrame:
    """Per type, its rows and how many runs of one source they make in order of arrival."""
    cells = read(spark, d, "cells").select(type_name(F.col("cell_type")).alias("cell_type"), "source", "ingested_at", "delivery_id", "cell_id")
    return ordered_runs(cells, ["cell_type"], "source", order=["ingested_at", "delivery_id", "cell_id"])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return masks_found(_documents(spark, d))


def _p5(table: str, *columns: str) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return flatten(_documents(spark, d), table).select(*columns).distinct()

    return query


QUERIES: dict[str, Query] = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_cells_um": p2_cells_um,
    "p2_resolutions": p2_resolutions,
    "p2_ring_points": p2_ring_points,
    "p2_patch_sizes": p2_patch_sizes,
    "p3_found": p3_found,
    "p3_source_runs": p3_source_runs,
    "p3_type_statistics": p3_type_statistics,
    "p5_found": p5_found,
    "p5_tiles": _p5("tiles", "export_id", "tile_pos", "x", "y", "width", "height", "n_masks"),
    "p5_points": _p5("points", "export_id", "tile_pos", "mask_pos", "point_pos", "px", "py"),
}

TYPE_SQL = "coalesce(nullif(trim(regexp_replace(lower(cell_type), '[\\s]+', ' ', 'g')), ''), 'unknown')"
#: Tiles of nested documents and of JSON text, as (export_id, tile_pos, tile as JSON).
TILE_SQL = """
tiles AS (
  SELECT export_id, i - 1 AS tile_pos, to_json(cell_masks[i]) AS tile
  FROM cell_masks, unnest(range(1, len(cell_masks) + 1)) AS u(i) WHERE cell_masks[i] IS NOT NULL
  UNION ALL
  SELECT export_id, i AS tile_pos, t[i + 1] AS tile FROM (
    SELECT export_id, coalesce(try_cast(json_extract(raw_json, '$.cell_masks') AS JSON[]), try_cast(json_extract(raw_json, '$.payload.cell_masks') AS JSON[])) AS t
    FROM cell_masks WHERE cell_masks IS NULL AND raw_json IS NOT NULL), unnest(range(0, len(t))) AS u(i)
  WHERE json_type(t[i + 1]) = 'OBJECT'),
masks AS (
  SELECT export_id, tile_pos, i AS mask_pos, m[i + 1] AS mask FROM (
    SELECT export_id, tile_pos, try_cast(json_extract(tile, '$.masks') AS JSON[]) AS m FROM tiles), unnest(range(0, len(m))) AS u(i)
  WHERE json_type(m[i + 1]) = 'OBJECT'),
points AS (
  SELECT export_id, tile_pos, mask_pos, c, len(c) AS n_stored FROM (
    SELECT export_id, tile_pos, mask_pos, try_cast(json_extract(mask, '$.coordinates') AS JSON[]) AS c FROM masks))
"""
#: um per px of each export; an unlabelled value takes the unit that fits its slide's magnification.
RESOLUTION_SQL = MPP.replace("SELECT slide, v, lower(u) AS u, m FROM (\n    SELECT e.slide", "SELECT slide, export_id, v, lower(u) AS u, m FROM (\n    SELECT e.slide, e.export_id").replace("SELECT slide, u, round(CASE", "SELECT slide, export_id, u, round(CASE")
#: Ring units by label, by header text, else by the slope of the masks' centroids on the means of their rings.
RING_SQL = """
said AS (
  SELECT export_id, slide, CASE
    WHEN t IS NULL OR t = '' THEN NULL WHEN t LIKE '%half%' OR t LIKE '%level-1%' THEN 'half'
    WHEN t LIKE 'fraction%' OR t LIKE '0..1%' THEN 'share' WHEN t LIKE 'um%' OR t LIKE 'µm%' OR t LIKE 'μm%' OR t LIKE 'micro%' THEN 'um' ELSE 'px' END AS unit
  FROM (SELECT DISTINCT export_id, slide, lower(trim(coalesce(nullif(trim(coord_space), ''), regexp_extract(header_text, '(?:polygon unit: |vertices given as |rings in )([^;]+)', 1)))) AS t FROM cell_masks)),
pt AS (
  SELECT DISTINCT export_id, tile_pos, mask_pos, i AS point_pos, CAST(coalesce(json_extract(c[i + 1], '$[0]'), json_extract(c[i + 1], '$.x')) AS DOUBLE) AS x, CAST(coalesce(json_extract(c[i + 1], '$[1]'), json_extract(c[i + 1], '$.y')) AS DOUBLE) AS y
  FROM points, unnest(range(0, len(c))) AS u(i) WHERE json_type(c[i + 1]) <> 'NULL'),
size AS (SELECT DISTINCT export_id, tile_pos, CAST(json_extract(tile, '$.x') AS DOUBLE) AS tx, CAST(json_extract(tile, '$.y') AS DOUBLE) AS ty, CAST(json_extract(tile, '$.width') AS DOUBLE) AS w, CAST(json_extract(tile, '$.height') AS DOUBLE) AS h FROM tiles),
mid AS (
  SELECT export_id, tile_pos, mask_pos, avg(x) AS mx, avg(y) AS my, max(greatest(x, y)) AS top FROM pt WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2, 3),
cen AS (SELECT DISTINCT export_id, tile_pos, mask_pos, CAST(json_extract(mask, '$.centroid[0]') AS DOUBLE) AS gx, CAST(json_extract(mask, '$.centroid[1]') AS DOUBLE) AS gy FROM masks),
slope AS (
  SELECT export_id, sum((gx - tx * w) * mx + (gy - ty * h) * my) / nullif(sum(mx * mx + my * my) FILTER (gx IS NOT NULL AND gy IS NOT NULL), 0) AS k, max(w) AS w, max(top) AS top
  FROM mid JOIN cen USING (export_id, tile_pos, mask_pos) JOIN size USING (export_id, tile_pos) GROUP BY 1),
unit AS (
  SELECT s.export_id, m.mpp, coalesce(s.unit, CASE list_position(gaps, list_min(gaps)) WHEN 1 THEN 'px' WHEN 2 THEN 'um' WHEN 3 THEN 'half' ELSE 'share' END) AS unit
  FROM (SELECT s.*, list_transform([1, 1 / m.mpp, 2, k.w], lambda v: abs(ln(CASE WHEN coalesce(k.k, k.w / k.top) > 0 THEN v / coalesce(k.k, k.w / k.top) END))) AS gaps FROM said s JOIN slope k USING (export_id) LEFT JOIN mpp m ON s.slide = m.slide) s
  LEFT JOIN mpp m ON s.slide = m.slide)"""
#: Names of the units in which values were recorded, by the rules that the values' own SQL has.
FOUND_SQL = f"""
cxu AS (
  SELECT cell_id, coalesce(label, {NOTE}, fit, 'um') AS unit
  FROM raw r LEFT JOIN deliveries d ON r.delivery_id = d.delivery_id LEFT JOIN best b ON r.delivery_id = b.delivery_id),
resu AS (
  SELECT export_id, CASE
    WHEN u LIKE '%dpi%' OR u LIKE '%inch%' THEN 'px_per_inch' WHEN u LIKE '%cm%' THEN 'px_per_cm' WHEN u LIKE 'nm%' THEN 'nm_per_px' WHEN u LIKE 'mm%' THEN 'mm_per_px' WHEN u IS NOT NULL THEN 'um_per_px'
    ELSE list_reduce([{{'n': 'um_per_px', 'x': v}}, {{'n': 'nm_per_px', 'x': v / 1e3}}, {{'n': 'mm_per_px', 'x': v * 1e3}}, {{'n': 'px_per_cm', 'x': 1e4 / v}}, {{'n': 'px_per_inch', 'x': 25400 / v}}],
      lambda a, b: CASE WHEN abs(ln(b.x * m / 10)) < abs(ln(a.x * m / 10)) THEN b ELSE a END).n END AS unit FROM res),
sizeu AS (
  SELECT slide_id, CASE
    WHEN t LIKE '%target%' THEN 'target_px' WHEN t LIKE '%px%' OR t LIKE '%pixel%' THEN 'px' WHEN t LIKE 'mm%' OR t LIKE 'milli%' THEN 'mm' WHEN t IS NOT NULL THEN 'um'
    WHEN abs(v - side) < 1 THEN 'px' WHEN abs(v * level0_magnification / target_magnification - side) < 1 THEN 'target_px'
    WHEN abs(v / mpp - side) < 1 THEN 'um' WHEN abs(v * 1000 / mpp - side) < 1 THEN 'mm' END AS unit
  FROM (SELECT *, patch_size_level0 AS v, lower(nullif(trim(patch_size_unit), '')) AS t FROM slides) JOIN side USING (slide) JOIN mpp USING (slide) WHERE v IS NOT NULL)"""
SQL: dict[str, str] = {
    "p2_found": f"""
WITH {CELLS.replace(MPP, RESOLUTION_SQL)}, {TILE_SQL}, {RING_SQL}, {SIDE}, {FOUND_SQL}
SELECT DISTINCT * FROM (
  SELECT 'cells.cx' AS field, cell_id AS record_id, unit FROM cxu WHERE unit <> 'um'
  UNION ALL SELECT 'cell_masks.inference_mpp', export_id, unit FROM resu WHERE unit <> 'um_per_px'
  UNION ALL SELECT 'cell_masks.coordinates', export_id, CASE unit WHEN 'half' THEN 'half_px' WHEN 'share' THEN 'tile_fraction' ELSE unit END FROM unit WHERE unit <> 'px'
  UNION ALL SELECT 'TridentTiling.patch_size_level0', slide_id, unit FROM sizeu WHERE unit <> 'px')
WHERE record_id IS NOT NULL""",
    "p2_resolutions": f"WITH {RESOLUTION_SQL} SELECT DISTINCT export_id, mpp AS um_per_px FROM fit WHERE export_id IS NOT NULL",
    "p2_ring_points": f"""
WITH {TILE_SQL}, {MPP}, {RING_SQL}
SELECT export_id, CAST(tile_pos AS INT) AS tile_pos, CAST(mask_pos AS INT) AS mask_pos, CAST(point_pos AS INT) AS point_pos,
  round(x * CASE unit WHEN 'um' THEN 1 / mpp WHEN 'half' THEN 2 WHEN 'share' THEN w ELSE 1 END, 6) + 0.0 AS px, round(y * CASE unit WHEN 'um' THEN 1 / mpp WHEN 'half' THEN 2 WHEN 'share' THEN h ELSE 1 END, 6) + 0.0 AS py
FROM pt JOIN unit USING (export_id) JOIN size USING (export_id, tile_pos)""",
    "p2_patch_sizes": f"WITH {SIDE.rstrip().rstrip(',')} SELECT slide_id, slide, CAST(side AS DOUBLE) AS patch_px FROM slides JOIN side USING (slide) WHERE patch_size_level0 IS NOT NULL",
    "p3_source_runs": f"""
WITH r AS (SELECT {TYPE_SQL} AS cell_type, source, ingested_at, delivery_id, cell_id FROM cells),
s AS (SELECT cell_type, source, row_number() OVER w AS k, lag(source) OVER w AS before FROM r WINDOW w AS (PARTITION BY cell_type ORDER BY ingested_at NULLS FIRST, delivery_id NULLS FIRST, cell_id NULLS FIRST, source NULLS FIRST))
SELECT cell_type, count(*) AS n, count(*) FILTER (k = 1 OR source IS DISTINCT FROM before) AS n_runs FROM s GROUP BY 1""",
    "p3_type_statistics": f"""
SELECT {TYPE_SQL} AS cell_type, count(*) AS n, count(v) AS n_valid, round(avg(v), 4) AS mean_area, round(stddev_pop(v), 4) AS std_area, min(v) AS min_area, max(v) AS max_area
FROM (SELECT cell_type, CASE WHEN isfinite(area) THEN CAST(area AS DOUBLE) END AS v FROM cells) GROUP BY 1""",
    "p3_found": f"""
WITH {TILE_SQL},
r AS (SELECT 'cells.cell_type' AS field, {TYPE_SQL} AS cell_type FROM cells
  UNION ALL SELECT 'cell_masks.cell_type', {TYPE_SQL.replace("cell_type", "json_extract_string(mask, '$.cell_type')")} FROM masks),
c AS (SELECT field, cell_type, count(*) AS n FROM r GROUP BY 1, 2)
SELECT field, cell_type FROM (SELECT *, sum(n) OVER (PARTITION BY field) AS total FROM c) WHERE n >= 0.05 * total""",
    "p5_found": f"""
WITH {TILE_SQL}
SELECT DISTINCT export_id, CAST(tile_pos AS INT) AS tile_pos, CAST(mask_pos AS INT) AS mask_pos,
  CAST(n_stored - CASE WHEN CAST(c[1] AS VARCHAR) = CAST(c[n_stored] AS VARCHAR) THEN 1 ELSE 0 END AS INT) AS n_points
FROM points WHERE n_stored >= 3""",
    "p5_tiles": f"""
WITH {TILE_SQL}
SELECT DISTINCT export_id, CAST(tile_pos AS INT) AS tile_pos, CAST(json_extract(tile, '$.x') AS BIGINT) AS x, CAST(json_extract(tile, '$.y') AS BIGINT) AS y,
  CAST(json_extract(tile, '$.width') AS BIGINT) AS width, CAST(json_extract(tile, '$.height') AS BIGINT) AS height,
  CAST(coalesce(len(try_cast(json_extract(tile, '$.masks') AS JSON[])), 0) AS INT) AS n_masks
FROM tiles""",
    "p5_points": f"""
WITH {TILE_SQL}
SELECT DISTINCT export_id, CAST(tile_pos AS INT) AS tile_pos, CAST(mask_pos AS INT) AS mask_pos, CAST(i AS INT) AS point_pos,
  CAST(coalesce(json_extract(c[i + 1], '$[0]'), json_extract(c[i + 1], '$.x')) AS DOUBLE) + 0.0 AS px, CAST(coalesce(json_extract(c[i + 1], '$[1]'), json_extract(c[i + 1], '$.y')) AS DOUBLE) + 0.0 AS py
FROM points, unnest(range(0, len(c))) AS u(i) WHERE json_type(c[i + 1]) <> 'NULL'""",
}
