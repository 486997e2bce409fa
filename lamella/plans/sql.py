"""SQL twins of the shared tables: cells in um, one row each, and Delaunay edges by plain definition."""

LABEL = "nullif(trim(regexp_replace(lower({}), '[\\s]+', ' ', 'g')), '')"

#: um per px of every slide, from stated resolutions, else from values that fit the magnification.
MPP = """
res AS (
  SELECT slide, v, lower(u) AS u, m FROM (
    SELECT e.slide, coalesce(inference_mpp, try_cast(replace(regexp_extract(header_text, '([0-9]+[.,][0-9]+) ', 1), ',', '.') AS DOUBLE)) AS v,
      CASE WHEN inference_mpp IS NOT NULL THEN mpp_unit ELSE regexp_extract(header_text, '[0-9]+[.,][0-9]+ ([^;(]+)', 1) END AS u, s.m
    FROM cell_masks e LEFT JOIN (SELECT slide, max(level0_magnification) AS m FROM slides GROUP BY 1) s ON e.slide = s.slide) WHERE v IS NOT NULL),
fit AS (
  SELECT slide, u, round(CASE
    WHEN u LIKE '%dpi%' OR u LIKE '%inch%' THEN 25400 / v WHEN u LIKE '%cm%' THEN 1e4 / v
    WHEN u LIKE 'nm%' THEN v / 1e3 WHEN u LIKE 'mm%' THEN v * 1e3 WHEN u IS NOT NULL THEN v
    ELSE list_reduce([v, v / 1e3, v * 1e3, 1e4 / v, 25400 / v], lambda a, b: CASE WHEN abs(ln(b * m / 10)) < abs(ln(a * m / 10)) THEN b ELSE a END) END, 6) AS mpp FROM res),
mpp AS (
  SELECT s.slide, coalesce(quantile_disc(f.mpp, 0.5) FILTER (f.u IS NOT NULL), quantile_disc(f.mpp, 0.5), 10.0 / max(s.level0_magnification)) AS mpp,
    max(level0_width) AS w, max(level0_height) AS h
  FROM slides s LEFT JOIN fit f ON s.slide = f.slide GROUP BY 1)"""

_UNIT = "CASE WHEN {0} LIKE '%px%' OR {0} LIKE '%pixel%' THEN 'px' WHEN {0} LIKE 'mm' OR {0} LIKE 'milli%' THEN 'mm' WHEN {0} LIKE 'nm' OR {0} LIKE 'nano%' THEN 'nm' WHEN {0} IS NOT NULL THEN 'um' END"
NOTE = """CASE
  WHEN note ILIKE '%not multiplied%' OR note ILIKE '%pixel%' OR note ILIKE 'centroids in px%' THEN 'px'
  WHEN note ILIKE '%thousandths of a millimet%' OR note ILIKE '%multiplied by%' OR note ILIKE 'centroids in micro%' OR note ILIKE '%to microns%' OR note ILIKE '%positions in um%' THEN 'um'
  WHEN note ILIKE '%millimet%' OR note ILIKE '%in mm%' OR note ILIKE '%= 1000 um%' THEN 'mm'
  WHEN note ILIKE '%0.001 um%' OR note ILIKE '%nanomet%' OR note ILIKE '%in nm%' THEN 'nm' END"""

#: One row per cell on the 0.1 um grid, from its earliest delivery.
CELLS = f"""{MPP},
raw AS (SELECT c.*, {_UNIT.format("trim(lower(coord_unit))")} AS label FROM cells c WHERE cx IS NOT NULL AND cy IS NOT NULL AND NOT isnan(cx) AND NOT isnan(cy)),
ext AS (
  SELECT delivery_id, mx * 1.0 / w AS rx, my * 1.0 / h AS ry, mpp FROM (
    SELECT delivery_id, slide, max(CAST(cx AS DOUBLE)) AS mx, max(CAST(cy AS DOUBLE)) AS my FROM raw WHERE label IS NULL GROUP BY 1, 2) JOIN mpp USING (slide)),
best AS (
  SELECT delivery_id, arg_max(u, r) AS fit FROM (
    SELECT delivery_id, u, greatest(rx, ry) * f AS r FROM ext, unnest([{{'u': 'um', 'f': 1 / mpp}}, {{'u': 'px', 'f': 1.0}}, {{'u': 'mm', 'f': 1000 / mpp}}, {{'u': 'nm', 'f': 0.001 / mpp}}]) AS x(s), unnest([s.u]) AS y(u), unnest([s.f]) AS z(f))
  WHERE r <= 1.02 GROUP BY 1),
um AS (
  SELECT r.*, CASE coalesce(label, {NOTE}, fit) WHEN 'px' THEN mpp WHEN 'mm' THEN 1e3 WHEN 'nm' THEN 1e-3 ELSE 1.0 END AS f
  FROM raw r LEFT JOIN deliveries d ON r.delivery_id = d.delivery_id LEFT JOIN best b ON r.delivery_id = b.delivery_id LEFT JOIN mpp m ON r.slide = m.slide),
rolemap AS (SELECT {LABEL.format("cell_type")} AS t, min({LABEL.format("role")}) AS r FROM roles GROUP BY 1),
cell AS (
  SELECT u.slide, cell_id, coalesce({LABEL.format("u.cell_type")}, 'unknown') AS cell_type, coalesce({LABEL.format("u.role")}, m.r, 'other') AS role, confidence,
    CAST(round(CAST(cx AS DOUBLE) * f / 0.1) AS BIGINT) AS qx, CAST(round(CAST(cy AS DOUBLE) * f / 0.1) AS BIGINT) AS qy,
    area, perimeter, major_axis, minor_axis, eccentricity, circularity, extent, solidity
  FROM um u LEFT JOIN rolemap m ON {LABEL.format("u.cell_type")} = m.t
  WHERE cell_id IS NOT NULL AND u.slide IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY delivery_id, ingested_at) = 1)"""


def edges(points: str, name: str, longest: int = 500) -> str:
    """CTEs that end in ``name``: (slide, i, j, d2), the Delaunay edges of ``points`` (slide, id, qx, qy)."""
    seen = """SELECT p.slide, p.i, p.j, p.d2, p.ix, p.iy, p.jx, p.jy, k.id,
    (p.ix - k.qx) * (p.jy - k.qy) - (p.iy - k.qy) * (p.jx - k.qx) AS c, (p.ix - k.qx) * (p.jx - k.qx) + (p.iy - k.qy) * (p.jy - k.qy) AS t"""
    return f"""
{name}_s AS (SELECT slide, min(id) AS id, qx, qy FROM ({points}) GROUP BY slide, qx, qy),
{name}_p AS (
  SELECT a.slide, a.id AS i, b.id AS j, (a.qx - b.qx) ** 2 + (a.qy - b.qy) ** 2 AS d2, a.qx AS ix, a.qy AS iy, b.qx AS jx, b.qy AS jy
  FROM {name}_s a JOIN (SELECT *, unnest([qx // {longest} - 1, qx // {longest}, qx // {longest} + 1]) AS g FROM {name}_s) b
    ON a.slide = b.slide AND a.qx // {longest} = b.g AND a.id < b.id AND abs(a.qy - b.qy) <= {longest}
  WHERE (a.qx - b.qx) ** 2 + (a.qy - b.qy) ** 2 <= {longest * longest}),
{name}_n AS (
  SELECT slide, i, j, any_value(d2) AS d2, any_value(ix) AS ix, any_value(iy) AS iy, any_value(jx) AS jx, any_value(jy) AS jy FROM (
    {seen} FROM {name}_p p LEFT JOIN (SELECT *, unnest([qx // 200 - 1, qx // 200, qx // 200 + 1]) AS g FROM {name}_s) k
      ON p.slide = k.slide AND p.ix // 200 = k.g AND k.id <> p.i AND k.id <> p.j AND abs(k.qx - p.ix) <= 200 AND abs(k.qy - p.iy) <= 200)
  GROUP BY 1, 2, 3 HAVING coalesce(min(t / abs(nullif(c, 0))) FILTER (c > 0), 'inf'::DOUBLE) + coalesce(min(t / abs(nullif(c, 0))) FILTER (c < 0), 'inf'::DOUBLE) >= 0),
{name}_m AS (
  SELECT slide, i, j, any_value(d2) AS d2, bool_or(c = 0 AND t < 0) AS inside,
    min(CASE WHEN c > 0 THEN t / abs(nullif(c, 0)) END) AS l, min(CASE WHEN c < 0 THEN t / abs(nullif(c, 0)) END) AS r,
    arg_min(id, {{'v': t / abs(nullif(c, 0)), 'id': id}}) FILTER (c > 0) AS lid, arg_min(id, {{'v': t / abs(nullif(c, 0)), 'id': id}}) FILTER (c < 0) AS rid
  FROM ({seen} FROM {name}_n p JOIN {name}_s k ON p.slide = k.slide AND k.id <> p.i AND k.id <> p.j) GROUP BY 1, 2, 3),
{name} AS (
  SELECT slide, i, j, d2 FROM {name}_m WHERE NOT inside AND (l IS NOT NULL OR r IS NOT NULL) AND (l IS NULL OR r IS NULL OR l + r > 0 OR (l + r = 0 AND least(lid, rid) > least(i, j))))"""


POINTS = "SELECT slide, cell_id AS id, qx, qy FROM cell"

EDGES = edges(POINTS, "e")
ROLES = ("immune", "tumor", "stroma", "epithelial", "endothelium", "other")
CHANNELS = ("area", "eccentricity", "circularity", "solidity", "major_axis")
PAIRS = (("immune", "tumor"), ("immune", "stroma"), ("tumor", "stroma"))
DIGITS = 5

NEIGHBOURS = "nb AS (SELECT slide, i AS cell_id, j AS other FROM e UNION ALL SELECT slide, j, i FROM e)"
#: Neighbours per role, degree and type entropy of each cell.
NODES = f"""{NEIGHBOURS},
deg AS (SELECT nb.cell_id, count(*) AS degree, {", ".join(f"count(*) FILTER (c.role = '{r}') AS n_{r}" for r in ROLES)} FROM nb JOIN cell c ON nb.other = c.cell_id GROUP BY 1),
typ AS (SELECT cell_id, 0.0 - sum(k / n * ln(k / n)) AS entropy FROM (
  SELECT nb.cell_id, c.cell_type, count(*) AS k, sum(count(*)) OVER (PARTITION BY nb.cell_id) AS n FROM nb JOIN cell c ON nb.other = c.cell_id GROUP BY 1, 2) GROUP BY 1),
node AS (SELECT c.slide, c.cell_id, c.role, coalesce(degree, 0) AS degree, {", ".join(f"coalesce(n_{r}, 0) AS n_{r}" for r in ROLES)}, coalesce(entropy, 0) AS entropy
  FROM cell c LEFT JOIN deg USING (cell_id) LEFT JOIN typ USING (cell_id))"""
_MIX = f"CASE WHEN degree > 0 THEN 1 - greatest({', '.join(f'n_{r}' for r in ROLES)}) * 1.0 / degree END"
_FILL = "fil AS (SELECT slide, cell_id, " + ", ".join(f"CASE WHEN isfinite({c}) THEN CAST({c} AS DOUBLE) ELSE coalesce(median(CASE WHEN isfinite({c}) THEN CAST({c} AS DOUBLE) END) OVER (PARTITION BY slide), 0) END AS {c}" for c in CHANNELS) + " FROM cell)"
#: SD of each channel over a cell and its neighbours.
SDS = f"""{_FILL}, sd AS (SELECT n.slide, n.cell_id, {", ".join(f"stddev_pop(f.{c}) AS sd_{c}" for c in CHANNELS)}
  FROM (FROM nb UNION ALL SELECT slide, cell_id, cell_id FROM cell) n JOIN fil f ON n.other = f.cell_id GROUP BY 1, 2)"""


def digits(feature: str) -> int:
    """Decimals that are compared: order statistics are exact, and a tie in rounding must not hide behind few decimals."""
    return 9 if feature.endswith(("p10", "p50", "p90", "median")) else DIGITS


def _tall(source: str, named: dict[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT slide, '{k}' AS feature, round(CAST({v} AS DOUBLE), {digits(k)}) AS value FROM {source}" for k, v in named.items())


def _stats(prefix: str, low: int = 10, skew: bool = False) -> dict[str, str]:
    out = {f"{prefix}__mean": "avg(v)", f"{prefix}__std": "stddev_pop(v)", f"{prefix}__p{low}": f"quantile_cont(v, {low / 100})", f"{prefix}__p90": "quantile_cont(v, 0.9)"}
    if skew:
        out[f"{prefix}__skew"] = "CASE WHEN count(v) = 0 THEN NULL WHEN count(v) <= 2 THEN 0 WHEN stddev_pop(v) = 0 THEN NULL ELSE avg((v - m) ** 3) / stddev_pop(v) ** 3 END"
    return out


def _blocks(source: str, value: str, prefix: str, low: int = 10, skew: bool = False, every: str = "cell") -> str:
    """Statistics of ``value`` of ``source`` (slide, ...) for each slide of ``every``."""
    v = f"(SELECT *, avg(v) OVER (PARTITION BY slide) AS m FROM (SELECT slide, CASE WHEN isfinite({value}) THEN CAST({value} AS DOUBLE) END AS v FROM ({source})))"
    rows = f"(SELECT s.slide, v, m FROM (SELECT DISTINCT slide FROM {every}) s LEFT JOIN {v} x ON s.slide = x.slide)"
    return "\nUNION ALL ".join(f"SELECT slide, '{k}' AS feature, round(CAST({e} AS DOUBLE), {digits(k)}) AS value FROM {rows} GROUP BY slide" for k, e in _stats(prefix, low, skew).items())


TISSUE = f"""tis AS (SELECT slide, count(*) AS n, count(DISTINCT (CAST(floor(qx / 640.0) AS BIGINT), CAST(floor(qy / 640.0) AS BIGINT))) * 64.0 * 64.0 / 1e6 AS tissue_mm2,
  {", ".join(f"count(*) FILTER (role = '{r}') AS {r}" for r in ROLES)} FROM cell GROUP BY 1)"""
_ENTROPY = "-(" + " + ".join(f"coalesce({r} * 1.0 / nullif(s, 0) * ln(nullif({r}, 0) * 1.0 / s), 0)" for r in ROLES) + ")"
_COMPOSITION = {"slide__n_cells": "n", "slide__tissue_area_mm2": "tissue_mm2", "comp__density_per_mm2": "n / (tissue_mm2 + 1e-9)"} | {f"comp__{r}_frac": f"{r} * 1.0 / n" for r in ROLES} | {"comp__tumor_immune_ratio": "(tumor * 1.0 / n) / (immune * 1.0 / n + 1e-9)", "comp__role_entropy": f"coalesce({_ENTROPY}, 0)"}

_PAIR = "\nUNION ALL ".join(
    f"SELECT a.slide, '{a}' AS a, '{b}' AS b, a.cell_id, coalesce((SELECT min((a.qx - t.qx) ** 2 + (a.qy - t.qy) ** 2) FROM cell t WHERE t.slide = a.slide AND t.role = '{b}'), 'inf'::DOUBLE) AS d2 FROM cell a WHERE a.role = '{a}'" for a, b in PAIRS
)
DISTANCES = f"dis AS (SELECT slide, a, b, cell_id, sqrt(d2) / 10 AS um FROM ({_PAIR}))"
_NEAREST = "\nUNION ALL ".join(
    f"SELECT s.slide, '{name}' AS feature, round(CAST({e} AS DOUBLE), {digits(name)}) AS value FROM (SELECT DISTINCT slide FROM cell) s LEFT JOIN (SELECT * FROM dis WHERE a = '{a}' AND b = '{b}') d ON s.slide = d.slide GROUP BY 1"
    for a, b in PAIRS
    for name, e in (*[(f"spatil__{a}_to_{b}__nndist_um__{k}", f"quantile_cont(um, {q}) FILTER (isfinite(um))") for k, q in (("median", 0.5), ("p10", 0.1), ("p90", 0.9))], (f"spatil__{a}_near_{b}__frac", "avg(CASE WHEN um <= 20 THEN 1.0 ELSE 0.0 END) FILTER (um IS NOT NULL)"))
)

CLUSTERS = f"""{edges("SELECT role || '|' || slide AS slide, cell_id AS id, qx, qy FROM cell WHERE role IN ('immune', 'tumor', 'stroma')", "r")},
rs AS (SELECT i AS a, j AS b FROM r UNION SELECT j, i FROM r),
walk(node, root) AS (SELECT a, a FROM rs UNION SELECT rs.b, walk.root FROM walk JOIN rs ON rs.a = walk.node AND rs.b > walk.root),
com AS (SELECT c.slide, c.role, w.cluster, c.cell_id, count(*) OVER (PARTITION BY w.cluster) AS n
  FROM (SELECT node, min(root) AS cluster FROM walk GROUP BY 1) w JOIN cell c ON w.node = c.cell_id)"""

SIDE = """side AS (SELECT slide, k & -k AS side FROM (SELECT slide, bit_or(patch_x_level0) | bit_or(patch_y_level0) AS k FROM patch_diversity GROUP BY 1) WHERE k > 0),
pat AS (SELECT DISTINCT p.slide, patch_x_level0, patch_y_level0, side FROM patch_diversity p JOIN side USING (slide) WHERE patch_x_level0 IS NOT NULL AND patch_y_level0 IS NOT NULL)"""
MASKS = """tiles AS (
  SELECT export_id, slide, i - 1 AS tile_pos, to_json(cell_masks[i]) AS tile FROM cell_masks, unnest(range(1, len(cell_masks) + 1)) AS u(i) WHERE cell_masks[i] IS NOT NULL
  UNION ALL SELECT export_id, slide, i, t[i + 1] FROM (
    SELECT export_id, slide, coalesce(try_cast(json_extract(raw_json, '$.cell_masks') AS JSON[]), try_cast(json_extract(raw_json, '$.payload.cell_masks') AS JSON[])) AS t
    FROM cell_masks WHERE cell_masks IS NULL AND raw_json IS NOT NULL), unnest(range(0, len(t))) AS u(i) WHERE json_type(t[i + 1]) = 'OBJECT'),
msk AS (
  SELECT DISTINCT export_id, slide, tile_pos, i AS mask_pos, CAST(m[i + 1] AS VARCHAR) AS mask FROM (
    SELECT *, try_cast(json_extract(tile, '$.masks') AS JSON[]) AS m FROM tiles), unnest(range(0, len(m))) AS u(i) WHERE json_type(m[i + 1]) = 'OBJECT'),
mc AS (SELECT slide, coalesce(nullif(trim(regexp_replace(lower(json_extract_string(mask, '$.cell_type')), '[\\s]+', ' ', 'g')), ''), 'unknown') AS cell_type,
  CAST(json_extract(mask, '$.centroid[0]') AS DOUBLE) AS x, CAST(json_extract(mask, '$.centroid[1]') AS DOUBLE) AS y FROM msk
  WHERE json_type(json_extract(mask, '$.centroid[0]')) <> 'NULL' AND json_type(json_extract(mask, '$.centroid[1]')) <> 'NULL')"""
BINNED = """bin AS (SELECT c.slide, c.cell_type, p.patch_x_level0, p.patch_y_level0
  FROM mc c JOIN side s ON c.slide = s.slide LEFT JOIN pat p ON c.slide = p.slide AND CAST(floor(c.x / s.side) AS BIGINT) = p.patch_x_level0 // s.side AND CAST(floor(c.y / s.side) AS BIGINT) = p.patch_y_level0 // s.side)"""


def _diversity(keys: str, n: str = "coalesce(sum(k), 0)") -> str:
    """Diversity expressions over rows (keys, cell_type, k) with their group's total ``t``."""
    h = "coalesce(0.0 - sum(k / t * ln(k / t)), 0)"
    sq = "sum((k / t) ** 2)"
    return f"{keys}, CAST({n} AS BIGINT) AS n_cells, CAST(count(k) AS INT) AS richness, round({h}, 5) AS shannon, round(CASE WHEN count(k) > 1 THEN {h} / ln(count(k)) ELSE 0.0 END, 5) AS shannon_norm, round(coalesce(1 - {sq}, 0), 5) AS simpson, round(coalesce(1 / {sq}, 0), 5) AS inv_simpson"


_PATCH_KEYS = "slide, patch_x_level0, patch_y_level0"
C, G = f"WITH {CELLS}", f"WITH {CELLS}, {EDGES}"
REFERENCE: dict[str, str] = {
    "cells_view": f"{C} SELECT slide, cell_id, cell_type, role, qx, qy FROM cell",
    "confidence_filter": f"{C} SELECT slide, count(*) AS n_cells FROM cell WHERE confidence >= CAST(0.5 AS FLOAT) GROUP BY 1",
    "tissue_area": f"{C}, {TISSUE} SELECT slide, n, round(tissue_mm2, 5) AS tissue_mm2, {', '.join(ROLES)} FROM tis",
    "composition": f"{C}, {TISSUE}, t AS (SELECT *, {' + '.join(ROLES)} AS s FROM tis) {_tall('t', _COMPOSITION)}",
    "morphometry": f"{C} " + "\nUNION ALL ".join(_blocks(f"SELECT slide, {c} FROM cell", c, f"morph__{c}", skew=True) for c in CHANNELS),
    "tumor_morphometry": f"{C} " + "\nUNION ALL ".join(_blocks(f"SELECT slide, {c} FROM cell WHERE role = 'tumor' QUALIFY count(*) OVER (PARTITION BY slide) >= 20", c, f"morph_tumor__{c}") for c in CHANNELS[:3]),
    "slide_headers": "SELECT slide, CAST(ceil(log2(greatest(level0_width, level0_height))) AS INT) AS deepzoom_level, CAST(CASE WHEN level0_magnification >= 40 THEN 0.25 ELSE 0.5 END AS DOUBLE) AS model_mpp FROM slides",
    "tile_expand": f"""WITH {SIDE}, b AS (SELECT p.slide, patch_x_level0 // 656 AS c0, least((patch_x_level0 + side - 1) // 656, (level0_width + 655) // 656 - 1) AS c1,
  patch_y_level0 // 656 AS r0, least((patch_y_level0 + side - 1) // 656, (level0_height + 655) // 656 - 1) AS r1 FROM pat p JOIN slides s ON p.slide = s.slide)
SELECT DISTINCT slide, c AS col, r AS row FROM b, unnest(range(c0, c1 + 1)) AS x(c), unnest(range(r0, r1 + 1)) AS y(r)""",
    "patch_bin": f"WITH {SIDE}, {MASKS}, {BINNED} SELECT slide, patch_x_level0 IS NULL AS outside, count(*) AS n_cells FROM bin GROUP BY 1, 2",
    "patch_diversity": f"""WITH {SIDE}, {MASKS}, {BINNED},
k AS (SELECT {_PATCH_KEYS}, cell_type, count(*) AS k FROM bin WHERE patch_x_level0 IS NOT NULL GROUP BY ALL),
f AS (SELECT p.slide, p.patch_x_level0, p.patch_y_level0, k, sum(k) OVER (PARTITION BY p.slide, p.patch_x_level0, p.patch_y_level0) AS t FROM pat p LEFT JOIN k USING (slide, patch_x_level0, patch_y_level0))
SELECT {_diversity(_PATCH_KEYS)} FROM f GROUP BY {_PATCH_KEYS}""",
    "slide_diversity": f"""WITH {SIDE}, {MASKS}, {BINNED}, {MPP},
k AS (SELECT slide, cell_type, count(*) AS k FROM mc GROUP BY ALL),
n AS (SELECT slide, any_value(side) AS side, count(*) AS n_patches FROM pat GROUP BY 1),
f AS (SELECT n.slide, k, sum(k) OVER (PARTITION BY n.slide) AS t FROM n LEFT JOIN k ON n.slide = k.slide),
v AS (SELECT {_diversity("slide")} FROM f GROUP BY slide),
o AS (SELECT slide, count(*) FILTER (patch_x_level0 IS NULL) AS n_outside FROM bin GROUP BY 1)
SELECT v.*, n_patches, coalesce(n_outside, 0) AS n_outside, CAST(n_patches * side * side AS DOUBLE) AS tissue_px2, round(n_patches * side * side * mpp * mpp / 1e6, 5) AS tissue_mm2,
  round(n_cells / (n_patches * side * side * mpp * mpp / 1e6), 5) AS cells_per_mm2
FROM v JOIN n ON v.slide = n.slide LEFT JOIN o ON v.slide = o.slide JOIN mpp ON v.slide = mpp.slide""",
    "cell_type_vocab": f"WITH {MASKS} SELECT DISTINCT cell_type FROM mc",
    "delaunay_edges": f"{G} SELECT slide, i, j, round(sqrt(d2) / 10, 4) AS edge_len FROM e",
    "degree": f"{G}, {NEIGHBOURS} SELECT c.slide, c.cell_id, coalesce(n, 0) AS degree FROM cell c LEFT JOIN (SELECT cell_id, count(*) AS n FROM nb GROUP BY 1) x USING (cell_id)",
    "neighbor_mean": f"""{G}, {NEIGHBOURS} SELECT n.slide, n.cell_id, round(avg(CAST(c.confidence AS DOUBLE)), 5) AS mean_confidence
FROM (FROM nb UNION ALL SELECT slide, cell_id, cell_id FROM cell) n JOIN cell c ON n.other = c.cell_id GROUP BY 1, 2""",
    "local_sd": f"{G}, {NEIGHBOURS}, {SDS} " + "\nUNION ALL ".join(_blocks(f"SELECT slide, sd_{c} FROM sd", f"sd_{c}", f"diversity__{c}_local_sd") for c in CHANNELS),
    "type_boundary": f"{G}, en AS (SELECT e.slide, {', '.join(f'abs(CAST(a.{c} AS DOUBLE) - CAST(b.{c} AS DOUBLE)) AS {c}' for c in CHANNELS)} FROM e JOIN cell a ON e.i = a.cell_id JOIN cell b ON e.j = b.cell_id WHERE a.cell_type <> b.cell_type) "
    + "\nUNION ALL ".join(_blocks(f"SELECT slide, {c} FROM en", c, f"diversity__{c}_at_type_boundary") for c in CHANNELS),
    "neighborhood": f"""{G}, {NODES} {_blocks("SELECT slide, entropy FROM node", "entropy", "diversity__cell_type_diversity", 50)}
UNION ALL SELECT slide, 'diversity__neighborhood_mixedness__mean', round(avg({_MIX}), 5) FROM node GROUP BY 1
UNION ALL SELECT slide, 'slide__mean_neighbors_per_cell', round(avg(degree), 5) FROM node GROUP BY 1
UNION ALL SELECT s.slide, 'diversity__cross_type_edge_frac', round(avg(CASE WHEN a.cell_type <> b.cell_type THEN 1.0 WHEN a.cell_type = b.cell_type THEN 0.0 END), 5)
  FROM (SELECT DISTINCT slide FROM cell) s LEFT JOIN e ON s.slide = e.slide LEFT JOIN cell a ON e.i = a.cell_id LEFT JOIN cell b ON e.j = b.cell_id GROUP BY 1""",
    "same_role": f"{G}, {NODES} " + "\nUNION ALL ".join(f"SELECT slide, 'spatil__{r}_same_role_frac' AS feature, round(avg(CASE WHEN role = '{r}' AND degree > 0 THEN n_{r} * 1.0 / degree END), 5) AS value FROM node GROUP BY 1" for r in ("immune", "tumor", "stroma")),
    "edge_enrichment": f"""{G}, {TISSUE}, x AS (SELECT e.slide, count(*) AS e, count(*) FILTER ((a.role = 'immune' AND b.role = 'tumor') OR (a.role = 'tumor' AND b.role = 'immune')) AS it
  FROM e JOIN cell a ON e.i = a.cell_id JOIN cell b ON e.j = b.cell_id GROUP BY 1)
SELECT t.slide, 'spatil__immune_tumor_edge_enrichment' AS feature, round(ln((it + 1e-9) / (2.0 * (immune * 1.0 / n) * (tumor * 1.0 / n) * e + 1e-9)), 5) AS value FROM tis t LEFT JOIN x ON t.slide = x.slide""",
    "infiltration": f"""{G}, {NODES}, {DISTANCES} {_blocks("SELECT slide, CASE WHEN degree > 0 THEN n_immune * 1.0 / degree END AS f FROM node WHERE role = 'tumor'", "f", "spatil__tumor_local_immune_frac", 50)}
UNION ALL SELECT slide, 'spatil__tumor_with_immune_neighbor_frac', round(avg(CASE WHEN role = 'tumor' THEN CASE WHEN n_immune > 0 THEN 1.0 ELSE 0.0 END END), 5) FROM node GROUP BY 1
UNION ALL SELECT s.slide, 'spatil__intratumoral_vs_stromal_immune', round(avg(CASE WHEN um <= 20 THEN 1.0 ELSE 0.0 END) FILTER (b = 'tumor') / (avg(CASE WHEN um <= 20 THEN 1.0 ELSE 0.0 END) FILTER (b = 'stroma') + 1e-9), 5)
  FROM (SELECT DISTINCT slide FROM cell) s LEFT JOIN (SELECT * FROM dis WHERE a = 'immune') d ON s.slide = d.slide GROUP BY 1""",
    "pair_distances": f"{C}, {DISTANCES} SELECT slide, a, b, cell_id, round(um, 4) AS um FROM dis",
    "nearest_features": f"{C}, {DISTANCES} {_NEAREST}",
    "immune_dispersion": f"""{C}, {TISSUE}, im AS (SELECT * FROM cell WHERE role = 'immune'),
nn AS (SELECT a.slide, avg((SELECT sqrt(min((a.qx - b.qx) ** 2 + (a.qy - b.qy) ** 2)) / 10 FROM im b WHERE b.slide = a.slide AND b.cell_id <> a.cell_id)) AS nn, count(*) AS k FROM im a GROUP BY 1)
SELECT t.slide, 'spatil__immune_spatial_dispersion' AS feature, round(CASE WHEN k >= 3 THEN nn / (0.5 / sqrt(k / (tissue_mm2 * 1e6 + 1e-9)) + 1e-9) END, 5) AS value FROM tis t LEFT JOIN nn ON t.slide = nn.slide""",
    "clusters": f"{C.replace('WITH', 'WITH RECURSIVE')}, {CLUSTERS} SELECT slide, role, cluster, cell_id FROM com WHERE n >= 5",
    "cluster_sizes": f"""{C.replace('WITH', 'WITH RECURSIVE')}, {CLUSTERS},
big AS (SELECT slide, role, cluster, count(*) AS n FROM com WHERE n >= 5 GROUP BY 1, 2, 3),
al AS (SELECT s.slide, r.role, (SELECT count(*) FROM cell c WHERE c.slide = s.slide AND c.role = r.role) AS k FROM (SELECT DISTINCT slide FROM cell) s, (SELECT unnest(['immune', 'tumor', 'stroma']) AS role) r)
SELECT al.slide, al.role, CAST(count(n) AS DOUBLE) AS n_clusters, round(coalesce(sum(n), 0) / (any_value(k) + 1e-9), 5) AS clustered_frac, round(avg(n), 5) AS mean_cluster_size, CAST(coalesce(max(n), 0) AS DOUBLE) AS largest_cluster_size
FROM al LEFT JOIN big ON al.slide = big.slide AND al.role = big.role GROUP BY 1, 2""",
    "cell_measurements": f"""{G}, {NODES}, {SDS} SELECT n.slide, n.cell_id, round(CASE WHEN degree > 0 THEN n_immune * 1.0 / degree ELSE 0.0 END, 5) AS immune_frac, round(CASE WHEN degree > 0 THEN n_tumor * 1.0 / degree ELSE 0.0 END, 5) AS tumor_frac,
  round(coalesce({_MIX}, 0), 5) AS mixedness, {", ".join(f"round(sd_{c}, 4) AS {c}_local_sd" for c in ("area", "eccentricity", "circularity"))} FROM node n JOIN sd USING (cell_id)""",
    "interaction_edges": f"{G} SELECT e.slide, i, j FROM e JOIN cell a ON e.i = a.cell_id JOIN cell b ON e.j = b.cell_id WHERE (a.role = 'immune' AND b.role = 'tumor') OR (a.role = 'tumor' AND b.role = 'immune')",
}

#: Regions on the grid and the cells strictly inside: odd crossings to the right, none on the rim.
INSIDE = """roi AS (SELECT DISTINCT roi_id, slide, list_transform(list_filter(ring, lambda p: p IS NOT NULL AND p.x IS NOT NULL AND p.y IS NOT NULL), lambda p: {'x': round(p.x / 0.1), 'y': round(p.y / 0.1)}) AS ring FROM rois),
seg AS (SELECT roi_id, slide, ring[i].x AS x1, ring[i].y AS y1, ring[i % len(ring) + 1].x AS x2, ring[i % len(ring) + 1].y AS y2 FROM roi, unnest(range(1, len(ring) + 1)) AS u(i) WHERE len(ring) >= 3 AND roi_id IS NOT NULL),
ins AS (SELECT roi_id, cell_id FROM (
  SELECT s.roi_id, c.cell_id, (y1 > qy) <> (y2 > qy) AND (CASE WHEN y2 > y1 THEN 1 ELSE -1 END) * ((x2 - x1) * (qy - y1) - (qx - x1) * (y2 - y1)) > 0 AS hit,
    (x2 - x1) * (qy - y1) = (qx - x1) * (y2 - y1) AND qx BETWEEN least(x1, x2) AND greatest(x1, x2) AND qy BETWEEN least(y1, y2) AND greatest(y1, y2) AS rim
  FROM seg s JOIN cell c ON s.slide = c.slide) GROUP BY 1, 2 HAVING NOT bool_or(rim) AND count(*) FILTER (hit) % 2 = 1)"""
REFERENCE["roi_cells"] = f"{C}, {INSIDE} SELECT roi_id, cell_id FROM ins"
REFERENCE["p2_cells_um"] = f"{C} SELECT cell_id, slide, qx / 10.0 AS x_um, qy / 10.0 AS y_um FROM cell"
REFERENCE["p1_found"] = f"""{C}, {INSIDE} SELECT 'inside' AS relation, roi_id AS id_a, cell_id AS id_b FROM ins
UNION SELECT 'near', least(a.cell_id, b.cell_id), greatest(a.cell_id, b.cell_id) FROM cell a
  JOIN (SELECT *, unnest([qx // 200 - 1, qx // 200, qx // 200 + 1]) AS g FROM cell WHERE role = 'tumor') b ON a.slide = b.slide AND a.qx // 200 = b.g
  WHERE a.role = 'immune' AND (a.qx - b.qx) ** 2 + (a.qy - b.qy) ** 2 <= 40000"""
