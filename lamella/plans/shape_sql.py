"""SQL twins of ring shapes: rings without their closing point, moments by the shoelace sums, hulls by testing pairs."""

from lamella.plans.problems import TILE_SQL

_RING = "export_id, tile_pos, mask_pos"
#: Points of each ring of at least three stored points: (ring, j, n, x, y) relative to the first, and the next one (u, v).
RINGS = f"""{TILE_SQL},
pt AS (
  SELECT DISTINCT {_RING}, i AS k, CAST(coalesce(json_extract(c[i + 1], '$[0]'), json_extract(c[i + 1], '$.x')) AS DOUBLE) AS px, CAST(coalesce(json_extract(c[i + 1], '$[1]'), json_extract(c[i + 1], '$.y')) AS DOUBLE) AS py
  FROM points, unnest(range(0, len(c))) AS u(i) WHERE json_type(c[i + 1]) <> 'NULL' AND n_stored >= 3),
od AS (
  SELECT *, row_number() OVER w AS j, count(*) OVER (PARTITION BY {_RING}) AS n, first_value(px) OVER w AS x0, first_value(py) OVER w AS y0
  FROM pt WINDOW w AS (PARTITION BY {_RING} ORDER BY k)),
ring AS (SELECT * FROM od WHERE NOT (n > 1 AND j = n AND px = x0 AND py = y0)),
seg AS (
  SELECT {_RING}, x0, y0, px - x0 AS x, py - y0 AS y, coalesce(lead(px) OVER w - x0, 0) AS u, coalesce(lead(py) OVER w - y0, 0) AS v
  FROM ring WINDOW w AS (PARTITION BY {_RING} ORDER BY j))"""

_KEYS = "export_id, CAST(tile_pos AS INT) AS tile_pos, CAST(mask_pos AS INT) AS mask_pos"
_GOOD = "abs(c) / 2 >= 1"


def _good(value: str) -> str:
    return f"CASE WHEN {_GOOD} THEN round({value}, 5) END"


SHAPES = {
    "polygon_shapes": f"""
WITH {RINGS},
t AS (
  SELECT {_RING}, any_value(x0) AS x0, any_value(y0) AS y0, sum(x * v - u * y) AS c, sum((x * v - u * y) * (x + u)) AS mx, sum((x * v - u * y) * (y + v)) AS my,
    sum((x * v - u * y) * (x * x + x * u + u * u)) AS xx, sum((x * v - u * y) * (y * y + y * v + v * v)) AS yy, sum((x * v - u * y) * (x * v + 2 * x * y + 2 * u * v + u * y)) AS xy,
    sum(sqrt((u - x) ** 2 + (v - y) ** 2)) AS p, avg(x) AS ax, avg(y) AS ay, (max(x) - min(x)) * (max(y) - min(y)) AS box
  FROM seg GROUP BY {_RING}),
m AS (SELECT *, mx / nullif(3 * c, 0) AS cx, my / nullif(3 * c, 0) AS cy FROM t),
q AS (SELECT *, xx / nullif(6 * c, 0) - cx * cx AS vxx, yy / nullif(6 * c, 0) - cy * cy AS vyy, xy / nullif(12 * c, 0) - cx * cy AS vxy FROM m),
l AS (SELECT *, greatest((vxx + vyy) / 2 + sqrt(((vxx - vyy) / 2) ** 2 + vxy * vxy), 0) AS l1, greatest((vxx + vyy) / 2 - sqrt(((vxx - vyy) / 2) ** 2 + vxy * vxy), 0) AS l2 FROM q)
SELECT {_KEYS}, {_good("abs(c) / 2")} AS area, {_good("p")} AS perimeter, round(x0 + CASE WHEN {_GOOD} THEN cx ELSE ax END + 1e-9, 5) AS centroid_x, round(y0 + CASE WHEN {_GOOD} THEN cy ELSE ay END + 1e-9, 5) AS centroid_y,
  {_good("2 * sqrt(abs(c) / 2 / pi())")} AS equiv_diameter, {_good("4 * sqrt(l1)")} AS major_axis, {_good("4 * sqrt(l2)")} AS minor_axis, {_good("sqrt(least(greatest(1 - l2 / nullif(l1, 0), 0), 1))")} AS eccentricity,
  {_good("0.5 * atan2(2 * vxy, vxx - vyy)")} AS orientation, {_good("least(4 * pi() * abs(c) / 2 / greatest(p * p, 1e-9), 1)")} AS circularity, {_good("least(abs(c) / 2 / greatest(box, 1e-9), 1)")} AS extent
FROM l""",
    "solidity": f"""
WITH {RINGS},
own AS (SELECT {_RING}, abs(sum(x * v - u * y)) / 2 AS area FROM seg GROUP BY {_RING}),
d AS (SELECT DISTINCT {_RING}, CAST(round(x * 1e9) AS HUGEINT) AS x, CAST(round(y * 1e9) AS HUGEINT) AS y FROM seg),
side AS (
  SELECT {_RING}, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS "by"
  FROM d a JOIN d b USING ({_RING}) JOIN d k USING ({_RING}) WHERE (a.x <> b.x OR a.y <> b.y) GROUP BY ALL
  HAVING bool_and((b.x - a.x) * (k.y - a.y) - (b.y - a.y) * (k.x - a.x) > 0 OR ((b.x - a.x) * (k.y - a.y) - (b.y - a.y) * (k.x - a.x) = 0 AND (k.x - a.x) * (k.x - b.x) + (k.y - a.y) * (k.y - b.y) <= 0))),
whole AS (SELECT {_RING}, CAST(sum(ax * "by" - bx * ay) AS DOUBLE) / 2e18 AS area FROM side GROUP BY {_RING})
SELECT {_KEYS}, CASE WHEN w.area > 0 THEN round(least(o.area / w.area, 1), 6) END AS solidity FROM own o LEFT JOIN whole w USING ({_RING})""",
    "detection_counts": f"""
WITH {TILE_SQL},
m AS (SELECT DISTINCT export_id, tile_pos, mask_pos, CAST(mask AS VARCHAR) AS mask FROM masks),
c AS (SELECT export_id, coalesce(json_extract_string(mask, '$.cell_type'), 'Unknown') AS cell_type, list_filter(coalesce(try_cast(json_extract(mask, '$.coordinates') AS JSON[]), []), lambda p: json_type(p) <> 'NULL') AS p FROM m),
s AS (SELECT *, len(p) - CASE WHEN len(p) > 1 AND CAST(p[1] AS VARCHAR) = CAST(p[len(p)] AS VARCHAR) THEN 1 ELSE 0 END AS k FROM c)
SELECT export_id, cell_type, count(*) FILTER (k >= 3) AS n, count(*) FILTER (k < 3) AS skipped FROM s GROUP BY 1, 2""",
}
