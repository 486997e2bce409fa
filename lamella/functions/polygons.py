"""Shape descriptors of polygon rings as column expressions: higher-order functions over arrays of points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lamella.sources.masks import open_ring


def _next(ring: Column) -> Column:
    """The ring moved on by one point."""
    return F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def shape(coordinates: Column, scale: Column | float = 1.0, least_area: float = 1.0) -> Column:
    """A struct of area, perimeter, centroid, equivalent diameter, axes, eccentricity, orientation, circularity and extent.

    Lengths are multiplied by ``scale``. Sums run over coordinates relative to the ring's first point, which keeps
    second moments from cancelling far from the origin. A ring of an area under ``least_area`` (before scaling) has
    null descriptors and the mean of its points as centroid.
    """
    s = scale if isinstance(scale, Column) else F.lit(scale)
    ring = F.filter(open_ring(coordinates), lambda p: F.get(p, 0).isNotNull() & F.get(p, 1).isNotNull())
    x0, y0 = F.get(F.get(ring, 0), 0), F.get(F.get(ring, 0), 1)
    local = F.transform(ring, lambda p: F.struct((F.get(p, 0) - x0).alias("x"), (F.get(p, 1) - y0).alias("y")))
    pairs = F.zip_with(local, _next(local), lambda a, b: F.struct(a["x"].alias("x"), a["y"].alias("y"), b["x"].alias("u"), b["y"].alias("v"), (a["x"] * b["y"] - b["x"] * a["y"]).alias("c")))
    # one pass gives all sums: twice the area, moments of first and second order, perimeter
    start = F.struct(*[F.lit(0.0).alias(k) for k in ("c", "mx", "my", "xx", "yy", "xy", "p")])

    def add(t: Column, e: Column) -> Column:
        return F.struct(
            (t["c"] + e["c"]).alias("c"), (t["mx"] + e["c"] * (e["x"] + e["u"])).alias("mx"), (t["my"] + e["c"] * (e["y"] + e["v"])).alias("my"),
            (t["xx"] + e["c"] * (e["x"] * e["x"] + e["x"] * e["u"] + e["u"] * e["u"])).alias("xx"), (t["yy"] + e["c"] * (e["y"] * e["y"] + e["y"] * e["v"] + e["v"] * e["v"])).alias("yy"),
            (t["xy"] + e["c"] * (e["x"] * e["v"] + 2 * e["x"] * e["y"] + 2 * e["u"] * e["v"] + e["u"] * e["y"])).alias("xy"), (t["p"] + F.hypot(e["u"] - e["x"], e["v"] - e["y"])).alias("p"),
        )

    def finish(t: Column) -> Column:
        area = F.abs(t["c"]) / 2
        good = area >= least_area
        cx, cy = F.try_divide(t["mx"], 3 * t["c"]), F.try_divide(t["my"], 3 * t["c"])
        vxx, vyy, vxy = F.try_divide(t["xx"], 6 * t["c"]) - cx * cx, F.try_divide(t["yy"], 6 * t["c"]) - cy * cy, F.try_divide(t["xy"], 12 * t["c"]) - cx * cy
        half, root = (vxx + vyy) / 2, F.sqrt(((vxx - vyy) / 2) ** 2 + vxy * vxy)
        l1, l2 = F.greatest(half + root, F.lit(0.0)), F.greatest(half - root, F.lit(0.0))
        clip = lambda c: F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))
        xs, ys = F.transform(local, lambda p: p["x"]), F.transform(local, lambda p: p["y"])
        box = (F.array_max(xs) - F.array_min(xs)) * (F.array_max(ys) - F.array_min(ys))
        n = F.size(local)
        at = lambda c, mean, zero: s * (zero + F.when(good, c).otherwise(mean))
        keep = lambda c: F.when(good, c)
        return F.struct(
            keep(area * s * s).alias("area"), keep(t["p"] * s).alias("perimeter"), at(cx, _sum(xs) / n, x0).alias("centroid_x"), at(cy, _sum(ys) / n, y0).alias("centroid_y"),
            keep(2 * F.sqrt(area / F.pi()) * s).alias("equiv_diameter"), keep(4 * F.sqrt(l1) * s).alias("major_axis"), keep(4 * F.sqrt(l2) * s).alias("minor_axis"),
            keep(F.sqrt(clip(1 - F.try_divide(l2, l1)))).alias("eccentricity"), keep(0.5 * F.atan2(2 * vxy, vxx - vyy)).alias("orientation"),
            keep(clip(4 * F.pi() * area / F.greatest(t["p"] * t["p"], F.lit(1e-9)))).alias("circularity"), keep(clip(area / F.greatest(box, F.lit(1e-9)))).alias("extent"),
        )

    return F.when(F.size(ring) > 0, F.aggregate(pairs, start, add, finish))
