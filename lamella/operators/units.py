"""Quantities recorded in different units, brought to common ones: um per px, level-0 px and um.

The unit of a value is decided by the label beside it, else by text (an export's header, a delivery's note), else by
what fits the other data of the slide. Labels and texts are parsed by :mod:`lamella.functions.unit_text` in Arrow
batches, only after the labels were made distinct or aggregated; the joins back are on tables whose size the planner
knows, so they broadcast while small and shuffle otherwise.

Nulls: a null value has no unit and gives no row. An unreadable label counts as none. Empty tables give empty results.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from lamella.functions import unit_text
from lamella.operators.flatten import flatten
from lamella.session import cut

#: Nominal um per px of a lens of magnification 1; only tells units apart, no value is taken from it while data tell.
NOMINAL_MPP = 10.0


SCALE = T.StructType([T.StructField("name", T.StringType()), T.StructField("factor", T.DoubleType()), T.StructField("kind", T.StringType())])


def _scales(found: list) -> pd.DataFrame:
    return pd.DataFrame([f or (None, None, None) for f in found], columns=["name", "factor", "kind"]).astype({"factor": float})


def _parser(field: str):
    @pandas_udf(SCALE)
    def parse(text: pd.Series) -> pd.DataFrame:
        return _scales([unit_text.scale(t, field) if isinstance(t, str) else None for t in text])

    return parse


@pandas_udf(SCALE)
def _note_unit(text: pd.Series) -> pd.DataFrame:
    return _scales([unit_text.note_scale(t) if isinstance(t, str) else None for t in text])


@pandas_udf(SCALE)
def _header_ring(text: pd.Series) -> pd.DataFrame:
    return _scales([unit_text.header_ring(t) if isinstance(t, str) else None for t in text])


@pandas_udf(T.StructType([T.StructField("value", T.DoubleType()), *SCALE.fields]))
def _header_resolution(text: pd.Series) -> pd.DataFrame:
    found = [(unit_text.header_resolution(t) if isinstance(t, str) else None) for t in text]
    return pd.concat([pd.DataFrame({"value": pd.Series([f[0] if f else None for f in found], dtype=float)}), _scales([f and f[1] for f in found])], axis=1)


def _known(unit: Column) -> Column:
    """A parsed unit as a struct, null where the text tells none."""
    return F.when(unit["name"].isNotNull(), F.struct(unit["name"].alias("name"), unit["factor"].alias("factor"), unit["kind"].alias("kind")))


def _constant(name: str, factor: float, kind: str) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(factor).alias("factor"), F.lit(kind).alias("kind"))


def to_mpp(value: Column, unit: Column) -> Column:
    """um per px of a resolution in ``unit``."""
    return F.when(unit["kind"] == "um_per_px", value * unit["factor"]).when(unit["kind"] == "px_per_um", F.try_divide(F.lit(1.0), value * unit["factor"]))


#: Units that a resolution without any text may have.
RESOLUTION_UNITS = (("um_per_px", 1.0, "um_per_px"), ("nm_per_px", 1e-3, "um_per_px"), ("mm_per_px", 1e3, "um_per_px"), ("px_per_cm", 1e-4, "px_per_um"), ("px_per_inch", 1 / 25400, "px_per_um"))


def _nearest(candidates: list[tuple[Column, Column]], target: Column) -> Column:
    """The unit (a struct) whose positive value is nearest to ``target`` in proportion; null where none is known."""
    def gap(v):
        return F.when((v > 0) & (target > 0), F.abs(F.log(v / target)))

    gaps = [F.struct(gap(v).alias("gap"), F.lit(i).alias("i"), u.alias("unit")) for i, (u, v) in enumerate(candidates)]
    best = F.array_min(F.filter(F.array(*gaps), lambda s: s["gap"].isNotNull()))
    return best["unit"]


def export_resolutions(exports: DataFrame, slides: DataFrame) -> DataFrame:
    """One row per export that tells a resolution: ``export_id, slide, mpp_value, resolution_unit, labelled, mpp``."""
    e = exports.select("export_id", "slide", "inference_mpp", "mpp_unit", "header_text").distinct()
    e = e.withColumn("label", _parser("resolution")("mpp_unit")).withColumn("told", _header_resolution("header_text"))
    s = slides.select("slide", "level0_magnification").distinct()
    e = e.join(s, "slide", "left")
    own = F.col("inference_mpp").isNotNull() & ~F.isnan("inference_mpp")
    value = F.when(own, F.col("inference_mpp")).otherwise(F.col("told.value"))
    fit = _nearest([(_constant(*u), to_mpp(F.col("mpp_value"), _constant(*u))) for u in RESOLUTION_UNITS], F.coalesce(NOMINAL_MPP / F.nullif(F.col("level0_magnification"), F.lit(0)), F.lit(0.35)))
    e = e.withColumn("mpp_value", value).where("mpp_value is not null")
    # a header that tells a unit for a value that stands in the column as well
    agrees = F.abs(F.col("told.value") / F.col("mpp_value") - 1) < 1e-3
    label = F.when(own, F.coalesce(_known(F.col("label")), F.when(agrees, _known(F.col("told"))))).otherwise(_known(F.col("told")))
    e = e.withColumn("given", label).withColumn("unit", F.coalesce("given", fit))
    return e.select("export_id", "slide", "mpp_value", F.col("unit.name").alias("resolution_unit"), F.col("given").isNotNull().alias("labelled"), to_mpp(F.col("mpp_value"), F.col("unit")).alias("mpp"))


def slide_resolution(exports: DataFrame, slides: DataFrame) -> DataFrame:
    """True um per px of each slide: ``slide, mpp``, known for every slide of ``slides``.

    The median over the slide's exports, those with a stated unit first; a slide without any takes the nominal
    resolution of its magnification. Values are rounded to 1e-6, so repeats in other units agree.
    """
    r = export_resolutions(exports, slides).groupBy("slide").agg(
        F.percentile_approx(F.when(F.col("labelled"), F.round("mpp", 6)), 0.5, 10_000).alias("stated"),
        F.percentile_approx(F.round("mpp", 6), 0.5, 10_000).alias("fitted"),
    )
    s = slides.groupBy("slide").agg(F.max("level0_magnification").alias("m"))
    return s.join(r, "slide", "left").select("slide", F.coalesce("stated", "fitted", NOMINAL_MPP / F.nullif(F.col("m"), F.lit(0)), F.lit(0.35)).alias("mpp"))


def um_per(unit: Column, mpp: Column, target: Column) -> Column:
    """um in one unit of position; ``target``: level-0 px in a px at the target magnification."""
    return F.when(unit["kind"] == "um", unit["factor"]).when(unit["kind"] == "px", unit["factor"] * mpp).when(unit["kind"] == "target_px", unit["factor"] * target * mpp)


#: Units that positions without any text may have.
POSITION_UNITS = (("um", 1.0, "um"), ("px", 1.0, "px"), ("mm", 1e3, "um"), ("nm", 1e-3, "um"))


def position_units(cells: DataFrame, deliveries: DataFrame, exports: DataFrame, slides: DataFrame) -> DataFrame:
    """The unit of every (delivery, label): ``delivery_id, slide, coord_unit, unit, um``; ``um`` is the factor to um.

    One aggregation over the cells gives the extent of each (delivery, label); everything after it works on that small
    table, which is written out so that its size is known to the joins. An unlabelled delivery whose note tells nothing
    takes the unit by which its largest coordinates come nearest to the slide's own width and height from below.
    """
    ext = cells.groupBy("delivery_id", "slide", "coord_unit").agg(F.max(F.nanvl("cx", F.lit(None))).cast("double").alias("mx"), F.max(F.nanvl("cy", F.lit(None))).cast("double").alias("my"))
    notes = deliveries.groupBy("delivery_id").agg(F.min(F.struct("note")).alias("n")).select("delivery_id", F.col("n.note").alias("note"))
    mpp = slide_resolution(exports, slides)
    size = slides.groupBy("slide").agg(F.max("level0_width").alias("w"), F.max("level0_height").alias("h"), F.max(F.try_divide(F.col("level0_magnification"), F.col("target_magnification"))).alias("target"))
    e = ext.join(notes, "delivery_id", "left").join(mpp, "slide", "left").join(size, "slide", "left")
    e = e.withColumn("label", _parser("position")("coord_unit")).withColumn("told", _note_unit("note"))
    e = cut(e)

    def reach(u: tuple):
        f = um_per(_constant(*u), F.col("mpp"), F.lit(1.0))
        return F.greatest(F.col("mx") * f / (F.col("w") * F.col("mpp")), F.col("my") * f / (F.col("h") * F.col("mpp")))

    # the unlabelled rows of a delivery share one unit: the largest reach that still fits the slide
    rest = e.where("label.name is null").groupBy("delivery_id", "slide").agg(*[F.max(reach(u)).alias(u[0]) for u in POSITION_UNITS])
    fits = F.array(*[F.struct(F.when(F.col(u[0]) <= 1.02, F.col(u[0])).alias("r"), _constant(*u).alias("u")) for u in POSITION_UNITS])
    rest = rest.select("delivery_id", "slide", F.array_max(F.filter(fits, lambda s: s["r"].isNotNull()))["u"].alias("fit"))
    unit = F.coalesce(_known(F.col("label")), _known(F.col("told")), F.col("fit"), _constant(*POSITION_UNITS[0]))
    e = e.join(rest, ["delivery_id", "slide"], "left").withColumn("unit", unit)
    return cut(e.select("delivery_id", "slide", "coord_unit", F.col("unit.name").alias("unit"), um_per(F.col("unit"), F.coalesce("mpp", F.lit(0.35)), F.coalesce("target", F.lit(1.0))).alias("um")))


def cells_in_um(cells: DataFrame, units: DataFrame, grid: float = 0.1) -> DataFrame:
    """Cells with coordinates as whole steps of ``grid`` um: all columns of ``cells`` plus ``unit``, ``qx``, ``qy``.

    Rows with null or NaN coordinates are out.
    """
    u = units.select(F.col("delivery_id").alias("__d"), F.col("slide").alias("__s"), F.col("coord_unit").alias("__c"), F.col("unit").alias("__u"), F.col("um").alias("__f"))
    on = F.expr("delivery_id <=> __d and slide <=> __s and coord_unit <=> __c")
    known = cells.where("cx is not null and cy is not null and not isnan(cx) and not isnan(cy)")
    joined = known.join(u, on)
    q = lambda c: F.round(F.col(c).cast("double") * F.col("__f") / grid).cast("bigint")
    return joined.withColumns({"qx": q("cx"), "qy": q("cy"), "unit": F.col("__u")}).drop("__d", "__s", "__c", "__u", "__f")


def _whole_points(mask: Column) -> Column:
    return F.filter(mask["coordinates"], lambda q: q.isNotNull() & F.get(q, 0).isNotNull() & F.get(q, 1).isNotNull())


def ring_units(documents: DataFrame, slides: DataFrame, mpp: DataFrame) -> DataFrame:
    """The unit of ring coordinates of each export with at least one point: ``export_id, slide, ring_unit, factor, kind``.

    ``documents`` is unified (see :func:`lamella.sources.masks.unified`). Without label and header text, the scale of
    the rings against the masks' own centroids (level-0 px) decides: the slope through the origin of tile-local
    centroids on ring centres, summed over the export; without any centroid, the reach of the rings in their tile.
    Only the undecided exports' tiles are spread over the cluster and looked into.
    """
    pointed = F.exists("cell_masks", lambda t: F.coalesce(F.exists(t["masks"], lambda m: F.coalesce(F.size(_whole_points(m)) > 0, F.lit(False))), F.lit(False)))
    d = documents.withColumn("label", _parser("ring")("coord_space")).withColumn("told", _header_ring("header_text")).where(F.coalesce(pointed, F.lit(False)))
    said = F.coalesce(_known(F.col("label")), _known(F.col("told")))
    decided = d.where(said.isNotNull()).select("export_id", "slide", said.alias("unit"))
    tiles = d.where(said.isNull()).select("export_id", "slide", F.posexplode("cell_masks").alias("pos", "t")).where("t.masks is not null")
    # a fixed number of partitions, so that few large documents are many tasks
    tiles = tiles.repartition(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), "export_id", "pos")
    rows = tiles.select("export_id", "slide", "t.x", "t.y", "t.width", "t.height", F.explode("t.masks").alias("m")).withColumn("p", _whole_points(F.col("m"))).where("size(p) > 0")
    rows = rows.withColumn("c", _ring_centre(F.col("p"))).withColumns({"gx": F.get("m.centroid", 0), "gy": F.get("m.centroid", 1)})
    lx, ly = F.col("gx") - F.col("x") * F.col("width"), F.col("gy") - F.col("y") * F.col("height")
    ok = F.col("gx").isNotNull() & F.col("gy").isNotNull() & (F.col("width") > 0) & (F.col("height") > 0)
    agg = rows.groupBy("export_id", "slide").agg(
        F.sum(F.when(ok, lx * F.col("c.x") + ly * F.col("c.y"))).alias("sxy"), F.sum(F.when(ok, F.col("c.x") ** 2 + F.col("c.y") ** 2)).alias("sxx"),
        F.max("width").alias("width"), F.max(F.greatest("c.x", "c.y")).alias("reach"),
    )
    slope, width = F.try_divide(F.col("sxy"), F.col("sxx")), F.col("width").cast("double")
    scales = [(_constant("px", 1.0, "px"), F.lit(1.0)), (_constant("um", 1.0, "um"), F.try_divide(F.lit(1.0), F.col("mpp"))), (_constant("half_px", 2.0, "px"), F.lit(2.0)), (_constant("tile_fraction", 1.0, "tile"), width)]
    by_fit = F.coalesce(_nearest(scales, slope), _nearest(scales, F.try_divide(width, F.col("reach"))), scales[0][0])
    fitted = agg.join(mpp, "slide", "left").select("export_id", "slide", by_fit.alias("unit"))
    return decided.unionByName(fitted).select("export_id", "slide", F.col("unit.name").alias("ring_unit"), "unit.factor", "unit.kind")


def _ring_centre(p: Column) -> Column:
    """``x, y``: the centre of a ring's area in one pass over its points, else the mean of them."""
    n = F.size(p)
    edges = F.zip_with(p, F.concat(F.slice(p, 2, F.greatest(n - 1, F.lit(0))), F.slice(p, 1, 1)), lambda a, b: F.struct(F.get(a, 0).alias("x"), F.get(a, 1).alias("y"), F.get(b, 0).alias("u"), F.get(b, 1).alias("v")))

    def add(t: Column, e: Column) -> Column:
        cross = e["x"] * e["v"] - e["u"] * e["y"]
        return F.struct((t["c"] + cross).alias("c"), (t["mx"] + cross * (e["x"] + e["u"])).alias("mx"), (t["my"] + cross * (e["y"] + e["v"])).alias("my"), (t["sx"] + e["x"]).alias("sx"), (t["sy"] + e["y"]).alias("sy"))

    def centre(t: Column) -> Column:
        flat = F.abs(t["c"]) <= 1e-9
        return F.struct(F.when(flat, t["sx"] / n).otherwise(F.try_divide(t["mx"], 3 * t["c"])).alias("x"), F.when(flat, t["sy"] / n).otherwise(F.try_divide(t["my"], 3 * t["c"])).alias("y"))

    return F.aggregate(edges, F.struct(*[F.lit(0.0).alias(k) for k in ("c", "mx", "my", "sx", "sy")]), add, centre)


def rings_in_px(documents: DataFrame, slides: DataFrame, mpp: DataFrame) -> DataFrame:
    """Every ring point in level-0 px from its tile's corner: ``export_id, tile_pos, mask_pos, point_pos, px, py``.

    ``documents`` is unified; exact repeats of a document count once, which is settled before its points are spread out.
    Positions are those of the arrays as stored. A point that lacks a coordinate keeps a null there; a share of a tile
    whose size isn't known gives null. Exports without any whole point give no rows.
    """
    # one unit an export; its table is written, so that the join's planner knows that it is small
    units = cut(ring_units(documents, slides, mpp).groupBy("export_id", "slide").agg(F.min(F.struct("kind", "factor")).alias("unit")).join(mpp, "slide", "left").select(F.col("export_id").alias("__e"), F.col("slide").alias("__s"), "unit", "mpp"))
    d = documents.select("export_id", "slide", "cell_masks").distinct().join(units, F.expr("export_id <=> __e and slide <=> __s"))
    tiles = d.select("export_id", "unit", "mpp", F.posexplode("cell_masks").alias("tile", "t")).where("t is not null")
    points = flatten(tiles.withColumns({"width": F.col("t.width"), "height": F.col("t.height"), "cell_masks": F.array("t")}), "points", ("export_id", "tile", "unit", "mpp", "width", "height"))
    factor, kind = F.col("unit.factor"), F.col("unit.kind")

    def px(at: str, side: str) -> Column:
        return F.when(kind == "um", F.try_divide(F.col(at) * factor, F.col("mpp"))).when(kind == "tile", F.col(at) * factor * F.col(side)).otherwise(F.col(at) * factor)

    return points.select("export_id", F.col("tile").alias("tile_pos"), "mask_pos", "point_pos", px("px", "width").alias("px"), px("py", "height").alias("py"))


def patch_units(slides: DataFrame, patches: DataFrame, mpp: DataFrame) -> DataFrame:
    """The unit of ``patch_size_level0``: ``slide_id, slide, patch_unit, patch_px``.

    Without label, the patch grid decides: patch corners are multiples of the true size, so the largest candidate size
    in level-0 px that divides every corner of the slide; a slide without patches takes the candidate nearest to an
    octave of 64 px, px first.
    """
    s = slides.select("slide_id", "slide", "patch_size_level0", "patch_size_unit", "level0_magnification", "target_magnification").where("patch_size_level0 is not null")
    s = s.join(mpp, "slide", "left").withColumn("label", _parser("patch")("patch_size_unit"))
    v = F.col("patch_size_level0")
    size = {"px": v, "target_px": v * F.col("level0_magnification") / F.nullif(F.col("target_magnification"), F.lit(0)), "um": v / F.col("mpp"), "mm": v * 1000 / F.col("mpp")}
    for u, c in size.items():
        s = s.withColumn(f"size_{u}", c)
    per = F.try_divide(F.col("level0_magnification"), F.col("target_magnification"))
    s = s.withColumn("size_label", F.when(F.col("label.kind") == "um", v * F.col("label.factor") / F.col("mpp")).when(F.col("label.kind") == "px", v * F.col("label.factor")).when(F.col("label.kind") == "target_px", v * F.col("label.factor") * per))
    s = cut(s)
    open_ = s.where("label.name is null").select("slide", *[F.round(f"size_{u}").cast("bigint").alias(f"int_{u}") for u in size]).distinct()
    grid = patches.select("slide", "patch_x_level0", "patch_y_level0").join(open_, "slide")
    def misses(u):
        k = F.col(f"int_{u}")
        bad = (k < 1) | (F.try_mod(F.col("patch_x_level0"), k) != 0) | (F.try_mod(F.col("patch_y_level0"), k) != 0)
        return F.sum(F.when(F.coalesce(bad, F.lit(True)), 1).otherwise(0)).alias(f"miss_{u}")

    seen = grid.groupBy("slide").agg(*[misses(u) for u in size])
    s = s.join(seen, "slide", "left")
    cands = F.array(*[F.struct(F.when((F.col(f"miss_{u}") == 0) & (F.abs(F.col(f"size_{u}") - F.round(f"size_{u}")) < 0.01 * F.col(f"size_{u}")), F.round(f"size_{u}")).alias("size"), F.lit(-i).alias("first"), F.lit(u).alias("u")) for i, u in enumerate(size)])
    by_grid = F.array_max(F.filter(cands, lambda c: c["size"].isNotNull()))["u"]
    octave = lambda c: F.abs(F.log2(c / 64) - F.round(F.log2(c / 64))) + F.when((c < 32) | (c > 4096), 9.0).otherwise(0.0)
    alone = F.array_min(F.filter(F.array(*[F.struct(F.when(F.col(f"size_{u}") > 0, F.round(octave(F.col(f"size_{u}")), 3)).alias("gap"), F.lit(i).alias("i"), F.lit(u).alias("u")) for i, u in enumerate(size)]), lambda c: c["gap"].isNotNull()))["u"]
    unit = F.coalesce("label.name", by_grid, alone, F.lit("px"))
    chosen = F.lit(None).cast("double")
    for u in size:
        chosen = F.when(F.col("patch_unit") == u, F.col(f"size_{u}")).otherwise(chosen)
    return s.withColumn("patch_unit", unit).select("slide_id", "slide", "patch_unit", F.round(F.coalesce("size_label", chosen), 3).alias("patch_px"))


def units_found(cells: DataFrame, deliveries: DataFrame, documents: DataFrame, slides: DataFrame, patches: DataFrame) -> DataFrame:
    """``field, record_id, unit`` of every record whose value stands in another unit than the common one."""
    mpp = cut(slide_resolution(documents, slides))
    units = position_units(cells, deliveries, documents, slides)
    other = units.where("unit <> 'um'")
    here = cells.where("cx is not null and not isnan(cx)").select("cell_id", "delivery_id", "slide", "coord_unit")
    o = other.select(F.col("delivery_id").alias("__d"), F.col("slide").alias("__s"), F.col("coord_unit").alias("__c"), "unit")
    cx = here.join(o, F.expr("delivery_id <=> __d and slide <=> __s and coord_unit <=> __c")).select(F.lit("cells.cx").alias("field"), F.col("cell_id").alias("record_id"), "unit")
    res = export_resolutions(documents, slides).where("resolution_unit <> 'um_per_px'").select(F.lit("cell_masks.inference_mpp").alias("field"), F.col("export_id").alias("record_id"), F.col("resolution_unit").alias("unit"))
    rings = ring_units(documents, slides, mpp).where("ring_unit <> 'px'").select(F.lit("cell_masks.coordinates").alias("field"), F.col("export_id").alias("record_id"), F.col("ring_unit").alias("unit"))
    size = patch_units(slides, patches, mpp).where("patch_unit <> 'px'").select(F.lit("TridentTiling.patch_size_level0").alias("field"), F.col("slide_id").alias("record_id"), F.col("patch_unit").alias("unit"))
    return cx.unionByName(res).unionByName(rings).unionByName(size).where("record_id is not null").distinct()
