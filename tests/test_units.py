import pytest
from pyspark.sql import functions as F

from lamella.functions import unit_text as u
from lamella.operators import units
from lamella.sources.masks import unified


@pytest.mark.parametrize(
    "text, field, name",
    [
        ("µm", "position", "um"), (" UM ", "position", "um"), ("μm", "position", "um"), ("micrometres", "position", "um"), ("MM", "position", "mm"),
        ("nanometre", "position", "nm"), ("px (L0)", "position", "px"), ("level-0 px", "position", "px"), ("", "position", None), (None, "position", None),
        ("banana", "position", None), ("um/px", "resolution", "um_per_px"), ("nm per pixel", "resolution", "nm_per_px"), ("dpi", "resolution", "px_per_inch"),
        ("1/cm", "resolution", "px_per_cm"), ("pixels per inch", "resolution", "px_per_inch"), ("0..1 of tile side", "ring", "tile_fraction"),
        ("level-1 px", "ring", "half_px"), ("microns from tile corner", "ring", "um"), ("local pixels", "ring", "px"), ("px at target magnification", "patch", "target_px"),
        ("level0 px", "patch", "px"), ("millimetre", "patch", "mm"),
    ],
)
def test_unit_names(text, field, name):
    assert u.unit_name(text, field) == name


@pytest.mark.parametrize(
    "text, field, factor, kind",
    [
        ("10 um", "position", 10, "um"), ("0.1 um", "position", 0.1, "um"), ("100 nm", "position", 0.1, "um"), ("0,5 mm", "position", 500, "um"), ("cm", "position", 1e4, "um"),
        ("inch", "position", 25400, "um"), ("m", "position", 1e6, "um"), ("pm", "position", 1e-6, "um"), ("dm", "position", 1e5, "um"), ("Å", "position", 1e-4, "um"), ("thou", "position", 25.4, "um"),
        ("px @ level 1", "position", 2, "px"), ("2 px", "position", 2, "px"), ("px (L0)", "position", 1, "px"), ("px at target magnification", "position", 1, "target_px"), ("10um", "position", 10, "um"),
        ("cm/px", "resolution", 1e4, "um_per_px"), ("px/mm", "resolution", 1e-3, "px_per_um"), ("px/um", "resolution", 1, "px_per_um"), ("px/m", "resolution", 1e-6, "px_per_um"), ("um per px at level 1", "resolution", 0.5, "um_per_px"),
        ("1000 px/cm", "resolution", 0.1, "px_per_um"), ("mm", "ring", 1e3, "um"), ("nm", "ring", 1e-3, "um"), ("nm", "patch", 1e-3, "um"), ("cm", "patch", 1e4, "um"), ("tenths of a micron", "patch", 0.1, "um"),
    ],
)
def test_factors(text, field, factor, kind):
    got = u.scale(text, field)
    assert got.kind == kind and got.factor == pytest.approx(factor)


def test_dimensions_that_a_field_cannot_have():
    assert u.parse("mm²", "position").dims == (2, 0) and u.scale("mm²", "position") is None
    assert u.scale("um/px", "position") is None and u.scale("um", "resolution") is None and u.scale("20", "position") is None


@pytest.mark.parametrize(
    "note, unit",
    [
        ("coordinates: thousandths of a millimetre", "um"), ("position unit is 0.001 um", "nm"), ("positions: 1 unit = 1000 um", "mm"), ("cx, cy exported in nm", "nm"),
        ("centroid columns were NOT multiplied by mpp", "px"), ("cx and cy were multiplied by the slide mpp", "um"), ("patch 512 px; positions in um", "um"),
        ("tile 784 px, overlap 64 px", None), ("shape columns use mpp of the header", None), ("", None), (None, None), ("cx/cy in mm, shapes in um", "mm"),
    ],
)
def test_notes(note, unit):
    assert u.note_unit(note) == unit


def test_headers():
    named = lambda t: (u.header_resolution(t)[0], u.header_resolution(t)[1].name)
    assert named("784/64 tiles; 20000,0 px/cm (from scanner header)") == (20000.0, "px_per_cm")
    assert u.header_resolution("batch 8; model v2") is None
    assert named("scale: 39555,1 1/cm") == (39555.1, "px_per_cm")
    assert u.header_ring("mixed precision; vertices given as level-1 px").name == "half_px"
    assert u.header_ring("784/64 tiles") is None


SLIDES = "slide_id bigint, slide string, patch_size_level0 double, patch_size_unit string, level0_width bigint, level0_height bigint, level0_magnification int, target_magnification int"
EXPORTS = "export_id bigint, slide string, inference_mpp double, mpp_unit string, coord_space string, header_text string, cell_masks array<struct<x:bigint,y:bigint,width:bigint,height:bigint,masks:array<struct<cell_type:string,confidence:double,centroid:array<double>,coordinates:array<array<double>>>>>>, raw_json string"
CELLS = "slide string, cell_id bigint, delivery_id bigint, cx float, cy float, coord_unit string"


def _tables(spark):
    slides = spark.createDataFrame([(1, "A", 128.0, None, 4000, 2000, 40, 20), (2, "B", None, None, 100, 100, 20, 10)], SLIDES)
    ring = [[10.0, 10.0], [30.0, 10.0], [30.0, 30.0], [10.0, 30.0]]
    tile = lambda k: [(1, 0, 100, 100, [("t", 0.5, [100 + 20.0, 20.0], [[a / k, b / k] for a, b in ring]), None, ("t", None, None, None)])]
    exports = spark.createDataFrame(
        [
            (1, "A", 0.25, "um/px", None, None, tile(2), None),
            (2, "A", 101600.0, None, None, None, tile(1), None),
            (3, "A", None, None, None, "resolution 0,00025 mm/px; rings in um", tile(4), None),
            (4, "A", None, None, None, None, None, '{"payload": {"cell_masks": [{"x": 1, "y": 0, "width": 100, "height": 100, "masks": [{"centroid": [120, 20], "coordinates": [{"x": 0.1, "y": 0.1}, {"x": 0.3, "y": 0.1}, {"x": 0.3, "y": 0.3}, {"x": 0.1, "y": 0.3}]}]}]}}'),
            (5, "A", None, None, None, None, None, "no json"),
        ],
        EXPORTS,
    )
    cells = spark.createDataFrame([("A", 1, 1, 3900.0, 1900.0, None), ("A", 2, 1, 100.0, 50.0, None), ("A", 1, 2, 0.975, 0.475, "mm"), ("A", 3, 2, None, None, "mm"), ("A", 4, 3, 980.0, 10.0, None), ("A", 5, 4, 500.0, 7.0, None)], CELLS)
    deliveries = spark.createDataFrame([(1, None), (2, ""), (3, "second pass"), (4, "cx, cy exported in nm")], "delivery_id bigint, note string")
    patches = spark.createDataFrame([("A", 256, 512), ("A", 0, 768)], "slide string, patch_x_level0 bigint, patch_y_level0 bigint")
    return cells, deliveries, unified(exports), slides, patches


def test_found(spark):
    found = {(r.field.split(".")[1], r.record_id, r.unit) for r in units.units_found(*_tables(spark)).collect()}
    assert found == {
        ("cx", 1, "px"), ("cx", 2, "px"), ("cx", 1, "mm"), ("cx", 5, "nm"), ("inference_mpp", 2, "px_per_inch"), ("inference_mpp", 3, "mm_per_px"),
        ("coordinates", 1, "half_px"), ("coordinates", 3, "um"), ("coordinates", 4, "tile_fraction"), ("patch_size_level0", 1, "target_px"),
    }


def test_cells_on_grid(spark):
    cells, deliveries, docs, slides, _ = _tables(spark)
    u = units.position_units(cells, deliveries, docs, slides)
    rows = {(r.cell_id, r.delivery_id): (r.qx, r.qy) for r in units.cells_in_um(cells.withColumns({c: F.lit(1) for c in ("unit", "um", "qx", "mpp")}), u).collect()}
    assert rows == {(1, 1): (9750, 4750), (2, 1): (250, 125), (1, 2): (9750, 4750), (4, 3): (9800, 100), (5, 4): (5, 0)}


def test_empty(spark):
    cells, deliveries, docs, slides, patches = (t.limit(0) for t in _tables(spark))
    assert units.units_found(cells, deliveries, docs, slides, patches).count() == 0


def test_ring_points_in_px(spark):
    _, _, docs, slides, _ = _tables(spark)
    mpp = units.slide_resolution(docs, slides)
    twice = docs.unionByName(docs).withColumns({c: F.lit("clash") for c in ("kind", "unit", "tile", "px", "mpp")})
    rows = units.rings_in_px(twice, slides, mpp).collect()
    # whatever the unit, the same square comes out, once for each of the four documents with points
    for e in (1, 2, 4):
        got = [(r.tile_pos, r.mask_pos, r.point_pos, round(r.px, 6), round(r.py, 6)) for r in rows if r.export_id == e]
        assert sorted(got) == [(0, 0, 0, 10.0, 10.0), (0, 0, 1, 30.0, 10.0), (0, 0, 2, 30.0, 30.0), (0, 0, 3, 10.0, 30.0)]
    assert sorted((round(r.px, 6), round(r.py, 6)) for r in rows if r.export_id == 3) == [(10.0, 10.0), (10.0, 30.0), (30.0, 10.0), (30.0, 30.0)]
    assert {r.export_id for r in rows} == {1, 2, 3, 4}
    assert units.rings_in_px(docs.limit(0), slides, mpp).count() == 0


def test_ring_points_with_holes(spark):
    slides = spark.createDataFrame([(1, "A", None, None, 100, 100, 40, 20)], SLIDES)
    tile = (0, 0, None, 50, [("t", 0.5, None, [[0.5, 0.5], None, [None, 0.5], []]), ("t", None, None, None), ("t", None, None, [])])
    docs = unified(spark.createDataFrame([(1, "A", 0.25, "um/px", "fraction of tile", None, [None, tile], None), (2, None, None, None, "um", None, [(0, 0, 9, 9, [("t", 1.0, None, [[1.0, 2.0]])])], None)], EXPORTS))
    rows = {tuple(r) for r in units.rings_in_px(docs, slides, units.slide_resolution(docs, slides)).collect()}
    # a width that isn't known and a slide without resolution give null, positions are those of the arrays as stored
    assert rows == {(1, 1, 0, 0, None, 25.0), (1, 1, 0, 2, None, 25.0), (1, 1, 0, 3, None, None), (2, 0, 0, 0, None, None)}
