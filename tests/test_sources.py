import json

import pytest

from lamella.__main__ import main
from lamella.operators.regions import cells_in_regions, regions_on_grid
from lamella.sources.cells import load_cells
from lamella.sources.discovery import cached, slide_files
from lamella.sources.geojson import cell_features, write_collections
from lamella.sources.masks import read_geojson, read_json_documents, read_regions, read_split_documents

SQUARE = [[0, 0], [8, 0], [8, 8], [0, 8]]


def _slide(root, name, masks, mpp=0.5, file="cell_masks.json"):
    (root / name).mkdir(parents=True)
    (root / name / file).write_text(json.dumps({"inference_mpp": mpp, "cell_masks": [{"x": 1, "y": 2, "width": 100, "height": 100, "masks": masks}]}))


def test_load_cells(spark, tmp_path):
    masks = [{"coordinates": SQUARE, "cell_type": "Cancer cell", "confidence": 0.9}, {"coordinates": [*SQUARE, SQUARE[0]]}, {"coordinates": SQUARE[:2]}, {"cell_type": "x"}]
    _slide(tmp_path, "S1", masks)
    _slide(tmp_path, "S2", [])
    files = slide_files(spark, str(tmp_path), ["none*", "*.json"])
    assert list(files) == ["S1", "S2"]
    rows = sorted(load_cells(spark, list(files.values())).collect(), key=lambda r: r.role)
    assert [(r.slide, r.role, r.cell_type) for r in rows] == [("S1", "other", "unknown"), ("S1", "tumor", "cancer cell")]
    assert all((r.cx, r.cy, r.area, r.perimeter) == (52.0, 102.0, 16.0, 16.0) for r in rows) and rows[0].confidence == 1.0
    assert load_cells(spark, list(files.values()), min_confidence=0.9).count() == 2 and load_cells(spark, list(files.values()), min_confidence=0.95).count() == 1


def test_errors(spark, tmp_path):
    _slide(tmp_path, "S1", [{"coordinates": SQUARE}], mpp=None)
    path = str(tmp_path / "S1" / "cell_masks.json")
    with pytest.raises(Exception, match="no resolution"):
        load_cells(spark, path).collect()
    assert load_cells(spark, path, mpp=1.0).first().area == 64.0
    (tmp_path / "bad.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="not a cell-mask"):
        read_json_documents(spark, str(tmp_path / "bad.json")).collect()


def _tiles(spark, path):
    files, tiles = read_split_documents(spark, path)
    assert files.count() == 1
    return files.first().inference_mpp, sorted((r.tile_pos, r.t) for r in tiles.collect())


@pytest.mark.parametrize("split, indent", [(500, None), (7_000, 1)])
def test_split_documents(spark, tmp_path, split, indent):
    """Files cut anywhere give the tiles of the whole document: fields in any order, null and mask-less tiles, empty masks."""
    mask = lambda n: {"coordinates": [[0, 0], [n, 0.5], [8, n]], "cell_type": f'a "masks": ]}}, {{ {n}', "confidence": None if n % 5 == 0 else 0.5}
    tiles = []
    for n in range(40):
        masks = [mask(n), None, {"cell_type": "no ring"}, *[mask(k) for k in range(n % 7)]]
        place = {"x": n, "y": 2, "width": 100, "height": 50}
        tiles.append([{**place, "masks": masks}, {"masks": masks, **place}, {"x": n, "y": 3, "masks": [], "width": 100, "height": 50}, {**place, "masks": None}, None, place][n % 6])
    for name, doc in {"head": {"a": None, "inference_mpp": 0.25, "cell_masks": tiles}, "tail": {"cell_masks": [None, *tiles], "meta": {"n": [1]}, "inference_mpp": 0.25}, "wrapped": {"payload": {"inference_mpp": 0.25, "cell_masks": tiles}}, "empty": {"inference_mpp": 0.25, "cell_masks": []}}.items():
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(doc, indent=indent))
        whole = read_json_documents(spark, str(path)).first().cell_masks
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
        try:
            mpp, got = _tiles(spark, str(path))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        named = doc.get("payload", doc)["cell_masks"]
        assert mpp == 0.25 and got == [(i, t) for i, t in enumerate(whole) if t is not None and "masks" in named[i]]


def test_geojson(spark, tmp_path):
    poly = lambda ring, kind="Polygon", **p: {"type": "Feature", "geometry": {"type": kind, "coordinates": [ring]}, "properties": p}
    doc = {"type": "FeatureCollection", "features": [poly([*SQUARE, SQUARE[0]], classification={"name": "a"}), poly([[0, 0], [1, 1], [0, 0]]), poly(SQUARE, "MultiPolygon"), poly(SQUARE)]}
    (tmp_path / "c.geojson").write_text(json.dumps(doc))
    got = [(r.feature_pos, r.cell_type, r.confidence, len(r.ring)) for r in read_geojson(spark, str(tmp_path / "c.geojson")).collect()]
    assert got == [(0, "a", 1.0, 4), (3, "Unknown", 1.0, 4)]


def test_regions(spark, tmp_path):
    """A hole is out, its rim too; the parts of a multipolygon are one region; places of features are kept."""
    box = lambda a, b: [[a, a], [b, a], [b, b], [a, b], [a, a]]
    shape = lambda kind, c: {"type": "Feature", "geometry": {"type": kind, "coordinates": c}, "properties": {}}
    doc = {"type": "FeatureCollection", "features": [shape("Polygon", [box(0, 20), box(4, 10)]), shape("Point", [1, 1]), shape("MultiPolygon", [[box(0, 3)], [box(6, 20), [[8, 8], [12, 8], [8, 12], [8, 8]]]]), shape("Polygon", [box(0, 1)[:2]])]}
    (tmp_path / "r.geojson").write_text(json.dumps(doc))
    regions = regions_on_grid(read_regions(spark, str(tmp_path / "r.geojson")).selectExpr("'S' as slide", "region", "rings", "0.5 as mpp"))
    at = [(x, y) for x in range(0, 22) for y in range(0, 22)]
    cells = spark.createDataFrame([("S", i, x * 5, y * 5) for i, (x, y) in enumerate(at)] + [("T", i, x * 5, y * 5) for i, (x, y) in enumerate(at)], "slide string, cell_id bigint, qx bigint, qy bigint")
    got = {}
    for r in cells_in_regions(cells, regions).collect():
        assert r.slide == "S"
        got.setdefault(r.region, set()).add(at[r.cell_id])
    within = lambda p, a, b: all(a < v < b for v in p)
    ring = {p for p in at if within(p, 0, 20) and not all(4 <= v <= 10 for v in p)}
    parts = {p for p in at if within(p, 0, 3) or (within(p, 6, 20) and not (min(p) >= 8 and sum(p) <= 20))}
    assert sorted(map(len, got.values())) == sorted([len(ring), len(parts)]) and all(v in (ring, parts) for v in got.values())


def test_collections(spark, tmp_path):
    _slide(tmp_path, "S1", [{"coordinates": SQUARE, "cell_type": "a"}, {"coordinates": SQUARE[:2]}])
    docs = read_json_documents(spark, str(tmp_path / "S1")).selectExpr("1L as export_id", "cell_masks")
    out = str(tmp_path / "out")
    write_collections(cell_features(docs).coalesce(1), out)
    (file,) = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part") and p.stat().st_size]
    c = json.loads(file.read_text())
    ring = c["features"][0]["geometry"]["coordinates"][0]
    assert c["type"] == "FeatureCollection" and len(c["features"]) == 1 and ring[0] == ring[-1] == [100.0, 200.0] and len(ring) == 5


def test_cache(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a").write_text("x")
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([("S", 1)], "slide string, v int")

    for _ in range(2):
        assert cached(spark, str(tmp_path / "cache"), str(tmp_path / "src"), build).first().slide == "S"
    assert len(calls) == 1
    cached(spark, str(tmp_path / "cache"), str(tmp_path / "src"), build, rebuild=True)
    assert len(calls) == 2


RICH = ["Lymphocytes", "Cancer cell", "Fibroblasts", "Epithelial", "Endothelial Cell", "Apoptotic Body"]


def _rich(root):
    """Bands of cells of every role, dense enough for clusters of three roles that overlap."""
    masks = []
    for k in range(420):
        x, y, w = (k % 28) * 60 + k * 13 % 23, (k // 28) * 60 + k * 29 % 31, 10 + k % 7
        masks.append({"coordinates": [[x, y], [x + w, y], [x + w + k % 5, y + 8 + k % 3], [x + 4, y + 5], [x, y + 9]], "cell_type": RICH[(k * 7 // 3) % 3 if k % 11 else k % 6], "confidence": 0.9})
    _slide(root, "S1", masks)


def test_cli(spark, tmp_path):
    _rich(tmp_path / "in")
    main([str(tmp_path / "in"), "-o", str(tmp_path / "f")])
    row = spark.read.parquet(str(tmp_path / "f.parquet")).first()
    assert len(row) == 145 and row.slide == "S1" and row.slide__n_cells == 420
    # nothing of a rich slide is missing
    assert [c for c, v in row.asDict().items() if v is None] == []
    assert 0 < row.morph__solidity__mean < 1 and row.diversity__solidity_local_sd__mean > 0
    main(["features", str(tmp_path / "in"), "-o", str(tmp_path / "f"), "--min-cluster", "100000", "--near-um", "0.1", "--max-edge-um", "40"])
    other = spark.read.parquet(str(tmp_path / "f.parquet")).first()
    assert other.spatil__immune__n_clusters == 0 and row.spatil__immune__n_clusters > 0 and other.spatil__immune_near_tumor__frac == 0 < row.spatil__immune_near_tumor__frac


def test_export(spark, tmp_path):
    _rich(tmp_path / "in")
    main(["export", str(tmp_path / "in"), "-o", str(tmp_path / "x"), "--clusters", "--interactions", "--measurements"])
    found = {}
    for kind in ("clusters", "edges", "cells"):
        (file,) = [p for p in (tmp_path / "x" / kind / "slide=S1").iterdir() if p.name.startswith("part")]
        found[kind] = json.loads(file.read_text())["features"]
    assert len(found["cells"]) == 420 and len(found["cells"][0]["properties"]["measurements"]) == 11
    one = found["cells"][0]
    assert one["geometry"]["coordinates"][0][0] == one["geometry"]["coordinates"][0][-1] and one["properties"]["measurements"]["solidity"] > 0
    assert {f["properties"]["classification"]["name"] for f in found["clusters"]} <= {"immune_cluster", "tumor_cluster", "stroma_cluster"}
    assert found["edges"] and found["edges"][0]["properties"]["classification"] == {"name": "immune_tumor_edge", "color": [155, 93, 229]}


def test_diversity(spark, tmp_path):
    masks = [{"cell_type": t, "centroid": [x, 5.0]} for t, x in (("a", 1.0), ("b", 2.0), ("a", 300.0), ("a", 9000.0))]
    _slide(tmp_path / "in", "S1", masks)
    _slide(tmp_path / "in", "S2", masks)
    spark.createDataFrame([("S1", 0, 0, 256), ("S1", 256, 0, 256), ("S3", 0, 0, 256)], "slide string, patch_x_level0 bigint, patch_y_level0 bigint, patch_px bigint").write.parquet(str(tmp_path / "p"))
    main(["diversity", str(tmp_path / "in"), "-o", str(tmp_path / "d"), "--patches", str(tmp_path / "p")])
    read = lambda n: spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "d" / n))
    (row,) = read("slide_diversity.csv").collect()
    assert (row.slide, row.n_cells, row.n_outside, row.n_a, row.n_b) == ("S1", 4, 1, 3, 1)
    assert {r.slide for r in read("unpaired.csv").collect()} == {"S2", "S3"}
    assert sorted((r.patch_x_level0, r.n_cells, r.n_a) for r in read("patch_diversity").collect()) == [(0, 2, 1), (256, 1, 1)]


def test_resolution_of_a_sibling(spark, tmp_path):
    _slide(tmp_path, "S1", [], mpp=0.5)
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [SQUARE]}, "properties": {}}]}
    (tmp_path / "S1" / "c.geojson").write_text(json.dumps(doc))
    assert load_cells(spark, str(tmp_path / "S1" / "c.geojson")).first().area == 16.0
    (tmp_path / "S1" / "cell_masks.json").unlink()
    with pytest.raises(Exception, match="no resolution"):
        load_cells(spark, str(tmp_path / "S1" / "c.geojson")).collect()
