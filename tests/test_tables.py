import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lamella.functions.labels import type_name, with_role
from lamella.functions.polygons import shape
from lamella.operators import features, order_stats, patches, skew
from lamella.operators.flatten import flatten, masks_found
from lamella.plans import reference
from lamella.sources.masks import unified
from tests.test_units import EXPORTS


def _documents(spark):
    ring = [[0.0, 0.0], [2.0, 0.0], [0.0, 2.0], [0.0, 0.0]]
    tiles = [None, (0, 0, 9, 9, [None, ("a ", 0.5, [1.0, 2.0], ring), (None, None, None, [[1.0, 1.0], None, [2.0, 2.0], [3.0, 1.0]])]), (1, 0, 9, 9, []), (2, 0, 9, 9, None)]
    text = '{"cell_masks": [{"x": 0, "masks": [{"cell_type": "b", "extra": {"q": 1}, "coordinates": [{"x": 1, "y": 1}, {"x": 2, "y": 1}, {"x": 2, "y": 2}]}, {"coordinates": [[1, 2]]}, {}]}]}'
    rows = [(1, "A", None, None, None, None, tiles, None), (1, "A", None, None, None, None, tiles, None), (2, "A", None, None, None, None, None, text), (3, "A", None, None, None, None, [], None), (4, "A", None, None, None, None, None, None), (5, "A", None, None, None, None, None, "{"), (6, "A", None, None, None, None, None, '{"payload": {"cell_masks": []}}')]
    return unified(spark.createDataFrame(rows, EXPORTS))


def test_polygon_shapes_of_both_forms(spark, tmp_path):
    ring = [[0.0, 0.0], [4.0, 0.0], [4.0, 3.0], [0.0, 3.0]]
    text = '{"cell_masks": [null, {"masks": [null, {"coordinates": [[0, 0], [4, 0], [4, 3], [0, 3]]}]}]}'
    rows = [(1, "A", None, None, None, None, [None, (0, 0, 9, 9, [None, (None, None, None, ring)])], None), (2, "A", None, None, None, None, None, text)]
    spark.createDataFrame(rows, EXPORTS).write.parquet(f"{tmp_path}/cell_masks.parquet")
    got = sorted(map(tuple, reference.polygon_shapes(spark, str(tmp_path)).select("export_id", "tile_pos", "mask_pos", "area", "perimeter").collect()))
    assert got == [(1, 1, 1, 12.0, 14.0), (2, 1, 1, 12.0, 14.0)]


def test_all_features_of_regions(spark, monkeypatch):
    rng = np.random.default_rng(6)
    shapes = ", ".join(f"{c} double" for c in features.CHANNELS)
    rows = [(k, "A", ("tumor", "immune", "stroma")[k % 3], "abc"[k % 3], int(rng.integers(0, 1500)), int(rng.integers(0, 1500)), *[float(v) for v in rng.uniform(1, 2, len(features.CHANNELS))]) for k in range(60)]
    cells = spark.createDataFrame(rows, f"cell_id bigint, slide string, role string, cell_type string, qx bigint, qy bigint, {shapes}")
    inside = spark.createDataFrame([(7, k) for k in range(60)] + [(8, k) for k in range(30)], "roi_id bigint, cell_id bigint")
    monkeypatch.setattr(reference, "stored_cells", lambda spark, d: cells)
    monkeypatch.setattr(reference, "roi_cells", lambda spark, d: inside)
    got = reference.roi_features(spark, "").collect()
    assert len(got) == 288 and {(r.slide, r.feature) for r in got} == {(s, f) for s in "78" for f in features.FEATURES}
    assert {r.slide: r.value for r in got if r.feature == "slide__n_cells"} == {"7": 60.0, "8": 30.0}


def test_flatten(spark):
    docs = _documents(spark)
    assert sorted(map(tuple, masks_found(docs).collect())) == [(1, 1, 1, 3), (1, 1, 2, 3), (2, 0, 0, 3)]
    assert sorted((r.export_id, r.tile_pos, r.n_masks) for r in flatten(docs, "tiles").distinct().collect()) == [(1, 1, 3), (1, 2, 0), (1, 3, 0), (2, 0, 3)]
    masks = [(r.export_id, r.tile_pos, r.mask_pos, r.cell_type) for r in flatten(docs, "masks").distinct().collect()]
    assert sorted(masks, key=str) == [(1, 1, 1, "a "), (1, 1, 2, None), (2, 0, 0, "b"), (2, 0, 1, None), (2, 0, 2, None)]
    assert flatten(docs, "points").where("export_id = 1 and mask_pos = 2").distinct().count() == 3
    assert {r.export_id: r.n_tiles for r in flatten(docs, "documents").collect()} == {1: 4, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0}
    assert flatten(docs.limit(0), "points").count() == 0


def test_labels(spark):
    df = spark.createDataFrame([(" Cancer\t cell ", None, 1), ("cancer cell", " ", 2), (None, "Immune", 3), ("", None, 4)], "cell_type string, role string, k int")
    roles = spark.createDataFrame([("Cancer cell", "tumor"), ("Cancer  CELL", "tumor")], "cell_type string, role string")
    assert [r[0] for r in df.select(type_name(F.col("cell_type"))).collect()] == ["cancer cell", "cancer cell", "unknown", "unknown"]
    assert {r.k: r.role_u for r in with_role(df, roles).collect()} == {1: "tumor", 2: "tumor", 3: "immune", 4: "other"}


def test_hot_keys(spark):
    rows = [("hot", float(i)) for i in range(1000)] + [(None, None), ("x", float("nan")), ("x", 2.0)]
    df = spark.createDataFrame(rows, "key string, value double").repartition(7)
    n = skew.number_rows(df, ["key"])
    assert sorted(r.pos for r in n.where("key = 'hot'").collect()) == list(range(1000))
    s = {r.key: r for r in skew.key_statistics(df, ["key"], "value", 64).collect()}
    assert s["hot"].n == 1000 and s["hot"].n_chunks == 16 and s["hot"].mean == pytest.approx(499.5) and s["hot"].std == pytest.approx(np.std(range(1000)))
    assert (s[None].n, s[None].n_valid, s[None].mean) == (1, 0, None) and (s["x"].n, s["x"].n_valid, s["x"].high) == (2, 1, 2.0)
    runs = spark.createDataFrame([("a", v) for v in (1, 1, 2, 2, 2, 1, None, None)], "key string, value int").coalesce(1)
    for size in (1, 3, 100):
        assert [tuple(r) for r in skew.ordered_runs(runs, ["key"], "value", size).collect()] == [("a", 8, 4)]
    assert skew.key_statistics(df.limit(0), ["key"], "value").count() == 0


def test_runs_in_an_order(spark):
    rows = [("a", "s", 3), ("a", "t", 1), ("a", "s", 2), ("a", None, None), ("a", "s", 5), ("a", "t", 4), (None, "s", 1), ("a", "s", 4), ("a", "s", 4)]
    df = spark.createDataFrame(rows, "key string, value string, at int").repartition(3)
    # a by at, ties by value: null, t, s, s, s, s, t, s
    for size in (1, 2, 3, 100):
        assert {tuple(r) for r in skew.ordered_runs(df, ["key"], "value", size, ["at"]).collect()} == {("a", 8, 5), (None, 1, 1)}
    assert skew.ordered_runs(df.limit(0), ["key"], "value", 2, ["at"]).count() == 0


def test_statistics(spark):
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(size=6000), np.full(4000, 0.25)])
    df = spark.createDataFrame([("a", float(x)) for x in v] + [("b", 1.0), ("b", float("inf")), ("c", None), ("d", 1.0), ("d", 2.0), ("d", 4.0), ("d", 9.0)], "k string, x double")
    s = {r.k: r for r in order_stats.stat_block(df.select("k", order_stats.finite(F.col("x")).alias("v")), ["k"]).collect()}
    assert s["a"].p50 == pytest.approx(np.percentile(v, 50), abs=1e-12)
    assert s["a"].p10 == pytest.approx(np.percentile(v, 10), abs=1e-12) and s["a"].p90 == pytest.approx(np.percentile(v, 90), abs=1e-12)
    assert s["b"].skew == 0.0 and s["b"].n == 1 and "c" not in s and s["d"].skew == pytest.approx(0.7684, abs=1e-4)


def test_shapes(spark):
    rings = [[[0, 0], [4, 0], [4, 3]], [[0, 0], [4, 0], [4, 3], [0, 0]], [[4, 3], [4, 0], [0, 0]], [[1e6, 1e6], [1e6 + 10, 1e6], [1e6 + 10, 1e6 + 10], [1e6, 1e6 + 10]], [[0, 0], [1, 1], [2, 2]], [], None]
    rings.append([[10 * math.cos(t), 10 * math.sin(t)] for t in np.linspace(0, 2 * math.pi, 200, endpoint=False)])
    df = spark.createDataFrame([(i, r if r is None else [[float(a), float(b)] for a, b in r]) for i, r in enumerate(rings)], "i int, ring array<array<double>>")
    s = {r.i: r.s for r in df.select("i", shape(F.col("ring")).alias("s")).collect()}
    assert s[0].area == s[1].area == s[2].area == 6.0 and s[0].perimeter == 12.0 and s[0].centroid_x == pytest.approx(8 / 3)
    assert s[3].area == 100 and s[3].centroid_x == pytest.approx(1e6 + 5) and s[3].major_axis == pytest.approx(4 * math.sqrt(100 / 12)) and s[3].eccentricity == pytest.approx(0)
    assert s[4].area is None and (s[4].centroid_x, s[4].centroid_y) == (1.0, 1.0) and s[6] is None
    assert s[7].major_axis == pytest.approx(20, rel=1e-3) and s[7].circularity == pytest.approx(1, abs=1e-3) and s[7].extent == pytest.approx(math.pi / 4, abs=1e-3)


def test_patches(spark):
    p = spark.createDataFrame([("A", 0, 0, 256, 700, 700), ("A", 512, 512, 256, 700, 700), ("A", 1536, 0, 256, 700, 700)], "slide string, patch_x_level0 bigint, patch_y_level0 bigint, patch_px bigint, level0_width bigint, level0_height bigint")
    assert sorted((r.col, r.row) for r in patches.covering_tiles(p).collect()) == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert patches.off_grid(p.withColumn("patch_px", F.lit(300))).count() == 2
    cells = spark.createDataFrame([("A", "x", 5.0, 5.0), ("A", "y", 255.9, 0.0), ("A", "x", 256.0, 0.0)], "slide string, cell_type string, x double, y double")
    side = p.select("slide", "patch_px").distinct()
    d = {(r.patch_x_level0, r.patch_y_level0): r for r in patches.patch_diversity(cells, p, side).collect()}
    assert d[(0, 0)].n_cells == 2 and d[(0, 0)].shannon == pytest.approx(math.log(2)) and d[(0, 0)].shannon_norm == pytest.approx(1) and d[(512, 512)].inv_simpson == 0
    mpp = spark.createDataFrame([("A", 0.5)], "slide string, mpp double")
    s = patches.slide_diversity(cells, p, side, mpp).first()
    assert (s.n_cells, s.n_outside, s.n_patches) == (3, 1, 3) and s.tissue_mm2 == pytest.approx(3 * 256**2 * 0.25 / 1e6)


def test_feature_names():
    from lamella.operators.features import FEATURES

    assert len(FEATURES) == len(set(FEATURES)) == 144


CELL = "slide string, cell_id bigint, cell_type string, role string, confidence float, qx bigint, qy bigint, area float, perimeter float, major_axis float, minor_axis float, eccentricity float, circularity float, extent float, solidity float"


def test_features_of_a_poor_slide(spark):
    """Two immune cells only: every feature is there, null or a stated zero where its population is missing."""
    rows = [("A", i, "lymphocytes", "immune", 0.5, i * 100, 0, 5.0, 1.0, 1.0, 1.0, 0.5, 0.5, 0.5, None) for i in (1, 2)]
    cells = spark.createDataFrame(rows, CELL)
    f = {r.feature: r.value for r in features.all_features(cells).collect()}
    assert set(f) == set(features.FEATURES)
    assert f["slide__n_cells"] == 2 and f["slide__mean_neighbors_per_cell"] == 0 and f["morph__solidity__mean"] is None and f["morph_tumor__area__mean"] is None
    assert f["spatil__immune__n_clusters"] == 0 and f["spatil__immune__clustered_frac"] == 0 and f["spatil__largest_immune_cluster_area_mm2"] == 0
    assert f["spatil__immune_near_tumor__frac"] == 0 and f["spatil__tumor_near_stroma__frac"] is None and f["spatil__immune_to_tumor__nndist_um__median"] is None
    assert f["spatil__immune_spatial_dispersion"] is None and f["diversity__cell_type_diversity__mean"] == 0 and f["spatil__immune_tumor_edge_enrichment"] is None
