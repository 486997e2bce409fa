import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from lamella.functions import hulls
from lamella.functions.kdtree import KDTree, strictly_inside
from lamella.operators.clusters import cluster_overlap
from lamella.operators.components import block_components, graph_components, labels
from lamella.operators.delaunay import delaunay_edges
from lamella.operators.near import near_and_inside
from lamella.operators.nearest import nearest


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 200), st.integers(1, 40), st.integers(0, 10**6))
def test_kdtree(n, m, seed):
    rng = np.random.default_rng(seed)
    p, q = rng.integers(0, 30, (n, 2)).astype(float), rng.integers(0, 30, (m, 2)).astype(float)
    tree = KDTree(p, leaf=4) if n else None
    if not n:
        return
    d = ((q[:, None] - p[None]) ** 2).sum(axis=2)
    got = {(a, b) for x, y in tree.within(q, 5.0, block=7) for a, b in zip(x.tolist(), y.tolist())}
    assert got == set(zip(*map(lambda v: v.tolist(), np.nonzero(d <= 25))))
    assert np.array_equal(tree.nearest(q)[:, 0], d.min(axis=1))
    assert np.array_equal(tree.nearest(q, 3)[:, : min(3, n)], np.sort(d, axis=1)[:, :3])


def test_strictly_inside():
    ring = np.array([[0, 0], [10, 0], [10, 10], [5, 5], [0, 10], [0, 0]], dtype=float)
    x, y = (np.array(v, dtype=float) for v in ([5, 5, 0, 2, 5, 9, 5, 11, 1], [5, 4, 3, 9, 0, 9, 8, 5, 1]))
    for r in (ring, ring[::-1], ring[:-1]):
        assert sorted(strictly_inside(x, y, np.argsort(y), r).tolist()) == [1, 8]


def _points(seed=1, n=400, wide=3000):
    rng = np.random.default_rng(seed)
    p = pd.DataFrame({"slide": np.where(np.arange(n) % 3 == 0, "B", "A"), "id": np.arange(n), "kind": rng.integers(0, 3, n), "qx": rng.integers(0, wide, n), "qy": rng.integers(0, wide, n)})
    p.loc[5, ["slide", "kind", "qx", "qy"]] = ["A", 0, 1000, 1000]
    p.loc[7, ["slide", "kind", "qx", "qy"]] = ["A", 1, 1120, 1160]  # exactly 200 steps away
    p.loc[8, ["slide", "kind", "qx", "qy"]] = ["A", 1, 1120, 1161]
    return p


def test_near_and_inside(spark):
    p = _points()
    rings = spark.createDataFrame([("A", 900, [0.0, 0.0, 2000.0, 0.0, 2000.0, 2000.0, 0.0, 2000.0]), ("A", 900, [0.0, 0.0, 2000.0, 0.0, 2000.0, 2000.0, 0.0, 2000.0]), ("C", 901, [0.0, 0.0, 5.0, 0.0, 5.0, 5.0])], "slide string, id bigint, ring array<double>")
    want = set()
    for _, g in p.groupby("slide"):
        a, b = g[g.kind == 0], g[g.kind == 1]
        d = (a.qx.values[:, None] - b.qx.values) ** 2 + (a.qy.values[:, None] - b.qy.values) ** 2
        want |= {("near", min(x, y), max(x, y)) for i, j in zip(*np.nonzero(d <= 40000)) for x, y in [(a.id.values[i], b.id.values[j])]}
    g = p[(p.slide == "A") & (p.qx > 0) & (p.qx < 2000) & (p.qy > 0) & (p.qy < 2000)]
    want |= {("inside", 900, i) for i in g.id}
    assert ("near", 5, 7) in want and ("near", 5, 8) not in want
    for target in (30_000, 20):
        got = [tuple(r) for r in near_and_inside(spark.createDataFrame(p), rings, 200, target).collect()]
        assert set(got) == want and len([r for r in got if r[0] == "near"]) == len({r for r in got if r[0] == "near"})


def test_near_empty(spark):
    none = spark.createDataFrame([], "slide string, id bigint, kind int, qx bigint, qy bigint")
    assert near_and_inside(none, spark.createDataFrame([], "slide string, id bigint, ring array<double>"), 200).count() == 0


def _brute_edges(g, longest):
    g = g.drop_duplicates(["qx", "qy"])
    x, y, ids, out = g.qx.to_numpy(), g.qy.to_numpy(), g.id.to_numpy(), set()
    for a in range(len(g)):
        for b in np.flatnonzero(((x - x[a]) ** 2 + (y - y[a]) ** 2 <= longest**2) & (ids > ids[a])):
            ax, ay, bx, by = x[a] - x, y[a] - y, x[b] - x, y[b] - y
            c, d = ax * by - ay * bx, ax * bx + ay * by
            other = np.ones(len(g), bool)
            other[[a, b]] = False
            cot = d / np.where(c == 0, 1, np.abs(c))
            lo, hi = np.where(c > 0, cot, np.inf), np.where(c < 0, cot, np.inf)
            if ((c == 0) & (d < 0) & other).any() or (np.isinf(lo.min()) and np.isinf(hi.min())) or lo.min() + hi.min() < 0:
                continue
            if lo.min() + hi.min() == 0 and min(ids[lo == lo.min()].min(), ids[hi == hi.min()].min()) <= min(ids[a], ids[b]):
                continue
            out.add((int(ids[a]), int(ids[b])))
    return out


def test_delaunay(spark):
    grid = pd.DataFrame({"slide": "G", "id": np.arange(100), "qx": np.arange(100) % 10 * 100, "qy": np.arange(100) // 10 * 100})
    line = pd.DataFrame({"slide": "L", "id": np.arange(9), "qx": np.arange(9) * 40, "qy": 3})
    sparse = pd.DataFrame({"slide": "S", "id": np.arange(5), "qx": [0, 400, 5000, 5400, 5200], "qy": [0, 0, 4000, 4000, 4300]})
    twins = pd.DataFrame({"slide": "D", "id": np.arange(5), "qx": [0, 0, 100, 0, 100], "qy": [0, 0, 0, 100, 100]})
    # a third of the points in the first column; one row; and a coast: flat arcs whose circles are wider than any node
    column = _points(7, 300, 4000).drop(columns="kind").assign(slide="C")
    column.loc[column.index < 100, "qx"] = column.qx.min()
    row = _points(8, 200, 4000).drop(columns="kind").assign(slide="R")
    row.loc[row.index < 80, "qy"] = 0
    k = np.arange(120)
    coast = pd.DataFrame({"slide": "O", "id": k, "qx": k * 60, "qy": (k - 60) ** 2 // 90})
    bay = pd.concat([coast, coast.assign(id=k + 200, qy=9000 - coast.qy)]).assign(slide="Q")
    p = pd.concat([_points(3, 300, 4000).drop(columns="kind"), grid, line, sparse, twins, column, row, coast, bay])
    e = delaunay_edges(spark.createDataFrame(p), 500, 120).toPandas()
    for slide, g in p.groupby("slide"):
        own = e[e.slide == slide]
        assert set(zip(own.i, own.j)) == _brute_edges(g, 500), slide
    # Euler's formula for all edges of points in general position
    q = _points(4, 60, 5000).drop(columns="kind").assign(slide="E")
    h = len(hulls.hull(q[["qx", "qy"]].to_numpy()))
    assert delaunay_edges(spark.createDataFrame(q), 10_000).count() == 3 * 60 - 3 - h


def test_nearest(spark):
    p = _points(5)
    q, t = p[p.kind == 0], p[(p.kind == 1) & (p.slide == "A")]
    got = {r.id: r.steps for r in nearest(spark.createDataFrame(q), spark.createDataFrame(t), target=15).collect()}
    for r in q.itertuples():
        d = np.sqrt(((t.qx - r.qx) ** 2 + (t.qy - r.qy) ** 2).min()) if r.slide == "A" else np.inf
        assert got[r.id] == d
    for r in nearest(spark.createDataFrame(q), spark.createDataFrame(t), target=15, k=3).collect():
        me = q[q.id == r.id].iloc[0]
        d = np.sqrt(np.sort((t.qx - me.qx) ** 2 + (t.qy - me.qy) ** 2)[:3]).tolist() if me.slide == "A" else [np.inf] * 3
        assert r.steps == d
    one = nearest(spark.createDataFrame(q), spark.createDataFrame(q), other=True, target=15)
    for r in one.collect():
        me = q[q.id == r.id].iloc[0]
        o = q[(q.slide == me.slide) & (q.id != r.id)]
        assert r.steps == np.sqrt(((o.qx - me.qx) ** 2 + (o.qy - me.qy) ** 2).min())


def test_components(spark):
    pairs = [(1, 2), (2, 3), (3, 1), (10, 9), (9, 8), (8, 7), (7, 6), (5, 5), (20, 21)]
    got = {r.node: r.component for r in graph_components(spark.createDataFrame(pairs, "i bigint, j bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6, 8: 6, 9: 6, 10: 6, 20: 20, 21: 20}


def test_components_across_blocks(spark):
    rng = np.random.default_rng(2)
    pairs = pd.DataFrame({"slide": np.where(np.arange(300) % 2, "a", "b"), "node": rng.integers(0, 6, 300), "i": rng.integers(0, 250, 300), "j": rng.integers(0, 250, 300)})
    pairs["ix"], pairs["jx"] = pairs.i * 3, pairs.j * 3
    for share in (1, 100):
        got = {(r.slide, r.id): (r.component, r.x) for r in block_components(spark.createDataFrame(pairs.assign(node=pairs.node // share)), ["slide"], "node", ["x"]).collect()}
        for s, g in pairs.groupby("slide"):
            low = labels(g.i.to_numpy(), g.j.to_numpy(), 250)
            assert {k[1]: v for k, v in got.items() if k[0] == s} == {int(n): (int(low[n]), int(n) * 3) for n in set(g.i) | set(g.j)}


def test_overlap_of_hulls_wider_than_a_cell(spark):
    rect = lambda x, y, w, h: [x, y, x + w, y, x + w, y + h, x, y + h]
    rows = [("S", "immune", 1, 9, rect(-4000, -4000, 33_000, 12_000)), ("S", "tumor", 2, 9, rect(0, 0, 5000, 5000)), ("S", "tumor", 3, 9, rect(2000, 2000, 20_000, 2000)), ("S", "tumor", 4, 9, rect(29_000, 0, 10, 10)), ("S", "stroma", 5, 9, rect(50_000, 0, 10, 10))]
    hull = spark.createDataFrame([(*r, float((r[4][2] - r[4][0]) * (r[4][5] - r[4][1]))) for r in rows], "slide string, role string, cluster bigint, n bigint, ring array<bigint>, area double")
    got = {(r.a, r.b): (r.meets_frac, r.overlap_ratio) for r in cluster_overlap(hull).collect()}
    assert got[("immune", "stroma")] == (0.0, 0.0) and got[("immune", "tumor")][0] == 1.0
    assert abs(got[("immune", "tumor")][1] - (25e6 + 40e6 - 6e6) / (33e3 * 12e3)) < 1e-9
    assert cluster_overlap(hull.limit(0)).count() == 0


def test_solidity():
    rng = np.random.default_rng(6)
    rings = [np.array([0, 0, 4, 0, 4, 4, 0, 4]), np.array([0, 0, 4, 0, 4, 4, 2, 1]), np.array([0, 0, 1, 1, 2, 2]), None, np.array([0, 0, 4, 0, 4, 4, 0, 4, 0, 0])]
    rings += [rng.integers(0, 9, 2 * int(rng.integers(3, 12))) for _ in range(300)]
    got = hulls.solidity(rings)
    for r, s in zip(rings, got):
        ring = np.empty((0, 2)) if r is None else r.reshape(-1, 2).astype(float)
        whole = hulls.area(hulls.hull(ring)) if len(ring) else 0.0
        assert (np.isnan(s) and whole == 0) or s == min(hulls.area(ring) / whole, 1.0)


def test_hulls():
    square = np.array([[0, 0], [4, 0], [4, 4], [0, 4], [2, 2], [2, 0]])
    h = hulls.hull(square)
    assert len(h) == 4 and hulls.area(h) == 16 and hulls.perimeter(h) == 16
    assert len(hulls.hull(np.array([[0, 0], [1, 1], [2, 2]]))) < 3
    moved = h + np.array([2, 2])
    assert hulls.area(hulls.clip(h, moved)) == 4
    assert len(hulls.clip(h, h + np.array([4, 0]))) > 0 and hulls.area(hulls.clip(h, h + np.array([4, 0]))) == 0
    assert len(hulls.clip(h, h + np.array([5, 0]))) == 0
    assert abs(hulls.union_area([h.astype(float), moved.astype(float)]) - 28) < 1e-9
