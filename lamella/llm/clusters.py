"""Similarity clusters: neighbour descent gives an approximate nearest-neighbour graph, modularity its communities.

Equal vectors are one node with a weight. In every round the nodes are sorted over the cluster along another
space-filling curve and cut into blocks of bounded size; in a block, neighbour descent (neighbours of neighbours, and
reverse neighbours, until little changes) improves each node's list. The lists of all rounds are united, and further
passes of neighbour descent, as joins, carry them across the blocks; links as long as ``reach`` or longer are left
out, so points further apart never share a community through one link.

Communities come from rounds of local moves that raise modularity, on labels joined to edges and added up with
map-side combine, and from contraction of the graph. A community is described by its size and by its members of
highest weighted degree within it. Isolated groups are put together from whole communities and then checked exactly;
see :func:`isolated_groups`.

Rows with a null in a feature are out; repeated rows of one id count once; an empty table gives empty results.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamella.session import Table, bounded

BLOCK, NEIGHBOURS, ROUNDS, PASSES, BITS = 4096, 10, 3, 1, 12
#: Cells on each side of a centre's cell; rounding of measures that a distance may have.
WINDOW, SLACK = 3, 1e-9


def descend(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Approximate ``k`` nearest neighbours (largest difference of a coordinate) of each row of a block: indices, distances."""
    n = len(x)
    k = min(k, n - 1)
    rng = np.random.default_rng(seed)
    me = np.arange(n)[:, None]
    steps = np.array([s for d in range(1, k // 2 + 1) for s in (d, -d)] or [1])
    near = np.concatenate([(me + steps) % n, rng.integers(0, n, (n, k))], axis=1)

    def best(cand: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cand = np.sort(cand, axis=1)
        d = np.abs(x[cand, 0] - x[:, None, 0])
        for j in range(1, x.shape[1]):
            np.maximum(d, np.abs(x[cand, j] - x[:, None, j]), out=d)
        d[cand == me] = np.inf
        d[:, 1:][cand[:, 1:] == cand[:, :-1]] = np.inf
        take = np.argpartition(d, k - 1, axis=1)[:, :k]
        return np.take_along_axis(cand, take, 1), np.take_along_axis(d, take, 1)

    ids, dist = best(near)
    for _ in range(rounds):
        flat = ids.ravel()
        order = np.argsort(flat, kind="stable")
        starts = np.searchsorted(flat[order], np.arange(n + 1))
        rank = np.arange(n * k) - np.repeat(starts[:-1], np.diff(starts))
        back = np.repeat(me, k, axis=1)
        keep = rank < k
        back[flat[order][keep], rank[keep]] = order[keep] // k
        pool = np.concatenate([ids, ids[ids[:, : max(3, k // 2)]].reshape(n, -1), back, ids[back[:, :3]].reshape(n, -1)], axis=1)
        new, d = best(pool)
        gained = np.sum(d.sum(axis=1) < dist.sum(axis=1) - 1e-12)
        ids, dist = new, d
        if gained < 0.01 * n:
            break
    return ids, dist


def neighbour_graph(nodes: DataFrame, dims: list[str], reach: float, k: int = NEIGHBOURS, rounds: int = ROUNDS, block: int = BLOCK, passes: int = PASSES) -> DataFrame:
    """``a, b, d`` (a < b): links shorter than ``reach`` of the approximate ``k``-nearest-neighbour graph of ``node, *dims``."""
    ends = nodes.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(dims)], *[F.max(c).alias(f"hi{i}") for i, c in enumerate(dims)]).first()
    low = np.array([ends[f"lo{i}"] or 0.0 for i in range(len(dims))], dtype=float)
    wide = np.maximum(np.array([ends[f"hi{i}"] or 0.0 for i in range(len(dims))], dtype=float) - low, 1e-9)
    many = nodes.count()

    def curve(turn: int):
        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                # a shifted grid, and the axes in another order, each round
                q = ((pdf[dims].to_numpy() - low) / wide * 0.7 + 0.11 * turn) * (2**BITS - 1)
                q = np.roll(q.astype(np.int64), turn, axis=1)
                key = np.zeros(len(pdf), dtype=np.int64)
                for bit in reversed(range(BITS)):
                    for j in range(q.shape[1]):
                        key = key << 1 | (q[:, j] >> bit & 1)
                yield pdf.assign(key=key)

        return work

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(part: pd.DataFrame) -> pd.DataFrame:
            ids = part["node"].to_numpy()
            near, d = descend(part[dims].to_numpy(), k)
            keep = d < reach
            a, b = np.repeat(ids, near.shape[1]).reshape(near.shape)[keep], ids[near[keep]]
            return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "d": d[keep]})

        held = None
        for pdf in batches:
            held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            # keep a full block back, so that the last one isn't a scrap
            while len(held) >= 2 * block:
                yield done(held.iloc[:block])
                held = held.iloc[block:].reset_index(drop=True)
        if held is not None and len(held) > 1:
            yield done(held)

    types = dict(nodes.dtypes)
    kind = ", ".join(f"{c} {types[c]}" for c in ["node", *dims])
    parts = max(1, -(-many // (2 * block)))
    links = None
    for turn in range(rounds):
        keyed = nodes.select("node", *dims).mapInPandas(curve(turn), f"{kind}, key bigint")
        found = keyed.repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node").mapInPandas(link, "a bigint, b bigint, d double")
        links = found if links is None else links.unionByName(found)
    lists = _nearest_lists(links.groupBy("a", "b").agg(F.min("d").alias("d")), k)
    for _ in range(passes):
        lists = _nearest_lists(lists.unionByName(_across(lists, nodes, dims, k)), k)
    return Table(lists.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "d").distinct()).df


def _nearest_lists(links: DataFrame, k: int) -> DataFrame:
    """``a, b, d``: of each node's links, seen from either end, the ``k`` nearest."""
    both = links.select("a", "b", "d").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "d")).groupBy("a", "b").agg(F.min("d").alias("d"))
    best = both.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy("d", "b"))).where(F.col("r") <= k)
    return Table(best.drop("r")).df


def _across(lists: DataFrame, nodes: DataFrame, dims: list[str], k: int) -> DataFrame:
    """Links ``a, b, d`` by which a node's list gets better: neighbours of its neighbours, in whatever block they were.

    A row meets one neighbour's whole list (``k`` entries), so only links that are nearer than the node's last one
    leave the task. As equal vectors are one node, few lists name the same node.
    """
    place = nodes.select(F.col("node").alias("b"), F.array(*dims).alias("x"))
    full = lists.join(place, "b").groupBy("a").agg(F.collect_list("b").alias("ids"), F.flatten(F.collect_list("x")).alias("xs"), F.max("d").alias("far"), F.count("*").alias("n"))
    # a node with fewer links than k takes any
    full = Table(full.join(place.withColumnRenamed("b", "a"), "a").withColumn("far", F.when(F.col("n") < k, float("inf")).otherwise(F.col("far")))).df
    asked = full.select("a", "x", "far", F.explode("ids").alias("b")).join(full.select(F.col("a").alias("b"), F.col("ids").alias("ids"), "xs"), "b").select("a", "far", "x", "ids", "xs")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, far, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).flatten().to_numpy().reshape(-1, len(dims))
            times = batch.column(3).value_lengths().to_numpy()
            c, xs = batch.column(3).flatten().to_numpy(), batch.column(4).flatten().to_numpy().reshape(-1, len(dims))
            at = np.repeat(np.arange(len(a)), times)
            d = np.abs(xs - x[at]).max(axis=1) if len(at) else np.empty(0)
            keep = (d < far[at]) & (c != a[at])
            yield pa.RecordBatch.from_arrays([pa.array(a[at[keep]]), pa.array(c[keep]), pa.array(d[keep])], names=["a", "b", "d"])

    return asked.mapInArrow(work, "a bigint, b bigint, d double").distinct()


def communities(links: DataFrame, levels: int = 4, moves: int = 4) -> DataFrame:
    """``node, community`` of every end of ``links`` (a, b, w): label moves by gain in modularity, then contraction.

    A move in an even pass may only go to a lower label, in an odd one to a higher, so neighbours can't swap for ever;
    equal gains go to the lowest label. A community's label is one of its nodes.
    """
    # a contracted node's inner weight is a loop, with both of its directions
    edges = Table(links.select("a", "b", "w").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "w"))).df
    total = edges.agg(F.sum("w")).first()[0]
    member = None
    if not total:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("community"))
    for _ in range(levels):
        degree = Table(edges.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("k"), F.bool_or(F.col("a") != F.col("b")).alias("linked")), F.col("linked"))
        outer = edges.where("a <> b")
        # nodes without a link to another one never move
        label = degree.df.where("linked").select("node", F.col("node").alias("c"), "k")
        changed = 0
        for turn in range(moves):
            whole = label.groupBy("c").agg(F.sum("k").alias("tot"))
            own = label.join(whole, "c").select("node", "c", "k", "tot")
            at = own.select(F.col("node").alias("b"), F.col("c").alias("to"), F.col("tot").alias("to_tot"))
            pull = outer.join(at, "b").groupBy(F.col("a").alias("node"), "to", "to_tot").agg(F.sum("w").alias("w"))
            here = F.col("to") == F.col("c")
            gain = F.col("w") - F.col("k") * (F.col("to_tot") - F.when(here, F.col("k")).otherwise(0.0)) / F.lit(float(total))
            fair = here | ((F.col("to") < F.col("c")) if turn % 2 == 0 else (F.col("to") > F.col("c")))
            # one row per node: the gain of staying (nothing pulls: minus its own expectation) and the best fair move
            stay = F.coalesce(F.max(F.when(here, gain)), F.max(-F.col("k") * (F.col("tot") - F.col("k")) / F.lit(float(total))))
            best = F.max(F.when(fair, gain))
            choice = pull.join(own, "node").groupBy("node", "c", "k").agg(stay.alias("stay"), best.alias("best"), F.max_by(F.col("to"), F.when(fair, F.struct(gain.alias("g"), (-F.col("to")).alias("t")))).alias("to"))
            better = F.coalesce(F.col("best") > F.col("stay") + 1e-12, F.lit(False))
            step = Table(choice.select("node", F.when(better, F.col("to")).otherwise(F.col("c")).alias("c"), "k", better.alias("moved")), F.col("moved"))
            changed += step.counted
            label = step.df.select("node", "c", "k")
            if step.counted <= 0.005 * degree.counted and turn % 2:
                break
        to = degree.df.select("node").join(label.select("node", "c"), "node", "left").select("node", F.coalesce("c", "node").alias("c"))
        to = Table(to).df
        member = to.withColumnRenamed("c", "community") if member is None else Table(member.join(to.withColumnRenamed("node", "community"), "community").select("node", F.col("c").alias("community"))).df
        if not changed:
            break
        edges = Table(edges.join(to.select(F.col("node").alias("a"), F.col("c").alias("ca")), "a").join(to.select(F.col("node").alias("b"), F.col("c").alias("cb")), "b").groupBy(F.col("ca").alias("a"), F.col("cb").alias("b")).agg(F.sum("w").alias("w"))).df
    return member


def valid_records(records: DataFrame, dims: list[str]) -> DataFrame:
    """``id, *dims``, one row per id, without nulls."""
    for c in dims:
        records = records.where(F.col(c).isNotNull() & ~F.isnan(c))
    return Table(records.select("id", *[F.col(c).cast("double").alias(c) for c in dims]).where("id is not null").dropDuplicates(["id"])).df


class Clusters:
    """Nodes, links and communities of records ``id, *dims`` (numbers, scaled so that 1 is the same step in each)."""

    def __init__(self, records: DataFrame, dims: list[str], reach: float):
        self.dims, self.reach = dims, reach
        self.records = valid_records(records, dims)
        nodes = self.records.groupBy(*dims).agg(F.min("id").alias("node"), F.count("*").alias("weight"))
        self.nodes = Table(nodes).df
        self.links = Table(neighbour_graph(self.nodes, dims, reach).withColumn("w", 1 - F.col("d") / reach)).df
        found = communities(self.links)
        alone = self.nodes.select("node").join(found.select("node"), "node", "left_anti").select("node", F.col("node").alias("community"))
        self.member = Table(found.unionByName(alone)).df

    def of_records(self) -> DataFrame:
        """``id, kind``: the community of each record, named by its smallest id."""
        named = self.member.groupBy("community").agg(F.min("node").alias("kind"))
        return self.with_nodes(self.nodes.join(self.member, "node").join(named, "community"), "kind")

    def with_nodes(self, nodes: DataFrame, name: str) -> DataFrame:
        """``id`` of each record and column ``name`` of its node in ``nodes``."""
        known = nodes.select(name, *[F.col(c).alias(f"_{c}") for c in self.dims])
        same = F.lit(True)
        for c in self.dims:
            same &= F.col(c) == F.col(f"_{c}")
        return self.records.join(known, same).select("id", name)

    def described(self, top: int = 3) -> DataFrame:
        """``kind, size, typical``: records of a community and its nodes of highest weighted degree within it."""
        named = self.member.groupBy("community").agg(F.min("node").alias("kind"))
        m = Table(self.member.join(named, "community").select("node", "kind")).df
        inner = self.links.join(m.withColumnsRenamed({"node": "a", "kind": "ka"}), "a").join(m.withColumnsRenamed({"node": "b", "kind": "kb"}), "b").where("ka = kb")
        degree = inner.select(F.col("a").alias("node"), "w").unionByName(inner.select(F.col("b").alias("node"), "w")).groupBy("node").agg(F.sum("w").alias("deg"))
        # equal records stand at distance 0 of each other: each adds a full weight
        ranked = self.nodes.join(m, "node").join(degree, "node", "left").select("kind", "node", "weight", (F.coalesce("deg", F.lit(0.0)) + F.col("weight") - 1).alias("deg"))
        ranked = ranked.withColumn("r", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("deg"), "node")))
        typical = F.array_sort(F.collect_list(F.when(F.col("r") <= top, F.struct("r", "node"))))
        return ranked.groupBy("kind").agg(F.sum("weight").alias("size"), F.transform(typical, lambda s: s["node"]).alias("typical"))


def cells_in_windows(n: np.ndarray, lo: np.ndarray, hi: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum of ``n``, least ``lo`` and greatest ``hi`` over all windows of ``wide`` cells a side; ``lo`` and ``hi`` have one array per measure in front."""
    for axis in range(n.ndim):
        n = sliding_window_view(n, wide, axis).sum(axis=-1)
        lo = sliding_window_view(lo, wide, axis + 1).min(axis=-1)
        hi = sliding_window_view(hi, wide, axis + 1).max(axis=-1)
    return n, lo, hi


def candidate_boxes(boxes: DataFrame, dims: list[str], least: int, inner: float, outer: float) -> DataFrame:
    """``lo_*, hi_*``: the tight boxes of all sets of communities, of at least ``least`` records, that may be a group.

    ``boxes``: a row per community with one of its records (``dims``), its ends (``lo_*, hi_*``) and its size ``n``. No
    group is missed: a link is shorter than ``outer - inner``, so a community lies wholly in a group or wholly out of it.
    Space is cut into cells of a side just under ``outer / 4``. For any centre, records in the window of 3 cells on
    every side of its cell are nearer than ``outer``, so the communities with a record there are the group if there is
    one; hence at most one set per cell. A window lies in two blocks of 7 cells per measure; sums over such blocks leave
    at most 2^d / share of them, each of at most 14^d cells, however many the records are.
    """
    d, side, wide = len(dims), outer / (WINDOW + 1) * 0.995, 2 * WINDOW + 1
    # a community wider than a group can be is in none
    for c in dims:
        boxes = boxes.where(F.col(f"hi_{c}") - F.col(f"lo_{c}") <= 2 * (inner + SLACK))
    cell = [F.floor(F.col(c) / side).alias(f"k_{c}") for c in dims]
    ends = [f(f"{w}_{c}").alias(f"{w}_{c}") for c in dims for f, w in ((F.min, "lo"), (F.max, "hi"))]
    fine = boxes.groupBy(*cell).agg(F.sum("n").alias("n"), *ends)
    fine = Table(fine.select("*", *[F.floor(F.col(f"k_{c}") / wide).alias(f"b_{c}") for c in dims])).df
    blocks, starts = [f"b_{c}" for c in dims], [f"s_{c}" for c in dims]
    shifts = F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for v, c in zip(at, starts)]) for at in itertools.product((0, 1), repeat=d)])).alias("at")
    pairs = Table(fine.groupBy(*blocks).agg(F.sum("n").alias("n")).select(*blocks, "n", shifts).select(*blocks, "n", *[(F.col(b) - F.col(f"at.{s}")).alias(s) for b, s in zip(blocks, starts)])).df
    heavy = pairs.groupBy(*starts).agg(F.sum("n").alias("whole")).where(F.col("whole") >= least).select(*starts)
    held = fine.join(bounded(Table(pairs.join(bounded(Table(heavy).df), starts).select(*blocks, *starts)).df), blocks)
    slack = SLACK

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf[starts].iloc[0].to_numpy(dtype=np.int64) * wide
        at = tuple((pdf[[f"k_{c}" for c in dims]].to_numpy(dtype=np.int64) - first).T)
        n, lo, hi = np.zeros((2 * wide,) * d, dtype=np.int64), np.full((d, *(2 * wide,) * d), np.inf), np.full((d, *(2 * wide,) * d), -np.inf)
        n[at] = pdf["n"]
        for j, c in enumerate(dims):
            lo[j][at], hi[j][at] = pdf[f"lo_{c}"], pdf[f"hi_{c}"]
        n, lo, hi = cells_in_windows(n, lo, hi, wide)
        fits = n >= least
        for j in range(d):
            centre = ((first[j] + WINDOW + np.arange(n.shape[j])) * side).reshape([-1 if i == j else 1 for i in range(d)])
            # a set without records has infinite ends, which fit nothing
            fits &= (hi[j] - lo[j] <= 2 * (inner + slack)) & (hi[j] - inner - slack <= centre + side + slack) & (lo[j] + inner + slack >= centre - slack)
        out = np.concatenate([lo[:, fits].T, hi[:, fits].T], axis=1)
        return pd.DataFrame(np.unique(out, axis=0), columns=[f"lo_{c}" for c in dims] + [f"hi_{c}" for c in dims])

    return held.groupBy(*starts).applyInPandas(work, ", ".join(f"{w}_{c} double" for w in ("lo", "hi") for c in dims)).distinct()


def foremost(lo: np.ndarray, hi: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of boxes ``lo`` to ``hi``, cut to ``low`` to ``high``, those that lie in no other."""
    order = np.argsort(-(np.minimum(hi, high + 1) - np.maximum(lo, low - 1)).sum(axis=1), kind="stable")
    lo, hi, keep_lo, keep_hi = lo[order], hi[order], [], []
    while len(lo):
        keep_lo.append(lo[0])
        keep_hi.append(hi[0])
        rest = ~((lo >= lo[0]) & (hi <= hi[0])).all(axis=1)
        lo, hi = lo[rest], hi[rest]
    return np.array(keep_lo).reshape(-1, len(low)), np.array(keep_hi).reshape(-1, len(low))


def has_free_point(low: np.ndarray, high: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> bool:
    """Whether the closed box ``low`` to ``high`` has a point in none of the open boxes ``lo`` to ``hi``. Exact.

    A box over the middle is avoided on one of its sides only, and what is left there is less than half as wide.
    """
    left = [(low, high)]
    while left:
        a, b = left.pop()
        if ((lo < a) & (hi > b)).all(axis=1).any():
            continue
        middle = (a + b) / 2
        over = np.flatnonzero(((lo < middle) & (hi > middle)).all(axis=1))
        if not len(over):
            return True
        sides = (lo[over] >= a).sum(axis=1) + (hi[over] <= b).sum(axis=1)
        k = over[np.argmin(sides)]
        for j in range(len(a)):
            if lo[k, j] >= a[j]:
                left.append((a, np.where(np.arange(len(a)) == j, lo[k, j], b)))
            if hi[k, j] <= b[j]:
                left.append((np.where(np.arange(len(a)) == j, hi[k, j], a), b))
    return False


def isolated_groups(found: Clusters, total: int, inner: float = 0.5, outer: float = 0.9, share: float = 0.01) -> DataFrame:
    """``id, group_id``: groups of at least three records and ``share`` of ``total`` within ``inner`` of a centre that every other record is ``outer`` from.

    Groups are sets of whole communities of ``found``, whose ``reach`` may be ``outer - inner`` at most: no link crosses
    a group's rim, so no community does, however many links the approximate graph misses; a group of scattered records
    is a set of many small ones. All sets that may be groups are checked over all records: a set's centres fill a box,
    every other record blocks an open box of them, and a group is a set with a centre left. A set that holds a smaller
    group besides other records is none of its own.
    """
    if found.reach > outer - inner + SLACK:
        raise ValueError("links must be shorter than the gap around a group")
    dims, nodes = found.dims, found.nodes
    least = max(3, math.ceil(share * total - SLACK))
    placed = nodes.join(found.member, "node")
    ends = [f"{w}_{c}" for w in ("lo", "hi") for c in dims]
    spans = [F.min(c).alias(f"lo_{c}") for c in dims] + [F.max(c).alias(f"hi_{c}") for c in dims]
    boxes = Table(placed.groupBy("community").agg(F.sum("weight").alias("n"), F.min("node").alias("first"), *[F.min_by(c, "node").alias(c) for c in dims], *spans)).df
    empty = found.records.select("id", F.col("id").alias("group_id")).limit(0)
    # at most one row per cell of a bounded number of windows
    sets = candidate_boxes(boxes, dims, least, inner, outer).collect()
    if not sets:
        return empty
    lo, hi = (np.array([[r[f"{w}_{c}"] for c in dims] for r in sets]) for w in ("lo", "hi"))
    low, high, reach = hi - inner - SLACK, lo + inner + SLACK, outer - SLACK

    def blocked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for pdf in batches:
            x = pdf[dims].to_numpy()
            x = x[np.argsort(x[:, 0])]
            for g in range(len(low)):
                y = x[np.searchsorted(x[:, 0], low[g, 0] - reach, "right") : np.searchsorted(x[:, 0], high[g, 0] + reach, "left")]
                near = ((y > low[g] - reach) & (y < high[g] + reach)).all(axis=1) & ~((y >= lo[g]) & (y <= hi[g])).all(axis=1)
                if near.any():
                    y = y[near]
                    p = np.where(y - reach < low[g], -np.inf, y - reach), np.where(y + reach > high[g], np.inf, y + reach)
                    if g in held:
                        p = tuple(np.concatenate([q, r]) for q, r in zip(held[g], p))
                    held[g] = foremost(*p, low[g], high[g])
        for g, p in held.items():
            yield pd.DataFrame(np.concatenate(p, axis=1), columns=ends).assign(g=g)

    def settled(pdf: pd.DataFrame) -> pd.DataFrame:
        g, p = int(pdf["g"].iloc[0]), pdf[ends].to_numpy()
        return pd.DataFrame({"g": [g], "free": [has_free_point(low[g], high[g], *foremost(p[:, : len(dims)], p[:, len(dims) :], low[g], high[g]))]})

    blocks = nodes.select(*dims).mapInPandas(blocked, ", ".join(f"{e} double" for e in ends) + ", g int")
    lost = {r["g"] for r in blocks.groupBy("g").applyInPandas(settled, "g int, free boolean").where("not free").collect()}
    valid = [g for g in range(len(lo)) if g not in lost]
    within = lambda g, h: g != h and (lo[g] >= lo[h]).all() and (hi[g] <= hi[h]).all()
    valid = [h for h in valid if not any(within(g, h) for g in valid)]
    if not valid:
        return empty

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for g in valid:
                mine = ((pdf[ends[: len(dims)]].to_numpy() >= lo[g]) & (pdf[ends[len(dims) :]].to_numpy() <= hi[g])).all(axis=1)
                yield pdf.loc[mine, ["community", "first"]].assign(g=g)

    kinds = Table(boxes.select("community", "first", *ends).mapInPandas(parts, "community bigint, first bigint, g int")).df
    named = kinds.join(kinds.groupBy("g").agg(F.min("first").alias("group_id")), "g").select("community", "group_id")
    return found.with_nodes(placed.join(named, "community"), "group_id").distinct()


def patch_records(patches: DataFrame) -> DataFrame:
    """Patches with cells as ``id`` and four scaled measures; those with a null measure are out."""
    p = patches.where("n_cells > 0 and shannon is not null and simpson is not null and richness is not null")
    return p.select(F.col("patch_id").alias("id"), (F.col("shannon") / 0.3).alias("x0"), (F.col("simpson") / 0.15).alias("x1"), F.col("richness").cast("double").alias("x2"), (F.log(F.col("n_cells").cast("double")) / 0.4).alias("x3"))


DIMS = ["x0", "x1", "x2", "x3"]
#: Members of a group and others are further apart than this (0.9 - 0.5).
REACH = 0.4


def patch_clusters(patches: DataFrame) -> Clusters:
    return Clusters(patch_records(patches), DIMS, REACH)


def patch_groups(patches: DataFrame) -> DataFrame:
    """``patch_id, group_id`` of the isolated groups of patches."""
    total = patches.where("patch_id is not null").select("patch_id").distinct().count()
    return isolated_groups(patch_clusters(patches), total).withColumnRenamed("id", "patch_id")
