"""Delaunay edges of very many points on a whole-number grid, per slide, up to a longest length.

A pair (i, j) is an edge iff some circle through both holds no other point. A third point k sees the pair under an
angle whose cotangent is ``dot / |cross|``; the circles that spare all points on the left and all on the right exist
iff ``min(cot left) + min(cot right) >= 0``. On the grid dot and cross are whole numbers, so equal cotangents are
equal as doubles and ties (four or more points on one circle) are seen exactly: of the chords of such a circle the
ones at its lowest id stay, a fan. A point strictly between i and j forbids the edge.

Points near i are enough to reject a pair for good, and to accept it once a sparing circle fits into the radius that
was looked at, so k-d nodes with halo copies settle nearly all pairs. What is left lies at the rim of the tissue or of
a void. There the points near i fix the smallest circle that may spare all, and the pair is an edge iff no point lies
in it: it goes to the nodes that this circle meets, at first with a part of the circle of bounded size, and each node
looks into the circle by its k-d tree. The circles of true edges are empty, so that costs little however large they
are, and no pair is ever held against all points of its slide.

Coincident points: the lowest id stands for all, the others have no edges. Slides whose points all lie on one line
have none. Null coordinates or ids are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lamella.functions.kdtree import KDTree
from lamella.operators.near import kd_splits, to_nodes
from lamella.session import Table

TARGET = 20_000
#: Radius in grid steps (0.1 um) around i that is looked at first; then radii of the circles, the last one without a bound.
RADIUS, CIRCLES = 600, (4000, 40_000, None)
NEAREST = 10

_PAIR = ["i", "j", "ix", "iy", "jx", "jy"]
_STATE = "slide string, node int, i bigint, j bigint, ix bigint, iy bigint, jx bigint, jy bigint, d2 bigint, left double, left_id bigint, right double, right_id bigint, between boolean"
NO_ID = np.iinfo(np.int64).max


class _Pairs:
    """Pairs with their running minima over third points."""

    def __init__(self, i, j, ix, iy, jx, jy):
        n = len(i)
        self.i, self.j, self.ix, self.iy, self.jx, self.jy = i, j, ix, iy, jx, jy
        self.left, self.right = np.full(n, np.inf), np.full(n, np.inf)
        self.left_id, self.right_id = np.full(n, NO_ID), np.full(n, NO_ID)
        self.between = np.zeros(n, dtype=bool)

    def take(self, keep) -> _Pairs:
        out = object.__new__(_Pairs)
        out.__dict__ = {k: v[keep] for k, v in self.__dict__.items()}
        return out

    def see(self, pair: np.ndarray, k: np.ndarray, kx: np.ndarray, ky: np.ndarray) -> None:
        """Take in third points ``k``, given for each the index of its pair (in ascending order)."""
        ax, ay, bx, by = self.ix[pair] - kx, self.iy[pair] - ky, self.jx[pair] - kx, self.jy[pair] - ky
        cross, dot = ax * by - ay * bx, ax * bx + ay * by
        own = (k == self.i[pair]) | (k == self.j[pair])
        self.between[pair[(cross == 0) & (dot < 0) & ~own]] = True
        for side, value, ids in ((cross > 0, self.left, self.left_id), (cross < 0, self.right, self.right_id)):
            p, cot, who = pair[side], dot[side] / np.abs(cross[side]), k[side]
            if not len(p):
                continue
            starts = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
            low, at = np.minimum.reduceat(cot, starts), p[starts]
            width = np.diff(np.r_[starts, len(p)])
            tied = np.where(cot == np.repeat(low, width), who, NO_ID)
            first = np.minimum.reduceat(tied, starts)
            same, less = low == value[at], low < value[at]
            ids[at[same]] = np.minimum(ids[at[same]], first[same])
            value[at[less]], ids[at[less]] = low[less], first[less]

    def alive(self) -> np.ndarray:
        return ~self.between & (self.left + self.right >= 0)

    def frame(self, slide, node) -> pd.DataFrame:
        d2 = (self.ix - self.jx) ** 2 + (self.iy - self.jy) ** 2
        return pd.DataFrame({"slide": slide, "node": np.int32(node), "i": self.i, "j": self.j, "ix": self.ix, "iy": self.iy, "jx": self.jx, "jy": self.jy, "d2": d2, "left": self.left, "left_id": self.left_id, "right": self.right, "right_id": self.right_id, "between": self.between})


def _spread(owner: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each owner the places ``first .. first + size`` of a list: (owner's index repeated, place)."""
    times = size[owner]
    ends = np.cumsum(times)
    return np.repeat(np.arange(len(owner)), times), np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - times, times) + np.repeat(first[owner], times)


def _first_look(longest: int, radius: int):
    def work(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, x, y = (pdf[c].to_numpy() for c in ("id", "qx", "qy"))
        home = np.flatnonzero(pdf["home"].to_numpy())
        none = np.empty(0, dtype=np.int64)
        out = [_Pairs(*[none] * 6).frame(*key)]
        if not len(home):
            # copies from other nodes only: no pair begins here
            return out[0]
        xy = np.column_stack([x, y]).astype(float)
        tree = KDTree(xy, leaf=24)
        for block in np.array_split(home, max(1, len(home) // 400)):
            q, k = map(np.concatenate, zip(*tree.within(xy[block], radius)))
            d2 = (x[block[q]] - x[k]) ** 2 + (y[block[q]] - y[k]) ** 2
            order = np.lexsort((d2, q))
            q, k, d2 = q[order], k[order], d2[order]
            first = np.searchsorted(q, np.arange(len(block)))
            size = np.diff(np.r_[first, len(q)])
            i = block[q]
            cand = np.flatnonzero((d2 <= longest * longest) & (ids[i] < ids[k]))
            p = _Pairs(ids[i[cand]], ids[k[cand]], x[i[cand]], y[i[cand]], x[k[cand]], y[k[cand]])
            owner = q[cand]
            # the nearest few reject most pairs, all within the radius the rest
            for most in (NEAREST, None):
                pair, place = _spread(owner, first, size if most is None else np.minimum(size, most + 1))
                p.see(pair, ids[k[place]], x[k[place]], y[k[place]])
                keep = p.alive()
                p, owner = p.take(keep), owner[keep]
            if len(p.i):
                out.append(p.frame(*key))
        return pd.concat(out[1:], ignore_index=True) if len(out) > 1 else out[0]

    return work


def _look_into_circles(key: tuple, pairs: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
    """For pairs and points of one node: minima over the points in each pair's circle."""
    p = _Pairs(*(pairs[c].to_numpy() for c in _PAIR))
    if len(pairs) and len(points):
        ids, x, y = (points[c].to_numpy() for c in ("id", "qx", "qy"))
        tree = KDTree(np.column_stack([x, y]).astype(float), leaf=24)
        # a step more than the circle, so that points on its line are seen however far its centre is
        for q, k in tree.within(pairs[["cx", "cy"]].to_numpy(), pairs["r"].to_numpy() + 1.0, block=64):
            order = np.argsort(q, kind="stable")
            p.see(q[order], ids[k[order]], x[k[order]], y[k[order]])
    return p.frame(*key)


def _bend() -> Column:
    """The smallest circle through i and j that may spare all points has its centre so many halves of their distance to the left of their middle."""
    return F.greatest(F.lit(0.0) - F.col("right"), F.least(F.lit(0.0), F.col("left")))


def _seen() -> Column:
    return F.least("left", "right") < float("inf")


def _within(diameter: int | None) -> Column:
    """Whether the smallest circle that may spare all points is at most so wide."""
    return F.lit(True) if diameter is None else F.col("d2") * (1 + _bend() * _bend()) <= float(diameter) ** 2


def _in_circles(open_: DataFrame, sites: DataFrame, splits: DataFrame, radius: int | None) -> DataFrame:
    """The state of open pairs with the minima over their circles, or over those of ``radius`` in them, taken in.

    Narrower circles through i and j lie within wider ones on the side that matters; on the other side all points that
    count are nearer to i than ``RADIUS`` and known.
    """
    most = F.lit(float("inf")) if radius is None else F.sqrt(F.greatest(F.lit(4.0 * radius * radius) / F.col("d2") - 1, F.lit(0.0)))
    bend = F.signum(_bend()) * F.least(F.abs(_bend()), most)
    at = open_.withColumn("bend", bend).withColumns({
        "cx": (F.col("ix") + F.col("jx")) / 2 - F.col("bend") * (F.col("jy") - F.col("iy")) / 2, "cy": (F.col("iy") + F.col("jy")) / 2 + F.col("bend") * (F.col("jx") - F.col("ix")) / 2,
        "r": F.sqrt(F.col("d2") * (1 + F.col("bend") * F.col("bend"))) / 2,
    })
    far = F.ceil(F.col("r")) + 1
    asked = to_nodes(at.select("slide", *_PAIR, "cx", "cy", "r"), splits, F.floor("cx") - far, F.ceil("cx") + far, F.floor("cy") - far, F.ceil("cy") + far)
    points = to_nodes(sites, splits, F.col("qx"), F.col("qx"), F.col("qy"), F.col("qy")).join(asked.select("slide", "node").distinct(), ["slide", "node"], "left_semi")
    found = asked.groupBy("slide", "node").cogroup(points.groupBy("slide", "node")).applyInPandas(_look_into_circles, _STATE)
    low = open_.drop("sure").unionByName(found).groupBy("slide", *_PAIR, "d2").agg(
        F.min(F.struct("left", "left_id")).alias("l"), F.min(F.struct("right", "right_id")).alias("r"), F.bool_or("between").alias("between"), F.min("node").alias("node"))
    return low.select("slide", "node", *_PAIR, "d2", "l.left", "l.left_id", "r.right", "r.right_id", "between").where("not between and left + right >= 0")


def _edges(state: DataFrame) -> DataFrame:
    """Edges of pairs whose minima are final, ties settled by the fan of the lowest id."""
    tie = F.col("left") + F.col("right") == 0
    lowest = F.least("left_id", "right_id") > F.least("i", "j")
    keep = ~F.col("between") & (F.col("left") + F.col("right") >= 0) & _seen() & (~tie | lowest)
    return state.where(keep).select("slide", "node", *_PAIR, F.sqrt(F.col("d2").cast("double")).alias("steps"))


def _off_line(lone: DataFrame, sites: DataFrame) -> DataFrame:
    """Of pairs that saw no third point those in slides whose points aren't all on one line; their circle is empty."""
    some = lone.select("slide").distinct()
    here = sites.join(some, "slide", "left_semi")
    ends = here.groupBy("slide").agg(F.min(F.struct("qx", "qy")).alias("p"), F.max(F.struct("qx", "qy")).alias("q"))
    cross = (F.col("q.qx") - F.col("p.qx")) * (F.col("qy") - F.col("p.qy")) - (F.col("q.qy") - F.col("p.qy")) * (F.col("qx") - F.col("p.qx"))
    wide = here.join(ends, "slide").where(cross != 0).select("slide").distinct()
    return lone.join(wide, "slide", "left_semi").select("slide", "node", *_PAIR, F.sqrt(F.col("d2").cast("double")).alias("steps"))


class Sites:
    """Distinct places of points ``slide, id, qx, qy`` (whole numbers; ids unique within a slide) and their k-d splits."""

    def __init__(self, points: DataFrame, target: int = TARGET):
        known = points.where("slide is not null and id is not null and qx is not null and qy is not null")
        self.df = Table(known.groupBy("slide", "qx", "qy").agg(F.min("id").alias("id"))).df
        self.splits = kd_splits(self.df, target)


def delaunay(sites: Sites, longest: int = 500) -> DataFrame:
    """``slide, node, i, j, ix, iy, jx, jy, steps`` (i < j): edges of at most ``longest`` grid steps with the k-d node of i."""
    radius = max(RADIUS, longest)
    x, y = F.col("qx"), F.col("qy")
    copies = to_nodes(sites.df, sites.splits, x - radius, x + radius, y - radius, y + radius, (x, y))
    first = copies.groupBy("slide", "node").applyInPandas(_first_look(longest, radius), _STATE)
    sure = _seen() & _within(radius)
    state = Table(first.withColumn("sure", sure), ~F.col("sure"))
    out = _edges(state.df.where("sure"))
    if state.counted:
        rest = state.df.where("not sure")
        out = out.unionByName(_off_line(rest.where(~_seen()), sites.df))
        open_ = rest.where(_seen())
        for wide in CIRCLES:
            state = Table(_in_circles(open_, sites.df, sites.splits, wide).withColumn("sure", _within(None if wide is None else 2 * wide)), ~F.col("sure"))
            out = out.unionByName(_edges(state.df.where("sure")))
            if not state.counted:
                break
            open_ = state.df.where("not sure")
    return out


def delaunay_edges(points: DataFrame, longest: int = 500, target: int = TARGET) -> DataFrame:
    """``slide, i, j, steps`` (i < j): Delaunay edges of at most ``longest`` grid steps of ``slide, id, qx, qy``."""
    return Table(delaunay(Sites(points, target), longest).select("slide", "i", "j", "steps")).df
