"""A balanced k-d tree over an array of points, built and queried level by level in numpy."""

from __future__ import annotations

import numpy as np


class KDTree:
    """Level ``l`` cuts the ordered points into ``2**l`` equal runs, each split at the median of its widest axis."""

    def __init__(self, points: np.ndarray, leaf: int = 12):
        self.n = len(points)
        self.depth = 0
        while self.n >> self.depth > leaf:
            self.depth += 1
        self.order = np.arange(self.n)
        self.starts, self.low, self.high = [], [], []
        for level in range(self.depth + 1):
            starts = np.arange(2**level) * self.n >> level
            p = points[self.order]
            low, high = np.minimum.reduceat(p, starts), np.maximum.reduceat(p, starts)
            self.starts.append(np.append(starts, self.n))
            self.low.append(low)
            self.high.append(high)
            if level < self.depth:
                node = np.repeat(np.arange(2**level), np.diff(self.starts[-1]))
                axis = np.argmax(high - low, axis=1)[node]
                self.order = self.order[np.lexsort((p[np.arange(self.n), axis], node))]
        self.points = points[self.order]

    def within(self, queries: np.ndarray, radius: float | np.ndarray, block: int = 4096):
        """Pairs (index of a query, index of a point) at most ``radius`` (one, or one a query) apart, block by block."""
        radii = np.broadcast_to(np.asarray(radius, dtype=float) ** 2, len(queries))
        for begin in range(0, len(queries), block):
            part, r2 = queries[begin : begin + block], radii[begin : begin + block]
            q, node = np.arange(len(part)), np.zeros(len(part), dtype=np.int64)
            for level in range(self.depth + 1):
                if level:
                    q, node = np.repeat(q, 2), (np.repeat(node * 2, 2).reshape(-1, 2) + np.array([0, 1])).ravel()
                gap = np.maximum(self.low[level][node] - part[q], 0) + np.maximum(part[q] - self.high[level][node], 0)
                near = (gap * gap).sum(axis=1) <= r2[q]
                q, node = q[near], node[near]
            first, size = self.starts[-1][node], self.starts[-1][node + 1] - self.starts[-1][node]
            q = np.repeat(q, size)
            at = np.arange(len(q)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
            d = self.points[at] - part[q]
            near = (d * d).sum(axis=1) <= r2[q]
            yield q[near] + begin, self.order[at[near]]

    def nearest(self, queries: np.ndarray, k: int = 1, own: np.ndarray | None = None, names: np.ndarray | None = None) -> np.ndarray:
        """Squared distances from each query to its ``k`` nearest points, other than those named as the query is; inf without."""
        best = np.full((len(queries), k), np.inf)
        if not self.n or not len(queries):
            return best
        # go down to a node that still holds enough points for a bound
        floor = self.depth
        while floor and self.n >> floor < 2 * k + 2:
            floor -= 1
        node = np.zeros(len(queries), dtype=np.int64)
        for level in range(1, floor + 1):
            gaps = []
            for child in (node * 2, node * 2 + 1):
                gap = np.maximum(self.low[level][child] - queries, 0) + np.maximum(queries - self.high[level][child], 0)
                gaps.append((gap * gap).sum(axis=1))
            node = node * 2 + (gaps[1] < gaps[0])
        place = np.empty(self.n, dtype=np.int64)
        place[self.order] = np.arange(self.n)

        def take(q: np.ndarray, at: np.ndarray) -> None:
            d = ((self.points[at] - queries[q]) ** 2).sum(axis=1)
            if own is not None:
                d = np.where(names[self.order[at]] == own[q], np.inf, d)
            if k == 1:
                np.minimum.at(best[:, 0], q, d)
                return
            order = np.lexsort((d, q))
            q, d = q[order], d[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            keep = rank < k
            best[q[keep], rank[keep]] = d[keep]

        first, size = self.starts[floor][node], self.starts[floor][node + 1] - self.starts[floor][node]
        q = np.repeat(np.arange(len(queries)), size)
        take(q, np.arange(len(q)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size))
        span = np.sqrt(((self.high[0] - self.low[0]) ** 2).sum()) + np.sqrt((np.maximum(np.abs(queries - self.low[0]), np.abs(queries - self.high[0])) ** 2).sum(axis=1))
        bound = best[:, -1]
        # all that lies within the bound holds the k nearest, which are taken anew
        for q, p in self.within(queries, np.where(np.isfinite(bound), np.sqrt(np.where(np.isfinite(bound), bound, 0)) * (1 + 1e-12), span), block=2048):
            best[np.unique(q)] = np.inf
            take(q, place[p])
        return best


def unit_vectors(x: np.ndarray, y: np.ndarray, sphere: float) -> np.ndarray:
    """Points of longitude ``x`` and latitude ``y``, given as lengths on a sphere of radius ``sphere``."""
    lon, lat = x / sphere, y / sphere
    return np.column_stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])


def chord(distance: float, sphere: float) -> float:
    return 2 * np.sin(distance / (2 * sphere))


def strictly_inside(x: np.ndarray, y: np.ndarray, by_y: np.ndarray, *rings: np.ndarray) -> np.ndarray:
    """Indices of the points strictly inside a region of one or more rings, by a sweep of their edges over the points in order of ``y``.

    ``by_y`` orders the points by ``y``. Each edge meets one run of them; it flips the parity of those on its left and
    marks those that lie on it, so a ring within a ring is a hole. Whole coordinates below 2**26 make the test exact.
    """
    ys = y[by_y]
    low, high = np.searchsorted(ys, min(r[:, 1].min() for r in rings), "left"), np.searchsorted(ys, max(r[:, 1].max() for r in rings), "right")
    px, py = x[by_y[low:high]], ys[low:high]
    odd, rim = np.zeros(high - low, dtype=bool), np.zeros(high - low, dtype=bool)
    for start, end in ((p, q) for r in rings for p, q in zip(r, np.roll(r, -1, axis=0))):
        (x1, y1), (x2, y2) = (start, end) if start[1] <= end[1] else (end, start)
        a, b = np.searchsorted(py, y1, "left"), np.searchsorted(py, y2, "right")
        if a == b:
            continue
        side = (x2 - x1) * (py[a:b] - y1) - (px[a:b] - x1) * (y2 - y1)
        rim[a:b] |= (side == 0) & (px[a:b] >= min(x1, x2)) & (px[a:b] <= max(x1, x2))
        odd[a:b] ^= (side > 0) & (py[a:b] < y2)
    return by_y[low:high][odd & ~rim]
