"""Convex hulls and their intersections, in numpy, for one group of few points at a time."""

from __future__ import annotations

import numpy as np


def hull(points: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, counter-clockwise from the lowest x; fewer than three if the points lie on a line."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p
    def half(seq):
        out: list = []
        for q in seq:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(q)
        return out

    lower, upper = half(p.tolist()), half(p[::-1].tolist())
    return np.array(lower[:-1] + upper[:-1])


def area(ring: np.ndarray) -> float:
    if len(ring) < 3:
        return 0.0
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(abs(np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))) / 2)


def perimeter(ring: np.ndarray) -> float:
    return float(np.hypot(*(ring - np.roll(ring, -1, axis=0)).T).sum())


def clip(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The part of convex ``a`` inside convex, counter-clockwise ``b``; touching leaves points or a segment."""
    out = a.astype(float)
    for p, q in zip(b, np.roll(b, -1, axis=0)):
        if not len(out):
            break
        side = (q[0] - p[0]) * (out[:, 1] - p[1]) - (q[1] - p[1]) * (out[:, 0] - p[0])
        new = []
        for k in range(len(out)):
            s, t = side[k - 1], side[k]
            if (s < 0) != (t < 0) and s != t and s != 0 and t != 0:
                new.append(out[k - 1] + (out[k] - out[k - 1]) * (s / (s - t)))
            if t >= 0:
                new.append(out[k])
        out = np.array(new) if new else np.empty((0, 2))
    return out


def union_area(polygons: list[np.ndarray]) -> float:
    """Area covered by convex polygons that may overlap, slab by slab between all corners and crossings."""
    parts = [p for p in polygons if len(p) >= 3]
    if len(parts) < 2:
        return sum(map(area, parts))
    seg = np.concatenate([np.hstack([p, np.roll(p, -1, axis=0)]) for p in parts])
    who = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    xs = [seg[:, 0]]
    dx, dy = seg[:, 2] - seg[:, 0], seg[:, 3] - seg[:, 1]
    for k in range(len(seg)):
        den = dx[k] * dy - dy[k] * dx
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((seg[:, 0] - seg[k, 0]) * dy - (seg[:, 1] - seg[k, 1]) * dx) / den
        xs.append(seg[k, 0] + t[(den != 0) & (t >= 0) & (t <= 1)] * dx[k])
    xs = np.unique(np.concatenate(xs))
    total = 0.0
    for x1, x2 in zip(xs[:-1], xs[1:]):
        xm = (x1 + x2) / 2
        cross = (np.minimum(seg[:, 0], seg[:, 2]) < xm) & (np.maximum(seg[:, 0], seg[:, 2]) > xm)
        y = seg[cross, 1] + (xm - seg[cross, 0]) * dy[cross] / dx[cross]
        w, spans = who[cross], []
        for g in np.unique(w):
            spans.append((y[w == g].min(), y[w == g].max()))
        reach, height = -np.inf, 0.0
        for lo, hi in sorted(spans):
            height += max(0.0, hi - max(lo, reach))
            reach = max(reach, hi)
        total += height * (x2 - x1)
    return total


def solidity(rings: list[np.ndarray | None]) -> np.ndarray:
    """Area of each ring (x0, y0, x1, y1 ...) as a share of its convex hull's; NaN without area.

    Rings of like length are wrapped together: from the lowest corner on, every step takes for each ring the point that
    has all others on its left.
    """
    out = np.full(len(rings), np.nan)
    size = np.array([0 if r is None else len(r) // 2 for r in rings])
    for n in np.unique(size[size >= 3]):
        own = np.flatnonzero(size == n)
        p = np.stack([np.asarray(rings[k], dtype=float).reshape(-1, 2) for k in own])
        p = p - p[:, :1]
        x, y = p[..., 0], p[..., 1]
        area_ = np.abs((x * np.roll(y, -1, axis=1) - np.roll(x, -1, axis=1) * y).sum(axis=1)) / 2
        rows, start = np.arange(len(own)), np.lexsort((y.ravel(), x.ravel(), np.repeat(np.arange(len(own)), n))).reshape(-1, n)[:, 0] % n
        at, twice, live = start.copy(), np.zeros(len(own)), np.ones(len(own), dtype=bool)
        for _ in range(n):
            dx, dy = x - x[rows, at][:, None], y - y[rows, at][:, None]
            best = np.zeros(len(own), dtype=np.int64)
            for k in range(1, n):
                bx, by = dx[rows, best], dy[rows, best]
                cross = bx * dy[:, k] - by * dx[:, k]
                far = dx[:, k] ** 2 + dy[:, k] ** 2 > bx**2 + by**2
                best = np.where((cross < 0) | ((cross == 0) & far), k, best)
            twice += np.where(live, x[rows, at] * y[rows, best] - x[rows, best] * y[rows, at], 0.0)
            at = np.where(live, best, at)
            # coincident points end a ring's walk as its first corner does
            live &= (x[rows, at] != x[rows, start]) | (y[rows, at] != y[rows, start])
            if not live.any():
                break
        hull_area = np.abs(twice) / 2
        with np.errstate(invalid="ignore", divide="ignore"):
            out[own] = np.where((area_ > 0) & (hull_area > 0), np.minimum(area_ / hull_area, 1.0), np.where(hull_area > 0, 0.0, np.nan))
    return out
