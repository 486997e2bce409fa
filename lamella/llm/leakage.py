"""Evaluation texts leaking into training text, by greedy string tiling.

Documents and test items become word sequences (:mod:`lamella.llm.latex_words`), each word a 64-bit hash. Seeds are
rolling hashes (Karp-Rabin) of ``min_words`` consecutive words, or of a whole item that is shorter; documents and items
are joined on equal seeds. For each (document, item) that shares one, tiling marks the longest common runs of words that
don't overlap, again and again; the share of the item's words under tiles is its coverage, which doesn't depend on the
order of the passages.

Items and their seeds are tables like any other, made in Spark. Each document is cut into words once, whatever the
number of items. While the distinct seeds are few (:data:`FILTER_SEEDS`, counted) they go to the tasks, which then keep
only windows that some item has; beyond that all windows are joined with the seeds by a shuffle, with the same result.
Null, empty and blank texts hold no words and match nothing; equal rows give equal results once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.llm.latex_words import words
from lamella.session import Table

#: Distinct seeds that are sent to the tasks at most (32 MB).
FILTER_SEEDS = 4_000_000
#: Pairs of equal windows of an item and a run that tiling lists at once; beyond it goes diagonal by diagonal.
LISTED_PAIRS = 4_000_000
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(int(BASE), -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, BASE, dtype=np.uint64))
        down = np.cumprod(np.full(n, inverse, dtype=np.uint64))
    return up, down


class RollingHash:
    """Hashes of all windows of a sequence of word numbers, modulo 2**64; equal windows have equal hashes anywhere."""

    def __init__(self):
        self.up, self.down = _powers(1 << 12)

    def windows(self, numbers: np.ndarray, width: int) -> np.ndarray:
        n = len(numbers)
        if n < width:
            return np.empty(0, dtype=np.uint64)
        if n > len(self.up):
            self.up, self.down = _powers(2 * n)
        with np.errstate(over="ignore"):
            mixed = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(32)
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed * self.up[:n], dtype=np.uint64)])
            return (sums[width:] - sums[:-width]) * self.down[: n - width + 1]


def word_numbers(ws: list[str]) -> np.ndarray:
    """64-bit hashes of words, alike in every process."""
    return pd.util.hash_array(np.array(ws, dtype=object), categorize=False) if ws else np.empty(0, dtype=np.uint64)


def _diagonals(item: np.ndarray, run: np.ndarray, least: int, rolling: RollingHash) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start in the item, start in the run and length of all maximal common stretches of at least ``least`` words."""
    h, g = rolling.windows(item, least), rolling.windows(run, least)
    order = np.argsort(h, kind="stable")
    lo, hi = np.searchsorted(h[order], g, "left"), np.searchsorted(h[order], g, "right")
    many = hi - lo
    if many.sum() <= LISTED_PAIRS:
        q = np.repeat(np.arange(len(g)), many)
        p = order[np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many)]
        at = np.lexsort((p, q - p))
        p, q = p[at], q[at]
        # windows in a row on one diagonal are one stretch
        first = np.flatnonzero(np.r_[True, (np.diff(q - p) != 0) | (np.diff(p) != 1)]) if len(p) else np.empty(0, dtype=np.int64)
        return p[first], q[first], np.diff(np.r_[first, len(p)]) + least - 1
    found = []
    for d in range(least - len(item), len(run) - least + 1):
        p0 = max(0, -d)
        n = min(len(item) - p0, len(run) - p0 - d)
        edge = np.flatnonzero(np.diff(np.r_[False, item[p0 : p0 + n] == run[p0 + d : p0 + d + n], False]))
        found += [(p0 + a, p0 + a + d, b - a) for a, b in zip(edge[::2], edge[1::2]) if b - a >= least]
    return tuple(np.array(found, dtype=np.int64).reshape(-1, 3).T)


def tile(item: np.ndarray, runs: list[np.ndarray], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: (start in the item, run, length) of the longest common runs, longest first, none overlapping.

    ``least`` is the shortest length that counts. Ties go to the earliest place in the item, then in the runs. A stretch
    that a tile has cut into goes back to the heap with what is left of it.
    """
    free_item, free_run = np.ones(len(item), dtype=bool), [np.ones(len(r), dtype=bool) for r in runs]
    rolling, tiles, heap = RollingHash(), [], []
    for k, r in enumerate(runs):
        heap += [(-n, p, k, q) for p, q, n in zip(*(v.tolist() for v in _diagonals(item, r, least, rolling)))]
    heapq.heapify(heap)
    while heap:
        n, p, k, q = heapq.heappop(heap)
        free = free_item[p : p - n] & free_run[k][q : q - n]
        if free.all():
            if np.array_equal(item[p : p - n], runs[k][q : q - n]):
                free_item[p : p - n] = False
                free_run[k][q : q - n] = False
                tiles.append((p, k, -n))
            continue
        edge = np.flatnonzero(np.diff(np.r_[False, free, False]))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a >= least:
                heapq.heappush(heap, (a - b, p + a, k, q + a))
    return tiles


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(values) if values else np.empty(0, dtype=np.int64), kind))


def item_words(items: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """``item_id, ws, width, seeds`` of every distinct item with a word."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash()
        for batch in batches:
            rows = [(i, word_numbers(words(t))) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            rows = [(i, w) for i, w in rows if len(w)]
            width = [min(min_words, len(w)) for _, w in rows]
            seeds = [np.unique(rolling.windows(w, n)).view(np.int64) for (_, w), n in zip(rows, width)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), _lists([w.view(np.int64) for _, w in rows], pa.int64()), pa.array(width, pa.int32()), _lists(seeds, pa.int64())], names=["item_id", "ws", "width", "seeds"])

    known = items.select(F.col(key).cast("bigint"), F.col(text)).where(F.col(key).isNotNull() & F.col(text).isNotNull()).distinct()
    return known.mapInArrow(work, "item_id bigint, ws array<bigint>, width int, seeds array<bigint>")


def _windows(docs: DataFrame, key: str, text: str, widths: list[int], known: np.ndarray | None) -> DataFrame:
    """``doc_id, at, ws, seeds``: stretches of a document's words and the seeds in them.

    With ``known`` seeds a stretch is what windows of such seeds cover without a gap, so it holds all that can be common
    to any item; without, it is the whole document and its seeds are all its windows.
    """
    spark = docs.sparkSession
    shared = None if known is None else spark.sparkContext.broadcast(known)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling, seeds = RollingHash(), None if shared is None else shared.value
        for batch in batches:
            rows = []
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if d is None or not t:
                    continue
                ws = word_numbers(words(t))
                hashes = [(w, rolling.windows(ws, w)) for w in widths if len(ws) >= w]
                if seeds is None:
                    if hashes:
                        rows.append((d, 0, ws, np.unique(np.concatenate([h for _, h in hashes]))))
                    continue
                edge, hits = np.zeros(len(ws) + 1, dtype=np.int64), []
                for w, h in hashes:
                    # all windows that an item has begin and end a stretch
                    at = np.flatnonzero(seeds[np.minimum(np.searchsorted(seeds, h), len(seeds) - 1)] == h)
                    if len(at):
                        edge[at] += 1
                        np.add.at(edge, at + w, -1)
                        hits.append((at, h[at]))
                if not hits:
                    continue
                covered = np.flatnonzero(np.diff(np.r_[False, np.cumsum(edge[:-1]) > 0, False]))
                at, h = (np.concatenate(v) for v in zip(*hits))
                for a, b in zip(covered[::2], covered[1::2]):
                    rows.append((d, a, ws[a:b], np.unique(h[(at >= a) & (at < b)])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), *[_lists([r[i].view(np.int64) for r in rows], pa.int64()) for i in (2, 3)]], names=["doc_id", "at", "ws", "seeds"])

    return docs.select(F.col(key).cast("bigint"), F.col(text)).mapInArrow(work, "doc_id bigint, at int, ws array<bigint>, seeds array<bigint>")


def leaks(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", doc_text: str = "text", item_key: str = "item_id", item_text: str = "text", min_words: int = 12, min_coverage: float = 0.0, filter_seeds: int = FILTER_SEEDS) -> DataFrame:
    """``doc_id, item_id, n_tiles, longest, coverage`` of every document and item that share ``min_words`` consecutive
    words, or all words of a shorter item, with at least ``min_coverage`` of the item's words under tiles."""
    item = Table(item_words(items, item_key, item_text, min_words)).df
    seed = Table(item.select("item_id", F.explode("seeds").alias("seed")).distinct(), F.lit(True))
    widths = sorted(r["width"] for r in item.select("width").distinct().collect())
    # a bound on the rows, which repeated seeds only make safer
    known = None
    if seed.counted <= filter_seeds:
        known = np.sort(seed.df.select("seed").distinct().toPandas()["seed"].to_numpy(dtype=np.int64).view(np.uint64))
    if known is not None and not len(known):
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, n_tiles int, longest int, coverage double")
    found = Table(_windows(docs, doc_key, doc_text, widths, known)).df
    pairs = found.select("doc_id", F.explode("seeds").alias("seed")).join(seed.df, "seed").select("doc_id", "item_id").distinct()
    # the stretches of one document, which that document bounds; rows with one id are one document
    whole = found.groupBy("doc_id").agg(F.array_sort(F.collect_set("ws")).alias("runs"))

    def tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for d, i, ws, runs in zip(pdf["doc_id"], pdf["item_id"], pdf["ws"], pdf["runs"]):
                marked = tile(np.asarray(ws), [np.asarray(r) for r in runs], min(min_words, len(ws)))
                if marked:
                    out.append((d, i, len(marked), max(n for *_, n in marked), sum(n for *_, n in marked) / len(ws)))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "n_tiles", "longest", "coverage"])

    joined = pairs.join(item.select("item_id", "ws"), "item_id").join(whole, "doc_id").select("doc_id", "item_id", "ws", "runs")
    out = joined.mapInPandas(tiles, "doc_id bigint, item_id bigint, n_tiles int, longest int, coverage double")
    return out.where(F.col("coverage") >= min_coverage).distinct()
