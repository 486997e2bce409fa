"""Connected components of cell graphs, whose nodes are named within a slide.

Edges come with the block (k-d node) that they begin in. Each block's own components are found in one task and become
stars; only stars that share a node with another block go on to alternating large-star and small-star rounds over the
cluster, until all stars are single. A graph whose components keep to their blocks needs no round at all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.session import Table


def labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0 to n - 1 and edges between ``a`` and ``b``: the lowest node that each is linked to."""
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while not np.array_equal(new[new], new):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _stars_of_block(keys: list[str], carried: list[str]):
    def work(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ends = np.concatenate([pdf["i"].to_numpy(), pdf["j"].to_numpy()])
        ids, first, flat = np.unique(ends, return_index=True, return_inverse=True)
        root = ids[labels(flat[: len(pdf)], flat[len(pdf) :], len(ids))]
        out = pd.DataFrame({k: v for k, v in zip(keys, key)} | {"id": ids, "root": root}) if keys else pd.DataFrame({"id": ids, "root": root})
        for c in carried:
            out[c] = np.concatenate([pdf[f"i{c}"].to_numpy(), pdf[f"j{c}"].to_numpy()])[first]
        return out

    return work


def _large_star(e: DataFrame, keys: list[str]) -> DataFrame:
    both = e.select(*keys, "u", "v").unionByName(e.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy(*keys, "u").agg(F.min("v").alias("m")).select(*keys, "u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, [*keys, "u"]).select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame, keys: list[str]) -> DataFrame:
    down = e.select(*keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy(*keys, "u").agg(F.min("v").alias("m"))
    links = down.join(low, [*keys, "u"])
    return links.select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(*keys, "u", F.col("m").alias("v"))).where("u <> v").distinct()


def graph_components(edges: DataFrame, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """``keys, node, component``: the smallest node that a node with an edge (``i, j``) of its ``keys`` is linked to."""
    now = Table(edges.select(*keys, F.greatest("i", "j").alias("u"), F.least("i", "j").alias("v")).where("u <> v").distinct())
    mark = None
    while True:
        then = Table(_small_star(_large_star(now.df, keys), keys))
        now.drop()
        now = then
        # sizes and labels stand still once every component is one star
        state = tuple(now.df.agg(F.count("*"), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))).first())
        if state == mark:
            stars = now.df.select(*keys, F.col("u").alias("node"), F.col("v").alias("component"))
            return stars.unionByName(stars.select(*keys, F.col("component").alias("node"), "component").distinct())
        mark = state


def block_components(edges: DataFrame, keys: list[str], block: str, carried: list[str]) -> DataFrame:
    """``keys, id, component`` and ``carried`` of every node with an edge.

    ``edges``: ``keys, block, i, j`` and for each name ``c`` in ``carried`` what stands at the ends, ``ic`` and ``jc``.
    """
    types = dict(edges.dtypes)
    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], "id bigint", "root bigint", *[f"{c} {types[f'i{c}']}" for c in carried]])

    def work(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return _stars_of_block(keys, carried)(key[:-1], pdf)

    stars = Table(edges.groupBy(*keys, block).applyInPandas(work, schema)).df
    node = Table(stars.groupBy(*keys, "id").agg(F.min("root").alias("low"), F.max("root").alias("high"), *[F.min(c).alias(c) for c in carried]), F.col("low") < F.col("high"))
    if not node.counted:
        return node.df.select(*keys, "id", F.col("low").alias("component"), *carried)
    shared = stars.join(node.df.where("low < high").select(*keys, "id", "low"), [*keys, "id"]).where("root <> low")
    named = graph_components(shared.select(*keys, F.col("low").alias("i"), F.col("root").alias("j")), keys)
    return node.df.join(named.withColumnRenamed("node", "low"), [*keys, "low"], "left").select(*keys, "id", F.coalesce("component", "low").alias("component"), *carried)
