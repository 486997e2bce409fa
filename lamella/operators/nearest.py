"""Exact distances to the nearest point of another population, per slide, over k-d nodes of the targets.

A query first asks the node it falls into; the distance found there bounds the nodes that can hold a nearer target,
and it asks those as well. Without a target in its slide a query's distance is infinite.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamella.functions.kdtree import KDTree
from lamella.operators.near import home_node, kd_splits, to_nodes
from lamella.session import Table


def _ask(kept: list[str], k: int, other: bool):
    def work(key: tuple, queries: pd.DataFrame, targets: pd.DataFrame) -> pd.DataFrame:
        out = queries[kept].copy()
        d2 = np.full((len(queries), k), np.inf)
        if len(targets) and len(queries):
            tree = KDTree(targets[["qx", "qy"]].to_numpy(dtype=float))
            own = queries["id"].to_numpy() if other else None
            d2 = tree.nearest(queries[["qx", "qy"]].to_numpy(dtype=float), k, own, targets["id"].to_numpy())
        out["d2"] = pd.Series(list(d2), index=out.index, dtype=object)
        return out

    return work


def nearest(queries: DataFrame, targets: DataFrame, other: bool = False, target: int = 20_000, splits: DataFrame | None = None, k: int = 1, carried: tuple[str, ...] = ()) -> DataFrame:
    """``slide, id, carried`` and ``steps`` for every query: grid steps to the nearest target (with ``other``: of another id).

    With ``k`` above 1 ``steps`` is an array of the ``k`` nearest, infinite where there are fewer. ``splits`` may be
    given where they are known already. Queries are one row per slide, id and ``carried``.
    """
    t = Table(targets.select("slide", "id", "qx", "qy")).df
    q = queries.select("slide", "id", *carried, "qx", "qy")
    splits = kd_splits(t, target) if splits is None else splits
    at = home_node(t, splits).select("slide", "node", "id", "qx", "qy")
    kept = ["slide", "id", *carried, "qx", "qy"]
    types = dict(q.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", d2 array<double>"
    first = Table(home_node(q, splits).groupBy("slide", "node").cogroup(at.groupBy("slide", "node")).applyInPandas(_ask(kept, k, other), schema)).df
    # a whole slide is within reach of a query whose node held too few other targets
    last = F.element_at("d2", -1)
    reach = F.when(last == float("inf"), F.lit(1 << 40)).otherwise(F.ceil(F.sqrt(last))).cast("bigint")
    x, y = F.col("qx"), F.col("qy")
    wide = to_nodes(first.withColumn("r", reach), splits, x - F.col("r"), x + F.col("r"), y - F.col("r"), y + F.col("r"), (x, y)).where("not home")
    second = wide.select(*kept, "node").groupBy("slide", "node").cogroup(at.groupBy("slide", "node")).applyInPandas(_ask(kept, k, other), schema)
    names = ["slide", "id", *carried]
    if k == 1:
        best = first.unionByName(second).groupBy(*names).agg(F.min(F.get("d2", 0)).alias("d2")).select(*names, F.sqrt("d2").alias("steps"))
        none = F.lit(float("inf"))
    else:
        # a query asks few nodes
        best = first.unionByName(second).groupBy(*names).agg(F.slice(F.array_sort(F.flatten(F.collect_list("d2"))), 1, k).alias("d2")).select(*names, F.transform("d2", F.sqrt).alias("steps"))
        none = F.array_repeat(F.lit(float("inf")), k)
    # slides without targets
    return best.unionByName(q.join(splits.select("slide"), "slide", "left_anti").select(*names, none.alias("steps")))
