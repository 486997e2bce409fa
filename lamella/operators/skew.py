"""Per-key results where a few keys hold most rows: exact offset chunking.

Rows are numbered within each key without a shuffle: every input partition numbers its own rows per key, the counts of
(key, partition) are summed up over the partitions into offsets, and offset plus local number is the row's position in
its key. Positions cut each key into chunks of equal size, whatever the key's share; chunks are the groups that are
processed, and their states are merged per key in chunk order, with windows over one row per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamella.functions.labels import type_name
from lamella.operators.flatten import flatten
from lamella.session import Table, bounded

CHUNK_ROWS = 100_000


def _number(keys: list[str]):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict = {}
        for pdf in batches:
            if not len(pdf):
                continue
            codes = pdf.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
            local = pdf.groupby(codes, sort=False).cumcount().to_numpy()
            first, where, size = np.unique(codes, return_index=True, return_counts=True)
            base = np.zeros(len(first), dtype=np.int64)
            for c, i, n in zip(first, where, size):
                key = tuple(None if pd.isna(v) else v for v in pdf.iloc[i][keys])
                base[c] = seen.get(key, 0)
                seen[key] = base[c] + n
            yield pdf.assign(__local=local + base[codes])

    return work


def number_rows(df: DataFrame, keys: list[str], out: str = "pos") -> DataFrame:
    """``df`` plus ``out``, the row's number within its key (from 0, gapless). Null is a key like any other.

    The numbered rows are written out once, with the partition that numbered them, so a lost executor or another number
    of cores cannot change a number. A name that ``df`` has already (``__part``, ``__local``) is not allowed.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__local", T.LongType())])
    numbered = Table(df.withColumn("__part", F.spark_partition_id()).mapInPandas(_number(keys), schema)).df
    counts = numbered.groupBy("__part", *keys).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = Table(counts.select("__part", *keys, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))).df
    o = bounded(offsets.select(F.col("__part").alias("__p"), *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__offset"))
    same = (F.col("__part") == F.col("__p"))
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return numbered.join(o, same).withColumn(out, F.col("__offset") + F.col("__local")).select(*df.columns, out)


def key_statistics(df: DataFrame, keys: list[str], value: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per key: ``n`` rows, ``n_valid``, ``mean``, ``std`` (population), ``low``, ``high``, ``n_chunks``.

    ``value`` null or not finite counts in ``n`` only. Chunk states (count, mean, squared deviations, extremes) are
    merged by the pairwise formula, which doesn't cancel as sums of squares do.
    """
    v = F.when(~F.isnan(value) & (F.abs(F.col(value)) != float("inf")), F.col(value).cast("double"))
    chunks = number_rows(df.select(*keys, value), keys).groupBy(*keys, F.floor(F.col("pos") / chunk_rows).alias("chunk"))
    state = chunks.agg(F.count("*").alias("n"), F.count(v).alias("k"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("low"), F.max(v).alias("high"))
    whole = Window.partitionBy(*keys)
    state = state.withColumn("all_mean", F.try_divide(F.sum(F.col("k") * F.col("mean")).over(whole), F.sum("k").over(whole)))
    moved = F.col("m2") + F.col("k") * (F.col("mean") - F.col("all_mean")) ** 2
    return state.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("k").alias("n_valid"), F.max("all_mean").alias("mean"),
        F.sqrt(F.try_divide(F.sum(moved), F.sum("k"))).alias("std"), F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("n_chunks"),
    )


def ordered_runs(df: DataFrame, keys: list[str], value: str, chunk_rows: int = CHUNK_ROWS, order: list[str] | None = None) -> DataFrame:
    """Per key, ``n`` rows and ``n_runs``: runs of equal ``value`` by ``order``, else in the order in which the rows stand.

    ``order`` sorts all rows by range, not by key, so a hot key lies in many partitions; nulls come first and rows that
    tie are in order of ``value``. Chunks count their inner changes; a boundary state (first and last value) of
    neighbouring chunks settles whether a run goes on across them. A null value is a value like any other.
    """
    inner = Window.partitionBy(*keys, "chunk").orderBy("pos")
    if order is not None:
        df = df.select(*dict.fromkeys([*keys, value, *order])).orderBy(*[F.asc_nulls_first(c) for c in [*order, value]])
    rows = number_rows(df.select(*keys, value), keys).withColumn("chunk", F.floor(F.col("pos") / chunk_rows))
    rows = rows.withColumn("change", (F.row_number().over(inner) > 1) & ~F.col(value).eqNullSafe(F.lag(value).over(inner)))
    state = rows.groupBy(*keys, "chunk").agg(F.count("*").alias("n"), F.sum(F.col("change").cast("int")).alias("changes"), F.min_by(F.struct(value), "pos").alias("first"), F.max_by(F.struct(value), "pos").alias("last"))
    across = Window.partitionBy(*keys).orderBy("chunk")
    before = F.lag("last").over(across)
    state = state.withColumn("joins", F.when(before.isNull(), 1).when(before[value].eqNullSafe(F.col("first")[value]), 0).otherwise(1))
    return state.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.col("changes") + F.col("joins")).alias("n_runs"))


def typed_rows(cells: DataFrame, documents: DataFrame) -> DataFrame:
    """``field, cell_type, value``: every row of cells (value: area) and every non-null mask (value: confidence)."""
    a = cells.select(F.lit("cells.cell_type").alias("field"), type_name(F.col("cell_type")).alias("cell_type"), F.col("area").cast("double").alias("value"))
    b = flatten(documents, "masks").select(F.lit("cell_masks.cell_type").alias("field"), type_name(F.col("cell_type")).alias("cell_type"), F.col("confidence").alias("value"))
    return a.unionByName(b)


def dominant_types(cells: DataFrame, documents: DataFrame, share: float = 0.05, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``field, cell_type`` of the types that hold at least ``share`` of the field's rows."""
    stats = key_statistics(typed_rows(cells, documents), ["field", "cell_type"], "value", chunk_rows)
    whole = F.sum("n").over(Window.partitionBy("field"))
    return stats.withColumn("total", whole).where(F.col("n") >= share * F.col("total")).select("field", "cell_type")
