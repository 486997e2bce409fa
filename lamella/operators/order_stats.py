"""Statistics blocks per group, with exact percentiles by bracketing.

A quantile sketch brackets every wanted order statistic; one more pass counts the rows below the bracket and adds up
the few values inside it, where the position is found exactly. No group is sorted as a whole, and a value that fills
much of a group is one row by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.session import BROADCAST_ROWS, Table

SLACK, ACCURACY = 0.002, 5000


def finite(col: Column) -> Column:
    """``col`` as double, null where it isn't finite."""
    c = col.cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def stat_block(rows: DataFrame, keys: list[str], percents: tuple[int, ...] = (10, 50, 90)) -> DataFrame:
    """``keys``, ``n``, ``mean``, ``std`` (population), ``skew`` and ``p<percent>`` (linear interpolation) of finite values ``v``.

    Groups without a finite value are absent. ``skew`` is 0 for up to two values, null for equal ones. ``rows`` is read
    twice: once for moments and brackets of all groups, once for what lies in and below the brackets.
    """
    values = rows.where(F.col("v").isNotNull())
    wanted = [p for q in percents for p in (max(q / 100 - SLACK, 0.0), min(q / 100 + SLACK, 1.0))]
    moments = [F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.when(F.count("*") <= 2, F.lit(0.0)).otherwise(F.skewness("v")).alias("skew")]
    sketch = Table(values.groupBy(*keys).agg(*moments, F.percentile_approx("v", wanted, ACCURACY).alias("q"), F.min("v").alias("vmin"), F.max("v").alias("vmax")), F.lit(True))
    # small groups are within the sketch's error as a whole
    lo = lambda i: F.when(F.col("n") <= 2000, F.col("vmin")).otherwise(F.col("q")[2 * i])
    hi = lambda i: F.when(F.col("n") <= 2000, F.col("vmax")).otherwise(F.col("q")[2 * i + 1])
    brackets = sketch.df.select(*keys, F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(q / 100) * (F.col("n") - 1)).alias("at"), lo(i).alias("lo"), hi(i).alias("hi")) for i, q in enumerate(percents)]).alias("__b"))
    joined = values.join(F.broadcast(brackets) if sketch.counted <= BROADCAST_ROWS else brackets, keys).select(*keys, "v", F.explode("__b").alias("__b"))
    # below the bracket all rows fold into one; inside it equal values do; above it none is needed
    kept = joined.where(F.col("v") <= F.col("__b.hi"))
    folded = kept.groupBy(*keys, F.col("__b.i").alias("__i"), F.col("__b.at").alias("at"), F.when(F.col("v") >= F.col("__b.lo"), F.col("v")).alias("v")).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*keys, "__i").orderBy(F.col("v").asc_nulls_first())
    placed = folded.withColumn("end", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("v is not null")
    ends = placed.groupBy(*keys, "__i").agg(
        F.min(F.when(F.col("end") > F.floor("at"), F.col("v"))).alias("__a"), F.min(F.when(F.col("end") > F.ceil("at"), F.col("v"))).alias("__z"), F.max(F.col("at") - F.floor("at")).alias("__t"))
    value = F.col("__a") + (F.col("__z") - F.col("__a")) * F.col("__t")
    found = ends.groupBy(*keys).agg(*[F.max(F.when(F.col("__i") == i, value)).alias(f"p{q}") for i, q in enumerate(percents)])
    return sketch.df.select(*keys, "n", "mean", "std", "skew").join(found, keys)
