"""Percentiles per group over very large columns, exact, and with summaries that combine within a stated error.

Exact: one distributed sort by group and value; per-partition counts give each group's offsets, these locate the
partition and row of every wanted position, and the two neighbouring order statistics are interpolated. A tie-breaker
in the sort key keeps a value that fills a third of the rows from landing in one partition.

Summaries: evenly spaced order statistics with weights, of a group within one part (a slide, a day). The weighted union
of any summaries gives percentiles whose rank is off by at most ``error`` of the rows united.

Null, NaN and infinite values are dropped first; a group without any other value gives no row. Repeated rows count as
often as they stand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamella.functions.labels import with_role
from lamella.session import Table, bounded

PERCENTS = (0.1, 0.5, 0.9)


def finite(df: DataFrame, value: str) -> DataFrame:
    return df.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(F.col(value)) != float("inf")))


def _sorted(df: DataFrame, by: list[str], value: str, tie: Column) -> DataFrame:
    """``by``, value, ``part`` and ``seq`` (the row's place in its partition) of the distributed sort, written out."""
    rows = df.select(*by, F.col(value).cast("double").alias("v"), tie.alias("tie"))
    ranged = rows.repartitionByRange(*by, "v", "tie").sortWithinPartitions(*by, "v").drop("tie")
    return Table(ranged.withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))).df


def _offsets(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row per group and partition: ``n``, ``first`` (place of its first row), ``before`` (rows in earlier partitions), ``total``."""
    counts = rows.groupBy("part", *by).agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    w = Window.partitionBy(*by)
    before = w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return Table(counts.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(w).alias("total"))).df


def _at(rows: DataFrame, offsets: DataFrame, by: list[str], places: Column) -> DataFrame:
    """Values at the group's ``places`` (structs with ``pos`` from 0): ``by``, ``place``, ``total``, ``v``."""
    wanted = offsets.withColumn("place", F.explode(places)).where("place.pos >= before and place.pos < before + n")
    wanted = wanted.select("part", (F.col("first") + F.col("place.pos") - F.col("before")).alias("seq"), *by, "place", "total")
    return rows.select("part", "seq", "v").join(bounded(Table(wanted).df), ["part", "seq"])


def exact_percentiles(df: DataFrame, by: list[str], value: str, percents: tuple[float, ...] = PERCENTS, tie: Column | None = None) -> DataFrame:
    """``by``, ``n`` and ``percents`` (an array in the given order): linear interpolation between order statistics.

    ``tie`` spreads equal values over partitions; by default the row's place in the input.
    """
    rows = _sorted(finite(df, value), by, value, F.monotonically_increasing_id() if tie is None else tie)
    offsets = _offsets(rows, by)
    at = lambda p: F.lit(float(p)) * (F.col("total") - 1)
    ends = [F.struct(F.lit(i).alias("i"), f(at(p)).cast("bigint").alias("pos"), (at(p) - F.floor(at(p))).alias("part_way")) for i, p in enumerate(percents) for f in (F.floor, F.ceil)]
    found = _at(rows, offsets, by, F.array(*ends)).groupBy(*by, F.col("place.i").alias("i")).agg(F.max("total").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.max("place.part_way").alias("t"))
    each = found.withColumn("v", F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("t"))
    out = each.groupBy(*by).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("i") == i, F.col("v"))).alias(f"p{i}") for i in range(len(percents))])
    return out.select(*by, "n", F.array(*[F.col(f"p{i}") for i in range(len(percents))]).alias("percents"))


def summaries(df: DataFrame, by: list[str], value: str, error: float = 0.005, tie: Column | None = None) -> DataFrame:
    """``by``, ``n``, ``v``, ``weight``: points of the summary of each group; at most ``1 / (2 * error) + 1`` of them.

    A point stands for ``step`` neighbouring rows (``step <= max(1, 2 * error * n)``) and sits in their middle.
    """
    rows = _sorted(finite(df, value), by, value, F.monotonically_increasing_id() if tie is None else tie)
    step = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(2 * error) * F.col("total")))
    places = F.transform(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("total") - 1) / step)), lambda i: F.struct(F.least(i * step + F.floor(step / 2), F.floor((i * step + F.col("total") - 1) / 2), F.col("total") - 1).alias("pos"), F.least(step, F.col("total") - i * step).alias("weight")))
    return _at(rows, _offsets(rows, by), by, places).select(*by, F.col("total").alias("n"), "v", F.col("place.weight").alias("weight"))


def combine(points: DataFrame, by: list[str], percents: tuple[float, ...] = PERCENTS) -> DataFrame:
    """``by``, ``n``, ``percents`` from the united points of any summaries, each percentile a value of the data.

    Points are sorted over the cluster like rows are; only the range partitions that hold a wanted rank are summed up.
    """
    ranged = points.select(*by, "v", "weight").repartitionByRange(*by, "v")
    rows = Table(ranged.withColumn("part", F.spark_partition_id())).df
    w = Window.partitionBy(*by)
    counts = rows.groupBy("part", *by).agg(F.sum("weight").alias("n"))
    counts = counts.select("*", F.coalesce(F.sum("n").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.sum("n").over(w).alias("total"))
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("total") - 1)).alias("rank")) for i, p in enumerate(percents)])
    wanted = Table(counts.withColumn("want", F.explode(ranks)).where("want.rank >= before and want.rank < before + n").select("part", *by, "want", "before", "total")).df
    upto = F.sum("weight").over(Window.partitionBy("part", *by, "want").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    inside = rows.join(bounded(wanted), ["part", *by]).withColumn("upto", F.col("before") + upto)
    found = inside.where(F.col("upto") > F.col("want.rank")).groupBy(*by, F.col("want.i").alias("i")).agg(F.min("v").alias("v"), F.max("total").alias("n"))
    out = found.groupBy(*by).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("i") == i, F.col("v"))).alias(f"p{i}") for i in range(len(percents))])
    return out.select(*by, "n", F.array(*[F.col(f"p{i}") for i in range(len(percents))]).alias("percents"))


def cell_measures(cells: DataFrame, roles: DataFrame, measures: tuple[str, ...] = ("area", "eccentricity")) -> DataFrame:
    """``slide, cell_id, role, measure, value``: each value of a cell once, though the cell came in several deliveries."""
    u = with_role(cells.select("slide", "cell_id", "cell_type", "role", *measures), roles)
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures])
    rows = u.select("slide", "cell_id", F.col("role_u").alias("role"), F.inline(pairs))
    return finite(rows, "value").distinct()
