"""Queries of the training-data problems for text and learning (p4, p6 to p10) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.llm import clusters, components, leakage, percentiles, spam, tokens
from lamella.session import read

Query = Callable[[SparkSession, str], DataFrame]


def _named(df: DataFrame, error: float) -> DataFrame:
    names = ("p10", "median", "p90")
    return df.select("role", "measure", "n", *[F.round(F.col("percents")[i], 9).alias(c) for i, c in enumerate(names)], F.lit(error).alias("rank_error"))


def _measures(spark: SparkSession, d: str) -> DataFrame:
    return percentiles.cell_measures(read(spark, d, "cells"), read(spark, d, "roles"))


def p4_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return _named(percentiles.exact_percentiles(_measures(spark, d), ["role", "measure"], "value", tie=F.xxhash64("cell_id")), 0.0)


def p4_combined(spark: SparkSession, d: str) -> DataFrame:
    """The same from summaries of single slides; ``rank_error`` bounds the error of a rank as a share of ``n``."""
    points = percentiles.summaries(_measures(spark, d), ["slide", "role", "measure"], "value", 0.005, F.xxhash64("cell_id"))
    return _named(percentiles.combine(points, ["role", "measure"]), 0.005)


def p4_combined_error(spark: SparkSession, d: str) -> DataFrame:
    """Whether each percentile from united summaries has a rank within the stated error, counted over all values."""
    got = p4_combined(spark, d).select("role", "measure", F.inline(F.array(*[F.struct(F.lit(p).alias("percent"), F.col(c).alias("at")) for p, c in ((10, "p10"), (50, "median"), (90, "p90"))])))
    # values were rounded to nine decimals
    n = _measures(spark, d).join(got, ["role", "measure"]).groupBy("role", "measure", "percent").agg(F.count("*").alias("n"), F.count(F.when(F.col("value") < F.col("at") - 1e-9, 1)).alias("below"), F.count(F.when(F.col("value") <= F.col("at") + 1e-9, 1)).alias("upto"))
    rank, slack = F.col("percent") / 100 * (F.col("n") - 1), 0.005 * F.col("n") + 1
    return n.select("role", "measure", "percent", ((F.col("below") - slack <= rank) & (rank <= F.col("upto") + slack)).alias("within"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return components.cell_groups(read(spark, d, "cells"), read(spark, d, "cell_edges"), read(spark, d, "cell_adj"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return clusters.patch_groups(read(spark, d, "patch_diversity"))


def p7_kinds(spark: SparkSession, d: str) -> DataFrame:
    return clusters.patch_clusters(read(spark, d, "patch_diversity")).of_records().withColumnRenamed("id", "patch_id")


def p7_described(spark: SparkSession, d: str) -> DataFrame:
    return clusters.patch_clusters(read(spark, d, "patch_diversity")).described()


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(read(spark, d, "documents"))


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return tokens.round_trip(read(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(read(spark, d, "documents"), read(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


def p9_reordered(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold at least half of an item in passages of eight words or more, in any order."""
    found = leakage.leaks(read(spark, d, "documents"), read(spark, d, "eval_items"), min_words=8, min_coverage=0.5)
    return found.select("doc_id", "item_id", "n_tiles", "longest", F.round("coverage", 6).alias("coverage"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_found(read(spark, d, "documents"))


QUERIES: dict[str, Query] = {
    "p4_percentiles": p4_percentiles,
    "p4_combined": p4_combined,
    "p4_combined_error": p4_combined_error,
    "p6_found": p6_found,
    "p7_found": p7_found,
    "p7_kinds": p7_kinds,
    "p7_described": p7_described,
    "p8_ids": p8_ids,
    "p8_round_trip": p8_round_trip,
    "p9_found": p9_found,
    "p9_reordered": p9_reordered,
    "p10_found": p10_found,
}

_LABEL = "nullif(trim(regexp_replace(lower({}), '[\\s]+', ' ', 'g')), '')"
SQL: dict[str, str] = {
    "p4_percentiles": f"""
WITH r AS (SELECT {_LABEL.format("cell_type")} AS t, min({_LABEL.format("role")}) AS r FROM roles GROUP BY 1),
c AS (SELECT cell_id, coalesce({_LABEL.format("c.role")}, r.r, 'other') AS role, CAST(area AS DOUBLE) AS area, CAST(eccentricity AS DOUBLE) AS eccentricity
  FROM cells c LEFT JOIN r ON {_LABEL.format("c.cell_type")} = r.t),
v AS (SELECT DISTINCT cell_id, role, 'area' AS measure, area AS v FROM c WHERE isfinite(area)
  UNION ALL SELECT DISTINCT cell_id, role, 'eccentricity', eccentricity FROM c WHERE isfinite(eccentricity))
SELECT role, measure, count(*) AS n, round(quantile_cont(v, 0.1), 9) AS p10, round(quantile_cont(v, 0.5), 9) AS median, round(quantile_cont(v, 0.9), 9) AS p90, 0.0::DOUBLE AS rank_error
FROM v GROUP BY 1, 2""",
    "p4_combined_error": f"""
WITH r AS (SELECT {_LABEL.format("cell_type")} AS t, min({_LABEL.format("role")}) AS r FROM roles GROUP BY 1),
c AS (SELECT DISTINCT coalesce({_LABEL.format("c.role")}, r.r, 'other') AS role, isfinite(area) AS a, isfinite(eccentricity) AS e FROM cells c LEFT JOIN r ON {_LABEL.format("c.cell_type")} = r.t),
g AS (SELECT role, 'area' AS measure FROM c WHERE a UNION SELECT role, 'eccentricity' FROM c WHERE e)
SELECT role, measure, percent, true AS within FROM g, (SELECT unnest([10, 50, 90]) AS percent)""",
    "p6_found": """
WITH RECURSIVE k AS (SELECT DISTINCT cell_id FROM cells),
p AS (SELECT i AS a, j AS b FROM cell_edges WHERE edge_len <= 50 UNION SELECT cell_id, unnest(neighbours) FROM cell_adj),
e AS (SELECT a, b FROM p WHERE a <> b AND a IN (FROM k) AND b IN (FROM k)),
s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
w(node, root) AS (SELECT a, a FROM s UNION SELECT s.b, w.root FROM w JOIN s ON s.a = w.node)
SELECT node AS cell_id, min(root) AS group_id FROM w GROUP BY 1""",
    "p8_round_trip": "SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars, true AS exact FROM documents",
}
