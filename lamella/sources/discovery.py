"""Slide folders, cached cell tables and outputs, through Hadoop's file systems so that any store works."""

from __future__ import annotations

from fnmatch import fnmatch

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _list(spark: SparkSession, path: str) -> list:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(fs.listStatus(p), key=lambda s: s.getPath().getName()) if fs.exists(p) else []


def read_head(spark: SparkSession, path: str, size: int = 4096) -> str:
    """The first bytes of a file as text; empty where there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return ""
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(size)).decode("utf-8", "ignore")
    finally:
        stream.close()


def slide_files(spark: SparkSession, root: str, patterns: list[str]) -> dict[str, str]:
    """Slide folder name to its first file that fits the earliest pattern; folders without one are left out."""
    found = {}
    for folder in (s for s in _list(spark, root) if s.isDirectory()):
        names = [s.getPath() for s in _list(spark, folder.getPath().toString()) if s.isFile()]
        for pattern in patterns:
            fit = [p.toString() for p in names if fnmatch(p.getName(), pattern)]
            if fit:
                found[folder.getPath().getName()] = fit[0]
                break
    return found


def _newest(spark: SparkSession, path: str) -> int:
    return max((s.getModificationTime() for s in _list(spark, path)), default=-1)


def fresh(spark: SparkSession, cache: str, sources: list[str]) -> bool:
    """Whether a cache is complete and no older than any of its sources (files or folders of files)."""
    newest = max((_newest(spark, s) for s in sources), default=-1)
    return any(s.getPath().getName() == "_SUCCESS" for s in _list(spark, cache)) and _newest(spark, cache) >= newest


def cached(spark: SparkSession, cache: str, sources: str | list[str], build, rebuild: bool = False) -> DataFrame:
    """The table in ``cache`` if it is fresh, else what ``build`` gives, written there by slide."""
    if rebuild or not fresh(spark, cache, [sources] if isinstance(sources, str) else sources):
        build().write.mode("overwrite").partitionBy("slide").parquet(cache)
    return spark.read.parquet(cache).withColumn("slide", F.col("slide").cast("string"))


def write_features(wide: DataFrame, out: str) -> None:
    """The wide feature table as parquet and CSV, sorted by slide."""
    ordered = wide.orderBy("slide")
    ordered.write.mode("overwrite").parquet(f"{out}.parquet")
    ordered.write.mode("overwrite").option("header", True).csv(f"{out}.csv")


def write_patch_tables(patches: DataFrame, out: str) -> None:
    """One folder of CSV per slide, patches in order of their corners."""
    patches.repartition("slide").sortWithinPartitions("slide", "patch_y_level0", "patch_x_level0").write.mode("overwrite").partitionBy("slide").option("header", True).csv(out)
