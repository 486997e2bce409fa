"""Session helpers: where intermediate tables go, and how big a side may be to be broadcast."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A side of at most so many rows may be broadcast; more rows take a shuffled join.
BROADCAST_ROWS = 50_000

_roots: dict[str, str] = {}
T = TypeVar("T")


def scratch_root(spark: SparkSession) -> str:
    """The folder of this session's intermediate tables, under ``spark.checkpoint.dir``.

    Only where that setting is absent and all runs on one machine (tests) a temporary folder stands in; on a cluster
    an absent setting is an error, since other executors couldn't read a folder of one machine.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not base and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not base:
            base = tempfile.mkdtemp(prefix="spark-lamella-")
        _roots[app] = f"{base.rstrip('/')}/lamella-{uuid.uuid4().hex[:12]}"
        atexit.register(_remove, spark, _roots[app])
    return _roots[app]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    except Exception:  # the session is already gone
        pass


class Table:
    """An intermediate result written as parquet, which any executor can read again."""

    def __init__(self, df: DataFrame, count: Column | None = None):
        """``count``: a condition; the rows that meet it are counted while writing, into ``counted``."""
        self.spark = df.sparkSession
        self.path = f"{scratch_root(self.spark)}/{uuid.uuid4().hex}"
        self.schema = df.schema
        self.counted = None
        if count is None:
            df.write.parquet(self.path)
        else:
            seen = Observation()
            df.observe(seen, F.count(F.when(count, 1)).alias("n")).write.parquet(self.path)
            self.counted = seen.get["n"]

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def drop(self) -> None:
        _remove(self.spark, self.path)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends, sizes become known to the planner."""
    return Table(df).df


def together(spark: SparkSession, *builds: Callable[[], T]) -> list[T]:
    """Results of ``builds``, which write tables that don't depend on each other, so that their jobs share the cluster."""
    with ThreadPoolExecutor(len(builds)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(b)) for b in builds]]


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else as it is (the join shuffles)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
