"""Tiles as they arrive: running counts of cell types per slide over a folder of tile lines (an extension).

The file source remembers in its checkpoint which files it has read, so a stopped run goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamella.functions.labels import type_name
from lamella.sources.masks import MASK

SCHEMA = f"slide string, x bigint, y bigint, width bigint, height bigint, masks array<{MASK}>"


def tile_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def type_counts(tiles: DataFrame) -> DataFrame:
    """``slide, cell_type, n`` of non-null masks; works on a stream (update or complete mode) and on a table alike."""
    masks = tiles.select("slide", F.explode("masks").alias("m")).where("m is not null")
    return masks.groupBy("slide", type_name(F.col("m.cell_type")).alias("cell_type")).agg(F.count("*").alias("n"))
