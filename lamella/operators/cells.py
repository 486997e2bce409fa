"""The cell table: one row per cell in um, with united type and role."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lamella.functions.labels import type_name, with_role
from lamella.operators.units import cells_in_um, position_units
from lamella.session import Table, read
from lamella.sources.masks import unified

ROLES = ("immune", "tumor", "stroma", "epithelial", "endothelium", "other")
SHAPES = ("area", "perimeter", "major_axis", "minor_axis", "eccentricity", "circularity", "extent", "solidity")


def one_per_cell(rows: DataFrame) -> DataFrame:
    """Of the rows of a cell the one of the earliest delivery."""
    first = Window.partitionBy("cell_id").orderBy("delivery_id", "ingested_at")
    return rows.where("cell_id is not null and slide is not null").withColumn("__r", F.row_number().over(first)).where("__r = 1").drop("__r")


def at_least(cells: DataFrame, confidence: float) -> DataFrame:
    """Cells of at least this confidence; the bound is compared as a float, as the column is. Zero keeps all, nulls too."""
    return cells.where(F.col("confidence") >= F.lit(confidence).cast("float")) if confidence > 0 else cells


def cell_table(spark: SparkSession, d: str, confidence: float = 0.0) -> DataFrame:
    """``slide, cell_id, cell_type, role, confidence, qx, qy`` (0.1 um) and the shape columns."""
    cells = read(spark, d, "cells").select("slide", "cell_id", "delivery_id", "cell_type", "role", "confidence", "cx", "cy", "coord_unit", "ingested_at", *SHAPES)
    units = position_units(cells, read(spark, d, "deliveries"), unified(read(spark, d, "cell_masks")), read(spark, d, "slides"))
    u = one_per_cell(cells_in_um(cells, units))
    u = with_role(u, read(spark, d, "roles"))
    return at_least(u.select("slide", "cell_id", type_name(F.col("cell_type")).alias("cell_type"), F.col("role_u").alias("role"), "confidence", "qx", "qy", *SHAPES), confidence)


def stored_cells(spark: SparkSession, d: str) -> DataFrame:
    """The cell table written out once, for operators that read it several times."""
    return Table(cell_table(spark, d)).df
