"""Uniting spellings of types and roles, as column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space that may surround or stand inside a label.
SPACE = r"[\s  -  　]+"


def united(col: Column) -> Column:
    """Lower case, trimmed (tabs too), inner white space as one blank; an empty label becomes null."""
    return F.nullif(F.trim(F.lower(F.regexp_replace(col, SPACE, " "))), F.lit(""))


def type_name(col: Column) -> Column:
    """The united cell type; a missing one counts as ``unknown``."""
    return F.coalesce(united(col), F.lit("unknown"))


def with_role(cells: DataFrame, roles: DataFrame, out: str = "role_u") -> DataFrame:
    """Add ``out``: the united role of a cell, else the role of its type, else ``other``.

    ``roles`` is the fixed map of types to roles; the join broadcasts it by its size on disk. Types given twice take
    the first role in order of the alphabet. Columns of ``cells`` stay as they are, whatever their names.
    """
    by_type = roles.select(united(F.col("cell_type")).alias("__t"), united(F.col("role")).alias("__r")).where("__t is not null").groupBy("__t").agg(F.min("__r").alias("__r"))
    keyed = cells.withColumn("__k", united(F.col("cell_type")))
    joined = keyed.join(by_type, keyed["__k"] == by_type["__t"], "left")
    return joined.withColumn(out, F.coalesce(united(F.col("role")), F.col("__r"), F.lit("other"))).drop("__k", "__t", "__r")
