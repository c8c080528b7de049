"""Unit spellings in the attributes table; values are never touched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.functions.units import unit_table


def normalise_units(attrs: DataFrame, variable: str | None = None) -> DataFrame:
    """Rewrite ``units`` (of one variable, or of all) to their canonical spelling."""
    return _respell(attrs, variable, "canonical")


def units_to_cf(attrs: DataFrame, variable: str | None = None) -> DataFrame:
    """Rewrite ``units`` (of one variable, or of all) to their CF spelling."""
    return _respell(attrs, variable, "cf")


def _respell(attrs: DataFrame, variable: str | None, column: str) -> DataFrame:
    """A spelling outside the table is an error, raised when the row is read."""
    mine = F.col("key") == "units"
    if variable is not None:
        mine = mine & (F.col("variable") == variable)
    table = F.broadcast(unit_table(attrs.sparkSession))  # a few dozen fixed rows
    joined = attrs.join(table, mine & (F.trim("value") == F.col("spelling")), "left")
    unknown = F.raise_error(F.concat(F.lit("unknown unit spelling: "), "value"))
    value = F.when(~mine, F.col("value")).when(F.col(column).isNotNull(), F.col(column)).otherwise(unknown)
    return joined.select(*[value.alias(c) if c == "value" else F.col(c) for c in attrs.columns])
