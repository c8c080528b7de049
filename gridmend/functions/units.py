"""Spellings of units, as a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmend.functions.joins import local_table

# Fixed values: (canonical spelling, CF spelling, further accepted spellings).
UNIT_SPELLINGS = (
    ("kelvin", "K", ("degK", "degree_Kelvin", "degrees_kelvin")),
    ("degree_Celsius", "degC", ("C", "celsius", "degrees_celsius", "deg C")),
    ("millimeter / day", "mm d-1", ("mm day-1", "mm/day", "mm d^-1", "mm/d", "millimeter/day")),
    ("millimeter", "mm", ("millimeters", "millimetre")),
    ("meter", "m", ("meters", "metre")),
    ("meter / second", "m s-1", ("m/s", "m s^-1", "meter/second")),
    ("kilogram / meter ** 2 / second", "kg m-2 s-1", ("kg/m2/s", "kg m^-2 s^-1", "kg / m ** 2 / s")),
    ("watt / meter ** 2", "W m-2", ("W/m2", "W m^-2")),
    ("pascal", "Pa", ("pascals",)),
    ("percent", "%", ("pct",)),
    ("dimensionless", "1", ("", "none")),
    ("degree", "degree", ("degrees", "deg", "degree_north", "degrees_north", "degree_east", "degrees_east")),
    ("day", "d", ("days",)),
)


def unit_table(spark: SparkSession) -> DataFrame:
    """``spelling`` -> ``canonical``, ``cf`` for every accepted spelling."""
    spelled = [(s, canonical, cf) for canonical, cf, more in UNIT_SPELLINGS for s in sorted({canonical, cf, *more})]
    columns = dict(zip(("spelling", "canonical", "cf"), zip(*spelled)))
    return local_table(spark, columns, "spelling string, canonical string, cf string")
