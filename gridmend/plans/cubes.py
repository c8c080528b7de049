"""Test cubes derived from the driver's tables, each over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmend.operators.calendars import remove_leap_days
from gridmend.operators.regrid import axis_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))


def dtr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A diurnal temperature range per event, at one of 181 latitudes."""
    position = F.col("event_id") % 181
    return _events(spark, sf_dir).select(
        "event_id", "date", position.cast("int").alias("lat_idx"), (position - 90).cast("double").alias("lat"),
        F.col("value").alias("dtr"),
    )


def dtr_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dtr`` with the value of every 97th event missing."""
    return dtr(spark, sf_dir).withColumn("dtr", F.when(F.col("event_id") % 97 != 0, F.col("dtr")))


def dtr_shuffled_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dtr`` on an axis whose latitudes are in no order."""
    label = (F.col("lat_idx") * 50) % 181 - 90
    return dtr(spark, sf_dir).withColumn("lat", label.cast("double"))


def precipitation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily precipitation in mm per event, about two thirds below the wet-day threshold."""
    return _events(spark, sf_dir).select("event_id", "date", (F.col("value") / 50.0).alias("pr"))


def extreme_precipitation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("pr")
    )


def temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A temperature per line item that leaves the valid range in both directions."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("date"), (F.col("l_quantity") * 8).alias("tasmax")
    )


def daily_series(
    spark: SparkSession, sf_dir: str, status: str | None, cell: str = "l_returnflag", value: str = "l_quantity", leap_days: bool = False
) -> DataFrame:
    """Daily mean of ``value`` per cell of one line status (or of both), on the noleap calendar or, with ``leap_days``, the standard one."""
    items = table(spark, sf_dir, "lineitem")
    if status is not None:
        items = items.filter(F.col("l_linestatus") == status)
    days = items.groupBy(F.col(cell).alias("cell"), F.to_date("l_shipdate").alias("date"))
    series = days.agg(F.avg(value).alias("v"))
    return series if leap_days else remove_leap_days(series)


def holed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean quantity of all line items, a single series, missing on the first days of every ten."""
    days = table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(F.avg("l_quantity").alias("v"))
    return days.withColumn("v", F.when(F.dayofyear("date") % 10 >= 3, F.col("v")))


def ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of the time axis all daily series share, from one column."""
    dates = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate"))
    return dates.agg(F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last"))


def fine_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean quantity of fine cells, one per return flag and line status; the two line statuses of a
    return flag make up a coarse cell."""
    fine_cell = F.concat("l_returnflag", "l_linestatus").alias("cell")
    days = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_returnflag").alias("coarse_cell"), fine_cell, F.to_date("l_shipdate").alias("date")
    )
    return remove_leap_days(days.agg(F.avg("l_quantity").alias("v")))


def monthly_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly quantities on a global 5 x 5 grid: one cell per nation, by its suppliers."""
    items = table(spark, sf_dir, "lineitem")
    by_supplier = items.groupBy(
        F.col("l_suppkey").alias("s_suppkey"), F.to_date(F.trunc("l_shipdate", "month")).alias("date")
    ).agg(F.sum("l_quantity").alias("v"))
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    by_nation = by_supplier.join(suppliers, "s_suppkey").groupBy("nation", "date").agg(F.sum("v").alias("v"))
    return by_nation.select(
        F.col("nation").alias("src_cell"), "date",
        F.floor(F.col("nation") / 5).cast("int").alias("lat_idx"), (F.col("nation") % 5).cast("int").alias("lon_idx"),
        (F.floor(F.col("nation") / 5) * 40 - 80).cast("double").alias("lat"),
        (F.col("nation") % 5 * 72 + 36).cast("double").alias("lon"), "v",
    )


def grid_axes(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Axes of ``monthly_grid``."""
    lat = axis_table(spark, [-80 + 40 * i for i in range(5)], [-90 + 36 * i for i in range(6)])
    lon = axis_table(spark, [36 + 72 * j for j in range(5)], [72 * j for j in range(6)])
    return lat, lon


def points_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two years on the 360-day calendar for every 720 events."""
    at = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.floor(at / 720).alias("cell"),
        (F.floor(at / 360) % 2 + 1951).cast("int").alias("year"),
        (at % 360).cast("int").alias("day360"),
        F.col("value").alias("v"),
    )


def event_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of each event type: its count, its first and its last day."""
    facts = F.array(
        attr(0, "n", F.count("*")), attr(1, "first_day", F.min("date")), attr(2, 'last "day"', F.max("date"))
    )
    by_type = _events(spark, sf_dir).groupBy(F.col("event_type").alias("variable")).agg(facts.alias("facts"))
    return by_type.select("variable", F.explode("facts").alias("f")).select("variable", "f.*")


def attr(pos: int, key: str, value: Column) -> Column:
    """One row of an attributes table, as a struct."""
    return F.struct(F.lit(pos).alias("pos"), F.lit(key).alias("key"), value.cast("string").alias("value"))
