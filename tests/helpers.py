"""Small cubes for the tests."""

from pyspark.sql import functions as F

from gridmend.functions import timeaxis


def noleap_series(spark, first_year, n_days, value, name="v", start_doy=1, cell="a"):
    """Daily noleap series; ``value`` is a column over the day number ``id``."""
    first = first_year * 365 + start_doy - 1
    days = spark.range(n_days).withColumn("_s", (F.col("id") + first).cast("int"))
    return days.select(
        F.lit(cell).alias("cell"), timeaxis.date_of_step(F.col("_s")).alias("date"), value.cast("double").alias(name)
    )


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*order).collect()]
