import datetime as dt
import warnings

import pytest
from pyspark.sql import functions as F

from gridmend.operators import checks
from helpers import noleap_series


def year_of(spark, value, name, lat=0.0, n=365, first=1950):
    return noleap_series(spark, first, n, value, name).withColumn("lat", F.lit(float(lat)))


def rules(cube, variable, data_type="downscaled", **options):
    return {r["rule"] for r in checks.validation_report(cube, variable, data_type, **options).collect()}


@pytest.mark.parametrize(
    "variable, value, lat, broken",
    [
        ("tasmax", 300, 0, set()),
        ("tasmin", 130, 0, {"temp_range_min"}),
        ("tasmax", 377, 0, {"temp_range_max"}),
        ("pr", 3000, 0, set()),
        ("pr", 3000.5, 0, {"max_precip"}),
        ("pr", -0.001, 0, set()),
        ("pr", -0.01, 0, {"negative"}),
        ("dtr", 70, 0, set()),
        ("dtr", 70.5, 0, {"dtr_between"}),
        ("dtr", 0, 0, {"dtr_min"}),
        ("dtr", -1, 0, {"dtr_min", "negative"}),
        ("dtr", 99, -75, {"dtr_between"}),
        ("dtr", 100, -75, {"dtr_between", "dtr_south"}),
        ("dtr", 100, 75, {"dtr_between", "dtr_north"}),
        ("dtr", 500, 60, {"dtr_between"}),
    ],
)
def test_limits(spark, variable, value, lat, broken):
    assert rules(year_of(spark, F.lit(value), variable, lat), variable) == broken


def test_raw_model_output_may_have_a_zero_range(spark):
    assert rules(year_of(spark, F.lit(0), "dtr"), "dtr", "cmip6") == set()
    assert rules(year_of(spark, F.lit(5), "dtr", 80), "dtr", allow_empty_band=True) == set()


def test_missing_values_are_reported_by_year(spark):
    holed = year_of(spark, F.when(F.col("id") != 400, 300), "tasmax", n=3 * 365)
    found = checks.validation_report(holed, "tasmax", "downscaled").collect()
    assert [(r["year"], r["rule"], r["observed"]) for r in found] == [(1951, "no_missing", 1.0)]
    nothing = year_of(spark, F.lit(None), "tasmax")
    assert rules(nothing, "tasmax") == {"no_missing", "temp_range_min", "temp_range_max"}


@pytest.mark.parametrize(
    "data_type, period, fewest, most",
    [
        ("cmip6", "future", 35040, 35405),
        ("downscaled", "future", 31025, 31390),
        ("cmip6", "historical", 27740, 27740),
        ("bias_corrected", "historical", 23725, 23725),
    ],
)
def test_number_of_days(spark, data_type, period, fewest, most):
    days = noleap_series(spark, 1950, most + 1, F.lit(300), "tasmax")
    enough = days.filter(F.col("date") < days.select(F.sort_array(F.collect_set("date"))[most].alias("d")).first()["d"])
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        checks.check_timesteps(enough, data_type, period)
        checks.check_timesteps(enough.limit(5), data_type, "another period")
    with pytest.warns(UserWarning, match="excess"):
        checks.check_timesteps(days, data_type, period)
    with pytest.raises(AssertionError, match="missing"):
        checks.check_timesteps(days.limit(fewest - 1), data_type, period)


def test_whole_validation(spark):
    good = year_of(spark, F.lit(300), "tasmax", n=23725)
    checks.validate(good, "tasmax", "downscaled", "historical")
    with pytest.raises(AssertionError, match="temp_range_max"):
        checks.validate(good.withColumn("tasmax", F.when(F.year("date") == 1960, 400).otherwise(300)), "tasmax", "downscaled", "historical")
    with pytest.raises(AssertionError, match="not a numeric variable"):
        checks.validate(good, "tasmin", "downscaled", "historical")
    with pytest.raises(ValueError, match="must be one of"):
        checks.validate(good.withColumnRenamed("tasmax", "wind"), "wind", "downscaled", "historical")
    with pytest.raises(ValueError, match="latitude"):
        checks.violations(good.drop("lat"), "tasmax", ["dtr_range"])
    assert good.agg(F.min("date")).first()[0] == dt.date(1950, 1, 1)
