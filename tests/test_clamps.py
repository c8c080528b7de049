import pytest
from pyspark.sql import functions as F

from gridmend.operators import clamps
from helpers import column


@pytest.fixture
def dtr(spark):
    rows = [(0, -90.0, 80.0), (1, -60.0, 80.0), (2, -59.5, 80.0), (3, 0.0, 0.2), (4, 59.5, 70.0), (5, 60.0, 71.0), (6, 0.0, None), (7, 70.0, None)]
    return spark.createDataFrame(rows, "i int, lat double, dtr double")


def test_floor_raises_small_and_missing_values_and_repeats(dtr):
    once = clamps.dtr_floor(dtr, ["dtr"])
    assert column(once, "dtr", "i") == [80, 80, 80, 1, 70, 71, 1, 1]
    assert column(clamps.dtr_floor(once, ["dtr"]), "dtr", "i") == column(once, "dtr", "i")


def test_ceiling_spares_the_poles_and_both_sixtieth_parallels(dtr):
    assert column(clamps.non_polar_dtr_ceiling(dtr, ["dtr"]), "dtr", "i") == [80, 80, 70, 0.2, 70, 71, 70, None]


def test_precipitation_ceiling(spark):
    rows = spark.createDataFrame([(0, 2999.0), (1, 3000.0), (2, 4000.0), (3, None)], "i int, pr double")
    assert column(clamps.precip_ceiling(rows, ["pr"]), "pr", "i") == [2999, 3000, 3000, 3000]


@pytest.mark.parametrize("kind", ["double", "float"])
def test_wet_days_before_adjustment(spark, kind):
    rain = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.lit(-0.1)).cast(kind).alias("pr"))
    out = clamps.wet_day_frequency(rain, "pre", ["id"], seed=3)
    assert out.schema["pr"].dataType == rain.schema["pr"].dataType
    values = column(out, "pr", "id")
    assert set(values[::2]) == {5.0}
    dry = values[1::2]
    assert min(dry) >= 0.5 and max(dry) < 1 and len(set(dry)) > 990 and abs(sum(dry) / len(dry) - 0.75) < 0.02
    assert column(clamps.wet_day_frequency(rain.repartition(7), "pre", ["id"], seed=3), "pr", "id") == values
    assert column(clamps.wet_day_frequency(rain, "pre", ["id"], seed=4), "pr", "id") != values


def test_wet_days_after_adjustment(spark):
    rain = spark.createDataFrame([(0, 0.5), (1, 1.0), (2, 1.5), (3, 0.1), (4, None)], "i int, pr double")
    assert column(clamps.wet_day_frequency(rain, "post"), "pr", "i") == [0, 1, 1.5, 0, 0]
    with pytest.raises(ValueError):
        clamps.wet_day_frequency(rain, "during")


def test_precipitation_units(spark):
    flux = spark.createDataFrame([(1.0,)], "pr double")
    assert clamps.pr_to_mm_day(flux, "kg m-2 s-1").first()["pr"] == 86400
    with pytest.raises(ValueError):
        clamps.pr_to_mm_day(flux, "mm/day")


def test_wet_day_draws_need_keys(spark):
    cube = spark.createDataFrame([(1, 0.1), (2, 0.2)], "id long, pr double")
    with pytest.raises(ValueError):
        clamps.wet_day_pre(cube, [])
    drawn = clamps.wet_day_pre(cube, ["id"]).select("pr").distinct().count()
    assert drawn == 2
