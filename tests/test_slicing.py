import datetime as dt

import pytest

from gridmend.operators import slicing

LATS = [10.5, 7.0, -3.0, 31.0, 24.0]


def grid(spark, lats):
    return spark.createDataFrame([(i, lat, float(i)) for i, lat in enumerate(lats)], "lat_idx int, lat double, v double")


def kept(cube, first, last):
    out = slicing.sel_slice(cube, {"lat": (first, last)}, {"lat": slicing.axis_of(cube, "lat")})
    return sorted(r["lat_idx"] for r in out.collect())


def test_unordered_axis_is_cut_between_positions(spark):
    cube = grid(spark, LATS)
    assert kept(cube, 7.0, 31.0) == [1, 2, 3]
    assert kept(cube, -3.0, 24.0) == [2, 3, 4]
    assert kept(cube, None, 7.0) == [0, 1]
    with pytest.raises(Exception, match="no label"):
        kept(cube, 8.0, 31.0)


def test_ordered_axes_take_labels_between_grid_lines(spark):
    up, down = grid(spark, [1.0, 2.0, 3.0, 4.0]), grid(spark, [4.0, 3.0, 2.0, 1.0])
    assert kept(up, 1.5, 3.0) == [1, 2] and kept(up, 5.0, 6.0) == [] and kept(up, None, None) == [0, 1, 2, 3]
    assert kept(down, 3.0, 1.5) == [1, 2] and kept(down, 1.5, 3.0) == []


def test_positions(spark):
    cube = grid(spark, LATS)
    pick = lambda i, j: sorted(r["lat_idx"] for r in slicing.isel_slice(cube, {"lat": (i, j)}).collect())
    assert pick(1, 3) == [1, 2] and pick(None, -1) == [0, 1, 2, 3] and pick(-2, None) == [3, 4] and pick(2, 2) == []


def test_partial_dates_cover_their_period_and_reach_the_scan(spark, tmp_path):
    days = [(dt.date(1999, 12, 31),), (dt.date(2000, 1, 1),), (dt.date(2000, 12, 31),), (dt.date(2001, 1, 1),)]
    spark.createDataFrame(days, "date date").write.parquet(f"{tmp_path}/days")
    cube = spark.read.parquet(f"{tmp_path}/days")
    assert slicing.sel_year(cube, 2000).count() == 2
    assert slicing.sel_slice(cube, {"date": ("2000-12", "2001")}).count() == 2
    plan = slicing.sel_year(cube, 2000)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2000-01-01)" in plan


def test_column_order(spark):
    assert slicing.reorder_dims(grid(spark, LATS), ["lat", "lat_idx"]).columns == ["lat", "lat_idx", "v"]
    assert slicing.select_variable(grid(spark, LATS), ["v"], ["lat"]).columns == ["lat", "v"]
