"""Stored axes, the calendar they show, priming without rows, and one scan per input."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from gridmend.functions import axes as ax
from gridmend.functions import timeaxis
from gridmend.operators import slicing
from gridmend.operators import regrid as grids
from gridmend.plans import services
from gridmend.sources import attrs, store

KEYS = ["date", "lat_idx", "lon_idx", "lat", "lon"]
LATS, LONS = [30.0, -10.0, 10.0], [5.0, 6.0]


def cube(spark, first="2003-01-01", days=800, leap_days=True):
    at = F.col("id")
    rows = spark.range(days * 6).select(
        F.date_add(F.lit(first), F.floor(at / 6).cast("int")).alias("date"),
        F.floor(at % 6 / 2).cast("int").alias("lat_idx"), (at % 2).cast("int").alias("lon_idx"),
        F.get(F.array(*map(F.lit, LATS)), F.floor(at % 6 / 2).cast("int")).alias("lat"),
        F.get(F.array(*map(F.lit, LONS)), (at % 2).cast("int")).alias("lon"), F.sin(at).alias("v"),
    )
    return rows if leap_days else rows.filter(~timeaxis.is_leap_day(F.col("date")))


def saved(spark, rows, path, **options):
    store.write_cube(rows, path, **options)
    return path


def axes_at(spark, path):
    return store.read_axes(spark, path, store.read_cube(spark, path).schema)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df, *folders):
    """How often a plan reads each of the paths."""
    found = re.findall(r"FileScan parquet .*?Location: \S+ ?\(\d+ paths?\)\[(.*?)[\],]", plan_of(df))
    return [sum(name.rstrip("/").rstrip(".").endswith(os.path.basename(f)) or f in name for name in found) for f in folders]


def test_axes_are_stored_with_their_types(spark, tmp_path):
    axes = axes_at(spark, saved(spark, cube(spark), f"{tmp_path}/c"))
    assert axes.by_dim["lat"] == ax.Axis((0, 1, 2), tuple(LATS)) and axes.by_dim["lon"].labels == tuple(LONS)
    assert axes.time.labels[0] == dt.date(2003, 1, 1) and len(axes.time.labels) == 800 and axes.calendar == "standard"
    unlabelled = cube(spark).select("lat_idx", "v")
    assert axes_at(spark, saved(spark, unlabelled, f"{tmp_path}/u")).by_dim == {"lat": ax.Axis((0, 1, 2), (0, 1, 2))}
    spark.range(3).write.parquet(f"{tmp_path}/foreign")
    assert store.read_axes(spark, f"{tmp_path}/foreign", spark.range(1).schema) is None
    empty = axes_at(spark, saved(spark, cube(spark).limit(0), f"{tmp_path}/e"))
    assert not empty.by_dim and empty.time_range is None


def test_slices_by_stored_axes_reach_the_scan(spark, tmp_path):
    path = saved(spark, cube(spark), f"{tmp_path}/c")
    rows = store.read_cube(spark, path)
    known = axes_at(spark, path).by_dim
    cut = slicing.sel_slice(rows, {"lat": (30.0, -10.0), "time": ("2003-02", "2003-02")}, known)
    assert {r["lat"] for r in cut.select("lat").distinct().collect()} == {30.0, -10.0} and cut.count() == 28 * 4
    assert "GreaterThanOrEqual(lat_idx,0)" in plan_of(cut) and "Subquery" not in plan_of(cut)
    with pytest.raises(ValueError, match="no label"):
        slicing.sel_slice(rows, {"lat": (30.0, 11.0)}, known)
    for first, stop in ((3, 10), (-5, None), (None, 2), (790, 5000), (4, 4), (-5000, 3)):
        want = [dt.date(2003, 1, 1) + dt.timedelta(days=i) for i in range(800)][first:stop]
        for axes in (known, None):
            cut = slicing.isel_slice(rows, {"date": (first, stop)}, axes)
            assert sorted({r["date"] for r in cut.select("date").collect()}) == want
    assert "GreaterThanOrEqual(date,2003-01-04)" in plan_of(slicing.isel_slice(rows, {"time": (3, 10)}, known))
    assert {r["lat_idx"] for r in slicing.isel_slice(rows, {"lat": (-2, None)}, known).collect()} == {1, 2}


def test_calendars_show_in_the_days(spark, tmp_path):
    def found(rows):
        return ax.resolved_calendar(rows, None, None), axes_at(spark, saved(spark, rows, f"{tmp_path}/{os.urandom(4).hex()}")).calendar

    assert found(cube(spark)) == ("standard", "standard")
    assert found(cube(spark, leap_days=False)) == ("noleap", "noleap")
    assert found(cube(spark, days=300)) == (None, None)
    monthly = cube(spark).filter("day(date) = 1")
    assert found(monthly) == (None, None)
    assert ax.resolved_calendar(monthly, None, "365_day") == "noleap" and ax.resolved_calendar(monthly, None, "gregorian") == "standard"
    assert ax.resolved_calendar(spark.range(1).withColumn("day360", F.lit(0)), None, None) == "360_day"
    assert ax.common_calendar(None, "noleap", None) == "noleap" and ax.common_calendar(None) == "standard"
    for wrong in (lambda: ax.common_calendar("noleap", "standard"), lambda: ax.resolved_calendar(monthly, None, "lunar")):
        with pytest.raises(ValueError, match="calendar"):
            wrong()


def test_models_are_trained_and_applied_on_the_calendar_found(spark, tmp_path):
    """Cubes without a calendar attribute: leap days are pooled as day 366, and calendars must agree."""
    root = str(tmp_path)
    hist, ref = (saved(spark, cube(spark, days=1500).withColumn("v", F.lit(v)), f"{root}/{n}") for n, v in (("hist", 3.0), ("ref", 1.0)))
    services.train_qdm(spark, hist, ref, f"{root}/model", "v", "additive", quantiles_n=5, window=5)
    model = store.read_cube(spark, f"{root}/model")
    assert model.filter("doy = 366").count() == 6 and model.count() == 6 * 366
    sim = saved(spark, cube(spark, "2016-01-01", 366), f"{root}/sim")
    services.apply_qdm(spark, sim, f"{root}/model", [2016], "v", f"{root}/out")
    out = store.read_cube(spark, f"{root}/out").join(store.read_cube(spark, sim).withColumnRenamed("v", "raw"), KEYS)
    assert out.count() == 366 * 6 and out.filter("abs(v - raw + 2) > 1e-12").count() == 0
    noleap = saved(spark, cube(spark, "2016-01-01", 700, leap_days=False), f"{root}/noleap")
    with pytest.raises(ValueError, match="different calendars: noleap, standard"):
        services.apply_qdm(spark, noleap, f"{root}/model", [2016], "v", f"{root}/no")
    with pytest.raises(ValueError, match="different calendars"):
        services.train_qdm(spark, hist, noleap, f"{root}/no", "v", "additive")
    short = saved(spark, cube(spark, "2017-01-01", 365), f"{root}/short")  # the same on both calendars
    services.apply_qdm(spark, short, f"{root}/model", [2017], "v", f"{root}/out17")
    assert store.read_cube(spark, f"{root}/out17").count() == 365 * 6


def data_files(path):
    return [name for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet") and "/_" not in folder[len(path) :]]


def test_priming_writes_no_row_and_regions_fill_the_store(spark, tmp_path):
    sim = saved(spark, cube(spark), f"{tmp_path}/sim")
    path, sizes = f"{tmp_path}/out", {"lat": 2}
    services.prime_qdm_output_store(spark, sim, "v", [2004], path, sizes)
    assert data_files(path) == [] and store.region_sizes_of(spark, path) == sizes
    primed = store.read_cube(spark, path)
    whole = cube(spark).filter("year(date) = 2004").drop("v")
    assert primed.select(KEYS).exceptAll(whole).isEmpty() and whole.exceptAll(primed.select(KEYS)).isEmpty()
    assert primed.filter("v IS NULL AND sim_q = 0").count() == 366 * 6 and dict(primed.dtypes)["sim_q"] == "double"
    assert {r[0] for r in primed.select("region_id").distinct().collect()} == {"lat0", "lat1"}
    wanted = cube(spark).filter("year(date) = 2004").withColumn("sim_q", F.lit(0.5))
    store.write_region(wanted.filter("lat_idx = 2"), path, sizes)
    half = store.read_cube(spark, path)
    assert half.count() == 366 * 6 and half.filter("v IS NOT NULL").count() == 366 * 2 and half.filter("lat_idx = 2 AND sim_q = 0.5").count() == 366 * 2
    with pytest.raises(Exception, match="off the axes"):
        store.write_region(cube(spark).withColumn("sim_q", F.lit(0.5)).filter("lat_idx < 2"), path, sizes)
    store.write_region(wanted.filter("lat_idx < 2"), path, sizes)
    full = store.read_cube(spark, path)
    assert full.drop("region_id").exceptAll(wanted.select(*full.drop("region_id").columns)).isEmpty() and full.count() == 366 * 6
    assert "Union" not in plan_of(full) and axes_at(spark, path).time.labels[0] == dt.date(2004, 1, 1)


def test_priming_with_stored_axes_reads_no_data(spark, tmp_path, monkeypatch):
    sim = saved(spark, cube(spark), f"{tmp_path}/sim")
    monkeypatch.setattr(ax, "axes_table", None)  # what would scan the keys
    services.prime_qdm_output_store(spark, sim, "v", [2003, 2004], f"{tmp_path}/a", {"lat": 1})
    services.prime_qplad_output_store(spark, sim, "v", f"{tmp_path}/b", {"lat": 1})
    assert store.read_cube(spark, f"{tmp_path}/b").columns == [*KEYS, "v", "region_id"]


def test_regions_along_time(spark, tmp_path):
    """Independent writes of stretches of time, by positions, fill a store like one write of all."""
    sim = saved(spark, cube(spark, days=100), f"{tmp_path}/sim")
    path = f"{tmp_path}/out"
    services.prime_qplad_output_store(spark, sim, "v", path, {"time": 40, "lat": 2})
    for first in (80, 0, 40):
        part = services.open_dataset(spark, sim, isel={"time": (first, first + 40)})
        assert part.axes.time.positions[-1] == min(39, 99 - first)
        store.write_region(part.cube, path, {"time": 40, "lat": 2})
    out = store.read_cube(spark, path)
    assert {r[0] for r in out.select("region_id").distinct().collect()} == {f"date{i}_lat{j}" for i in range(3) for j in range(2)}
    assert out.drop("region_id").exceptAll(store.read_cube(spark, sim).select(*KEYS, "v")).isEmpty() and out.count() == 600
    monthly = saved(spark, cube(spark).filter("day(date) = 1"), f"{tmp_path}/monthly")
    services.prime_qplad_output_store(spark, monthly, "v", f"{tmp_path}/m", {"time": 12})
    store.write_region(store.read_cube(spark, monthly).filter("year(date) = 2004"), f"{tmp_path}/m", {"time": 12})
    written = store.read_cube(spark, f"{tmp_path}/m").filter("v IS NOT NULL")
    assert {(r["region_id"], r["y"]) for r in written.select("region_id", F.year("date").alias("y")).collect()} == {("date1", 2004)}


def test_cells_that_are_no_product_of_axes(spark, tmp_path):
    """Cells known by an id beside their positions keep their own list."""
    rows = cube(spark, days=5).filter("lat_idx = lon_idx").withColumn("cell", F.concat_ws("-", "lat", "lon"))
    store.prime_qplad_output(rows, "v", f"{tmp_path}/p", {"lat": 1}, ["cell", *KEYS])
    primed = store.read_cube(spark, f"{tmp_path}/p")
    assert primed.count() == 10 and primed.select("cell", *KEYS).exceptAll(rows.select("cell", *KEYS)).isEmpty()


def test_unprimed_stores_find_their_axes_after_a_region(spark, tmp_path):
    for lat in range(2):
        store.write_region(cube(spark, days=3).filter(f"lat_idx = {lat}"), f"{tmp_path}/r", {"lat": 1})
        assert axes_at(spark, f"{tmp_path}/r").by_dim["lat"].positions == tuple(range(lat + 1))


def test_services_scan_each_input_once(spark, tmp_path, monkeypatch):
    """Slices, grids, time ranges and the calendar come from the sidecars."""
    root, plans = str(tmp_path), []
    names = {n: saved(spark, cube(spark, d, n_days), f"{root}/{n}") for n, d, n_days in (("hist", "2003-01-01", 800), ("ref", "2003-01-01", 800), ("sim", "2015-01-01", 1461))}
    real = services._save
    monkeypatch.setattr(services, "_save", lambda out, *rest, **more: (plans.append(out), real(out, *rest, **more)))
    sel, isel = {"lat": (30.0, 10.0)}, {"lon": (0, 1), "time": (0, None)}
    services.train_qdm(spark, names["hist"], names["ref"], f"{root}/model", "v", "+", sel, isel, 10, 5)
    assert scans(plans[-1], names["hist"], names["ref"]) == [1, 1]
    services.apply_qdm(spark, names["sim"], f"{root}/model", [2016], "v", f"{root}/adjusted", sel, isel, half_years=1)
    assert scans(plans[-1], names["sim"], f"{root}/model") == [1, 1]
    domain = grids.axis_table(spark, [0.0, 5.0, 25.0]), grids.axis_table(spark, [5.0, 5.5, 6.0])
    services.regrid(spark, names["sim"], f"{root}/grid", "bilinear", domain)
    assert scans(plans[-1], names["sim"]) == [1] and store.read_cube(spark, f"{root}/grid").count() == 1461 * 9
    services.apply_dtr_floor(spark, names["sim"], f"{root}/floor", -0.5)
    assert scans(plans[-1], names["sim"]) == [1] and axes_at(spark, f"{root}/floor") == axes_at(spark, names["sim"])
    services.remove_leapdays(spark, names["sim"], f"{root}/noleap")
    assert scans(plans[-1], names["sim"]) == [1] and axes_at(spark, f"{root}/noleap").calendar == "noleap"
    fine = saved(spark, cube(spark, "1994-12-01", 31 + 730 + 31), f"{root}/fine")
    coarse = saved(spark, cube(spark, "1994-12-01", 31 + 730 + 31), f"{root}/coarse")
    with pytest.raises(ValueError, match="quantiles_n"):
        services.train_qplad(spark, coarse, fine, f"{root}/no", "v", "+")
    services.train_qplad(spark, coarse, fine, f"{root}/analogs", "v", "+", quantiles_n=10, window=5, sel_slice={"lat": (30.0, 30.0)})
    assert scans(plans[-1], coarse, fine) == [1, 1]


def test_regrid_service_with_weights_and_without_attributes(spark, tmp_path):
    """A lat/lon cube by given weights; other time keys than dates; attributes left out on demand."""
    root = str(tmp_path)
    table = attrs.attrs_table(spark, {"foo": "bar"}).unionByName(attrs.attrs_table(spark, {"calendar": "noleap"}, "time"))
    rows = cube(spark, days=4).withColumn("v", F.col("lat_idx") * 10.0 + F.col("lon_idx"))
    path = saved(spark, rows, f"{root}/in", attrs=table)
    weights = spark.createDataFrame([(1, 1, 0.5), (6, 1, 0.5), (3, 2, 1.0)], "src_cell int, dst_cell int, w double")
    domain = grids.axis_table(spark, [0.0, 1.0]), grids.axis_table(spark, [50.0, 60.0])
    services.regrid(spark, path, f"{root}/out", "bilinear", domain, weights=weights, first_cell=1, keep_attrs=False)
    out = store.read_cube(spark, f"{root}/out")
    found = {(r["lat"], r["lon"]): r["v"] for r in out.filter("date = '2003-01-02'").collect()}
    assert out.count() == 16 and found == {(0.0, 50.0): 10.5, (0.0, 60.0): 10.0, (1.0, 50.0): None, (1.0, 60.0): None}
    assert services.get_attrs(spark, f"{root}/out") == "{}" and services.get_attrs(spark, f"{root}/out", "time") == '{"calendar": "noleap"}'
    on_360 = rows.select(F.lit(2000).alias("year"), F.dayofyear("date").alias("day360"), "lat_idx", "lon_idx", "lat", "lon", "v")
    services.regrid(spark, saved(spark, on_360, f"{root}/360"), f"{root}/out360", "bilinear", (grids.axis_table(spark, [5.0, 15.0]), domain[1]))
    assert store.read_cube(spark, f"{root}/out360").count() == 16


def test_roles_are_stored(spark, tmp_path):
    raw = cube(spark, days=400, leap_days=False).withColumns({"height": F.col("v") * 2, "member_id": F.lit("r1")})
    path = saved(spark, raw, f"{tmp_path}/raw", roles={"height": "variable"})
    services.clean_cmip6(spark, path, f"{tmp_path}/clean")
    clean = store.read_cube(spark, f"{tmp_path}/clean")
    assert "member_id" not in clean.columns and clean.filter("abs(height - 2 * v) > 1e-12").count() == 0 and clean.count() == 2400
    assert store.read_roles(spark, f"{tmp_path}/clean") == {"height": "variable"}
    services.clean_cmip6(spark, saved(spark, raw, f"{tmp_path}/plain"), f"{tmp_path}/clean2")
    assert "height" not in store.read_cube(spark, f"{tmp_path}/clean2").columns
    with pytest.raises(ValueError, match="role"):
        store.write_roles(spark, {"v": "axis"}, path)
