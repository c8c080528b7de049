import json

import pytest
from pyspark.sql import functions as F

from gridmend.operators import regrid as grids
from gridmend.plans import services
from gridmend.sources import attrs, store
from helpers import noleap_series

SIZES = {"lat": 1}


def two_latitudes(spark, first, days, value, name="v", start_doy=1):
    parts = [
        noleap_series(spark, first, days, value(i), name, start_doy).drop("cell").withColumns(
            {"lat_idx": F.lit(i), "lon_idx": F.lit(0), "lat": F.lit(1.0 + i), "lon": F.lit(5.0)}
        )
        for i in range(2)
    ]
    return parts[0].unionByName(parts[1])


def save(spark, cube, path, variable="v", calendar="noleap", **more):
    table = attrs.attrs_table(spark, {"foo": "bar"}).unionByName(attrs.attrs_table(spark, {"units": "K", **more}, variable))
    store.write_cube(cube, path, table.unionByName(attrs.attrs_table(spark, {"calendar": calendar}, "time")))
    return path


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("services"))
    ref = save(spark, two_latitudes(spark, 1995, 3 * 365, lambda i: F.lit(1.0)), f"{root}/ref")
    hist = save(spark, two_latitudes(spark, 1995, 3 * 365, lambda i: F.lit(3.0)), f"{root}/hist")
    sim = save(spark, two_latitudes(spark, 2015, 5 * 365, lambda i: F.sin("id") + i), f"{root}/sim", cell="mean")
    services.train_qdm(spark, hist, ref, f"{root}/model", "v", "additive")
    return root, sim, f"{root}/model"


def rows(spark, path):
    cube = store.read_cube(spark, path)
    return sorted((r["date"], r["lat_idx"], r["v"], r["sim_q"]) for r in cube.collect())


def test_adjusting_carries_attributes(spark, trained):
    root, sim, model = trained
    services.apply_qdm(spark, sim, model, [2016, 2017], "v", f"{root}/all", new_attrs={"foo": "BAR", "more": "1"})
    out = rows(spark, f"{root}/all")
    assert len(out) == 2 * 2 * 365
    expected = {(r["date"], r["lat_idx"]): r["v"] - 2 for r in store.read_cube(spark, sim).collect()}
    assert all(abs(v - expected[(d, i)]) < 1e-12 and 0 < q <= 1 for d, i, v, q in out)
    assert services.get_attrs(spark, f"{root}/all") == '{"foo": "BAR", "more": "1"}'
    assert services.get_attrs(spark, f"{root}/all", "v") == '{"units": "K", "cell": "mean"}'
    assert services.get_attrs(spark, f"{root}/all", "sim_q") == "{}"


def test_regions_give_the_same_as_the_whole(spark, trained):
    root, sim, model = trained
    services.apply_qdm(spark, sim, model, [2016, 2017], "v", f"{root}/whole")
    with open(f"{root}/attrs.json", "w") as f:
        json.dump({"title": "t"}, f)
    services.prime_qdm_output_store(spark, sim, "v", [2016, 2017], f"{root}/parts", SIZES, f"{root}/attrs.json", {"x": "y"})
    for i in range(2):
        services.apply_qdm(
            spark, sim, model, [2016, 2017], "v", f"{root}/parts", isel_slice={"lat": (i, i + 1)}, out_region_sizes=SIZES
        )
    assert rows(spark, f"{root}/parts") == rows(spark, f"{root}/whole")
    assert services.get_attrs(spark, f"{root}/parts") == '{"title": "t", "x": "y"}'


def test_label_slices(spark, trained):
    root, sim, model = trained
    services.apply_qdm(spark, sim, model, [2016], "v", f"{root}/one", sel_slice={"lat": (2.0, 2.0)})
    assert {r[1] for r in rows(spark, f"{root}/one")} == {1}


def test_downscaling(spark, tmp_path):
    root = str(tmp_path)
    fine = two_latitudes(spark, 1994, 2 * 365 + 30, lambda i: 10 + i + F.sin("id"), start_doy=351)
    coarse = fine.withColumn("v", F.col("v") - F.col("lat_idx") + 0.5)
    save(spark, fine, f"{root}/fine")
    save(spark, coarse, f"{root}/coarse")
    services.train_qplad(spark, f"{root}/coarse", f"{root}/fine", f"{root}/model", "v", "additive", quantiles_n=62)
    assert store.read_cube(spark, f"{root}/model").filter(F.size("af") == 62).count() == 730
    save(spark, coarse.filter("year(date) = 1995").withColumn("sim_q", F.lit(0.5)), f"{root}/sim")
    services.apply_qplad(spark, f"{root}/sim", f"{root}/model", "v", f"{root}/out")
    services.prime_qplad_output_store(spark, f"{root}/sim", "v", f"{root}/primed", SIZES)
    services.apply_qplad(spark, f"{root}/sim", f"{root}/model", "v", f"{root}/primed", out_region_sizes=SIZES)
    expected = fine.filter("year(date) = 1995").withColumnRenamed("v", "e")
    for path in (f"{root}/out", f"{root}/primed"):
        both = store.read_cube(spark, path).join(expected, ["date", "lat_idx"])
        assert both.count() == 730 and both.filter(F.abs(F.col("v") - F.col("e")) > 1e-9).count() == 0
    with pytest.raises(ValueError):
        services.train_qplad(spark, f"{root}/coarse", f"{root}/fine", f"{root}/model", "v", "additive")


def test_cleaning_and_corrections(spark, tmp_path):
    root = str(tmp_path)
    days = spark.range(732).select(
        F.date_add(F.lit("1951-01-01"), F.col("id").cast("int")).alias("date"), F.lit(0).alias("lat_idx"), F.lit(0).alias("lon_idx"),
        F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"), (F.col("id") * 10.0).alias("pr"),
    )
    save(spark, days, f"{root}/rain", "pr", "standard")
    services.remove_leapdays(spark, f"{root}/rain", f"{root}/noleap")
    assert store.read_cube(spark, f"{root}/noleap").count() == 731
    assert services.get_attrs(spark, f"{root}/noleap", "time") == '{"calendar": "noleap"}'
    services.adjust_maximum_precipitation(spark, f"{root}/rain", f"{root}/capped")
    services.correct_wet_day_frequency(spark, f"{root}/capped", f"{root}/wet", "post")
    services.apply_dtr_floor(spark, f"{root}/wet", f"{root}/floor", 5.0)
    services.apply_non_polar_dtr_ceiling(spark, f"{root}/floor", f"{root}/ceiling", 100.0)
    ends = store.read_cube(spark, f"{root}/ceiling").agg(F.min("pr"), F.max("pr"), F.count("*")).first()
    assert tuple(ends) == (5.0, 100.0, 732)
    services.rechunk(spark, f"{root}/rain", {"lat": 1}, f"{root}/chunks")
    assert services.get_attrs(spark, f"{root}/chunks", "pr") == '{"units": "K"}'
    with pytest.raises(AssertionError, match="missing time steps"):
        services.validate(spark, f"{root}/rain", "pr", "downscaled", "historical")

    raw = days.withColumn("member_id", F.lit("r1i1p1f1"))
    flux = attrs.attrs_table(spark, {"units": "kg m-2 s-1", "long_name": "rain"}, "pr")
    store.write_cube(raw, f"{root}/raw", flux.unionByName(attrs.attrs_table(spark, {"calendar": "standard"}, "time")))
    services.clean_cmip6(spark, f"{root}/raw", f"{root}/clean")
    clean = store.read_cube(spark, f"{root}/clean")
    assert clean.count() == 731 and "member_id" not in clean.columns
    assert services.get_attrs(spark, f"{root}/clean", "pr") == '{"units": "mm day-1"}'


def test_regridding_keeps_attributes(spark, tmp_path):
    root = str(tmp_path)
    lats, lons = [-60.0, 0.0, 60.0], [45.0, 135.0, 225.0, 315.0]
    cells = [(i, j, lat, lon, lat) for i, lat in enumerate(lats) for j, lon in enumerate(lons)]
    cube = spark.createDataFrame(cells, "lat_idx int, lon_idx int, lat double, lon double, v double")
    save(spark, cube.withColumn("date", F.lit("2000-01-01").cast("date")), f"{root}/in")
    domain = grids.axis_table(spark, [-30.0, 30.0]), grids.axis_table(spark, [0.0, 90.0, 180.0, 270.0])
    services.regrid(spark, f"{root}/in", f"{root}/out", "bilinear", domain, add_cyclic="lon", astype="float")
    out = store.read_cube(spark, f"{root}/out")
    assert out.count() == 8 and out.filter("v != lat").count() == 0 and dict(out.dtypes)["v"] == "float"
    assert services.get_attrs(spark, f"{root}/out") == '{"foo": "bar"}'
