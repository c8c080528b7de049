import json
import math

import pytest
from pyspark.sql import functions as F

from gridmend.operators import units
from gridmend.sources import attrs, store
from gridmend.streaming import rowwise
from gridmend.operators.clamps import dtr_floor

KEYS = ["date", "lat_idx", "lon_idx"]


@pytest.fixture
def cube(spark):
    """Four days on a 4 x 4 grid, with a variable that depends on the date alone."""
    at = F.col("id")
    return spark.range(64).select(
        F.date_add(F.lit("2001-12-30"), (at / 16).cast("int")).alias("date"),
        (at / 4 % 4).cast("int").alias("lat_idx"),
        (at % 4).cast("int").alias("lon_idx"),
        at.cast("float").alias("v"),
        at.cast("double").alias("w"),
        (at / 16).cast("int").alias("index"),
    )


def values(df, *columns):
    return sorted(tuple(r) for r in df.select(*KEYS, *columns).collect())


def test_nan_is_read_as_missing(spark, tmp_path):
    frame = spark.createDataFrame([(1, math.nan), (2, 3.0), (3, None)], "i int, v double")
    store.write_cube(frame, f"{tmp_path}/c")
    assert [r["v"] for r in store.read_cube(spark, f"{tmp_path}/c").orderBy("i").collect()] == [None, 3.0, None]


def test_regions_replace_only_themselves(spark, cube, tmp_path):
    path, sizes = f"{tmp_path}/out", {"lat": 2, "lon": 2}
    dims = {"v": ("date", "lat", "lon"), "w": ("date", "lat", "lon"), "index": ("date",)}
    store.prime_qdm_output(cube, "v", [2002], path, sizes, KEYS, variable_dims=dims)
    primed = store.read_cube(spark, path)
    assert primed.count() == 32 and primed.filter("v IS NULL AND w IS NULL AND sim_q = 0").count() == 32
    assert dict(primed.dtypes)["sim_q"] == "float" and "index" not in primed.columns
    assert spark.read.parquet(f"{path}/_fixed/index").count() == 2

    wanted = cube.filter("year(date) = 2002").withColumn("sim_q", F.lit(0.5).cast("float"))
    corner = wanted.filter("lat_idx < 2 AND lon_idx >= 2")
    for _ in range(2):  # a repeated write changes nothing
        store.write_region(corner, path, sizes, dims)
    written = store.read_cube(spark, path)
    assert values(written.filter("v IS NOT NULL"), "v", "sim_q") == values(corner, "v", "sim_q")
    for rows in (wanted.filter("lat_idx < 2 AND lon_idx < 2"), wanted.filter("lat_idx >= 2")):
        store.write_region(rows, path, sizes, dims)
    assert values(store.read_cube(spark, path), "v", "w", "sim_q") == values(wanted, "v", "w", "sim_q")
    assert spark.read.parquet(f"{path}/_fixed/index").count() == 2


def test_region_writes_keep_the_other_variables(spark, cube, tmp_path):
    """Writing some variables, one after the other, leaves all primed ones in the store, with their types and values."""
    path, sizes = f"{tmp_path}/out", {"lat": 2, "lon": 2}
    labelled = cube.withColumn("lat", F.col("lat_idx") * 10.0)
    store.prime_qdm_output(labelled, "v", [2002], path, sizes, [*KEYS, "lat"])
    columns = set(store.read_cube(spark, path).columns)
    wanted = labelled.filter("year(date) = 2002").withColumn("sim_q", F.lit(0.5))
    corner = wanted.filter("lat_idx < 2 AND lon_idx < 2")
    store.write_region(wanted.select(*KEYS, "v", "sim_q"), path, sizes)  # every region lacks w, index and lat
    after = store.read_cube(spark, path)
    assert set(after.columns) == columns and dict(after.dtypes)["sim_q"] == "float"
    assert values(after, "lat", "v", "sim_q") == values(wanted, "lat", "v", "sim_q") and after.filter("w IS NULL AND index IS NULL").count() == 32
    for _ in range(2):
        store.write_region(corner.select(*KEYS, "w", F.lit(7).alias("extra")), path, sizes)
    after = store.read_cube(spark, path)
    assert set(after.columns) == {*columns, "extra"} and values(after, "lat", "v", "sim_q") == values(wanted, "lat", "v", "sim_q")
    assert values(after.filter("w IS NOT NULL AND extra = 7"), "w") == values(corner, "w")
    with pytest.raises(ValueError, match="date"):
        store.write_region(corner.select("lat_idx", "lon_idx", "v"), path, sizes)


def test_priming_for_downscaling_keeps_the_variable_alone(spark, cube, tmp_path):
    table = attrs.attrs_table(spark, {"a": "1"}).unionByName(attrs.attrs_table(spark, {"units": "K"}, "v"))
    extra = attrs.attrs_table(spark, {"b": "2", "a": "3"})
    store.prime_qplad_output(cube, "v", f"{tmp_path}/p", {"lat": 2}, KEYS, table, new_attrs=extra)
    primed = store.read_cube(spark, f"{tmp_path}/p")
    assert set(primed.columns) == {*KEYS, "v", "region_id"} and primed.filter("v IS NULL").count() == 64
    stored = store.read_cube_attrs(spark, f"{tmp_path}/p")
    assert attrs.get_attrs(stored) == '{"a": "3", "b": "2"}'
    assert attrs.get_attrs(stored, "v") == '{"units": "K"}'


def test_chunks(spark, cube, tmp_path):
    store.rechunk(cube, {"lat": 1, "lon": 3}, f"{tmp_path}/r")
    out = spark.read.parquet(f"{tmp_path}/r")
    assert values(out, "v") == values(cube, "v")
    assert out.select("chunk_lat", "chunk_lon").distinct().count() == 8
    per_file = out.groupBy(F.input_file_name().alias("f")).agg(F.count_distinct("chunk_lat", "chunk_lon").alias("n"))
    assert per_file.filter("n > 1").count() == 0


def test_attributes(spark, tmp_path):
    with open(f"{tmp_path}/attrs.json", "w") as f:
        json.dump({"zebra": "1", "fish": 'ch"ips', "apple": "ü"}, f, indent=2)
    table = attrs.read_attrs(spark, f"{tmp_path}/attrs.json")
    text = attrs.get_attrs(table)
    assert text == json.dumps({"zebra": "1", "fish": 'ch"ips', "apple": "ü"})
    assert json.loads(attrs.attrs_json(table).first()["attrs"]) == json.loads(text)
    merged = attrs.merge_attrs(table, attrs.attrs_table(spark, {"fish": "2", "new": "x"}))
    assert attrs.get_attrs(merged) == json.dumps({"zebra": "1", "fish": "2", "apple": "ü", "new": "x"})
    assert attrs.get_attrs(table, "nothing") == "{}"
    assert store.read_cube_attrs(spark, f"{tmp_path}/none").count() == 0


def test_unit_spellings(spark):
    table = attrs.attrs_table(spark, {"units": "mm d-1", "note": "K"}, "pr").unionByName(attrs.attrs_table(spark, {"units": "degK"}, "t"))
    canonical = units.normalise_units(table, "pr")
    assert attrs.get_attrs(canonical, "pr") == '{"units": "millimeter / day", "note": "K"}'
    assert attrs.get_attrs(canonical, "t") == '{"units": "degK"}'
    assert attrs.get_attrs(units.units_to_cf(canonical), "pr") == '{"units": "mm d-1", "note": "K"}'
    with pytest.raises(Exception, match="unknown unit"):
        units.normalise_units(attrs.attrs_table(spark, {"units": "furlong"}, "pr")).collect()


def test_corrections_run_on_a_stream(spark, cube, tmp_path):
    cube.select(*KEYS, "w").write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    for _ in range(2):  # a restart finds nothing left to do
        stream = rowwise.read_cube_stream(spark, f"{tmp_path}/in", schema, ["w"])
        assert stream.isStreaming
        run = rowwise.correct_stream(stream, lambda c: dtr_floor(c, ["w"], 10.0), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
        run.awaitTermination()
    assert values(spark.read.parquet(f"{tmp_path}/out"), "w") == values(dtr_floor(cube, ["w"], 10.0), "w")
