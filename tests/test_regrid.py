import pytest
from pyspark.sql import functions as F

from gridmend.operators import regrid


def globe(spark, step, value):
    """A global cube of one day with cells of ``step`` degrees, and its axes."""
    axes = regrid.global_axis(spark, -90, 90, step), regrid.global_axis(spark, 0, 360, step)
    lat = axes[0].select(F.col("idx").alias("lat_idx"), F.col("center").alias("lat"), F.lit(1).alias("k"))
    lon = axes[1].select(F.col("idx").alias("lon_idx"), F.col("center").alias("lon"), F.lit(1).alias("k"))
    cube = lat.join(lon, "k").drop("k").withColumn("date", F.lit("2000-01-01").cast("date"))
    return cube.withColumn("v", value.cast("double")), axes


def area_integral(cube, step):
    band = F.sin(F.radians(F.col("lat") + step / 2)) - F.sin(F.radians(F.col("lat") - step / 2))
    return cube.agg(F.sum(F.col("v") * band * step)).first()[0]


@pytest.mark.parametrize("method", ["bilinear", "conservative"])
@pytest.mark.parametrize("step", [10, 30])
def test_shape_and_constant_field(spark, method, step):
    cube, axes = globe(spark, 20, F.lit(7.0))
    target = regrid.global_axis(spark, -80, 80, step if step == 10 else 40), regrid.global_axis(spark, 0, 360, step)
    out = regrid.regrid(cube, axes, target, ["v"], method, periodic_lon=True)
    assert out.count() == target[0].count() * target[1].count()
    assert out.filter((F.abs(F.col("v") - 7) > 1e-9) | F.col("v").isNull()).count() == 0


@pytest.mark.parametrize("step", [15, 36, 45])
def test_conservative_keeps_the_area_integral(spark, step):
    cube, axes = globe(spark, 20, F.col("lat") * F.sin(F.radians("lon")) + F.col("lon_idx") ** 2)
    target = regrid.global_axis(spark, -90, 90, step), regrid.global_axis(spark, 0, 360, step)
    out = regrid.regrid(cube, axes, target, ["v"], "conservative")
    before, after = area_integral(cube, 20), area_integral(out, step)
    assert abs(before - after) < 1e-9 * abs(before)


def test_bilinear_is_exact_on_a_plane_and_missing_outside(spark):
    cube, axes = globe(spark, 20, 2 * F.col("lat") + 3 * F.col("lon"))
    target = regrid.axis_table(spark, [-85, -80, 13, 80]), regrid.axis_table(spark, [5, 10, 77, 350, 355])
    out = regrid.regrid(cube, axes, target, ["v"])
    inside = (F.abs("lat") <= 80) & F.col("lon").between(10, 350)
    assert out.count() == 20
    assert out.filter(inside & (F.abs(F.col("v") - 2 * F.col("lat") - 3 * F.col("lon")) < 1e-9)).count() == 9
    assert out.filter(~inside & F.col("v").isNull()).count() == 11
    closed = regrid.regrid(cube, axes, target, ["v"], periodic_lon=True)
    at_zero = closed.filter("lat = 13 AND lon = 355").first()["v"]
    assert abs(at_zero - (2 * 13 + 3 * (350 * 0.75 + 10 * 0.25))) < 1e-9


def test_missing_sources_make_missing_targets(spark):
    cube, axes = globe(spark, 30, F.when((F.col("lat_idx") != 2) | (F.col("lon_idx") != 3), 1.0))
    coarse = regrid.global_axis(spark, -90, 90, 60), regrid.global_axis(spark, 0, 360, 60)
    for source in (cube, cube.filter("v IS NOT NULL")):
        out = regrid.regrid(source, axes, coarse, ["v"], "conservative")
        assert [(r["lat_idx"], r["lon_idx"]) for r in out.filter("v IS NULL").collect()] == [(1, 1)]
        assert out.count() == 18


def test_partial_cover_counts_in_full_or_is_renormalised(spark):
    cube, axes = globe(spark, 30, F.lit(6.0))
    half = axes[1].filter("idx < 3")
    target = regrid.global_axis(spark, -90, 90, 90), regrid.axis_table(spark, [60, 300], [0, 120, 360])
    part = cube.filter("lon_idx < 3")
    out = {r["lon_idx"]: r["v"] for r in regrid.regrid(part, (axes[0], half), target, ["v"], "conservative").filter("lat_idx = 0").collect()}
    assert abs(out[0] - 4.5) < 1e-9 and out[1] is None
    whole = regrid.regrid(part, (axes[0], half), target, ["v"], "conservative_normed")
    assert abs(whole.filter("lat_idx = 0 AND lon_idx = 0").first()["v"] - 6) < 1e-9


@pytest.mark.parametrize("kind", ["float", "double"])
def test_type_of_the_output(spark, kind):
    cube, axes = globe(spark, 60, F.lit(1.0))
    out = regrid.regrid(cube, axes, axes, ["v"], astype=kind)
    assert dict(out.dtypes)["v"] == kind
    with pytest.raises(ValueError):
        regrid.regrid(cube, axes, axes, ["v"], "nearest")


def test_cyclic_slice(spark):
    cube, _ = globe(spark, 60, F.col("lon_idx"))
    out = regrid.add_cyclic(cube, "lon")
    assert out.count() == cube.count() + 3
    assert {(r["lon"], r["v"]) for r in out.filter("lon_idx = 6").collect()} == {(30.0, 0.0)}
    with pytest.raises(ValueError):
        regrid.add_cyclic(cube, "depth")


def test_given_weights(spark):
    cube = spark.createDataFrame([("d", 1, 2.0), ("d", 2, 4.0), ("d", 3, None)], "date string, src_cell int, v double")
    weights = spark.createDataFrame([(1, 10, 0.25), (2, 10, 0.75), (2, 11, 0.5), (3, 11, 0.5)], "src_cell int, dst_cell int, w double")
    out = regrid.apply_weights(cube, weights, ["v"])
    assert {r["dst_cell"]: r["v"] for r in out.collect()} == {10: 3.5, 11: None}


def test_one_shuffle_of_the_cube(spark, tmp_path):
    cube, axes = globe(spark, 30, F.lit(1.0))
    cube.write.parquet(f"{tmp_path}/cube")
    steps = spark.range(1).select(F.lit("2000-01-01").cast("date").alias("date"))
    out = regrid.regrid(spark.read.parquet(f"{tmp_path}/cube"), axes, axes, ["v"], time_steps=steps)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1
    assert plan.count("hashpartitioning(date") == 1
    assert "SortMergeJoin" not in plan
    coarse = regrid.global_axis(spark, -90, 90, 60), regrid.global_axis(spark, 0, 360, 60)
    out = regrid.regrid(spark.read.parquet(f"{tmp_path}/cube"), axes, coarse, ["v"], time_steps=steps)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 0 and plan.count("hashpartitioning(date") == 1


@pytest.mark.parametrize("method", ["bilinear", "conservative"])
@pytest.mark.parametrize("step", [10, 60])
def test_every_target_has_a_row_at_every_step(spark, method, step):
    """Absent source rows, a step with a single one and a step without any."""
    cube, axes = globe(spark, 20, F.lit(7.0))
    days = ["2000-01-01", "2000-01-02", "2000-01-03"]
    first = cube.filter("lat_idx < 3")
    second = cube.filter("lat_idx = 8 AND lon_idx = 0").withColumn("date", F.lit(days[1]).cast("date"))
    steps = spark.createDataFrame([(d,) for d in days], "day string").select(F.to_date("day").alias("date"))
    target = regrid.global_axis(spark, -90, 90, step), regrid.global_axis(spark, 0, 360, step)
    sparse = first.unionByName(second)
    size = (180 // step) * (360 // step)
    out = regrid.regrid(sparse, axes, target, ["v"], method, periodic_lon=True, time_steps=steps)
    assert {str(r["date"]): r["count"] for r in out.groupBy("date").count().collect()} == dict.fromkeys(days, size)
    assert out.groupBy("date", "lat_idx", "lon_idx", "lat", "lon").count().filter("count > 1").count() == 0
    known = out.filter("v IS NOT NULL")
    assert known.filter("abs(v - 7) > 1e-9").count() == 0 and known.filter("date = '2000-01-03'").count() == 0
    own_steps = regrid.regrid(sparse, axes, target, ["v"], method, periodic_lon=True)
    assert own_steps.count() == 2 * size and own_steps.filter("v IS NOT NULL").count() == known.count()


def test_weights_on_a_lat_lon_grid(spark):
    """Flat cell numbers from 0 or 1, a target cell without weights, missing and absent sources, a weight off the grid."""
    rows = [(d, i, j, float(10 * i + j)) for d in ("a", "b") for i in range(2) for j in range(3) if (d, i, j) != ("b", 1, 2)]
    cube = spark.createDataFrame(rows, "date string, lat_idx int, lon_idx int, v double")
    target = regrid.axis_table(spark, [5.0, -5.0], [10, 0, -10]), regrid.axis_table(spark, [100.0, 200.0], [50, 150, 250])
    for base in (0, 1):
        weights = [(0, 0, 0.5), (1, 0, 0.5), (5, 1, 1.0), (4, 3, 0.25), (3, 3, 0.75)]
        table = spark.createDataFrame([(s + base, d + base, w) for s, d, w in weights], "src_cell long, dst_cell long, w double")
        out = regrid.apply_grid_weights(cube, table, 3, target, ["v"], first_cell=base)
        found = {(r["date"], r["lat_idx"], r["lon_idx"]): (r["lat"], r["lon"], r["v"]) for r in out.collect()}
        assert len(found) == 8 and found["a", 0, 0] == (5.0, 100.0, 0.5) and found["a", 0, 1] == (5.0, 200.0, 12.0)
        assert found["b", 0, 1][2] is None and found["a", 1, 0] == (-5.0, 100.0, None) and found["b", 1, 1] == (-5.0, 200.0, 10.25)
    off = spark.createDataFrame([(0, 4, 1.0)], "src_cell long, dst_cell long, w double")
    with pytest.raises(Exception, match="beyond the target grid"):
        regrid.apply_grid_weights(cube, off, 3, target, ["v"]).collect()


def test_fine_axes_are_matched_without_comparing_all_lines(spark):
    n = 36_000
    fine = regrid.global_axis(spark, 0, 360, 360 / n)
    other = regrid.global_axis(spark, 0, 360, 360 / (n - 1))
    for weights in (regrid.bilinear_axis_weights(fine, other, 360.0), regrid.conservative_axis_weights(fine, other, 360.0, small=True)):
        assert "NestedLoop" not in weights._jdf.queryExecution().executedPlan().toString()
        sums = weights.groupBy("dst").agg(F.sum("w").alias("w"), F.max("parts").alias("parts"), F.count("*").alias("n"))
        ends = sums.agg(F.count("*"), F.min("w"), F.max("w"), F.max(F.abs(F.col("parts") - F.col("n")))).first()
        assert ends[0] == n - 1 and abs(ends[1] - 1) < 1e-6 and abs(ends[2] - 1) < 1e-6 and ends[3] == 0


def test_axis_weights_against_all_pairs(spark):
    """Source cells with a gap between them, in no order, and targets that touch, span and miss them."""
    lo = [40.0, 0.0, 10.0, 70.0, 15.0]
    hi = [55.0, 10.0, 15.0, 80.0, 30.0]
    source = spark.createDataFrame([(i, (a + b) / 2, a, b) for i, (a, b) in enumerate(zip(lo, hi))], "idx int, center double, lo double, hi double")
    edges = [(-5.0, 0.0), (-5.0, 3.0), (0.0, 10.0), (10.0, 45.0), (30.0, 40.0), (31.0, 39.0), (5.0, 90.0), (80.0, 95.0), (55.0, 70.0)]
    target = spark.createDataFrame([(i, (a + b) / 2, a, b) for i, (a, b) in enumerate(edges)], "idx int, center double, lo double, hi double")
    found = {}
    for r in regrid.conservative_axis_weights(source, target, small=True).collect():
        if r["w"] is not None:
            found[r["dst"], r["src"]] = (round(r["w"], 9), r["parts"])
    want = {}
    for d, (a, b) in enumerate(edges):
        shares = {s: round((min(b, y) - max(a, x)) / (b - a), 9) for s, (x, y) in enumerate(zip(lo, hi)) if min(b, y) > max(a, x)}
        want |= {(d, s): (w, len(shares)) for s, w in shares.items()}
    assert found == want
    centers = sorted((a + b) / 2 for a, b in zip(lo, hi))
    for r in regrid.bilinear_axis_weights(source, target).groupBy("dst", "label").agg(F.sum("w").alias("w"), F.collect_list("src").alias("src")).collect():
        inside = centers[0] <= r["label"] <= centers[-1]
        assert (abs(r["w"] - 1) < 1e-12) if inside else r["w"] is None
