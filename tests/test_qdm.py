import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridmend.functions import nodes, timeaxis
from gridmend.operators import pools, qdm
from helpers import noleap_series

TWENTY_YEARS = 20 * 365


def constant_model(spark, kind, bias):
    ref = noleap_series(spark, 1995, TWENTY_YEARS, F.lit(1.0))
    hist = noleap_series(spark, 1995, TWENTY_YEARS, F.lit(1.0 + bias))
    return qdm.train_qdm(ref, hist, "v", kind)


def test_nodes_leave_out_both_ends(spark):
    up = noleap_series(spark, 1995, TWENTY_YEARS, F.col("id"))
    down = noleap_series(spark, 1995, TWENTY_YEARS, TWENTY_YEARS - 1 - F.col("id"))
    model = qdm.train_qdm(down, up, "v", "+", quantiles_n=100)
    assert model.count() == 365
    assert model.filter((F.size("hist_q") != 100) | (F.size("af") != 100)).count() == 0
    assert 0 < min(nodes.node_positions(100)) and max(nodes.node_positions(100)) < 1


@pytest.mark.parametrize("kind, expected", [("additive", -1.0), ("*", 0.5)])
def test_kind_decides_the_correction(spark, kind, expected):
    simulation = noleap_series(spark, 2015, 100 * 365, F.lit(2.0))
    out = qdm.apply_qdm_year(simulation, constant_model(spark, kind, 3.0), "v", 2026, kind)
    values = [r["v"] for r in out.collect()]
    assert len(values) == 365
    assert all(abs(v - expected) < 1e-12 for v in values)


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        constant_model(spark, "quadratic", 0)


def test_adjusted_year_runs_from_first_to_last_day(spark):
    simulation = noleap_series(spark, 2015, 85 * 365, F.lit(3.0))
    out = qdm.apply_qdm_year(simulation, constant_model(spark, "+", 2.0), "v", 2088, "+")
    ends = out.agg(F.min("date").alias("a"), F.max("date").alias("b"), F.count("*").alias("n")).first()
    assert (ends["a"], ends["b"], ends["n"]) == (dt.date(2088, 1, 1), dt.date(2088, 12, 31), 365)


def test_short_simulation_still_gives_quantiles(spark):
    simulation = noleap_series(spark, 2015, 5 * 365, F.lit(2.0))
    out = qdm.apply_qdm_year(simulation, constant_model(spark, "+", 3.0), "v", 2017, "+")
    assert out.filter((F.col("sim_q") > 0) & (F.col("sim_q") < 1)).count() == 365


def test_constant_pool_has_651_members_and_the_middle_node(spark):
    simulation = noleap_series(spark, 2015, 40 * 365, F.lit(2.0))
    ranked = qdm.nearest_factor(qdm.sim_quantile(simulation, "v", [2035]), 100)
    assert {tuple(r) for r in ranked.select("sim_n", "sim_rank2", "node").collect()} == {(651, 652, 50)}


def gappy_series(spark, calendar):
    """Two cells with ties, missing values and missing days."""
    first = 1995 * 365 if calendar == timeaxis.NOLEAP else (dt.date(1995, 1, 1) - dt.date(1970, 1, 1)).days
    days = spark.range(2 * 4 * 365).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("cell"),
        timeaxis.date_of_step((F.floor(F.col("id") / 2) + first).cast("int"), calendar).alias("date"),
        F.when(F.col("id") % 11 != 3, F.floor(F.rand(5) * 40).cast("double")).alias("v"),
        "id",
    )
    return days.filter(F.col("id") % 17 != 5).drop("id")


def members_by_hand(rows, lo, hi, calendar):
    """(cell, doy) -> [(centre year, value)], straight from the definition."""
    fields = {}
    for s in range(lo, hi + 1):
        if calendar == timeaxis.NOLEAP:
            fields[s] = (s // 365, s % 365 + 1)
        else:
            day = dt.date(1970, 1, 1) + dt.timedelta(days=s)
            fields[s] = (day.year, day.timetuple().tm_yday)
    out = {}
    for r in rows:
        if r["v"] is None:
            continue
        for k in range(-15, 16):
            if r["s"] + k in fields:
                year, doy = fields[r["s"] + k]
                out.setdefault((r["cell"], doy), []).append((year, r["v"]))
    return out, fields


@pytest.mark.parametrize("calendar", [timeaxis.NOLEAP, timeaxis.STANDARD])
def test_pools_ranks_and_quantiles_match_brute_force(spark, calendar):
    cube = gappy_series(spark, calendar)
    rows = cube.withColumn("s", timeaxis.step(F.col("date"), calendar)).collect()
    lo, hi = min(r["s"] for r in rows), max(r["s"] for r in rows)
    expected, fields = members_by_hand(rows, lo, hi, calendar)

    pooled = pools.doy_window_pool(cube, "v", calendar=calendar).collect()
    assert {(r["cell"], r["doy"]): r["pool"] for r in pooled} == {k: sorted(v for _, v in m) for k, m in expected.items()}

    ranked = qdm.sim_quantile(cube, "v", range(1995, 1999), half_years=1, calendar=calendar).collect()
    by_day = {(r["cell"], r["date"]): r for r in ranked}
    assert len(ranked) == len(by_day) == len(rows)
    for r in rows:
        got, (year, doy) = by_day[(r["cell"], r["date"])], fields[r["s"]]
        pool = [v for y, v in expected.get((r["cell"], doy), []) if abs(y - year) <= 1]
        assert got["sim_n"] == len(pool)
        if r["v"] is None:
            assert got["sim_rank2"] is None and got["sim_q"] is None
        else:
            assert got["sim_rank2"] == 2 * sum(v < r["v"] for v in pool) + sum(v == r["v"] for v in pool) + 1
            assert 0 < got["sim_q"] <= 1

    shifted = cube.withColumn("v", F.col("v") * 2 + 1)
    model = qdm.train_qdm(shifted, cube, "v", "+", quantiles_n=20, calendar=calendar)
    long = model.select("cell", "doy", F.posexplode("hist_q").alias("i", "q"))
    exact = F.percentile("v", nodes.quantile_nodes(20))
    again = pools.doy_window_pool(cube, "v", calendar=calendar).select("cell", "doy", F.explode("pool").alias("v"))
    again = again.groupBy("cell", "doy").agg(exact.alias("q")).select("cell", "doy", F.posexplode("q").alias("i", "e"))
    joined = long.join(again, ["cell", "doy", "i"])
    assert joined.count() == long.count()
    assert joined.filter(F.abs(F.col("q") - F.col("e")) > 1e-9).count() == 0
    factors = model.select(F.inline(F.arrays_zip("hist_q", "af")))
    assert factors.filter(F.abs(F.col("af") - F.col("hist_q") - 1) > 1e-9).count() == 0


@pytest.mark.parametrize("window", [1, 245, 301, 731])
def test_windows_of_any_odd_length(spark, window):
    cube = noleap_series(spark, 2000, 3 * 365 + 40, F.col("id") % 97, start_doy=300).withColumn("v", F.when(F.col("v") % 5 > 0, F.col("v")))
    values = [(r["s"], r["v"]) for r in cube.select(timeaxis.step(F.col("date")).alias("s"), "v").orderBy("s").collect()]
    lo, hi = values[0][0], values[-1][0]
    expected = {}
    for s, v in values:
        for centre in range(max(lo, s - window // 2), min(hi, s + window // 2) + 1):
            if v is not None:
                expected.setdefault(centre % 365 + 1, []).append(v)
    found = {r["doy"]: r["pool"] for r in pools.doy_window_pool(cube, "v", window=window).collect()}
    assert found == {d: sorted(vs) for d, vs in expected.items()}
    for wrong in (0, 4, -3):
        with pytest.raises(ValueError, match="odd"):
            pools.doy_window_pool(cube, "v", window=wrong)


def test_same_doy_scope_ranks_among_equal_days(spark):
    cube = noleap_series(spark, 2000, 5 * 365, F.floor(F.col("id") / 365))
    out = qdm.sim_quantile(cube, "v", [2002], half_years=2, rank_scope=qdm.SAME_DOY)
    assert {(r["sim_n"], r["sim_q"]) for r in out.collect()} == {(5, 0.6)}


def test_ratio_to_zero_is_missing(spark):
    zero = noleap_series(spark, 2000, 2 * 365, F.lit(0.0))
    one = noleap_series(spark, 2000, 2 * 365, F.lit(1.0))
    model = qdm.train_qdm(one, zero, "v", "*")
    assert model.filter(F.exists("af", lambda f: f.isNotNull())).count() == 0
    assert qdm.apply_qdm(one, model, "v", [2000], "*").filter("v IS NOT NULL").count() == 0


def test_node_of_a_tie_is_the_lower_one(spark):
    rows = spark.createDataFrame([(58, 100, 29 / 100.0), (2, 1, 1.0), (1, 1000, 0.0005)], "rank2 long, n int, q double")
    picked = rows.select(
        nodes.nearest_node_by_rank(F.col("rank2"), F.col("n"), 100).alias("r"),
        nodes.nearest_node_by_quantile(F.col("q"), 100).alias("q"),
    ).collect()
    assert [tuple(p) for p in picked] == [(28, 28), (99, 99), (0, 0)]


def test_one_shuffle_of_the_simulation(spark):
    cube = noleap_series(spark, 2000, 3 * 365, F.col("id"))
    model = spark.createDataFrame([], "cell string, doy int, n_hist int, n_ref int, hist_q array<double>, af array<double>")
    ends = ("2000-01-01", "2002-12-31")
    plan = qdm.apply_qdm(cube, model, "v", [2001], "+", time_range=ends)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    plan = qdm.train_qdm(cube, cube, "v", "+", reference_range=ends, historical_range=ends)
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def sparse_cells(spark, n_cells):
    """Many cells, one of them NULL, with a few days each, ties and missing values."""
    days = spark.range(n_cells * 40).select(
        F.nullif(F.col("id") % n_cells, F.lit(3)).alias("cell"),
        timeaxis.date_of_step((F.floor(F.col("id") / n_cells) * 17 + F.col("id") % 13 + 1995 * 365).cast("int")).alias("date"),
        F.when(F.col("id") % 11 != 3, (F.col("id") * 7919 % 23).cast("double")).alias("v"),
    )
    return days.filter(F.xxhash64("cell", "date") % 5 != 0)


def test_training_hands_many_cells_to_python_at_once(spark):
    """Batches that cut groups and batches that hold many give the quantiles of the pools, in far fewer calls than groups."""
    cube, name = sparse_cells(spark, 60), "spark.sql.execution.arrow.maxRecordsPerBatch"
    shifted = cube.withColumn("v", F.col("v") * 3 + 1)
    want = pools.doy_window_pool(cube, "v").select("cell", "doy", "n", F.explode("pool").alias("v")).groupBy("cell", "doy")
    want = want.agg(F.max("n").alias("n"), F.percentile("v", nodes.quantile_nodes(5)).alias("q")).collect()
    want = {(r["cell"], r["doy"]): (r["n"], [round(x, 9) for x in r["q"]], [round(2 * x + 1, 9) for x in r["q"]]) for r in want}
    before = spark.conf.get(name)
    try:
        for size in ("7", "10000"):
            spark.conf.set(name, size)
            rows = qdm.train_qdm(shifted, cube, "v", "+", quantiles_n=5).collect()
            assert all(r["n_hist"] == r["n_ref"] for r in rows) and len(rows) == len(want)
            got = {(r["cell"], r["doy"]): (r["n_hist"], [round(x, 9) for x in r["hist_q"]], [round(x, 9) for x in r["af"]]) for r in rows}
            assert got == want
    finally:
        spark.conf.set(name, before)
    calls, groups = (spark.sparkContext.accumulator(0) for _ in range(2))
    rows = cube.select("cell", (F.month("date") % 3).cast("int").alias("_block"), "v")

    def count(table, first):
        calls.add(1)
        groups.add(len(first))
        return table.select(["cell", "_block"]).take(first)

    found = pools.over_groups(rows, ["cell", "_block"], count, "cell long, _block int", 31).collect()
    assert sorted(map(str, found)) == sorted(map(str, rows.select("cell", "_block").distinct().collect()))
    assert groups.value == len(found) > 5 * calls.value


def test_training_refuses_two_values_of_a_day(spark):
    cube = sparse_cells(spark, 20)
    with pytest.raises(Exception, match="two values for one day"):
        qdm.train_qdm(cube, cube.unionAll(cube), "v", "+").collect()
    with pytest.raises(Exception, match="two values for one day"):
        qdm.train_qdm(cube.unionAll(cube), cube, "v", "+").collect()
