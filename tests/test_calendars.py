import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridmend.functions import timeaxis
from gridmend.operators import calendars, slicing


@pytest.fixture(scope="module")
def two_years(spark):
    """720 days from 1951-01-01 on the 360-day calendar, in two cells."""
    wave = F.sin((F.col("id") % 720) / 719 * 62.8 - 31.4) * 0.5
    return spark.range(1440).select(
        F.floor(F.col("id") / 720).alias("cell"),
        (F.lit(1951) + F.floor(F.col("id") % 720 / 360)).cast("int").alias("year"),
        (F.col("id") % 360).cast("int").alias("day360"),
        wave.alias("v"),
    )


def per_year(cube, condition=None):
    cube = cube if condition is None else cube.filter(condition)
    rows = cube.filter("cell = 0").groupBy(F.year("date").alias("y")).count().collect()
    return {r["y"]: r["count"] for r in rows}


@pytest.mark.parametrize("seed", range(3))
def test_year_lengths_and_inserted_days(two_years, seed):
    standard = calendars.convert_360_day(two_years, ["v"], target="standard", interpolation=None, seed=seed).cache()
    assert per_year(standard) == {1951: 365, 1952: 366}
    assert per_year(standard, "v IS NULL") == {1951: 5, 1952: 6}
    assert standard.filter("cell = 0 AND v IS NULL AND date = '1952-02-29'").count() == 1
    noleap = calendars.convert_360_day(two_years, ["v"], target="noleap", interpolation=None, seed=seed)
    assert per_year(noleap) == {1951: 365, 1952: 365}
    assert per_year(noleap, "v IS NULL") == {1951: 5, 1952: 5}
    gaps = {c: {r["date"] for r in standard.filter(f"cell = {c} AND v IS NULL").collect()} for c in (0, 1)}
    assert gaps[0] == gaps[1]


def test_regular_and_dated_alignment(two_years):
    def gaps(**options):
        out = calendars.convert_360_day(two_years, ["v"], interpolation=None, **options)
        return [r["date"].strftime("%m-%d") for r in out.filter("cell = 0 AND v IS NULL AND year(date) = 1951").orderBy("date").collect()]

    assert gaps(align_on="year") == ["02-06", "04-19", "07-02", "09-12", "11-25"]
    assert gaps(align_on="date") == [f"{m:02d}-31" for m in (1, 3, 5, 7, 8, 10, 12)]
    with pytest.raises(ValueError, match="align_on"):
        gaps(align_on="month")


def test_single_gaps_become_the_mean_of_their_neighbours(two_years):
    gaps = calendars.inserted_mask(calendars.convert_360_day(two_years, ["v"], interpolation=None), ["v"])
    marks = [r["v"] for r in gaps.filter("cell = 0").orderBy("date").collect()]
    filled = calendars.convert_360_day(two_years, ["v"])
    values = [r["v"] for r in filled.filter("cell = 0").orderBy("date").collect()]
    inside = [i for i, m in enumerate(marks) if m and 0 < i < 729 and not marks[i - 1] and not marks[i + 1]]
    assert inside
    for i in inside:
        assert abs(values[i] - (values[i - 1] + values[i + 1]) / 2) < 1e-12


def test_longer_gaps_and_ends(spark):
    days = [dt.date(2001, 1, 1) + dt.timedelta(days=i) for i in range(7)]
    cube = spark.createDataFrame([("a", d, v) for d, v in zip(days, [None, 1.0, None, None, 4.0, 8.0, None])], "cell string, date date, v double")
    out = calendars.interpolate_gaps(cube, ["v"]).orderBy("date").collect()
    assert [r["v"] for r in out] == [None, 1, 2, 3, 4, 8, None]


def test_missing_input_can_be_refused(spark, two_years):
    holed = two_years.withColumn("v", F.when(F.col("day360") > 0, F.col("v")))
    with pytest.raises(Exception, match="missing values"):
        calendars.convert_360_day(holed, ["v"], ignore_missing=False).collect()
    with pytest.raises(ValueError):
        calendars.convert_360_day(two_years.withColumnRenamed("day360", "date"), ["v"])


def test_densify_adds_days_at_ends_and_in_the_middle(spark):
    rows = [("a", dt.date(2004, 2, 27), 1.0), ("a", dt.date(2004, 3, 2), 2.0), ("b", dt.date(2004, 3, 1), 3.0)]
    cube = spark.createDataFrame(rows, "cell string, date date, v double")
    standard = calendars.densify(cube, ["v"])
    assert {r["cell"]: r["count"] for r in standard.groupBy("cell").count().collect()} == {"a": 5, "b": 5}
    noleap = calendars.densify(cube, ["v"], calendar="noleap", time_range=("2004-02-27", "2004-03-03"))
    got = {(r["cell"], r["date"].isoformat()): r["v"] for r in noleap.collect()}
    assert len(got) == 10 and ("a", "2004-02-29") not in got
    assert {k: v for k, v in got.items() if v} == {("a", "2004-02-27"): 1, ("a", "2004-03-02"): 2, ("b", "2004-03-01"): 3}


def test_leap_days_go_once(spark):
    days = spark.range(366).select(F.date_add(F.lit("1952-01-01"), F.col("id").cast("int")).alias("date"))
    once = calendars.remove_leap_days(days)
    assert once.count() == 365 and calendars.remove_leap_days(once).count() == 365
    assert calendars.detect_calendar(days).first()["calendar"] == "standard"
    assert calendars.detect_calendar(once).first()["calendar"] == "noleap"
    numbered = once.select(timeaxis.noleap_doy(F.col("date")).alias("d"), timeaxis.step(F.col("date")).alias("s"), "date")
    assert [r["d"] for r in numbered.orderBy("date").collect()] == list(range(1, 366))
    assert numbered.filter(timeaxis.date_of_step(F.col("s")) != F.col("date")).count() == 0


def test_whole_day_offsets(spark):
    raw = spark.createDataFrame([(0,), (59,), (366,)], "time int")
    dates = lambda calendar: [r["date"].isoformat() for r in calendars.decode_time(raw, "time", dt.date(2000, 1, 1), calendar).collect()]
    assert dates("standard") == ["2000-01-01", "2000-02-29", "2001-01-01"]
    assert dates("noleap") == ["2000-01-01", "2000-03-01", "2001-01-02"]
    rows = calendars.decode_time(raw, "time", dt.date(2000, 1, 1), "360_day").collect()
    assert [(r["year"], r["day360"]) for r in rows] == [(2000, 0), (2000, 59), (2001, 6)]


def test_numbered_days_are_decoded_when_cleaning(spark):
    raw = spark.range(720).select(F.lit(0).alias("cell"), (F.col("id") + 360).alias("time"), F.col("id").cast("double").alias("tas"))
    units = {"time": "days since 1950-01-01 00:00:00"}
    assert per_year(calendars.standardize_gcm(raw, ["tas"], "360_day", units=units)) == {1951: 365, 1952: 365}
    assert per_year(calendars.standardize_gcm(raw, ["tas"], "standard", units=units)) == {1950: 5, 1951: 365, 1952: 349}
    untouched = calendars.standardize_gcm(raw, ["tas"], "standard", units=units, leapday_removal=False)
    assert untouched.columns == raw.columns
    with pytest.raises(ValueError, match="days since"):
        calendars.standardize_gcm(raw, ["tas"], "standard", units={"time": "hours since 1950-01-01"})


def test_cleaning_a_model_run(spark, two_years):
    raw = two_years.withColumnRenamed("v", "pr").withColumns({"member_id": F.lit("r1"), "height": F.lit(2.0)})
    units = {"pr": "kg m-2 s-1"}
    noleap = calendars.standardize_gcm(raw, ["pr"], "360_day", units=units)
    assert noleap.columns == ["cell", "date", "pr"] and per_year(noleap) == {1951: 365, 1952: 365}
    assert abs(noleap.agg(F.max("pr")).first()[0] - 0.5 * 86400) < 50
    standard = calendars.standardize_gcm(raw, ["pr"], "360_day", units=units, leapday_removal=False)
    assert per_year(standard) == {1951: 365, 1952: 366}
    days = standard.select("date", "cell", F.col("pr").alias("tas"))
    assert per_year(calendars.standardize_gcm(days, ["tas"], "standard")) == {1951: 365, 1952: 365}
    assert per_year(calendars.standardize_gcm(days, ["tas"], "standard", leapday_removal=False)) == {1951: 365, 1952: 366}
    with pytest.raises(ValueError):
        calendars.standardize_gcm(raw, ["pr"], "360_day", units={"pr": "mm"})
    two_members = raw.withColumn("member_id", (F.col("day360") % 2).cast("string"))
    with pytest.raises(Exception, match="more than one value"):
        slicing.squeeze_cruft(two_members).collect()


def filled_plainly(rows):
    """Linear interpolation of (day, value) rows, one after the other."""
    known = [(d, v) for d, v in rows if v is not None]
    out = []
    for d, v in rows:
        before = [k for k in known if k[0] < d]
        after = [k for k in known if k[0] > d]
        if v is None and before and after:
            (d0, v0), (d1, v1) = before[-1], after[0]
            v = v0 + (v1 - v0) * ((d - d0).days / (d1 - d0).days)
        out.append((d, v))
    return out


def test_one_long_series_is_filled_by_blocks(spark):
    """Gaps within, over and as long as blocks, in a cube without cells and in cells with a NULL key."""
    import random

    rnd = random.Random(3)
    days = [dt.date(1900, 1, 1) + dt.timedelta(days=i) for i in range(0, 40_000, 37)]
    rows = [(d, rnd.uniform(-5, 5) if rnd.random() < 0.3 and not dt.date(1930, 1, 1) < d < dt.date(1960, 1, 1) else None) for d in days]
    want = {d: v for d, v in filled_plainly(rows)}
    series = spark.createDataFrame(rows, "date date, v double").repartition(5)
    out = calendars.interpolate_gaps(series, ["v"], [])
    found = {r["date"]: r["v"] for r in out.collect()}
    assert found.keys() == want.keys()
    assert all((found[d] is None) == (want[d] is None) and (want[d] is None or abs(found[d] - want[d]) < 1e-9) for d in want)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(_block" in plan and plan.count("SinglePartition") == 1  # the row per block, not the days
    cells = spark.createDataFrame([(c, d, v) for c in (None, 1) for d, v in rows], "cell int, date date, v double")
    found = {(r["cell"], r["date"]): r["v"] for r in calendars.interpolate_gaps(cells, ["v"]).collect()}
    assert len(found) == 2 * len(rows) and all(found[None, d] == found[1, d] for d in days)


def test_days_of_a_series_without_cells_are_added_over_blocks(spark):
    rows = [(dt.date(1950, 6, 1), 1.0, None), (dt.date(1990, 6, 1), 2.0, 5.0), (dt.date(1990, 6, 3), None, 6.0)]
    cube = spark.createDataFrame(rows, "date date, v double, w double")
    dense = calendars.densify(cube, ["v", "w"], [], "noleap", ("1950-01-01", "1999-12-31"))
    assert dense.count() == 50 * 365 and dense.filter("v IS NOT NULL").count() == 2 and dense.filter("w IS NOT NULL").count() == 2
    assert dense.select("date").distinct().count() == 50 * 365
    at_once = calendars.densify(cube, ["v", "w"], [], "noleap", ("1950-01-01", "1999-12-31"), interpolate=True)
    in_turn = calendars.interpolate_gaps(dense, ["v", "w"], [], "noleap")
    assert at_once.exceptAll(in_turn).isEmpty() and in_turn.exceptAll(at_once).isEmpty() and at_once.filter("v IS NOT NULL").count() == 40 * 365 + 1
    one_year = spark.range(720).select((F.lit(1951) + F.floor(F.col("id") / 360)).cast("int").alias("year"), (F.col("id") % 360).cast("int").alias("day360"), F.col("id").cast("double").alias("tas"))
    clean = calendars.standardize_gcm(one_year, ["tas"], "360_day", [])
    assert clean.columns == ["date", "tas"] and clean.count() == 730
    whole = calendars.convert_360_day(one_year, ["tas"], [], interpolation=None)
    stepwise = calendars.interpolate_gaps(whole, ["tas"], [], "noleap")
    assert clean.exceptAll(stepwise).count() == 0 and stepwise.exceptAll(clean).count() == 0


def test_leftovers_go_by_their_roles(spark):
    for name in ("height", "member_id", "time_bnds"):
        one = spark.createDataFrame([(1, 2.0), (2, 2.0)], f"id int, {name} double")
        two = spark.createDataFrame([(1, 2.0), (2, 3.0)], f"id int, {name} double")
        assert slicing.squeeze_cruft(one, roles={name: "dimension"}).columns == ["id"]
        with pytest.raises(Exception, match="more than one value"):
            slicing.squeeze_cruft(two, roles={name: "dimension"}).collect()
        assert slicing.squeeze_cruft(two, roles={name: "coordinate"}).columns == ["id"]
        kept = slicing.squeeze_cruft(two, roles={name: "variable"})
        assert [r[name] for r in kept.orderBy("id").collect()] == [2.0, 3.0]
    with pytest.raises(ValueError, match="role"):
        slicing.squeeze_cruft(two, roles={"height": "axis"})
