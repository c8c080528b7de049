"""The query catalogue: every operator on a cube derived from whole driver tables, with its expected SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmend.functions import axes, nodes, timeaxis
from gridmend.operators import calendars, checks, clamps, pools, qdm, qplad, quantiles, regrid, slicing, units
from gridmend.plans import cubes
from gridmend.plans import oracles as sql
from gridmend.session import scratch_path
from gridmend.sources import attrs, store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        ORACLES[name] = oracle
        return build

    return register


def rounded(column: str | Column, name: str | None = None) -> Column:
    return F.round(column, 6).alias(name or column)


# --- storage and attributes -------------------------------------------------------------------------


@query("read_cube", "SELECT event_id, user_id, event_type, value FROM events")
def _(spark, sf):
    return store.read_cube(spark, f"{sf}/events.parquet").select("event_id", "user_id", "event_type", "value")


@query("write_cube", f"WITH {sql.DTR} SELECT event_id, date, lat_idx, lat, dtr FROM dtr")
def _(spark, sf):
    path = scratch_path(spark, "write_cube")
    store.write_cube(cubes.dtr(spark, sf), path)
    return store.read_cube(spark, path)


@query(
    "write_region",
    f"""WITH {sql.GRID}, {sql.FULL_GRID}
SELECT date, lat_idx, lon_idx, v, 'lat0' AS region_id FROM grid WHERE lat_idx < 2
UNION ALL SELECT date, lat_idx, lon_idx, NULL, 'lat' || CAST(lat_idx // 2 AS VARCHAR) FROM full_grid WHERE lat_idx >= 2""",
)
def _(spark, sf):
    grid, path = cubes.monthly_grid(spark, sf).drop("src_cell"), scratch_path(spark, "write_region")
    store.prime_qplad_output(grid, "v", path, {"lat": 2}, ["date", "lat_idx", "lon_idx", "lat", "lon"])
    store.write_region(slicing.isel_slice(grid, {"lat": (0, 2)}), path, {"lat": 2})
    return store.read_cube(spark, path).select("date", "lat_idx", "lon_idx", "v", "region_id")


@query(
    "prime_qdm_output",
    f"""WITH {sql.GRID}, {sql.FULL_GRID}
SELECT date, lat_idx, lon_idx, lat, lon, CAST(NULL AS DOUBLE) AS v, CAST(0 AS DOUBLE) AS sim_q,
       'lat' || CAST(lat_idx // 2 AS VARCHAR) AS region_id, CAST(month(date) AS INTEGER) AS month
FROM full_grid WHERE year(date) BETWEEN 1996 AND 1999""",
)
def _(spark, sf):
    grid = cubes.monthly_grid(spark, sf).drop("src_cell").withColumn("month", F.month("date"))
    path = scratch_path(spark, "prime_qdm_output")
    store.prime_qdm_output(
        grid, "v", range(1996, 2000), path, {"lat": 2}, ["date", "lat_idx", "lon_idx", "lat", "lon"],
        variable_dims={"v": ("date", "lat", "lon"), "month": ("date",)},
    )
    months = store.read_cube(spark, f"{path}/_fixed/month")
    return store.read_cube(spark, path).join(months, "date")


@query(
    "prime_qplad_output",
    f"""WITH {sql.GRID}, {sql.FULL_GRID}
SELECT date, lat_idx, lon_idx, lat, lon, CAST(NULL AS DOUBLE) AS v, 'lat' || CAST(lat_idx // 2 AS VARCHAR) AS region_id
FROM full_grid""",
)
def _(spark, sf):
    grid, path = cubes.monthly_grid(spark, sf), scratch_path(spark, "prime_qplad_output")
    store.prime_qplad_output(grid, "v", path, {"lat": 2}, ["date", "lat_idx", "lon_idx", "lat", "lon"])
    return store.read_cube(spark, path)


@query(
    "stored_axes",
    f"""WITH {sql.GRID}
SELECT 'lat' AS dim, lat_idx AS idx, CAST(lat AS VARCHAR) AS label FROM grid GROUP BY ALL
UNION ALL SELECT 'lon', lon_idx, CAST(lon AS VARCHAR) FROM grid GROUP BY ALL
UNION ALL SELECT 'date', CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER), CAST(date AS VARCHAR) FROM (SELECT DISTINCT date FROM grid) AS t
UNION ALL SELECT 'calendar', 0, NULL""",
)
def _(spark, sf):
    grid, path = cubes.monthly_grid(spark, sf).drop("src_cell"), scratch_path(spark, "stored_axes")
    store.write_cube(grid, path)
    return spark.read.schema(store.AXES_SCHEMA).parquet(f"{path}/_axes")


TYPE_COUNTS = """counts AS (
  SELECT row_number() OVER (ORDER BY event_type) - 1 AS pos, event_type AS key, CAST(count(*) AS VARCHAR) AS value,
         CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS first_day
  FROM events GROUP BY event_type)"""


@query("read_attrs", f"WITH {TYPE_COUNTS} SELECT CAST(pos AS INTEGER) AS pos, key, value FROM counts")
def _(spark, sf):
    counts = cubes.table(spark, sf, "events").groupBy("event_type").agg(F.count("*").cast("string").alias("n"))
    entries = F.sort_array(F.collect_list(F.struct("event_type", "n")))
    path = scratch_path(spark, "read_attrs")
    counts.agg(F.to_json(F.map_from_entries(entries)).alias("value")).write.text(path)
    return attrs.read_attrs(spark, path).select("pos", "key", "value")


@query(
    "get_attrs",
    """SELECT event_type AS variable,
  '{"n": "' || count(*) || '", "first_day": "' || CAST(min(ts) AS DATE) || '", "last \\"day\\"": "'
  || CAST(max(ts) AS DATE) || '"}' AS attrs
FROM events GROUP BY event_type""",
)
def _(spark, sf):
    return attrs.attrs_json(cubes.event_attrs(spark, sf))


EVENT_FACTS = """facts AS (
  SELECT event_type AS variable, row_number() OVER (ORDER BY event_type) - 1 AS place, CAST(count(*) AS VARCHAR) AS n,
         CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last_day
  FROM events GROUP BY event_type),
entries AS (
  SELECT variable, place, 0 AS pos, 'n' AS key, n AS value FROM facts
  UNION ALL SELECT variable, place, 1, 'first_day', first_day FROM facts
  UNION ALL SELECT variable, place, 2, 'last "day"', last_day FROM facts)"""


@query(
    "merge_attrs",
    f"""WITH {EVENT_FACTS},
sets AS (
  SELECT 0 AS rank, place AS pos, variable AS key, n AS value FROM facts
  UNION ALL SELECT 1, place, variable || ' since', first_day FROM facts
  UNION ALL SELECT 2, place, variable, last_day FROM facts
  UNION ALL SELECT 3, r_regionkey, r_name, CAST(r_regionkey AS VARCHAR) FROM region)
SELECT CAST(row_number() OVER (ORDER BY min(rank * 1000 + pos)) - 1 AS INTEGER) AS pos, key,
       arg_max(value, rank) AS value
FROM sets GROUP BY key""",
)
def _(spark, sf):
    no_variable = F.lit(None).cast("string").alias("variable")
    facts = cubes.event_attrs(spark, sf)
    place = F.row_number().over(attrs.Window.partitionBy("key").orderBy("variable")) - 1

    def of(fact: str, suffix: str = "") -> DataFrame:
        named = F.concat("variable", F.lit(suffix)).alias("key")
        return facts.withColumn("pos", place).filter(F.col("key") == fact).select(no_variable, "pos", named, "value")

    regions = cubes.table(spark, sf, "region").select(
        no_variable, F.col("r_regionkey").alias("pos"), F.col("r_name").alias("key"), F.col("r_regionkey").cast("string").alias("value")
    )
    return attrs.merge_attrs(of("n"), of("first_day", " since"), of('last "day"'), regions).select("pos", "key", "value")


@query("carry_attrs", f"WITH {EVENT_FACTS} SELECT variable, pos, key, value FROM entries")
def _(spark, sf):
    facts = cubes.event_attrs(spark, sf)
    variables = [r["variable"] for r in facts.select("variable").distinct().collect()]  # one per event type
    as_quantile = facts.withColumn("variable", F.lit("sim_q"))
    return attrs.carry_attrs(facts.unionByName(as_quantile), [*variables, "sim_q"])


@query(
    "merge_attrs_all",
    f"""WITH {EVENT_FACTS},
sets AS (
  SELECT 0 AS rank, place * 3 + pos AS pos, variable || ' ' || key AS key, value FROM entries
  UNION ALL SELECT 1, place, variable || ' n', last_day FROM facts
  UNION ALL SELECT 2, r_regionkey, r_name, CAST(r_regionkey AS VARCHAR) FROM region)
SELECT CAST(row_number() OVER (ORDER BY min(rank * 1000 + pos)) - 1 AS INTEGER) AS pos, key,
       arg_max(value, rank) AS value
FROM sets GROUP BY key""",
)
def _(spark, sf):
    no_variable = F.lit(None).cast("string").alias("variable")
    facts = cubes.event_attrs(spark, sf)
    place = F.row_number().over(attrs.Window.partitionBy("key").orderBy("variable")) - 1
    placed = facts.withColumn("place", place)
    whole = placed.select(no_variable, (F.col("place") * 3 + F.col("pos")).alias("pos"), F.concat_ws(" ", "variable", "key").alias("key"), "value")
    changed = placed.filter("key = 'last \"day\"'").select(
        no_variable, F.col("place").alias("pos"), F.concat("variable", F.lit(" n")).alias("key"), "value"
    )
    regions = cubes.table(spark, sf, "region").select(
        no_variable, F.col("r_regionkey").alias("pos"), F.col("r_name").alias("key"), F.col("r_regionkey").cast("string").alias("value")
    )
    return attrs.merge_attrs(whole, changed, regions).select("pos", "key", "value")


@query("carry_attrs_all", f"WITH {EVENT_FACTS} SELECT variable, pos, key, value FROM entries WHERE variable IN ('click', 'view')")
def _(spark, sf):
    facts = cubes.event_attrs(spark, sf)
    as_quantile = facts.filter(F.col("variable") == "error").withColumn("variable", F.lit("sim_q"))
    return attrs.carry_attrs(facts.unionByName(as_quantile), ["click", "view", "sim_q"])


@query(
    "rechunk",
    f"""WITH {sql.GRID}
SELECT date, lat_idx, lon_idx, v, CAST(lat_idx // 2 AS INTEGER) AS chunk_lat, CAST(lon_idx // 3 AS INTEGER) AS chunk_lon FROM grid""",
)
def _(spark, sf):
    path = scratch_path(spark, "rechunk")
    store.rechunk(cubes.monthly_grid(spark, sf).select("date", "lat_idx", "lon_idx", "v"), {"lat": 2, "lon": 3}, path)
    return store.read_cube(spark, path)


# --- selections -------------------------------------------------------------------------------------


@query(
    "sel_slice",
    f"""WITH {sql.DTR} SELECT event_id, date, lat, dtr FROM dtr
WHERE lat BETWEEN -60 AND 45.5 AND date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
)
def _(spark, sf):
    cube = cubes.dtr(spark, sf)
    cut = slicing.sel_slice(
        cube, {"lat": (-60.0, 45.5), "date": ("2024-01-05", "2024-01-20")}, {"lat": slicing.axis_of(cube, "lat")}
    )
    return cut.select("event_id", "date", "lat", "dtr")


@query(
    "sel_slice_unordered_axis",
    f"""WITH {sql.DTR} SELECT event_id, CAST(lat_idx * 50 % 181 - 90 AS DOUBLE) AS lat, dtr FROM dtr
WHERE lat_idx BETWEEN 20 AND 100""",
)
def _(spark, sf):
    cube = cubes.dtr_shuffled_axis(spark, sf)
    cut = slicing.sel_slice(cube, {"lat": (5.0, 23.0)}, {"lat": slicing.axis_of(cube, "lat")})
    return cut.select("event_id", "lat", "dtr")


@query("isel_slice", f"WITH {sql.DTR} SELECT event_id, lat_idx, dtr FROM dtr WHERE lat_idx >= 10 AND lat_idx < 161")
def _(spark, sf):
    return slicing.isel_slice(cubes.dtr(spark, sf), {"lat": (10, -20)}).select("event_id", "lat_idx", "dtr")


@query(
    "sel_slice_stored_axes",
    f"""WITH {sql.DTR} SELECT event_id, CAST(lat_idx * 50 % 181 - 90 AS DOUBLE) AS lat, dtr FROM dtr
WHERE lat_idx BETWEEN 20 AND 100""",
)
def _(spark, sf):
    path = scratch_path(spark, "sel_slice_stored_axes")
    store.write_cube(cubes.dtr_shuffled_axis(spark, sf), path)
    cube = store.read_cube(spark, path)
    axes = store.read_axes(spark, path, cube.schema)
    return slicing.sel_slice(cube, {"lat": (5.0, 23.0)}, slicing.stored_axes(axes)).select("event_id", "lat", "dtr")


@query(
    "isel_slice_time",
    f"""WITH {sql.DTR} SELECT event_id, date, dtr
FROM (SELECT *, dense_rank() OVER (ORDER BY date) AS up, dense_rank() OVER (ORDER BY date DESC) AS down FROM dtr) AS d WHERE up > 3 AND down > 2""",
)
def _(spark, sf):
    path = scratch_path(spark, "isel_slice_time")
    store.write_cube(cubes.dtr(spark, sf), path)
    cube = store.read_cube(spark, path)
    axes = store.read_axes(spark, path, cube.schema)
    return slicing.isel_slice(cube, {"time": (3, -2)}, slicing.stored_axes(axes)).select("event_id", "date", "dtr")


TEMPERATURE = "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, l_quantity * 8 AS tasmax FROM lineitem"


@query("sel_year", f"{TEMPERATURE} WHERE year(l_shipdate) = 1997")
def _(spark, sf):
    return slicing.sel_year(cubes.temperature(spark, sf), 1997)


@query(
    "sel_year_window",
    f"{TEMPERATURE} WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-12-17' AND DATE '2000-01-15'",
)
def _(spark, sf):
    return qdm.sel_year_window(cubes.temperature(spark, sf), 1998, half_years=1)


@query("select_variable", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(spark, sf):
    return slicing.select_variable(cubes.table(spark, sf, "lineitem"), ["l_quantity"], ["l_orderkey", "l_linenumber"])


@query("squeeze_cruft", f"WITH {sql.DTR} SELECT event_id, date, lat_idx, lat, dtr FROM dtr")
def _(spark, sf):
    raw = cubes.dtr(spark, sf).withColumns({"member_id": F.lit("r1i1p1f1"), "height": F.lit(2.0), "time_bnds": F.col("date")})
    return slicing.squeeze_cruft(raw)


@query("squeeze_cruft_roles", f"WITH {sql.DTR} SELECT event_id, date, lat_idx, lat, dtr, dtr / 2 AS height FROM dtr")
def _(spark, sf):
    raw = cubes.dtr(spark, sf).withColumns({"member_id": F.lit("r1i1p1f1"), "height": F.col("dtr") / 2, "time_bnds": F.array("date", "date")})
    return slicing.squeeze_cruft(raw, roles={"height": slicing.VARIABLE})


@query("cast_values", f"WITH {sql.DTR} SELECT event_id, lat, CAST(dtr AS FLOAT) AS dtr FROM dtr")
def _(spark, sf):
    return clamps.cast_values(cubes.dtr(spark, sf), ["dtr"], "float").select("event_id", "lat", "dtr")


@query("reorder_dims", f"WITH {sql.DTR} SELECT lat, date, event_id, lat_idx, dtr FROM dtr")
def _(spark, sf):
    return slicing.reorder_dims(cubes.dtr(spark, sf), ["lat", "date"])


# --- row-local corrections --------------------------------------------------------------------------


@query(
    "dtr_floor",
    f"WITH {sql.DTR_MISSING} SELECT event_id, date, lat_idx, lat, CASE WHEN dtr >= 1 THEN dtr ELSE 1 END AS dtr FROM dtr",
)
def _(spark, sf):
    return clamps.dtr_floor(cubes.dtr_with_missing(spark, sf), ["dtr"])


@query(
    "non_polar_dtr_ceiling",
    f"""WITH {sql.DTR_MISSING}
SELECT event_id, date, lat_idx, lat, CASE WHEN dtr <= 70 OR lat <= -60 OR lat >= 60 THEN dtr ELSE 70 END AS dtr FROM dtr""",
)
def _(spark, sf):
    return clamps.non_polar_dtr_ceiling(cubes.dtr_with_missing(spark, sf), ["dtr"])


@query(
    "precip_ceiling",
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date,
       CASE WHEN l_extendedprice <= 3000 THEN l_extendedprice ELSE 3000 END AS pr FROM lineitem""",
)
def _(spark, sf):
    return clamps.precip_ceiling(cubes.extreme_precipitation(spark, sf), ["pr"])


@query(
    "wet_day_pre",
    f"""WITH {sql.PRECIPITATION}
SELECT event_id, date, CASE WHEN pr >= 1 THEN pr ELSE 0.5 + 0.5 * {sql.uniform(7, 'event_id')} END AS pr FROM pr""",
)
def _(spark, sf):
    return clamps.wet_day_frequency(cubes.precipitation(spark, sf), "pre", ["event_id"], seed=7)


@query("wet_day_post", f"WITH {sql.PRECIPITATION} SELECT event_id, date, CASE WHEN pr >= 1 THEN pr ELSE 0 END AS pr FROM pr")
def _(spark, sf):
    return clamps.wet_day_frequency(cubes.precipitation(spark, sf), "post")


@query("pr_to_mm_day", f"WITH {sql.PRECIPITATION} SELECT event_id, date, pr * 86400 AS pr FROM pr")
def _(spark, sf):
    return clamps.pr_to_mm_day(cubes.precipitation(spark, sf), "kg m-2 s-1")


SPELLINGS = ("K", "mm d-1", "mm/day", "degC", "kg m-2 s-1", "m/s")
CANONICAL = ("kelvin", "millimeter / day", "millimeter / day", "degree_Celsius", "kilogram / meter ** 2 / second", "meter / second")
CF_STYLE = ("K", "mm d-1", "mm d-1", "degC", "kg m-2 s-1", "m s-1")


def _unit_attrs(spark: SparkSession, sf: str) -> DataFrame:
    """One variable per customer, its units spelled in one of six ways, and an unrelated attribute."""
    spelled = F.get(F.array(*[F.lit(s) for s in SPELLINGS]), (F.col("c_custkey") % 6).cast("int"))
    facts = F.array(cubes.attr(0, "units", spelled), cubes.attr(1, "segment", F.col("c_mktsegment")))
    named = cubes.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("variable"), F.explode(facts).alias("f"))
    return named.select("variable", "f.*")


def _unit_oracle(spellings: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{s}'" for s in spellings)
    return f"""SELECT CAST(c_custkey AS VARCHAR) AS variable, 0 AS pos, 'units' AS key, [{listed}][c_custkey % 6 + 1] AS value FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 1, 'segment', c_mktsegment FROM customer"""


@query("normalise_units", _unit_oracle(CANONICAL))
def _(spark, sf):
    return units.normalise_units(_unit_attrs(spark, sf))


@query("units_to_cf", _unit_oracle(CF_STYLE))
def _(spark, sf):
    return units.units_to_cf(units.normalise_units(_unit_attrs(spark, sf)))


# --- calendars --------------------------------------------------------------------------------------


@query(
    "detect_calendar",
    """SELECT CASE WHEN bool_or(month(l_shipdate) = 2 AND day(l_shipdate) = 29) THEN 'standard' ELSE 'noleap' END AS calendar
FROM lineitem""",
)
def _(spark, sf):
    return calendars.detect_calendar(cubes.temperature(spark, sf))


@query(
    "decode_time",
    f"SELECT o_orderkey, {sql.noleap_date('(1995 + o_custkey // 365)', '(o_custkey % 365 + 1)')} AS date FROM orders",
)
def _(spark, sf):
    raw = cubes.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return calendars.decode_time(raw, "o_custkey", dt.date(1995, 1, 1), timeaxis.NOLEAP)


@query("remove_leap_days", f"{TEMPERATURE} WHERE NOT (month(l_shipdate) = 2 AND day(l_shipdate) = 29)")
def _(spark, sf):
    return calendars.remove_leap_days(cubes.temperature(spark, sf))


@query("convert_360_day", f"WITH {sql.points_360('standard')} SELECT cell, date, v FROM dense")
def _(spark, sf):
    return calendars.convert_360_day(cubes.points_360(spark, sf), ["v"], target=timeaxis.STANDARD, interpolation=None)


@query("convert_360_day_noleap", f"WITH {sql.points_360('noleap')}, {sql.FILLED} SELECT cell, date, round(v, 6) AS v FROM filled")
def _(spark, sf):
    return calendars.convert_360_day(cubes.points_360(spark, sf), ["v"]).withColumn("v", rounded("v"))


@query("convert_360_day_by_year", f"WITH {sql.points_360('noleap', align_on='year')} SELECT cell, date, v FROM dense")
def _(spark, sf):
    return calendars.convert_360_day(cubes.points_360(spark, sf), ["v"], align_on="year", interpolation=None)


@query("convert_360_day_by_date", f"WITH {sql.points_360('standard', align_on='date')} SELECT cell, date, v FROM dense")
def _(spark, sf):
    return calendars.convert_360_day(
        cubes.points_360(spark, sf), ["v"], target=timeaxis.STANDARD, align_on="date", interpolation=None
    )


DENSE_SUPPLIERS = f"""{sql.ENDS}, {sql.series('l_suppkey', False)},
dense AS (
  SELECT c.cell, a.t, l.v
  FROM (SELECT DISTINCT cell FROM line) AS c
  CROSS JOIN (SELECT unnest(generate_series(CAST(lo AS BIGINT), CAST(hi AS BIGINT))) AS t FROM ends) AS a
  LEFT JOIN line AS l ON l.cell = c.cell AND l.s = a.t)"""


@query(
    "interpolate_gaps",
    f"""WITH {DENSE_SUPPLIERS}, {sql.FILLED.replace('cell, date, coalesce', 'cell, t, coalesce')}
SELECT cell, {sql.noleap_date('(t // 365)', '(t % 365 + 1)')} AS date, round(v, 6) AS v FROM filled""",
)
def _(spark, sf):
    sparse = cubes.daily_series(spark, sf, None, "l_suppkey")
    filled = calendars.densify(sparse, ["v"], calendar=timeaxis.NOLEAP, time_range=cubes.ship_days(spark, sf), interpolate=True)
    return filled.withColumn("v", rounded("v"))


@query(
    "interpolate_gaps_series",
    f"""WITH dense AS (
  SELECT 'all' AS cell, date, date - DATE '1970-01-01' AS t, CASE WHEN dayofyear(date) % 10 >= 3 THEN v END AS v
  FROM (SELECT CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS v FROM lineitem GROUP BY ALL) AS d),
{sql.FILLED} SELECT date, round(v, 6) AS v FROM filled""",
)
def _(spark, sf):
    return calendars.interpolate_gaps(cubes.holed_series(spark, sf), ["v"], []).withColumn("v", rounded("v"))


@query("inserted_mask", f"WITH {sql.points_360('noleap')} SELECT cell, date, v IS NULL AS v FROM dense")
def _(spark, sf):
    return calendars.inserted_mask(calendars.convert_360_day(cubes.points_360(spark, sf), ["v"], interpolation=None), ["v"])


@query(
    "require_no_missing",
    """SELECT event_id // 720 AS cell, CAST(1951 + event_id // 360 % 2 AS INTEGER) AS year,
       CAST(event_id % 360 AS INTEGER) AS day360, value AS v FROM events""",
)
def _(spark, sf):
    return calendars.require_no_missing(cubes.points_360(spark, sf), ["v"])


@query(
    "standardize_gcm",
    f"WITH {sql.points_360('noleap')}, {sql.FILLED} SELECT cell, date, round(v * 86400, 4) AS pr FROM filled",
)
def _(spark, sf):
    raw = cubes.points_360(spark, sf).withColumnRenamed("v", "pr").withColumns({"member_id": F.lit("r1i1p1f1"), "height": F.lit(2.0)})
    clean = calendars.standardize_gcm(raw, ["pr"], timeaxis.DAY360, units={"pr": "kg m-2 s-1"})
    return clean.withColumn("pr", F.round("pr", 4))


# --- pools and quantile delta mapping ---------------------------------------------------------------

YEARS = range(1995, 2002)
HALF_YEARS = 1


WHOLE_POOLS = sql.pools(by_status=False)


@query(
    "doy_window_pool",
    f"""WITH {WHOLE_POOLS}
SELECT cell, CAST(doy AS INTEGER) AS doy, CAST(count(v) AS INTEGER) AS n, round(sum(v), 6) AS total, round(min(v), 6) AS lowest, round(max(v), 6) AS highest
FROM members GROUP BY cell, doy""",
)
def _(spark, sf):
    series, ends = cubes.daily_series(spark, sf, None), cubes.ship_days(spark, sf)
    total = F.aggregate("pool", F.lit(0.0), lambda a, x: a + x)
    return pools.doy_window_pool(series, "v", time_range=ends).select(
        "cell", "doy", "n", rounded(total, "total"),
        rounded(F.array_min("pool"), "lowest"), rounded(F.array_max("pool"), "highest"),
    )


@query("noleap_doy", f"WITH {sql.ENDS}, {sql.series()} SELECT cell, side, date, CAST(doy AS INTEGER) AS doy FROM line")
def _(spark, sf):
    both = [cubes.daily_series(spark, sf, s).withColumn("side", F.lit(s)) for s in ("F", "O")]
    rows = both[0].unionByName(both[1])
    return rows.select("cell", "side", "date", timeaxis.noleap_doy(F.col("date")).alias("doy"))


@query(
    "quantile_nodes",
    f"""SELECT l_returnflag AS cell, CAST(i AS INTEGER) AS node, round(q[i + 1], 6) AS q
FROM (SELECT l_returnflag, quantile_cont(l_extendedprice, [{', '.join(repr(p) for p in nodes.node_positions(20))}]) AS q
      FROM lineitem GROUP BY l_returnflag) AS t, (SELECT unnest(generate_series(0, 19)) AS i) AS o""",
)
def _(spark, sf):
    items = cubes.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("cell"), "l_extendedprice")
    found = quantiles.exact_quantiles(items, "l_extendedprice", nodes.node_positions(20), ["cell"])
    return found.withColumn("q", rounded("q"))


def _model(
    spark: SparkSession, sf: str, kind: str, n: int, cell: str = "l_returnflag", value: str = "l_quantity"
) -> DataFrame:
    ends = cubes.ship_days(spark, sf)
    return qdm.train_qdm(
        cubes.daily_series(spark, sf, "F", cell, value), cubes.daily_series(spark, sf, "O", cell, value), "v", kind,
        quantiles_n=n, reference_range=ends, historical_range=ends,
    )


@query(
    "train_qdm",
    f"""WITH {sql.pools()}, {sql.model(100, '+')}
SELECT cell, CAST(doy AS INTEGER) AS doy, CAST(n_hist AS INTEGER) AS n_hist, CAST(n_ref AS INTEGER) AS n_ref, CAST(i AS INTEGER) AS node,
       round(hist_q[i + 1], 7) AS hist_q, round(af[i + 1], 7) AS af
FROM model, (SELECT unnest(generate_series(0, 99)) AS i) AS o""",
)
def _(spark, sf):
    long = _model(spark, sf, "additive", 100).select(
        "cell", "doy", "n_hist", "n_ref", F.posexplode(F.arrays_zip("hist_q", "af")).alias("node", "q")
    )
    hist_q, af = (F.round(f"q.{name}", 7).alias(name) for name in ("hist_q", "af"))
    return long.select("cell", "doy", "n_hist", "n_ref", "node", hist_q, af)


@query(
    "train_qdm_multiplicative",
    f"""WITH {sql.pools(value='l_extendedprice')}, {sql.model(20, '*')}
SELECT cell, CAST(doy AS INTEGER) AS doy, CAST(i AS INTEGER) AS node, round(af[i + 1], 6) AS af
FROM model, (SELECT unnest(generate_series(0, 19)) AS i) AS o""",
)
def _(spark, sf):
    model = _model(spark, sf, "multiplicative", 20, value="l_extendedprice")
    return model.select("cell", "doy", F.posexplode("af").alias("node", "af")).withColumn("af", rounded("af"))


@query(
    "train_qdm_suppliers",
    f"""WITH {sql.pools('l_suppkey')}, {sql.model(20, '+')}
SELECT cell, CAST(doy AS INTEGER) AS doy, CAST(n_hist AS INTEGER) AS n_hist, CAST(n_ref AS INTEGER) AS n_ref,
       round(hist_q[1], 6) AS lowest_q, round(hist_q[20], 6) AS highest_q, round(list_sum(af), 6) AS total_af
FROM model""",
)
def _(spark, sf):
    total = F.aggregate("af", F.lit(0.0), lambda a, x: a + x)
    return _model(spark, sf, "+", 20, "l_suppkey").select(
        "cell", "doy", "n_hist", "n_ref", rounded(F.get("hist_q", F.lit(0)), "lowest_q"),
        rounded(F.get("hist_q", F.lit(19)), "highest_q"), rounded(total, "total_af"),
    )


ALL_SHIP_YEARS = range(1992, 2002)


def _ranked(spark: SparkSession, sf: str, **options) -> DataFrame:
    series, ends = cubes.daily_series(spark, sf, None), cubes.ship_days(spark, sf)
    return qdm.sim_quantile(series, "v", ALL_SHIP_YEARS, half_years=HALF_YEARS, time_range=ends, **options)


def _ranked_sql(same_doy: bool = False) -> str:
    """Ranks of the days of both line statuses."""
    return sql.ranked(ALL_SHIP_YEARS[0], ALL_SHIP_YEARS[-1], HALF_YEARS, same_doy).replace("'O'", "'*'")


RANKED_COLUMNS = "cell, date, rank2 AS sim_rank2, n AS sim_n, round(rank2 / (2.0 * n), 6) AS sim_q"


@query("sim_quantile", f"WITH {WHOLE_POOLS}, {_ranked_sql()} SELECT {RANKED_COLUMNS} FROM ranked")
def _(spark, sf):
    return _ranked(spark, sf).select("cell", "date", "sim_rank2", "sim_n", rounded("sim_q"))


@query(
    "sim_quantile_same_doy",
    f"WITH {WHOLE_POOLS}, {_ranked_sql(True)} SELECT {RANKED_COLUMNS} FROM ranked",
)
def _(spark, sf):
    return _ranked(spark, sf, rank_scope=qdm.SAME_DOY).select("cell", "date", "sim_rank2", "sim_n", rounded("sim_q"))


@query(
    "nearest_node",
    f"""WITH {WHOLE_POOLS}, {_ranked_sql()}
SELECT cell, date, CAST((100 * rank2 - 1) // (2 * n) AS INTEGER) AS node FROM ranked""",
)
def _(spark, sf):
    return qdm.nearest_factor(_ranked(spark, sf), 100).select("cell", "date", "node")


@query(
    "nearest_node_uneven",
    f"""SELECT l_orderkey, l_linenumber, CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS node
FROM (SELECT l_orderkey, l_linenumber, list_transform([{', '.join(repr(((i + 0.5) / 40) ** 2) for i in range(40))}], lambda x: abs(x - (l_quantity - 0.5) / 50)) AS d
      FROM lineitem) AS t""",
)
def _(spark, sf):
    positions = F.array(*[F.lit(((i + 0.5) / 40) ** 2) for i in range(40)])
    node = nodes.nearest_node_uneven((F.col("l_quantity") - 0.5) / 50, positions)
    return cubes.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", node.alias("node"))


# The same with a cell per flag and status.
BOTH_POOLS = sql.pools(sql.FINE_CELL, False)


def _both_ranked(spark: SparkSession, sf: str, **options) -> DataFrame:
    series, ends = cubes.fine_series(spark, sf).drop("coarse_cell"), cubes.ship_days(spark, sf)
    return qdm.sim_quantile(series, "v", ALL_SHIP_YEARS, half_years=HALF_YEARS, time_range=ends, **options)


@query(
    "doy_window_pool_both",
    f"""WITH {BOTH_POOLS}
SELECT cell, CAST(doy AS INTEGER) AS doy, CAST(count(v) AS INTEGER) AS n, round(sum(v), 6) AS total, round(min(v), 6) AS lowest, round(max(v), 6) AS highest
FROM members GROUP BY cell, doy""",
)
def _(spark, sf):
    series, ends = cubes.fine_series(spark, sf).drop("coarse_cell"), cubes.ship_days(spark, sf)
    total = F.aggregate("pool", F.lit(0.0), lambda a, x: a + x)
    return pools.doy_window_pool(series, "v", time_range=ends).select(
        "cell", "doy", "n", rounded(total, "total"),
        rounded(F.array_min("pool"), "lowest"), rounded(F.array_max("pool"), "highest"),
    )


@query("sim_quantile_both", f"WITH {BOTH_POOLS}, {_ranked_sql()} SELECT {RANKED_COLUMNS} FROM ranked")
def _(spark, sf):
    return _both_ranked(spark, sf).select("cell", "date", "sim_rank2", "sim_n", rounded("sim_q"))


@query("sim_quantile_same_doy_both", f"WITH {BOTH_POOLS}, {_ranked_sql(True)} SELECT {RANKED_COLUMNS} FROM ranked")
def _(spark, sf):
    return _both_ranked(spark, sf, rank_scope=qdm.SAME_DOY).select("cell", "date", "sim_rank2", "sim_n", rounded("sim_q"))


@query(
    "nearest_node_both",
    f"""WITH {BOTH_POOLS}, {_ranked_sql()}
SELECT cell, date, CAST((100 * rank2 - 1) // (2 * n) AS INTEGER) AS node FROM ranked""",
)
def _(spark, sf):
    return qdm.nearest_factor(_both_ranked(spark, sf), 100).select("cell", "date", "node")


@query(
    "apply_correction",
    """SELECT l_orderkey, l_linenumber, l_extendedprice + l_discount AS added, l_extendedprice * l_discount AS multiplied FROM lineitem""",
)
def _(spark, sf):
    value, factor = F.col("l_extendedprice"), F.col("l_discount")
    return cubes.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        nodes.apply_correction(value, factor, "additive").alias("added"),
        nodes.apply_correction(value, factor, "multiplicative").alias("multiplied"),
    )


def _adjusted_sql(cell: str, first: int, last: int, n: int, pools_sql: str | None = None) -> str:
    return f"""WITH {pools_sql or sql.pools(cell)}, {sql.model(n, '+')}, {sql.ranked(first, last, HALF_YEARS)}
SELECT r.cell, r.date, round(r.v + m.af[({n} * rank2 - 1) // (2 * n) + 1], 6) AS v, round(rank2 / (2.0 * n), 6) AS sim_q
FROM ranked AS r JOIN model AS m ON r.cell = m.cell AND r.doy = m.doy"""


def adjusted_series(spark: SparkSession, sf: str, cell: str = "l_returnflag", n: int = 100) -> DataFrame:
    """Train on one line status, adjust the other, all years: the flagship."""
    ends = cubes.ship_days(spark, sf)
    out = qdm.apply_qdm(
        cubes.daily_series(spark, sf, "O", cell), _model(spark, sf, "+", n, cell), "v", YEARS, "+",
        half_years=HALF_YEARS, time_range=ends,
    )
    return out.select("cell", "date", rounded("v"), rounded("sim_q"))


@query("apply_qdm", _adjusted_sql("l_returnflag", 1995, 2001, 100))
def _(spark, sf):
    return adjusted_series(spark, sf)


@query("apply_qdm_suppliers", _adjusted_sql("l_suppkey", 1995, 2001, 20))
def _(spark, sf):
    return adjusted_series(spark, sf, "l_suppkey", 20)


def _standard_model(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, str]:
    """Model and simulation on the calendar that their days show."""
    reference, historical = (cubes.daily_series(spark, sf, status, leap_days=True) for status in ("F", "O"))
    calendar = axes.common_calendar(*[axes.resolved_calendar(cube, None, None) for cube in (reference, historical)])
    ends = cubes.ship_days(spark, sf)
    model = qdm.train_qdm(reference, historical, "v", "+", calendar=calendar, reference_range=ends, historical_range=ends)
    return model, historical, calendar


@query(
    "train_qdm_standard",
    f"""WITH {sql.STANDARD_POOLS}, {sql.model(100, '+')}
SELECT cell, CAST(doy AS INTEGER) AS doy, CAST(n_hist AS INTEGER) AS n_hist, CAST(n_ref AS INTEGER) AS n_ref, CAST(i AS INTEGER) AS node,
       round(hist_q[i + 1], 7) AS hist_q, round(af[i + 1], 7) AS af
FROM model, (SELECT unnest(generate_series(0, 99)) AS i) AS o""",
)
def _(spark, sf):
    long = _standard_model(spark, sf)[0].select(
        "cell", "doy", "n_hist", "n_ref", F.posexplode(F.arrays_zip("hist_q", "af")).alias("node", "q")
    )
    hist_q, af = (F.round(f"q.{name}", 7).alias(name) for name in ("hist_q", "af"))
    return long.select("cell", "doy", "n_hist", "n_ref", "node", hist_q, af)


@query("apply_qdm_standard", _adjusted_sql("l_returnflag", 1995, 2001, 100, sql.STANDARD_POOLS))
def _(spark, sf):
    model, simulation, calendar = _standard_model(spark, sf)
    out = qdm.apply_qdm(
        simulation, model, "v", YEARS, "+", half_years=HALF_YEARS, calendar=calendar, time_range=cubes.ship_days(spark, sf)
    )
    return out.select("cell", "date", rounded("v"), rounded("sim_q"))


@query("apply_qdm_year", _adjusted_sql("l_returnflag", 1998, 1998, 100))
def _(spark, sf):
    out = qdm.apply_qdm_year(
        cubes.daily_series(spark, sf, "O"), _model(spark, sf, "+", 100), "v", 1998, "+",
        half_years=HALF_YEARS, time_range=cubes.ship_days(spark, sf),
    )
    return out.select("cell", "date", rounded("v"), rounded("sim_q"))


# --- analog downscaling -----------------------------------------------------------------------------

FULL_YEARS = range(1996, 2001)  # for training
ALL_YEARS = range(1995, 2002)
POOL_SIZE = len(FULL_YEARS) * 31


def _cell_map(spark: SparkSession, sf: str) -> DataFrame:
    """Fine cells and the coarse cell each lies in."""
    items = cubes.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    return items.select(F.concat("l_returnflag", "l_linestatus").alias("cell"), F.col("l_returnflag").alias("coarse_cell"))


def tiled_coarse(spark: SparkSession, sf: str) -> DataFrame:
    """The mean of the fine cells of each coarse cell, on each of them."""
    coarse = qplad.spatial_mean(cubes.fine_series(spark, sf), ["v"], ["coarse_cell", "date"])
    return qplad.broadcast_coarse(coarse, _cell_map(spark, sf))


def _downscaling_model(spark: SparkSession, sf: str, kind: str = "+") -> DataFrame:
    return qplad.train_qplad(
        tiled_coarse(spark, sf), cubes.fine_series(spark, sf), "v", kind,
        quantiles_n=POOL_SIZE, time_range=cubes.ship_days(spark, sf),
    )


@query(
    "train_qplad",
    f"WITH {sql.FINE}, {sql.QPLAD} SELECT cell, CAST(doy AS INTEGER) AS doy, CAST(r - 1 AS INTEGER) AS node, round(af, 6) AS af FROM qplad",
)
def _(spark, sf):
    model = _downscaling_model(spark, sf)
    return model.select("cell", "doy", F.posexplode("af").alias("node", "af")).withColumn("af", rounded("af"))


COARSE_RANKED = f"""ranked AS (
  SELECT t.cell, t.date, t.doy, t.coarse AS v,
         2 * count(*) FILTER (WHERE m.v < t.coarse) + count(*) FILTER (WHERE m.v = t.coarse) + 1 AS rank2, count(*) AS n
  FROM paired AS t
  JOIN (SELECT cell, (s + k) // 365 AS yr, (s + k) % 365 + 1 AS doy, coarse AS v
        FROM paired, (SELECT unnest(generate_series(-15, 15)) AS k) AS o, ends
        WHERE coarse IS NOT NULL AND s + k BETWEEN lo AND hi) AS m
    ON m.cell = t.cell AND m.doy = t.doy AND m.yr BETWEEN t.s // 365 - {HALF_YEARS} AND t.s // 365 + {HALF_YEARS}
  WHERE t.coarse IS NOT NULL AND t.s // 365 BETWEEN {ALL_YEARS[0]} AND {ALL_YEARS[-1]}
  GROUP BY t.cell, t.date, t.doy, t.coarse),
scaled AS (
  SELECT k.cell, k.date, k.v + q.af AS v
  FROM ranked AS k JOIN qplad AS q ON q.cell = k.cell AND q.doy = k.doy AND q.r = ({POOL_SIZE} * rank2 - 1) // (2 * n) + 1)"""


def downscaled_series(spark: SparkSession, sf: str, wet_days: bool = False) -> DataFrame:
    simulation = qdm.sim_quantile(
        tiled_coarse(spark, sf), "v", ALL_YEARS, half_years=HALF_YEARS, time_range=cubes.ship_days(spark, sf)
    )
    return qplad.apply_qplad(simulation, _downscaling_model(spark, sf), "v", "+", wet_day_post_correction=wet_days)


@query("apply_qplad", f"WITH {sql.FINE}, {sql.QPLAD}, {COARSE_RANKED} SELECT cell, date, round(v, 6) AS v FROM scaled")
def _(spark, sf):
    return downscaled_series(spark, sf).select("cell", "date", rounded("v"))


@query(
    "apply_qplad_wetday",
    f"""WITH {sql.FINE}, {sql.QPLAD}, {COARSE_RANKED}
SELECT cell, date, round(CASE WHEN v >= 1 THEN v ELSE 0 END, 6) AS v FROM scaled""",
)
def _(spark, sf):
    return downscaled_series(spark, sf, True).select("cell", "date", rounded("v"))


FINE_SERIES = f"WITH {sql.series(sql.FINE_CELL, False)}"


@query(
    "broadcast_coarse",
    f"""{FINE_SERIES}
SELECT c.cell, m.date, round(m.v, 6) AS v
FROM (SELECT substr(cell, 1, 1) AS coarse_cell, date, avg(v) AS v FROM line GROUP BY ALL) AS m
JOIN (SELECT DISTINCT cell FROM line) AS c ON substr(c.cell, 1, 1) = m.coarse_cell""",
)
def _(spark, sf):
    return tiled_coarse(spark, sf).select("cell", "date", rounded("v"))


@query("spatial_mean", f"{FINE_SERIES} SELECT date, round(avg(v), 6) AS v FROM line GROUP BY date")
def _(spark, sf):
    return qplad.spatial_mean(cubes.fine_series(spark, sf), ["v"]).select("date", rounded("v"))


# --- regridding -------------------------------------------------------------------------------------


@query(
    "add_cyclic",
    f"""WITH {sql.GRID}
SELECT date, lat_idx, lon_idx, lon, v FROM grid
UNION ALL SELECT date, lat_idx, 5, lon, v FROM grid WHERE lon_idx = 0""",
)
def _(spark, sf):
    return regrid.add_cyclic(cubes.monthly_grid(spark, sf), "lon").select("date", "lat_idx", "lon_idx", "lon", "v")


def _bilinear(spark: SparkSession, sf: str, **options) -> DataFrame:
    target = (
        regrid.axis_table(spark, [-60 + 20 * i for i in range(7)]),
        regrid.axis_table(spark, [18 + 36 * j for j in range(10)]),
    )
    return regrid.regrid(
        cubes.monthly_grid(spark, sf), cubes.grid_axes(spark), target, ["v"], periodic_lon=True, **options
    )


@query("regrid_bilinear", f"WITH {sql.GRID}, {sql.BILINEAR_WEIGHTS} {sql.REGRIDDED}")
def _(spark, sf):
    return _bilinear(spark, sf).withColumn("v", rounded("v"))


def _conservative(spark: SparkSession, sf: str, dlat: int, dlon: int) -> DataFrame:
    target = regrid.global_axis(spark, -90, 90, dlat), regrid.global_axis(spark, 0, 360, dlon)
    out = regrid.regrid(cubes.monthly_grid(spark, sf), cubes.grid_axes(spark), target, ["v"], regrid.CONSERVATIVE)
    return out.withColumn("v", rounded("v"))


@query("regrid_conservative", f"WITH {sql.GRID}, {sql.conservative_weights(20, 36)} {sql.REGRIDDED}")
def _(spark, sf):
    return _conservative(spark, sf, 20, 36)


@query("regrid_conservative_coarser", f"WITH {sql.GRID}, {sql.conservative_weights(90, 120)} {sql.REGRIDDED}")
def _(spark, sf):
    return _conservative(spark, sf, 90, 120)


@query(
    "apply_weights",
    f"""WITH {sql.GRID}
SELECT g.date, n_regionkey AS dst_cell, CASE WHEN count(*) = max(parts) THEN round(sum(v * 0.2), 6) END AS v
FROM grid AS g JOIN (SELECT *, count(*) OVER (PARTITION BY n_regionkey) AS parts FROM nation) AS n ON g.src_cell = n_nationkey
GROUP BY g.date, n_regionkey""",
)
def _(spark, sf):
    shares = cubes.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("src_cell"), F.col("n_regionkey").alias("dst_cell"), F.lit(0.2).alias("w")
    )
    return regrid.apply_weights(cubes.monthly_grid(spark, sf), shares, ["v"]).withColumn("v", rounded("v"))


@query(
    "apply_weights_grid",
    f"""WITH {sql.GRID},
sums AS (
  SELECT g.date, n_regionkey AS dst_cell, CASE WHEN count(*) = max(parts) THEN round(sum(v * 0.2), 6) END AS v
  FROM grid AS g JOIN (SELECT *, count(*) OVER (PARTITION BY n_regionkey) AS parts FROM nation) AS n
    ON g.lat_idx * 5 + g.lon_idx = n_nationkey
  GROUP BY g.date, n_regionkey)
SELECT t.date, CAST(c // 3 AS INTEGER) AS lat_idx, CAST(c % 3 AS INTEGER) AS lon_idx, CAST(c // 3 * 90 - 45 AS DOUBLE) AS lat,
       CAST(c % 3 * 120 + 60 AS DOUBLE) AS lon, s.v
FROM (SELECT DISTINCT date FROM grid) AS t CROSS JOIN (SELECT unnest(generate_series(0, 5)) AS c) AS d
LEFT JOIN sums AS s ON s.date = t.date AND s.dst_cell = d.c""",
)
def _(spark, sf):
    shares = cubes.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("src_cell"), F.col("n_regionkey").alias("dst_cell"), F.lit(0.2).alias("w")
    )
    target = regrid.global_axis(spark, -90, 90, 90), regrid.global_axis(spark, 0, 360, 120)
    out = regrid.apply_grid_weights(cubes.monthly_grid(spark, sf).drop("src_cell"), shares, 5, target, ["v"])
    return out.withColumn("v", rounded("v"))


@query(
    "regrid_cast_attrs",
    f"WITH {sql.GRID}, {sql.BILINEAR_WEIGHTS}, whole AS ({sql.REGRIDDED}) SELECT * REPLACE (CAST(v AS FLOAT) AS v) FROM whole",
)
def _(spark, sf):
    return _bilinear(spark, sf, astype="float")


# --- validation -------------------------------------------------------------------------------------


@query("check_variable_name", "SELECT l_linestatus, count(l_quantity) AS n FROM lineitem GROUP BY l_linestatus")
def _(spark, sf):
    items = cubes.table(spark, sf, "lineitem")
    checks.check_variable_name(items, "l_quantity")
    return items.groupBy("l_linestatus").agg(F.count("l_quantity").alias("n"))


@query(
    "check_timesteps",
    """SELECT n AS n_steps, 23725 AS min_steps, 23725 AS warn_above,
       CASE WHEN n < 23725 THEN 'missing' WHEN n > 23725 THEN 'excess' ELSE 'ok' END AS status
FROM (SELECT count(DISTINCT CAST(l_shipdate AS DATE)) AS n FROM lineitem) AS t""",
)
def _(spark, sf):
    return checks.timestep_counts(cubes.temperature(spark, sf), "downscaled", "historical")


def _rule_sql(rows: str, *rules: tuple[str, str, str, str]) -> str:
    """One SELECT per rule over yearly metrics: (name, failing condition, observed, bound)."""
    parts = [
        f"SELECT CAST(year AS INTEGER) AS year, '{name}' AS rule, CAST({observed} AS DOUBLE) AS observed, '{bound}' AS bound FROM y WHERE {failed}"
        for name, failed, observed, bound in rules
    ]
    return f"WITH {rows}\n" + "\nUNION ALL ".join(parts)


DTR_YEARS = f"""{sql.DTR_MISSING},
y AS (
  SELECT year(date) AS year, count(*) FILTER (WHERE dtr IS NULL) AS n_missing, min(dtr) AS low,
         max(dtr) FILTER (WHERE lat < -60) AS south, max(dtr) FILTER (WHERE lat > 60) AS north,
         max(dtr) FILTER (WHERE lat > -60 AND lat < 60) AS middle,
         count(*) FILTER (WHERE dtr < 60) AS n_low
  FROM dtr GROUP BY year(date))"""
ITEM_YEARS = """y AS (
  SELECT year(l_shipdate) AS year, min(l_quantity * 8) AS low, max(l_quantity * 8) AS high,
         count(*) FILTER (WHERE l_quantity - 25 < -0.001) AS n_negative,
         count(*) FILTER (WHERE l_extendedprice > 3000) AS n_over, max(l_extendedprice) AS wettest
  FROM lineitem GROUP BY year(l_shipdate))"""
MISSING = ("no_missing", "n_missing > 0", "n_missing", "no missing values")
DTR_RULES = (
    ("dtr_min", "low <= 0", "low", "min > 0"),
    ("dtr_south", "south >= 100", "south", "max < 100 south of -60"),
    ("dtr_north", "north >= 100", "north", "max < 100 north of 60"),
    ("dtr_between", "NOT coalesce(middle <= 70, false)", "middle", "max <= 70 between -60 and 60"),
)


@query("check_no_missing", _rule_sql(DTR_YEARS, MISSING))
def _(spark, sf):
    return checks.violations(cubes.dtr_with_missing(spark, sf), "dtr", ["no_missing"])


@query(
    "check_temp_range",
    _rule_sql(ITEM_YEARS, ("temp_range_min", "NOT low > 130", "low", "min > 130"), ("temp_range_max", "NOT high < 377", "high", "max < 377")),
)
def _(spark, sf):
    return checks.violations(cubes.temperature(spark, sf), "tasmax", ["temp_range"])


@query("check_dtr_range", _rule_sql(DTR_YEARS, *DTR_RULES))
def _(spark, sf):
    return checks.violations(cubes.dtr_with_missing(spark, sf), "dtr", ["dtr_range"])


@query("check_negative", _rule_sql(ITEM_YEARS, ("negative", "n_negative > 0", "n_negative", "no value < -0.001")))
def _(spark, sf):
    anomalies = cubes.temperature(spark, sf).withColumn("tasmax", F.col("tasmax") / 8 - 25)
    return checks.violations(anomalies, "tasmax", ["negative"])


@query("check_max_precip", _rule_sql(ITEM_YEARS, ("max_precip", "n_over > 0", "wettest", "no value > 3000")))
def _(spark, sf):
    return checks.violations(cubes.extreme_precipitation(spark, sf), "pr", ["max_precip"])


# Every tenth value of the two variables from line items is missing.
ITEM_YEARS_MISSING = """y AS (
  SELECT year(l_shipdate) AS year, count(*) FILTER (WHERE l_orderkey % 10 = 0) AS n_missing,
         min(l_quantity * 8) FILTER (WHERE l_orderkey % 10 <> 0) AS low, max(l_quantity * 8) FILTER (WHERE l_orderkey % 10 <> 0) AS high,
         count(*) FILTER (WHERE l_orderkey % 10 <> 0 AND l_extendedprice - 2000 < -0.001) AS n_negative,
         count(*) FILTER (WHERE l_orderkey % 10 <> 0 AND l_extendedprice - 2000 > 3000) AS n_over,
         max(l_extendedprice - 2000) FILTER (WHERE l_orderkey % 10 <> 0) AS wettest
  FROM lineitem GROUP BY year(l_shipdate))"""


def _some_missing(cube: DataFrame, value: Column, name: str) -> DataFrame:
    return cube.withColumn(name, F.when(F.col("l_orderkey") % 10 != 0, value))


PR_RULES = (
    MISSING, ("negative", "n_negative > 0", "n_negative", "no value < -0.001"),
    ("max_precip", "n_over > 0", "wettest", "no value > 3000"),
)
TEMPERATURE_RULES = (
    MISSING, ("temp_range_min", "NOT low > 130", "low", "min > 130"), ("temp_range_max", "NOT high < 377", "high", "max < 377"),
)


def _report(spark: SparkSession, sf: str, variable: str) -> DataFrame:
    """The validation report of one variable."""
    if variable == "dtr":
        cube = cubes.dtr_with_missing(spark, sf)
    elif variable == "pr":
        cube = _some_missing(cubes.extreme_precipitation(spark, sf), F.col("pr") - 2000, "pr")
    else:
        cube = _some_missing(cubes.temperature(spark, sf), F.col("tasmax"), "tasmax")
    return checks.validation_report(cube, variable, "downscaled")


@query(
    "validate",
    " UNION ALL ".join(
        f"SELECT '{name}' AS variable, * FROM ({_rule_sql(years, *rules)}) AS {name}_report"
        for name, years, rules in (
            ("dtr", DTR_YEARS, (MISSING, *DTR_RULES)), ("pr", ITEM_YEARS_MISSING, PR_RULES), ("tasmax", ITEM_YEARS_MISSING, TEMPERATURE_RULES),
        )
    ),
)
def _(spark, sf):
    parts = [_report(spark, sf, name).withColumn("variable", F.lit(name)) for name in ("dtr", "pr", "tasmax")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("validate_pr", _rule_sql(ITEM_YEARS_MISSING, *PR_RULES))
def _(spark, sf):
    return _report(spark, sf, "pr")


@query("validate_tasmax", _rule_sql(ITEM_YEARS_MISSING, *TEMPERATURE_RULES))
def _(spark, sf):
    return _report(spark, sf, "tasmax")
