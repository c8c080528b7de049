"""SQL building blocks of the expected results: the derived cubes and pools, in DuckDB's dialect."""

from __future__ import annotations


def leap(year: str) -> str:
    return f"(({year} % 4 = 0 AND {year} % 100 <> 0) OR {year} % 400 = 0)"


def step(date: str) -> str:
    """Gap-free day number on the noleap calendar."""
    skipped = f"CASE WHEN {leap(f'year({date})')} AND dayofyear({date}) > 59 THEN 1 ELSE 0 END"
    return f"(year({date}) * 365 + dayofyear({date}) - 1 - {skipped})"


def noleap_date(year: str, day: str) -> str:
    skipped = f"CASE WHEN {leap(year)} AND {day} >= 60 THEN 1 ELSE 0 END"
    return f"(make_date({year}, 1, 1) + CAST({day} - 1 + {skipped} AS INTEGER))"


def uniform(seed: int, *key: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in key]])
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / 4294967296.0)"


DTR = """dtr AS (
  SELECT event_id, CAST(ts AS DATE) AS date, CAST(event_id % 181 AS INTEGER) AS lat_idx,
         CAST(event_id % 181 - 90 AS DOUBLE) AS lat, value AS dtr
  FROM events)"""

DTR_MISSING = """dtr AS (
  SELECT event_id, CAST(ts AS DATE) AS date, CAST(event_id % 181 AS INTEGER) AS lat_idx,
         CAST(event_id % 181 - 90 AS DOUBLE) AS lat, CASE WHEN event_id % 97 <> 0 THEN value END AS dtr
  FROM events)"""

PRECIPITATION = "pr AS (SELECT event_id, CAST(ts AS DATE) AS date, value / 50.0 AS pr FROM events)"

ENDS = f"""ends AS (
  SELECT {step('a')} AS lo, {step('b')} AS hi
  FROM (SELECT CAST(min(l_shipdate) AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b FROM lineitem) AS e)"""


def series(cell: str = "l_returnflag", by_status: bool = True, value: str = "l_quantity") -> str:
    """``line``: the daily series with their step and calendar fields."""
    status = "l_linestatus" if by_status else "'*'"
    return f"""line AS MATERIALIZED (
  SELECT *, {step('date')} AS s, {step('date')} // 365 AS yr, {step('date')} % 365 + 1 AS doy
  FROM (SELECT {cell} AS cell, {status} AS side, CAST(l_shipdate AS DATE) AS date, avg({value}) AS v
        FROM lineitem
        WHERE NOT (month(l_shipdate) = 2 AND day(l_shipdate) = 29)
        GROUP BY ALL) AS d)"""


POOLS = """members AS MATERIALIZED (
  SELECT cell, side, (s + k) // 365 AS yr, (s + k) % 365 + 1 AS doy, s, v
  FROM line, (SELECT unnest(generate_series(-15, 15)) AS k) AS o, ends
  WHERE s + k BETWEEN lo AND hi)"""


STANDARD_POOLS = """ends AS (
  SELECT min(CAST(l_shipdate AS DATE)) - DATE '1970-01-01' AS lo, max(CAST(l_shipdate AS DATE)) - DATE '1970-01-01' AS hi FROM lineitem),
line AS MATERIALIZED (
  SELECT *, date - DATE '1970-01-01' AS s, year(date) AS yr, dayofyear(date) AS doy
  FROM (SELECT l_returnflag AS cell, l_linestatus AS side, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS v
        FROM lineitem GROUP BY ALL) AS d),
members AS MATERIALIZED (
  SELECT cell, side, year(DATE '1970-01-01' + CAST(s + k AS INTEGER)) AS yr, dayofyear(DATE '1970-01-01' + CAST(s + k AS INTEGER)) AS doy, s, v
  FROM line, (SELECT CAST(unnest(generate_series(-15, 15)) AS INTEGER) AS k) AS o, ends
  WHERE s + k BETWEEN lo AND hi)"""


def pools(cell: str = "l_returnflag", by_status: bool = True, value: str = "l_quantity") -> str:
    return f"{ENDS},\n{series(cell, by_status, value)},\n{POOLS}"


def model(n: int, kind: str) -> str:
    """``model``: quantiles and factors per (cell, doy) as lists, F against O."""
    nodes = ", ".join(repr((i + 0.5) / n) for i in range(n))
    factor = "p[1] - p[2]" if kind == "+" else "CASE WHEN p[2] <> 0 THEN p[1] / p[2] END"
    return f"""sides AS MATERIALIZED (
  SELECT cell, doy, side, count(*) AS n, quantile_cont(v, [{nodes}]) AS q FROM members GROUP BY cell, doy, side),
model AS MATERIALIZED (
  SELECT h.cell, h.doy, h.n AS n_hist, r.n AS n_ref, h.q AS hist_q,
         [{factor} FOR p IN list_zip(r.q, h.q)] AS af
  FROM sides AS h JOIN sides AS r ON h.cell = r.cell AND h.doy = r.doy AND h.side = 'O' AND r.side = 'F')"""


def ranked(first: int, last: int, half_years: int, same_doy: bool = False) -> str:
    """``ranked``: days of the O series with twice their rank and the size of their pool."""
    members = "(SELECT cell, side, yr, doy, v FROM line)" if same_doy else "members"
    return f"""ranked AS (
  SELECT t.cell, t.date, t.doy, t.v,
         CAST(2 * count(*) FILTER (WHERE m.v < t.v) + count(*) FILTER (WHERE m.v = t.v) + 1 AS BIGINT) AS rank2,
         CAST(count(*) AS INTEGER) AS n
  FROM line AS t JOIN {members} AS m
    ON m.side = 'O' AND m.cell = t.cell AND m.doy = t.doy
   AND m.yr BETWEEN t.yr - {half_years} AND t.yr + {half_years}
  WHERE t.side = 'O' AND t.yr BETWEEN {first} AND {last}
  GROUP BY t.cell, t.date, t.doy, t.v)"""


FINE_CELL = "l_returnflag || l_linestatus"

# Fine cells on the full axis, and the mean of the two that share a return flag as the coarse value of both.
FINE = f"""{ENDS},
{series(FINE_CELL, False)},
paired AS (
  SELECT c.cell, a.s, a.s % 365 + 1 AS doy, {noleap_date('(a.s // 365)', '(a.s % 365 + 1)')} AS date, l.v AS fine,
         avg(l.v) OVER (PARTITION BY substr(c.cell, 1, 1), a.s) AS coarse
  FROM (SELECT DISTINCT cell FROM line) AS c
  CROSS JOIN (SELECT unnest(generate_series(CAST(lo AS BIGINT), CAST(hi AS BIGINT))) AS s FROM ends) AS a
  LEFT JOIN line AS l ON l.cell = c.cell AND l.s = a.s)"""

QPLAD = """pairs AS (
  SELECT cell, (s + k) % 365 + 1 AS doy, s, coarse, fine,
         row_number() OVER (PARTITION BY cell, (s + k) % 365 ORDER BY coarse NULLS LAST, s) AS r
  FROM paired, (SELECT unnest(generate_series(-15, 15)) AS k) AS o, ends
  WHERE (s + k) // 365 > lo // 365 AND (s + k) // 365 < hi // 365),
qplad AS (SELECT cell, doy, r, fine - coarse AS af FROM pairs)"""

GRID = """grid AS (
  SELECT s_nationkey AS src_cell, date, CAST(s_nationkey // 5 AS INTEGER) AS lat_idx,
         CAST(s_nationkey % 5 AS INTEGER) AS lon_idx,
         CAST(s_nationkey // 5 * 40 - 80 AS DOUBLE) AS lat, CAST(s_nationkey % 5 * 72 + 36 AS DOUBLE) AS lon, v
  FROM (SELECT s_nationkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, sum(l_quantity) AS v
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL) AS m)"""

BILINEAR_WEIGHTS = """lat_w AS (
  SELECT d AS lat_to, -60 + 20 * d AS lat, i AS lat_idx,
         1 - abs(-60 + 20 * d - (-80 + 40 * i)) / 40.0 AS wy
  FROM (SELECT unnest(generate_series(0, 6)) AS d) AS a, (SELECT unnest(generate_series(0, 4)) AS i) AS b
  WHERE abs(-60 + 20 * d - (-80 + 40 * i)) < 40),
lon_w AS (
  SELECT d AS lon_to, 18 + 36 * d AS lon, j AS lon_idx,
         1 - least(abs(18 + 36 * d - (36 + 72 * j)), 360 - abs(18 + 36 * d - (36 + 72 * j))) / 72.0 AS wx
  FROM (SELECT unnest(generate_series(0, 9)) AS d) AS a, (SELECT unnest(generate_series(0, 4)) AS j) AS b
  WHERE least(abs(18 + 36 * d - (36 + 72 * j)), 360 - abs(18 + 36 * d - (36 + 72 * j))) < 72)"""


def conservative_weights(dlat: int, dlon: int) -> str:
    """Shares of global target cells of the given sizes that the 36 x 72 degree source cells cover."""
    low, high = f"(-90 + {dlat} * d)", f"(-90 + {dlat} * (d + 1))"
    west, east = f"({dlon} * d)", f"({dlon} * (d + 1))"
    return f"""lat_w AS (
  SELECT d AS lat_to, {low} + {dlat} / 2.0 AS lat, i AS lat_idx,
         (sin(radians(least({high}, -54 + 36 * i))) - sin(radians(greatest({low}, -90 + 36 * i))))
         / (sin(radians({high})) - sin(radians({low}))) AS wy
  FROM (SELECT unnest(generate_series(0, {180 // dlat - 1})) AS d) AS a, (SELECT unnest(generate_series(0, 4)) AS i) AS b
  WHERE least({high}, -54 + 36 * i) > greatest({low}, -90 + 36 * i)),
lon_w AS (
  SELECT d AS lon_to, {west} + {dlon} / 2.0 AS lon, j AS lon_idx,
         (least({east}, 72 + 72 * j) - greatest({west}, 72 * j)) / {dlon}.0 AS wx
  FROM (SELECT unnest(generate_series(0, {360 // dlon - 1})) AS d) AS a, (SELECT unnest(generate_series(0, 4)) AS j) AS b
  WHERE least({east}, 72 + 72 * j) > greatest({west}, 72 * j))"""


# Every cell of the grid's axes on every day of its time axis.
FULL_GRID = """full_grid AS (
  SELECT date, lat_idx, lon_idx, lat, lon
  FROM (SELECT DISTINCT date FROM grid) AS t, (SELECT DISTINCT lat_idx, lat FROM grid) AS y, (SELECT DISTINCT lon_idx, lon FROM grid) AS x)"""

REGRIDDED = """SELECT t.date, CAST(y.lat_to AS INTEGER) AS lat_idx, CAST(x.lon_to AS INTEGER) AS lon_idx,
       CAST(y.lat AS DOUBLE) AS lat, CAST(x.lon AS DOUBLE) AS lon, s.v
FROM (SELECT DISTINCT date FROM grid) AS t CROSS JOIN (SELECT DISTINCT lat_to, lat FROM lat_w) AS y
CROSS JOIN (SELECT DISTINCT lon_to, lon FROM lon_w) AS x
LEFT JOIN (
  SELECT g.date, lat_to, lon_to, CASE WHEN count(*) = max(ny * nx) THEN round(sum(v * wy * wx), 6) END AS v
  FROM grid AS g
  JOIN (SELECT *, count(*) OVER (PARTITION BY lat_to) AS ny FROM lat_w) AS lat_w ON g.lat_idx = lat_w.lat_idx
  JOIN (SELECT *, count(*) OVER (PARTITION BY lon_to) AS nx FROM lon_w) AS lon_w ON g.lon_idx = lon_w.lon_idx
  GROUP BY g.date, lat_to, lon_to) AS s ON s.date = t.date AND s.lat_to = y.lat_to AND s.lon_to = x.lon_to"""


def points_360(target: str, seed: int = 0, align_on: str = "random") -> str:
    """``moved``: 360-day points at their target dates; ``axis``: the full target axis; ``dense``: both."""
    day = "f.i + 1 + (SELECT count(*) FROM draws AS d WHERE d.year = f.year AND d.rm < f.i)"
    if target == "noleap":
        date = noleap_date("year", "day")
        kept = "WHERE NOT (month(date) = 2 AND day(date) = 29)"
    else:
        date = f"(make_date(year, 1, 1) + CAST(day - 1 + CASE WHEN {leap('year')} AND day >= 60 THEN 1 ELSE 0 END AS INTEGER))"
        kept = ""
    moved = f"SELECT cell, {date} AS date, v FROM placed"
    if align_on == "year":
        days = "CAST(round_even((i + 1) * 365 / 360.0, 0) AS BIGINT)"
        moved = f"SELECT cell, {noleap_date('year', days)} AS date, v FROM f360"
    if align_on == "date":
        moved = """SELECT cell, make_date(year, i // 30 + 1, 1) + CAST(i % 30 AS INTEGER) AS date, v FROM f360
  WHERE month(make_date(year, i // 30 + 1, 1) + CAST(i % 30 AS INTEGER)) = i // 30 + 1"""
    return f"""f360 AS (
  SELECT event_id // 720 AS cell, 1951 + (event_id // 360) % 2 AS year, event_id % 360 AS i, value AS v FROM events),
draws AS (
  SELECT year, b, 72 * b + CAST(floor({uniform(seed, 'year', 'b')} * 72) AS BIGINT) AS rm
  FROM (SELECT DISTINCT year FROM f360) AS y, (SELECT unnest(generate_series(0, 4)) AS b) AS o),
placed AS (SELECT cell, year, v, {day} AS day FROM f360 AS f),
moved AS ({moved}),
axis AS (
  SELECT CAST(date AS DATE) AS date FROM (
    SELECT unnest(generate_series(
      (SELECT min(make_date(year, i // 30 + 1, 1)) FROM f360),
      (SELECT last_day(max(make_date(year, i // 30 + 1, 1))) FROM f360), INTERVAL 1 DAY)) AS date) AS g
  {kept}),
dense AS (
  SELECT c.cell, a.date, m.v, row_number() OVER (PARTITION BY c.cell ORDER BY a.date) AS t
  FROM (SELECT DISTINCT cell FROM f360) AS c CROSS JOIN axis AS a
  LEFT JOIN moved AS m ON m.cell = c.cell AND m.date = a.date)"""


FILLED = """around AS (
  SELECT *, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER before AS t0,
            last_value(v IGNORE NULLS) OVER before AS v0,
            first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER after AS t1,
            first_value(v IGNORE NULLS) OVER after AS v1
  FROM dense
  WINDOW before AS (PARTITION BY cell ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         after AS (PARTITION BY cell ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT cell, date, coalesce(v, v0 + (v1 - v0) * (t - t0) / (t1 - t0)) AS v FROM around)"""
