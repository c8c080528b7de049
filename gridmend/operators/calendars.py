"""Calendar conversion and gap filling.

A cube on the 360-day calendar has no ``date`` column (30 February is not a date) but the integers
``year`` and ``day360``, 0..359 within the year.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmend.functions import timeaxis
from gridmend.functions.draws import keyed_uniform
from gridmend.functions.timeaxis import DAY360, NOLEAP, STANDARD
from gridmend.operators.clamps import pr_to_mm_day
from gridmend.operators.slicing import squeeze_cruft

BLOCK_360 = 72  # days of the 360-day year that share one inserted day
BLOCK_DAYS = 8 * 366  # days of a series that are sorted together


def detect_calendar(cube: DataFrame) -> DataFrame:
    """One row: the ``calendar`` the days of the cube can be on (``noleap`` if no leap day occurs)."""
    if "day360" in cube.columns:
        return cube.agg(F.lit(DAY360).alias("calendar"))
    leap_days = F.count_if(timeaxis.is_leap_day(F.col("date")))
    return cube.agg(F.when(leap_days > 0, STANDARD).otherwise(NOLEAP).alias("calendar"))


def decode_time(cube: DataFrame, number_col: str, origin: dt.date, calendar: str = STANDARD) -> DataFrame:
    """Turn a column of whole days since ``origin`` into ``date`` (or ``year`` and ``day360``)."""
    number = F.col(number_col).cast("int")
    if calendar == STANDARD:
        return cube.withColumn("date", F.date_add(F.lit(origin), number)).drop(number_col)
    if calendar == NOLEAP:
        days = timeaxis.step(F.lit(origin), NOLEAP) + number
        return cube.withColumn("date", timeaxis.date_of_step(days, NOLEAP)).drop(number_col)
    if calendar == DAY360:
        days = timeaxis.step_360(F.lit(origin.year), F.lit(origin.month), F.lit(origin.day)) + number
        year, day = F.floor(days / 360).cast("int"), F.pmod(days, F.lit(360)).cast("int")
        return cube.withColumns({"year": year, "day360": day}).drop(number_col)
    raise ValueError(f"unknown calendar {calendar!r}")


def origin_of(time_units: str) -> dt.date:
    """The origin of ``days since YYYY-MM-DD``, whatever time of day follows."""
    words = time_units.split()
    if words[:2] != ["days", "since"] or len(words) < 3:
        raise ValueError(f"time must count 'days since' a date, got {time_units!r}")
    return dt.date.fromisoformat(words[2].split("T")[0])


def remove_leap_days(cube: DataFrame) -> DataFrame:
    """Standard to noleap: rows of 29 February go, the others keep their dates."""
    return cube.filter(~timeaxis.is_leap_day(F.col("date")))


def densify(
    cube: DataFrame,
    value_cols: Sequence[str],
    cell_cols: Sequence[str] = ("cell",),
    calendar: str = STANDARD,
    time_range: tuple | DataFrame | None = None,
    interpolate: bool = False,
) -> DataFrame:
    """Give every cell a row on every day of the axis, with missing values where it had none.

    ``time_range`` states the ends of the axis (see ``timeaxis.time_axis``). Each row writes out the days up to its successor, so no scaffold is joined.
    ``interpolate`` fills the gaps in the same pass, as ``interpolate_gaps`` would afterwards.
    """
    return _filled(cube, value_cols, cell_cols, calendar, timeaxis.time_axis(cube, time_range), interpolate)


def interpolate_gaps(
    cube: DataFrame,
    value_cols: Sequence[str],
    cell_cols: Sequence[str] = ("cell",),
    calendar: str = STANDARD,
) -> DataFrame:
    """Fill missing values linearly in time between their neighbours; gaps at the ends stay missing."""
    return _filled(cube, value_cols, cell_cols, calendar, None, interpolate=True)


def _filled(cube, value_cols, cell_cols, calendar, axis, interpolate: bool) -> DataFrame:
    """A series per cell (one series without ``cell_cols``) filled in time: the days of ``axis`` it lacks, if given, and missing values.

    A series is cut into blocks of ``BLOCK_DAYS`` that are sorted for themselves, so one long series is
    many tasks. What a block must know of the others, its next first day and the known values nearest to its
    ends, comes from one row per cell and block.
    """
    keys, values = [*cell_cols, "_block"], list(value_cols)
    cells = ", ".join(f"`{c}`" for c in cell_cols)
    by_block = f"OVER ({'PARTITION BY ' + cells if cells else ''} ORDER BY _block)"
    by_day = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY _step)"

    def known(value: str) -> str:
        return f"CASE WHEN `{value}` IS NOT NULL THEN struct(_step AS t, `{value}` AS v) END"

    rows = cube.withColumn("_step", timeaxis.step(F.col("date"), calendar))
    rows = rows.withColumn("_block", F.floor(F.col("_step") / BLOCK_DAYS).cast("int"))
    ends = [F.min("_step").alias("_first")]
    for i, value in enumerate(values if interpolate else []):
        ends += [F.expr(f"min({known(value)})").alias(f"_low_{i}"), F.expr(f"max({known(value)})").alias(f"_high_{i}")]
    blocks = rows.groupBy(*keys).agg(*ends)
    beyond = {"_next": F.expr(f"lead(_first) {by_block}"), "_opens": F.expr(f"row_number() {by_block} = 1")}
    within = {"_follows": F.expr(f"lead(_step) {by_day}"), "_leads": F.expr(f"row_number() {by_day} = 1")}
    for i, value in enumerate(values if interpolate else []):
        beyond[f"_past_{i}"] = F.expr(f"lag(_high_{i}) IGNORE NULLS {by_block}")
        beyond[f"_coming_{i}"] = F.expr(f"lead(_low_{i}) IGNORE NULLS {by_block}")
        within[f"_before_{i}"] = F.expr(f"lag({known(value)}) IGNORE NULLS {by_day}")
        within[f"_after_{i}"] = F.expr(f"lead({known(value)}) IGNORE NULLS {by_day}")
    blocks = blocks.select(*keys, *[c.alias(name) for name, c in beyond.items()]).withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    rows = rows.withColumns(within).join(blocks, same)
    day, step = F.col("_step"), F.col("_step")
    if axis is not None:
        lo = timeaxis.axis_value(axis, calendar, lambda first, _: first)
        hi = timeaxis.axis_value(axis, calendar, lambda _, last: last)
        since = F.when(F.col("_opens") & F.col("_leads"), lo).otherwise(step)
        until = F.coalesce(F.col("_follows") - 1, F.col("_next") - 1, hi)
        rows = rows.withColumn("_since", since).withColumn("_day", F.explode(F.sequence("_since", F.greatest("_since", until))))
        day = F.col("_day")
    filled = {}
    for i, value in enumerate(values):
        own = F.when(day == step, F.col(value))
        if interpolate:
            point = F.expr(known(value))
            before = F.coalesce(F.when(day > step, point), F.col(f"_before_{i}"), F.col(f"_past_{i}"))
            after = F.coalesce(F.when(day < step, point), F.col(f"_after_{i}"), F.col(f"_coming_{i}"))
            weight = (day - before["t"]) / (after["t"] - before["t"])
            between = before["v"] + (after["v"] - before["v"]) * weight
            own = F.coalesce(own, between.cast(cube.schema[value].dataType))
        filled[value] = own
    if axis is None:
        return rows.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in cube.columns])
    return rows.select(*cell_cols, timeaxis.date_of_step(day, calendar).alias("date"), *[c.alias(v) for v, c in filled.items()])


def inserted_mask(cube: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    """The cube's keys with each value replaced by whether it is missing."""
    return cube.withColumns({v: F.col(v).isNull() for v in value_cols})


def require_no_missing(cube: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    """The cube itself; reading a row with a missing value fails."""
    complete = F.lit(True)
    for value in value_cols:
        complete = complete & F.col(value).isNotNull()
    message = F.lit("missing values before calendar conversion")
    return cube.filter(F.when(complete, True).otherwise(F.raise_error(message).cast("boolean")))


def block_draws(axis: DataFrame, seed: int) -> DataFrame:
    """Per year of the axis, the 0-based day of the 360-day year drawn in each of its five blocks (``draws``); all
    cells share them."""
    years = axis.select(F.explode(F.sequence(F.year("first"), F.year("last"))).alias("year"))
    drawn = [
        F.lit(BLOCK_360 * b) + F.floor(keyed_uniform(seed, F.col("year"), F.lit(b)) * BLOCK_360).cast("int")
        for b in range(5)
    ]
    return years.select("year", F.array(*drawn).alias("draws"))


def day360_to_date(year: Column, day360: Column, target: str, draws: Column | None = None) -> Column:
    """Date a source day moves to: one day later for every drawn day before it, or without draws to the
    same share of the target year, halves to the even day."""
    long_year = F.lit(target == STANDARD) & timeaxis.is_leap_year(year)
    if draws is None:
        day = F.bround((day360 + 1) * F.when(long_year, 366).otherwise(365) / 360)
    else:
        day = day360 + 1 + sum(((draws[b] < day360).cast("int") for b in range(5)), F.lit(0))
        day = day + F.when(long_year & (day >= 60), 1).otherwise(0)
    if target == NOLEAP:
        return timeaxis.noleap_date(year, day)
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), (day - 1).cast("int"))


def _move_360_days(cube: DataFrame, target: str, align_on: str, axis: DataFrame, seed: int) -> DataFrame:
    """Add the target ``date`` of every source day; days that have none are left out."""
    year, day360 = F.col("year"), F.col("day360")
    if align_on == "random":
        draws = F.broadcast(block_draws(axis, seed))  # one row per year
        return cube.join(draws, "year").withColumn("date", day360_to_date(year, day360, target, F.col("draws")))
    if align_on == "year":
        return cube.withColumn("date", day360_to_date(year, day360, target))
    if align_on == "date":
        first_of_month = F.make_date(year, F.floor(day360 / 30).cast("int") + 1, F.lit(1))
        date = F.date_add(first_of_month, (day360 % 30).cast("int"))
        valid = F.month("date") == F.month(first_of_month)
        if target == NOLEAP:
            valid = valid & ~timeaxis.is_leap_day(F.col("date"))
        return cube.withColumn("date", date).filter(valid)
    raise ValueError(f"align_on must be 'random', 'year' or 'date', got {align_on!r}")


def convert_360_day(
    cube: DataFrame,
    value_cols: Sequence[str],
    cell_cols: Sequence[str] = ("cell",),
    target: str = NOLEAP,
    align_on: str = "random",
    interpolation: str | None = "linear",
    seed: int = 0,
    ignore_missing: bool = True,
) -> DataFrame:
    """360-day calendar to ``noleap`` or ``standard``, filling the inserted days.

    By default five days are inserted per year, one at a random place in each 72 source days, drawn anew
    for every year; on the standard calendar 29 February of a leap year is inserted too.
    ``align_on="year"`` inserts them at regular intervals, ``"date"`` keeps month and day and drops days
    the target calendar lacks. ``interpolation=None`` leaves inserted days missing. The output runs over
    whole source months.
    """
    if "day360" not in cube.columns:
        raise ValueError("the cube is not on the 360-day calendar")
    if interpolation not in (None, "linear"):
        raise ValueError(f"interpolation must be 'linear' or None, got {interpolation!r}")
    if target not in (NOLEAP, STANDARD):
        raise ValueError(f"target must be {NOLEAP!r} or {STANDARD!r}, got {target!r}")
    if not ignore_missing:
        cube = require_no_missing(cube, value_cols)
    source_month = F.floor(F.col("day360") / 30).cast("int") + 1
    first_of_month = F.make_date(F.col("year"), source_month, F.lit(1))
    last = F.last_day(F.max(first_of_month))
    if target == NOLEAP:
        last = F.when(timeaxis.is_leap_day(last), F.date_sub(last, 1)).otherwise(last)
    axis = cube.agg(F.min(first_of_month).alias("first"), last.alias("last"))
    moved = _move_360_days(cube, target, align_on, axis, seed).select(*cell_cols, "date", *value_cols)
    return _filled(moved, value_cols, cell_cols, target, axis, interpolate=bool(interpolation))


def standardize_gcm(
    cube: DataFrame,
    value_cols: Sequence[str],
    calendar: str,
    cell_cols: Sequence[str] = ("cell",),
    units: dict[str, str] | None = None,
    leapday_removal: bool = True,
    seed: int = 0,
    roles: Mapping[str, str] | None = None,
) -> DataFrame:
    """Clean a raw model run: leftover dimensions and coordinates (see ``squeeze_cruft``), precipitation units, calendar.

    A 360-day run becomes noleap (standard if ``leapday_removal`` is off); any other loses its leap days
    if ``leapday_removal`` is on. ``units`` gives the units of each variable, and those of a ``time``
    column of whole days that stands in for dates.
    """
    cube = squeeze_cruft(cube, roles=roles)
    if "time" in cube.columns and (calendar == DAY360 or leapday_removal):
        cube = decode_time(cube, "time", origin_of((units or {}).get("time", "")), calendar)
    if "pr" in value_cols:
        cube = pr_to_mm_day(cube, (units or {}).get("pr", ""))
    if calendar == DAY360:
        return convert_360_day(cube, value_cols, cell_cols, NOLEAP if leapday_removal else STANDARD, seed=seed)
    return remove_leap_days(cube) if leapday_removal else cube
