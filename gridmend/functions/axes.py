"""The axes of a cube: the labels of its dimensions and their positions.

A dimension ``lat`` has the position column ``lat_idx`` and mostly a label column ``lat``; time has the label
column ``date`` alone, its positions being the order of its days. As a table an axis has one row per position
(``dim``, ``idx``, ``label`` as text); on the driver it is an ``Axis``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridmend.functions import timeaxis
from gridmend.functions.joins import BROADCAST_ROWS
from gridmend.functions.timeaxis import DAY360, NOLEAP, STANDARD

TIME, TIME_ALIAS, CALENDAR = "date", "time", "calendar"


def dimensions(columns: Sequence[str]) -> list[str]:
    """Dimensions with an axis: those with a position column, and time."""
    placed = [c.removesuffix("_idx") for c in columns if c.endswith("_idx")]
    return placed + [TIME] * (TIME in columns)


class Axis(NamedTuple):
    """One axis on the driver: ascending positions and their labels (the positions themselves, where it has none)."""

    positions: tuple[int, ...]
    labels: tuple

    def between(self, dim: str, first, last) -> tuple[int, int]:
        """Positions a label slice with both ends runs between; an unordered axis must have both labels."""
        steps = list(zip(self.labels, self.labels[1:]))
        up, down = all(a < b for a, b in steps), all(a > b for a, b in steps)
        if not up and not down:
            for label in (first, last):
                if label is not None and label not in self.labels:
                    raise ValueError(f"no label {label!r} on the unordered axis {dim!r}")
            ends = [None if label is None else self.positions[self.labels.index(label)] for label in (first, last)]
            return (0 if ends[0] is None else ends[0]), (self._end if ends[1] is None else ends[1])
        low, high = (first, last) if up else (last, first)
        inside = [p for p, label in zip(self.positions, self.labels) if (low is None or label >= low) and (high is None or label <= high)]
        return (inside[0], inside[-1]) if inside else (1, 0)

    def pick(self, start: int | None, stop: int | None) -> Axis:
        """The lines ``[start, stop)`` of the axis, counted from its first; negative bounds count from the end."""
        return Axis(self.positions[start:stop], self.labels[start:stop])

    @property
    def _end(self) -> int:
        return self.positions[-1] if self.positions else -1

    def cut(self, first, last) -> Axis:
        """The part of an ascending axis between two labels, its positions counted anew."""
        labels = tuple(label for label in self.labels if first <= label <= last)
        return Axis(tuple(range(len(labels))), labels)

    def is_gapless(self, calendar: str) -> bool:
        """Whether the days of a time axis follow each other without a gap on ``calendar``."""
        return all(_next_day(a, calendar) == b for a, b in zip(self.labels, self.labels[1:]))


def _next_day(day: dt.date, calendar: str) -> dt.date:
    after = day + dt.timedelta(days=1)
    skip = calendar == NOLEAP and (after.month, after.day) == (2, 29)
    return after + dt.timedelta(days=1) if skip else after


class Axes(NamedTuple):
    by_dim: Mapping[str, Axis]
    calendar: str | None = None

    @property
    def time(self) -> Axis | None:
        return self.by_dim.get(TIME)

    @property
    def time_range(self) -> tuple[dt.date, dt.date] | None:
        """First and last day, for the operators that else look them up."""
        return (self.time.labels[0], self.time.labels[-1]) if self.time and self.time.labels else None

    def with_time(self, first: dt.date, last: dt.date) -> Axes:
        """The same axes with time cut to the days between two."""
        return self._replace(by_dim={**self.by_dim, TIME: self.time.cut(first, last)}) if self.time else self


def axes_table(cube: DataFrame) -> DataFrame:
    """``dim``, ``idx``, ``label`` of every axis of a cube, and its ``calendar`` as one more row: one scan of its key columns.

    Labels are distinct per partition before they are shuffled, so what moves is axes, not rows.
    """
    dims = dimensions(cube.columns)
    if not dims:
        return cube.sparkSession.createDataFrame([], "dim string, idx int, label string")

    def entry(dim: str) -> Column:
        position = F.lit(None).cast("int") if dim == TIME else F.col(f"{dim}_idx").cast("int")
        label = F.col(dim).cast("string") if dim in cube.columns else F.lit(None).cast("string")
        return F.struct(F.lit(dim).alias("dim"), position.alias("idx"), label.alias("label"))

    found = cube.select(F.explode(F.array(*[entry(d) for d in dims])).alias("e")).select("e.*")
    if TIME in dims:
        found = found.where((F.col("dim") != TIME) | F.col("label").isNotNull())
    is_time = F.col("dim") == TIME
    day = F.when(is_time, F.col("label"))
    single = found.groupBy("dim", "idx", day.alias("day")).agg(F.min("label").alias("label"))
    order = F.row_number().over(Window.partitionBy("dim").orderBy("label")) - 1  # an axis: one row per label
    placed = single.select("dim", F.when(is_time, order).otherwise(F.col("idx")).cast("int").alias("idx"), "label")
    if TIME not in dims:
        return placed
    return placed.unionAll(calendar_of(placed.where(is_time).select(F.to_date("label").alias("date"))))


def calendar_of(days: DataFrame) -> DataFrame:
    """The row (``calendar``, 0, its name) for the ``date`` of every day of an axis.

    A 29 February says standard, a step over one says noleap. Without either the days are the same on both, and the name is NULL.
    """
    before = F.lag("date").over(Window.partitionBy(F.lit(0)).orderBy("date"))
    skipped = (F.datediff("date", before) == 2) & timeaxis.is_leap_day(F.date_sub("date", 1))
    marked = days.select("date", skipped.alias("skipped"))
    name = F.when(F.bool_or(timeaxis.is_leap_day(F.col("date"))), STANDARD).when(F.bool_or("skipped"), NOLEAP)
    return marked.agg(name.alias("label")).select(F.lit(CALENDAR).alias("dim"), F.lit(0).alias("idx"), "label")


def collected(table: DataFrame, schema: StructType) -> Axes:
    """The axes of an axes table on the driver, labels in the types ``schema`` gives them. Raises beyond ``BROADCAST_ROWS`` lines."""
    rows = table.limit(BROADCAST_ROWS + 1).collect()
    if len(rows) > BROADCAST_ROWS:
        raise ValueError(f"the axes have more than {BROADCAST_ROWS} lines")
    lines: dict[str, list] = {}
    for row in rows:
        lines.setdefault(row["dim"], []).append((row["idx"], row["label"]))
    calendar = lines.pop(CALENDAR, [(0, None)])[0][1]
    by_dim = {}
    for dim, pairs in lines.items():
        pairs.sort()
        kind = schema[dim].dataType.typeName() if dim in schema.names else "position"
        by_dim[dim] = Axis(tuple(i for i, _ in pairs), tuple(_label(kind, i, text) for i, text in pairs))
    return Axes(by_dim, calendar)


def _label(kind: str, position: int, text: str | None):
    if text is None:
        return position
    if kind == "date":
        return dt.date.fromisoformat(text)
    if kind in ("double", "float", "decimal"):
        return float(text)
    return int(text) if kind in ("byte", "short", "integer", "long") else text


#: Names of calendars in files, and what they are here (fixed values).
CALENDAR_NAMES = {
    "standard": STANDARD, "gregorian": STANDARD, "proleptic_gregorian": STANDARD,
    "noleap": NOLEAP, "365_day": NOLEAP, "360_day": DAY360,
}


def resolved_calendar(cube: DataFrame, axes: Axes | None, stated: str | None) -> str | None:
    """The calendar a cube is on: as stated, else as its stored axes say, else from its days (an action).

    None where nothing tells: no time, or days that are the same on the standard and the noleap calendar.
    """
    if stated:
        if stated not in CALENDAR_NAMES:
            raise ValueError(f"unknown calendar {stated!r}")
        return CALENDAR_NAMES[stated]
    if "day360" in cube.columns:
        return DAY360
    if axes is not None and axes.time is not None:
        return axes.calendar
    return calendar_of(cube.select(TIME).distinct()).first()["label"] if TIME in cube.columns else None


def common_calendar(*found: str | None) -> str:
    """The one calendar of several cubes; those on which nothing tells follow the others. Standard if none does."""
    known = sorted({c for c in found if c})
    if len(known) > 1:
        raise ValueError(f"the data are on different calendars: {', '.join(known)}")
    return known[0] if known else STANDARD


def time_position(axis: Axis, calendar: str) -> Column:
    """Position of a row's ``date`` on a gapless time axis, by calendar arithmetic."""
    if not axis.is_gapless(calendar):
        raise ValueError("the time axis has gaps, look its positions up instead")
    start = timeaxis.step(F.lit(axis.labels[0]), calendar)
    return (timeaxis.step(F.col(TIME), calendar) - start).cast("int")
