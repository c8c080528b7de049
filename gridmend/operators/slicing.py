"""Selections along a cube's dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.functions.axes import TIME, TIME_ALIAS, Axes, Axis
from gridmend.functions.timeaxis import label_bounds

DIMENSION, COORDINATE, VARIABLE = ROLES = ("dimension", "coordinate", "variable")


def axis_of(cube: DataFrame, dim: str) -> DataFrame:
    """Axis table of a dimension: position ``idx`` and ``label``."""
    return cube.select(F.col(f"{dim}_idx").alias("idx"), F.col(dim).alias("label")).distinct()


def sel_slice(
    cube: DataFrame, slices: Mapping[str, tuple], axes: Mapping[str, DataFrame | Axis] | None = None
) -> DataFrame:
    """Label slices, both ends included.

    A dimension with an axis in ``axes`` is cut between the *positions* of its two labels, which is
    what a label slice means on an axis in any order; on an unordered axis both labels must exist. A stored
    ``Axis`` gives the positions as literals that reach the scan, an axis table as a scalar subquery.
    Without either the axis is taken as ascending and the slice becomes a plain range filter that
    reaches the scan. Partial dates such as ``"1950"`` stand for their whole period; ``time`` means ``date``.
    """
    for dim, (first, last) in slices.items():
        dim = TIME if dim == TIME_ALIAS and TIME in cube.columns else dim
        first, last = label_bounds(first, last)
        if axes and dim != TIME and isinstance(axes.get(dim), Axis):
            low, high = axes[dim].between(dim, first, last)
            cube = cube.filter(F.col(f"{dim}_idx").between(low, high))
            continue
        if axes and isinstance(axes.get(dim), DataFrame):
            ends = _positions(axes[dim], dim, first, last)
            cube = cube.filter(F.col(f"{dim}_idx").between(ends["first"], ends["last"]))
            continue
        if first is not None:
            cube = cube.filter(F.col(dim) >= F.lit(first))
        if last is not None:
            cube = cube.filter(F.col(dim) <= F.lit(last))
    return cube


def _positions(axis: DataFrame, dim: str, first, last):
    """Scalar subquery with the positions a label slice runs between.

    The order of the labels shows in the sign of their steps; the table is one row per label.
    """
    ordered = axis.agg(F.sort_array(F.collect_list(F.struct("idx", "label"))).alias("a"))
    pairs = F.arrays_zip(
        F.slice("a", F.lit(1), F.size("a") - 1).alias("x"), F.slice("a", F.lit(2), F.size("a") - 1).alias("y")
    )
    ordered = ordered.select(
        "a",
        F.forall(pairs, lambda p: p["x"]["label"] < p["y"]["label"]).alias("up"),
        F.forall(pairs, lambda p: p["x"]["label"] > p["y"]["label"]).alias("down"),
    )

    def absent(label):
        return F.raise_error(F.lit(f"no label {label!r} on the unordered axis {dim!r}")).cast("bigint")

    def end(label, starts: bool):
        if label is None:
            return F.lit(None)
        label_col = F.lit(label)
        after = F.filter("a", lambda p: p["label"] >= label_col if starts else p["label"] <= label_col)
        before = F.filter("a", lambda p: p["label"] <= label_col if starts else p["label"] >= label_col)
        exact = F.filter("a", lambda p: p["label"] == label_col)
        pick = F.array_min if starts else F.array_max
        outside = F.lit(2**31 - 1 if starts else -1)
        return (
            F.when(F.col("up"), F.coalesce(pick(after)["idx"], outside))
            .when(F.col("down"), F.coalesce(pick(before)["idx"], outside))
            .otherwise(F.coalesce(F.array_min(exact)["idx"].cast("bigint"), absent(label)))
        )

    lowest, highest = F.lit(0), F.lit(2**31 - 1)
    return ordered.select(
        F.struct(
            F.coalesce(end(first, True), lowest).alias("first"), F.coalesce(end(last, False), highest).alias("last")
        ).alias("ends")
    ).scalar()


def isel_slice(cube: DataFrame, slices: Mapping[str, tuple], axes: Mapping[str, Axis] | None = None) -> DataFrame:
    """Positional slices ``[i, j)``; negative bounds count from the end of the axis, None means its end.

    With the stored ``Axis`` of a dimension the bounds are literals that reach the scan; those of time become a
    range of dates. Without it they come from scalar subqueries over the cube. ``time`` means ``date``.
    """
    source = cube
    for dim, (start, stop) in slices.items():
        dim = TIME if dim == TIME_ALIAS and TIME in cube.columns else dim
        axis = axes.get(dim) if axes else None
        if dim == TIME:
            cube = _isel_time(cube, source, axis, start, stop)
            continue
        idx = F.col(f"{dim}_idx")
        if axis is not None:
            at = axis.pick(start, stop).positions
            cube = cube.filter(idx.between(at[0], at[-1]) if at else F.lit(False))
            continue

        def position(bound: int):
            if bound >= 0:
                return F.lit(bound)
            return source.agg(F.max(f"{dim}_idx") + 1 + bound).scalar()

        if start is not None:
            cube = cube.filter(idx >= position(start))
        if stop is not None:
            cube = cube.filter(idx < position(stop))
    return cube


def _isel_time(cube: DataFrame, source: DataFrame, axis: Axis | None, start: int | None, stop: int | None) -> DataFrame:
    """The days from one position of the time axis up to another."""
    if axis is not None:
        days = axis.pick(start, stop).labels
        inside = F.col(TIME).between(F.lit(days[0]), F.lit(days[-1])) if days else F.lit(False)
        return cube.filter(inside)
    days = source.agg(F.sort_array(F.collect_set(TIME)).alias("days"))  # the calendar bounds them
    size = F.size("days")

    def position(bound: int | None, default: Column) -> Column:
        return default if bound is None else F.lit(bound) if bound >= 0 else F.greatest(size + bound, F.lit(0))

    first = position(start, F.lit(0))
    picked = F.slice("days", first + 1, F.greatest(position(stop, size) - first, F.lit(0)))
    ends = days.select(F.struct(F.array_min(picked).alias("first"), F.array_max(picked).alias("last")).alias("ends")).scalar()
    return cube.filter(F.col(TIME).between(ends["first"], ends["last"]))


def stored_axes(axes: Axes | None) -> Mapping[str, Axis]:
    return axes.by_dim if axes is not None else {}


def sel_year(cube: DataFrame, year: int) -> DataFrame:
    """All days of one year, as a date range the scan can use."""
    return sel_slice(cube, {"date": (f"{year:04d}", f"{year:04d}")})


def select_variable(cube: DataFrame, variables: Sequence[str], key_cols: Sequence[str]) -> DataFrame:
    return cube.select(*key_cols, *variables)


def squeeze_cruft(
    cube: DataFrame,
    names: Sequence[str] = ("height", "member_id", "time_bnds"),
    dims: Sequence[str] = ("member_id",),
    roles: Mapping[str, str] | None = None,
) -> DataFrame:
    """Drop leftover dimensions and coordinates; a data variable of such a name stays.

    ``roles`` says what a column is (``dimension``, ``coordinate`` or ``variable``); those it does not name are
    dimensions if in ``dims``, else coordinates. A dimension must take a single value; otherwise reading the
    result fails.
    """
    roles = roles or {}
    for name, role in roles.items():
        if role not in ROLES:
            raise ValueError(f"the role of {name!r} must be one of {ROLES}, got {role!r}")
    of = {n: roles.get(n, DIMENSION if n in dims else COORDINATE) for n in names if n in cube.columns}
    leftover = [n for n, role in of.items() if role != VARIABLE]
    for name in [n for n in leftover if of[n] == DIMENSION]:
        single = cube.agg(F.min(name).eqNullSafe(F.max(name)).alias("single")).scalar()
        message = F.lit(f"cannot drop {name!r}: it takes more than one value")
        cube = cube.filter(F.when(single, True).otherwise(F.raise_error(message).cast("boolean")))
    return cube.drop(*leftover)


def reorder_dims(cube: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Put dimension columns first, in the order given."""
    return cube.select(*dims, *[c for c in cube.columns if c not in dims])
