"""Row-local corrections of values; each also runs on a streaming cube.

A missing value fails every comparison, so it takes the replacement: floors, ceilings and wet-day
corrections fill missing values, as the operators' definitions ask.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.functions.draws import keyed_uniform

WET_DAY_THRESHOLD = 1.0  # mm/day


def dtr_floor(cube: DataFrame, value_cols: Sequence[str], floor: float = 1.0) -> DataFrame:
    """Raise values strictly below ``floor`` to it."""
    return _replace(cube, value_cols, lambda v: v >= floor, lambda v: F.lit(float(floor)))


def non_polar_dtr_ceiling(
    cube: DataFrame, value_cols: Sequence[str], ceiling: float = 70.0, lat_col: str = "lat"
) -> DataFrame:
    """Lower values strictly above ``ceiling`` to it where -60 < lat < 60."""
    polar = (F.col(lat_col) <= -60) | (F.col(lat_col) >= 60)
    return _replace(cube, value_cols, lambda v: (v <= ceiling) | polar, lambda v: F.lit(float(ceiling)))


def precip_ceiling(cube: DataFrame, value_cols: Sequence[str], ceiling: float = 3000.0) -> DataFrame:
    """Lower values strictly above ``ceiling`` to it."""
    return _replace(cube, value_cols, lambda v: v <= ceiling, lambda v: F.lit(float(ceiling)))


def wet_day_pre(cube: DataFrame, key_cols: Sequence[str], value_col: str = "pr", seed: int = 0) -> DataFrame:
    """Replace values below 1 mm/day by draws from U(0.5, 1), each fixed by ``seed`` and its row's key.

    Without key columns all rows would share one draw, so they must be given.
    """
    if not key_cols:
        raise ValueError("wet_day_pre needs key columns that tell rows apart")
    low = WET_DAY_THRESHOLD / 2
    draw = F.lit(low) + F.lit(WET_DAY_THRESHOLD - low) * keyed_uniform(seed, *[F.col(k) for k in key_cols])
    return _replace(cube, [value_col], lambda v: v >= WET_DAY_THRESHOLD, lambda v: draw)


def wet_day_post(cube: DataFrame, value_col: str = "pr") -> DataFrame:
    """Replace values below 1 mm/day by zero."""
    return _replace(cube, [value_col], lambda v: v >= WET_DAY_THRESHOLD, lambda v: F.lit(0.0))


def wet_day_frequency(
    cube: DataFrame, process: str, key_cols: Sequence[str] = (), value_col: str = "pr", seed: int = 0
) -> DataFrame:
    """``process`` "pre" (before bias adjustment) or "post" (after it)."""
    if process == "pre":
        return wet_day_pre(cube, key_cols, value_col, seed)
    if process == "post":
        return wet_day_post(cube, value_col)
    raise ValueError(f"process must be 'pre' or 'post', got {process!r}")


def cast_values(cube: DataFrame, value_cols: Sequence[str], astype: str) -> DataFrame:
    """Cast data variables; keys and ``sim_q`` keep their types unless named."""
    return cube.withColumns({v: F.col(v).cast(astype) for v in value_cols})


def pr_to_mm_day(cube: DataFrame, units: str, value_col: str = "pr") -> DataFrame:
    """Precipitation flux in kg m-2 s-1 to mm/day; other units are an error."""
    if units != "kg m-2 s-1":
        raise ValueError(f"expected {value_col} in units 'kg m-2 s-1', got {units!r}")
    return cube.withColumn(value_col, (F.col(value_col) * 86400).cast(cube.schema[value_col].dataType))


def _replace(cube: DataFrame, value_cols: Sequence[str], keep, other) -> DataFrame:
    def replaced(name: str) -> Column:
        value = F.col(name)
        return F.when(keep(value), value).otherwise(other(value).cast(cube.schema[name].dataType))

    return cube.withColumns({name: replaced(name) for name in value_cols})
