"""Day-of-year pools: the grouping under quantile mapping and analog downscaling.

The pool of a day of the year holds the values within half a window of every day with that number, over
all years. A pool needs its cell's days from a fixed stretch of the year only, so the cube is shuffled
once on (cell, block of days): rows near a block's edge go to both blocks (1.25 copies per row for a 31-day
window, instead of 31), and no group grows beyond years x (block + window) rows. Even a single cell spreads
over three tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.functions import kernels, timeaxis
from gridmend.functions.kernels import DAYS_IN_BLOCK, LAST_BLOCK, PoolSpec
from gridmend.shipping import ship

AXIS_BITS = 24
POOL_MEMBERS, MOST_GROUPS = 1 << 19, 256  # worked on at once, unless a single group has more


def pool_spec(calendar: str, window: int) -> PoolSpec:
    if window % 2 == 0 or window < 1:
        raise ValueError(f"window must be odd and positive, got {window}")
    return PoolSpec(calendar, window)


def block_of_doy(doy: Column) -> Column:
    return F.least(F.floor((doy - 1) / DAYS_IN_BLOCK), F.lit(LAST_BLOCK)).cast("int")


def spread_to_blocks(cube: DataFrame, spec: PoolSpec, time_range: tuple | DataFrame | None = None) -> DataFrame:
    """Copy every row to the blocks whose pools may hold it.

    The ``date`` becomes ``_step``; ``_block`` is added, and ``_axis``: first step and length of the time
    axis in one number, because every column handed to Python costs. Rows outside a stated axis are left out.
    """
    axis = timeaxis.time_axis(cube, time_range)
    packed = timeaxis.axis_value(
        axis, spec.calendar, lambda lo, hi: F.shiftleft(lo.cast("bigint"), AXIS_BITS) + (hi - lo)
    )
    shortest = 365 - LAST_BLOCK * DAYS_IN_BLOCK  # steps of this size skip no block
    reached = sorted({*range(-spec.half, spec.half, shortest), 0, spec.half})
    near = [block_of_doy(timeaxis.doy_of_step(F.col("_step") + offset, spec.calendar)) for offset in reached]
    return (
        cube.withColumn("_step", timeaxis.step(F.col("date"), spec.calendar))
        .drop("date")
        .withColumn("_axis", packed)
        .where((F.col("_step") - F.shiftright("_axis", AXIS_BITS)).between(0, F.col("_axis").bitwiseAND((1 << AXIS_BITS) - 1)))
        .withColumn("_block", F.explode(F.array_distinct(F.array(*near))))
    )


def axis_ends(table: pa.Table) -> tuple[int, int]:
    """First and last step of the time axis a group's rows belong to."""
    axis = table["_axis"][0].as_py()
    lo = axis >> AXIS_BITS
    return lo, lo + (axis & ((1 << AXIS_BITS) - 1))


def cell_schema(cube: DataFrame, cell_cols: Sequence[str]) -> str:
    """DDL of the cell columns, with a trailing comma."""
    return "".join(f"`{c}` {cube.schema[c].dataType.simpleString()}, " for c in cell_cols)


def repeat_key(key: tuple, cell_cols: Sequence[str], n: int) -> dict[str, pa.Array]:
    return {name: pa.repeat(value, n) for name, value in zip(cell_cols, key)}


def list_column(rows: np.ndarray) -> pa.Array:
    """A 2-d array as a column of equally long lists, NaN as missing."""
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), from_pandas=True))


def doy_window_pool(
    cube: DataFrame,
    value_col: str,
    cell_cols: Sequence[str] = ("cell",),
    window: int = 31,
    calendar: str = timeaxis.NOLEAP,
    time_range: tuple | DataFrame | None = None,
) -> DataFrame:
    """Pool of every (cell, day of year): ``doy``, ``n`` and the ascending values ``pool``.

    Windows, of any odd number of days, wrap over New Year through the series and are cut at its ends; missing values are left out.
    One longer than a year holds a day once for each window that reaches it.
    """
    spec, cell_cols = pool_spec(calendar, window), list(cell_cols)
    rows = spread_to_blocks(
        cube.select(*cell_cols, "date", F.col(value_col).cast("double").alias("_value")), spec, time_range
    )

    def pools(key, table):
        _, first_day, pool = block_windows(table, "_value", key[-1].as_py(), spec)
        flat, sizes = kernels.sorted_pools(pool)
        used = np.flatnonzero(sizes)
        offsets = np.concatenate([[0], np.cumsum(sizes[used])]).astype(np.int32)
        values = flat[used][np.arange(flat.shape[1]) < sizes[used, None]]
        return pa.table(
            {
                **repeat_key(key, cell_cols, used.size),
                "doy": pa.array(first_day + used + 1, pa.int32()),
                "n": pa.array(sizes[used], pa.int32()),
                "pool": pa.ListArray.from_arrays(offsets, pa.array(values)),
            }
        )

    schema = cell_schema(cube, cell_cols) + "doy int, n int, pool array<double>"
    ship(rows.sparkSession)
    return rows.groupBy(*cell_cols, "_block").applyInArrow(pools, schema)


def over_groups(rows: DataFrame, keys: Sequence[str], work: Callable[[pa.Table, np.ndarray], pa.Table], schema: str, window: int) -> DataFrame:
    """``work`` on many whole groups of one block at a time: their rows, and the first row of each group.

    One shuffle on ``keys``, the last of them ``_block``. A group to itself costs a task an Arrow stream and some calls, more than
    its work if a cell has few values; here a batch's groups share them. A task holds one batch and the group that its end may cut.
    """
    keys = list(keys)

    def starts(table: pa.Table) -> np.ndarray:
        new = np.arange(len(table)) == 0
        for key in keys:
            code = pc.dictionary_encode(table[key].combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new[1:] |= code[1:] != code[:-1]
        return np.flatnonzero(new)

    def pieces(table: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        block, ends = table["_block"].to_numpy(), np.append(first[1:], len(table))
        i = 0
        while i < len(first):
            most = np.searchsorted(ends, first[i] + POOL_MEMBERS // window, "right")
            other = np.flatnonzero(block[first[i:]] != block[first[i]])
            j = max(i + 1, min(most, i + MOST_GROUPS, i + other[0] if len(other) else len(first)))
            yield from work(table.slice(first[i], ends[j - 1] - first[i]), first[i:j] - first[i]).to_batches()
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            if not len(table):
                continue
            first = starts(table)
            kept = table.slice(first[-1])
            yield from pieces(table.slice(0, first[-1]), first[:-1])
        if kept is not None and len(kept):
            yield from pieces(kept, np.array([0]))

    ship(rows.sparkSession)
    return rows.repartition(*keys).sortWithinPartitions(keys[-1], *keys[:-1]).mapInArrow(run, schema)


def block_windows(table: pa.Table, column: str, block: int, spec: PoolSpec):
    """(first year, first day, windows) of one group's ``column``."""
    lo, hi = axis_ends(table)
    year, day, centre = kernels.centres(lo, hi, block, spec)
    series = kernels.spread(table["_step"].to_numpy(), table[column].to_numpy(), lo, hi, spec)
    return year, day, kernels.windows(series, centre, spec)
