"""Quantile delta mapping: train adjustment factors, rank simulated days, adjust them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmend.functions import kernels, timeaxis
from gridmend.functions.kernels import PoolSpec
from gridmend.functions.nodes import apply_correction, kind_symbol, nearest_node_by_rank, node_positions
from gridmend.operators import pools
from gridmend.shipping import ship

POOLED, SAME_DOY = "pooled", "same_doy"


def train_qdm(
    reference: DataFrame,
    historical: DataFrame,
    value_col: str,
    kind: str,
    cell_cols: Sequence[str] = ("cell",),
    quantiles_n: int = 100,
    window: int = 31,
    calendar: str = timeaxis.NOLEAP,
    reference_range: tuple | DataFrame | None = None,
    historical_range: tuple | DataFrame | None = None,
) -> DataFrame:
    """Model of one row per (cell, doy): ``n_hist``, ``n_ref``, ``hist_q`` and ``af`` per quantile node.

    ``af`` is the reference quantile minus (``+``) or over (``*``) the historical one; a ratio to zero is
    missing. Both sides go through one shuffle on (cell, block of days); cells or days only one side
    knows are left out. The ranges state the time axes where they are known, saving their lookup.
    """
    spec, symbol, cell_cols = pools.pool_spec(calendar, window), kind_symbol(kind), list(cell_cols)
    nodes = np.array(node_positions(quantiles_n))

    def side(cube: DataFrame, is_reference: bool, time_range) -> DataFrame:
        picked = cube.select(
            *cell_cols, "date", F.col(value_col).cast("double").alias("_value"), F.lit(is_reference).alias("_ref")
        )
        return pools.spread_to_blocks(picked, spec, time_range)

    def fit(table: pa.Table, first: np.ndarray) -> pa.Table:
        block = table["_block"][0].as_py()
        first_day, width = kernels.block_span(block, spec)
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(table))))
        is_reference = table["_ref"].to_numpy()
        series = group + len(first) * is_reference  # history first, then the reference
        values = table["_value"].to_numpy()
        members, sizes = kernels.many_pools(series, table["_step"].to_numpy(), values, 2 * len(first), *pools.axis_ends(table), block, spec)
        n_hist, n_ref = np.split(sizes, 2)
        used = np.flatnonzero((n_ref > 0) & (n_hist > 0))
        hist_q, ref_q = (kernels.pool_quantiles(members, sizes, at, nodes) for at in (used, used + n_hist.size))
        cells = table.select(cell_cols).take(pa.array(first[used // width]))
        return pa.table(
            {
                **{name: cells[name] for name in cell_cols},
                "doy": pa.array(first_day + used % width + 1, pa.int32()),
                "n_hist": pa.array(n_hist[used], pa.int32()),
                "n_ref": pa.array(n_ref[used], pa.int32()),
                "hist_q": pools.list_column(hist_q),
                "af": pools.list_column(kernels.factors(ref_q, hist_q, symbol)),
            }
        )

    both = side(reference, True, reference_range).unionByName(side(historical, False, historical_range))
    schema = pools.cell_schema(historical, cell_cols) + (
        "doy int, n_hist int, n_ref int, hist_q array<double>, af array<double>"
    )
    return pools.over_groups(both, [*cell_cols, "_block"], fit, schema, window)


def sel_year_window(cube: DataFrame, first: int, last: int | None = None, half_years: int = 10, half_days: int = 15) -> DataFrame:
    """Days the pools of the years ``first..last`` draw on: ``half_years`` each side and ``half_days`` more, half a window.

    Years the cube lacks simply make the window shorter.
    """
    last = first if last is None else last
    start, end = _window_ends(first, last, half_years, half_days)
    return cube.filter(F.col("date").between(F.lit(start), F.lit(end)))


def _window_ends(first: int, last: int, half_years: int, half_days: int) -> tuple[dt.date, dt.date]:
    leap = dt.timedelta(days=0 if half_days <= 31 else 1 + half_days // 365)  # leap days a pad can hold that the calendar lacks
    pad = dt.timedelta(days=half_days) + leap
    return dt.date(first - half_years, 1, 1) - pad, dt.date(last + half_years, 12, 31) + pad


def sim_quantile(
    simulation: DataFrame,
    value_col: str,
    years: Sequence[int],
    cell_cols: Sequence[str] = ("cell",),
    half_years: int = 10,
    window: int = 31,
    calendar: str = timeaxis.NOLEAP,
    rank_scope: str = POOLED,
    time_range: tuple | DataFrame | None = None,
) -> DataFrame:
    """Quantile of every simulated day of ``years`` in its pool: the days around it, +-``half_years``.

    Adds ``sim_rank2`` (twice the average-tie rank), ``sim_n`` (pool size) and ``sim_q``, half their
    ratio. ``rank_scope="same_doy"`` ranks among equal days of the year only. All years are ranked in one
    pass over the cube, each in its own pool.
    """
    spec, cell_cols, years = _rank_spec(calendar, window, rank_scope), list(cell_cols), sorted(set(years))
    rows = _rows_to_rank(simulation, value_col, years, cell_cols, half_years, spec, time_range)

    def rank(key, table):
        days, rank2, size = _rank_group(table, key[-1].as_py(), spec, years, half_years)
        return pa.table(_day_columns(key, cell_cols, days, rank2, size))

    schema = pools.cell_schema(simulation, cell_cols) + "_step int, _value double, sim_rank2 bigint, sim_n int"
    ship(rows.sparkSession)
    ranked = rows.groupBy(*cell_cols, "_block").applyInArrow(rank, schema)
    kept_type = simulation.schema[value_col].dataType
    date = timeaxis.date_of_step(F.col("_step"), calendar).alias("date")
    return ranked.select(
        *cell_cols, date, F.col("_value").cast(kept_type).alias(value_col), *_quantile_columns()
    )


def apply_qdm(
    simulation: DataFrame,
    model: DataFrame,
    value_col: str,
    years: Sequence[int],
    kind: str,
    cell_cols: Sequence[str] = ("cell",),
    half_years: int = 10,
    window: int = 31,
    calendar: str = timeaxis.NOLEAP,
    rank_scope: str = POOLED,
    time_range: tuple | DataFrame | None = None,
    astype: str | None = None,
) -> DataFrame:
    """Adjust the days of ``years`` by the factor of the quantile node nearest to each day's quantile.

    Output: cell columns, ``date``, the adjusted ``value_col`` (in ``astype``, else its own type),
    ``sim_q`` and the exact ``sim_rank2`` and ``sim_n`` behind it. Simulation and model meet in one
    co-grouped shuffle on (cell, block of days); days of cells without a model are left out.
    """
    spec, cell_cols, years = _rank_spec(calendar, window, rank_scope), list(cell_cols), sorted(set(years))
    rows = _rows_to_rank(simulation, value_col, years, cell_cols, half_years, spec, time_range)
    factors = model.select(*cell_cols, pools.block_of_doy(F.col("doy")).alias("_block"), "doy", "af")

    def pick(key, table, fitted):
        if table.num_rows == 0 or fitted.num_rows == 0:
            none = np.zeros(0)
            return pa.table(_day_columns(key, cell_cols, table.slice(0, 0), none, none, none))
        days, rank2, size = _rank_group(table, key[-1].as_py(), spec, years, half_years)
        af = fitted["af"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(fitted.num_rows, -1)
        model_row = np.full(367, -1)
        model_row[fitted["doy"].to_numpy()] = np.arange(fitted.num_rows)
        doy = kernels.split_steps(days["_step"].to_numpy(), spec.calendar)[1] + 1
        known = model_row[doy] >= 0
        days, rank2, size, at = days.filter(pa.array(known)), rank2[known], size[known], model_row[doy[known]]
        n = af.shape[1]
        node = np.clip((n * rank2 - 1) // np.maximum(2 * size, 1), 0, n - 1)
        return pa.table(_day_columns(key, cell_cols, days, rank2, size, af[at, node]))

    schema = pools.cell_schema(simulation, cell_cols) + (
        "_step int, _value double, sim_rank2 bigint, sim_n int, _factor double"
    )
    keys = [*cell_cols, "_block"]
    ship(rows.sparkSession)
    picked = rows.groupBy(*keys).cogroup(factors.groupBy(*keys)).applyInArrow(pick, schema)
    kept_type = astype or simulation.schema[value_col].dataType
    adjusted = apply_correction(F.col("_value"), F.col("_factor"), kind)
    date = timeaxis.date_of_step(F.col("_step"), calendar).alias("date")
    return picked.select(*cell_cols, date, adjusted.cast(kept_type).alias(value_col), *_quantile_columns())


def apply_qdm_year(
    simulation: DataFrame, model: DataFrame, value_col: str, year: int, kind: str, half_years: int = 10, **options
) -> DataFrame:
    """``apply_qdm`` for one year, from the slice of the simulation that year needs."""
    return apply_qdm(simulation, model, value_col, [int(year)], kind, half_years=half_years, **options)


def nearest_factor(ranked: DataFrame, quantiles_n: int) -> DataFrame:
    """Add ``node``, the 0-based nearest node of each ranked day."""
    return ranked.withColumn("node", nearest_node_by_rank(F.col("sim_rank2"), F.col("sim_n"), quantiles_n))


def _rank_spec(calendar: str, window: int, rank_scope: str) -> PoolSpec:
    if rank_scope not in (POOLED, SAME_DOY):
        raise ValueError(f"rank_scope must be {POOLED!r} or {SAME_DOY!r}, got {rank_scope!r}")
    return pools.pool_spec(calendar, 1 if rank_scope == SAME_DOY else window)


def _rows_to_rank(cube, value_col, years, cell_cols, half_years, spec, time_range) -> DataFrame:
    """Days the pools of ``years`` need, spread to blocks. The years are cut before the shuffle: a filter
    on the output could not pass below the pools."""
    if time_range is not None:
        time_range = timeaxis.clip_axis(time_range, *_window_ends(years[0], years[-1], half_years, spec.half))
    picked = cube.select(*cell_cols, "date", F.col(value_col).cast("double").alias("_value"))
    return pools.spread_to_blocks(sel_year_window(picked, years[0], years[-1], half_years, spec.half), spec, time_range)


def _rank_group(table: pa.Table, block: int, spec: PoolSpec, years: list[int], half_years: int):
    """The group's own days of the wanted years, twice their rank, and their pool sizes."""
    year0, first_day, pool = pools.block_windows(table, "_value", block, spec)
    wanted = slice(max(years[0] - year0, 0), min(years[-1] - year0 + 1, pool.shape[1]))
    below, equal, size = kernels.rank_counts(pool, pool[spec.half], half_years, wanted)
    year, day = kernels.split_steps(table["_step"].to_numpy(), spec.calendar)
    width = pool.shape[2]
    mine = (day >= first_day) & (day < first_day + width) & np.isin(year, years)
    at = year[mine] - year0, day[mine] - first_day
    return table.filter(pa.array(mine)), 2 * below[at] + equal[at] + 1, size[at]


def _day_columns(key, cell_cols, days: pa.Table, rank2, size, factor=None) -> dict:
    """Output columns of one group; a day without a value has no rank."""
    missing = np.isnan(days["_value"].to_numpy())
    columns = {
        **pools.repeat_key(key, cell_cols, days.num_rows),
        "_step": days["_step"],
        "_value": days["_value"],
        "sim_rank2": pa.array(rank2, pa.int64(), mask=missing),
        "sim_n": pa.array(size, pa.int32()),
    }
    if factor is not None:
        columns["_factor"] = pa.array(np.where(missing, np.nan, factor), pa.float64(), from_pandas=True)
    return columns


def _quantile_columns() -> list[Column]:
    sim_q = F.try_divide(F.col("sim_rank2").cast("double"), F.col("sim_n") * F.lit(2.0))
    return [sim_q.alias("sim_q"), F.col("sim_rank2"), F.col("sim_n")]
