"""Quantile-preserving localized analogs downscaling: from a coarse, adjusted field to fine cells."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmend.functions import kernels, timeaxis
from gridmend.functions.joins import broadcast_if, is_small
from gridmend.functions.nodes import (
    apply_correction,
    kind_symbol,
    nearest_node_by_quantile,
    nearest_node_by_rank,
)
from gridmend.operators import pools
from gridmend.operators.clamps import wet_day_post
from gridmend.shipping import ship


def check_qplad_inputs(coarse: DataFrame, fine: DataFrame, quantiles_n: int = 620, window: int = 31) -> None:
    """Raise ValueError unless both time axes are equally long and fill ``quantiles_n`` nodes.

    An action: one pass over the ``date`` columns.
    """

    def axis(cube: DataFrame, name: str) -> DataFrame:
        return cube.select("date").distinct().agg(
            F.lit(name).alias("side"), F.count("*").alias("days"), F.count_distinct(F.year("date")).alias("years")
        )

    found = {r["side"]: r for r in axis(coarse, "coarse").unionByName(axis(fine, "fine")).collect()}
    _check_lengths(found["coarse"]["days"], found["fine"]["days"], found["fine"]["years"], quantiles_n, window)


def check_axes(coarse_days: Sequence[dt.date], fine_days: Sequence[dt.date], quantiles_n: int = 620, window: int = 31) -> None:
    """As ``check_qplad_inputs``, on stored time axes and so without reading data."""
    _check_lengths(len(coarse_days), len(fine_days), len({d.year for d in fine_days}), quantiles_n, window)


def _check_lengths(coarse_days: int, fine_days: int, fine_years: int, quantiles_n: int, window: int) -> None:
    if coarse_days != fine_days:
        raise ValueError("coarse and fine reference data have different numbers of time steps")
    years = fine_years - 2
    if years * window != quantiles_n:
        raise ValueError(
            f"{quantiles_n} quantiles need quantiles_n == full years * window, but the data have "
            f"{years} full years and the window is {window}"
        )


def train_qplad(
    coarse: DataFrame,
    fine: DataFrame,
    value_col: str,
    kind: str,
    cell_cols: Sequence[str] = ("cell",),
    quantiles_n: int = 620,
    window: int = 31,
    calendar: str = timeaxis.NOLEAP,
    time_range: tuple | DataFrame | None = None,
) -> DataFrame:
    """Model of one row per (cell, doy): ``af``, a factor per rank of the coarse pool.

    ``coarse`` holds the coarse value tiled onto the fine cells (``broadcast_coarse``). The days pooled
    for a day of the year are those around it in all full years; sorted by coarse value, then by time, the
    factor at each rank is fine minus (``+``) or over (``*``) coarse *of the same day*. Days without a
    coarse value rank last, with no factor. A pool of a size other than ``quantiles_n`` is an error. Cells that
    only one side knows, and blocks of days of the year in which one side has none, are left out.
    """
    spec, symbol, cell_cols = pools.pool_spec(calendar, window), kind_symbol(kind), list(cell_cols)

    def side(cube: DataFrame, is_fine: bool) -> DataFrame:
        return cube.select(
            *cell_cols, "date", F.col(value_col).cast("double").alias("_value"), F.lit(is_fine).alias("_fine")
        )

    both = side(coarse, False).unionByName(side(fine, True))
    rows = pools.spread_to_blocks(both, spec, time_range)
    schema = pools.cell_schema(fine, cell_cols) + "doy int, af array<double>"

    def fit(key, table):
        block = key[-1].as_py()
        is_fine = table["_fine"].to_numpy()
        sides = []
        lo, hi = pools.axis_ends(table)
        year0, first_day, centre = kernels.centres(lo, hi, block, spec)
        ends = kernels.split_steps(np.array([lo, hi]), spec.calendar)[0]
        full = slice(ends[0] - year0 + 1, ends[1] - year0)
        for flag in (False, True):
            part = table.filter(pa.array(is_fine == flag))
            series = kernels.spread(part["_step"].to_numpy(), part["_value"].to_numpy(), lo, hi, spec)
            pool = kernels.windows(series, centre[full], spec)
            sides.append(pool.transpose(2, 1, 0).reshape(pool.shape[2], -1))
        by_coarse = np.argsort(sides[0], axis=1, kind="stable")
        low, high = (np.take_along_axis(s, by_coarse, axis=1) for s in sides)
        n_days = low.shape[0] if low.shape[1] and 0 < np.count_nonzero(is_fine) < len(is_fine) else 0
        return pa.table(
            {
                **pools.repeat_key(key, cell_cols, n_days),
                "doy": pa.array(first_day + 1 + np.arange(n_days), pa.int32()),
                "af": pools.list_column(kernels.factors(high, low, symbol)[:n_days].reshape(n_days, -1))
                if n_days
                else pa.array([], pa.list_(pa.float64())),
            }
        )

    ship(rows.sparkSession)
    model = rows.groupBy(*cell_cols, "_block").applyInArrow(fit, schema)
    wrong_size = F.concat(
        F.lit("pool of day "), F.col("doy"), F.lit(" has "), F.size("af"), F.lit(f" members, not {quantiles_n}")
    )
    checked = F.when(F.size("af") == quantiles_n, F.col("af")).otherwise(F.raise_error(wrong_size))
    return model.select(*cell_cols, "doy", checked.alias("af"))


def apply_qplad(
    simulation: DataFrame,
    model: DataFrame,
    value_col: str,
    kind: str,
    cell_cols: Sequence[str] = ("cell",),
    calendar: str = timeaxis.NOLEAP,
    wet_day_post_correction: bool = False,
) -> DataFrame:
    """Downscale: apply the factor of the node nearest to each day's ``sim_q`` at its day of the year.

    Needs ``sim_q``; the exact ``sim_rank2`` and ``sim_n`` are used where the simulation still has them.
    """
    if "sim_q" not in simulation.columns:
        raise ValueError("downscaling needs the column sim_q from quantile delta mapping")
    cell_cols, n = list(cell_cols), F.size("af")
    if {"sim_rank2", "sim_n"} <= set(simulation.columns):
        node = nearest_node_by_rank(F.col("sim_rank2"), F.col("sim_n"), n)
    else:
        node = nearest_node_by_quantile(F.col("sim_q"), n)
    days = simulation.withColumn("doy", timeaxis.doy(F.col("date"), calendar))
    joined = days.join(model.select(*cell_cols, "doy", "af"), [*cell_cols, "doy"])
    value = apply_correction(F.col(value_col), F.get("af", node), kind)
    out = joined.withColumn(value_col, value.cast(simulation.schema[value_col].dataType))
    out = out.select(*simulation.columns)
    return wet_day_post(out, value_col) if wet_day_post_correction else out


def broadcast_coarse(
    coarse: DataFrame, cell_map: DataFrame, coarse_col: str = "coarse_cell", fine_col: str = "cell"
) -> DataFrame:
    """Tile coarse values onto fine cells: ``cell_map`` pairs each ``fine_col`` with its ``coarse_col``.

    Counts the cell map (a small action): broadcast, it keeps the days of a coarse cell with many fine
    cells spread out; a map too large for that has many coarse cells to shuffle on.
    """
    pairs = broadcast_if(is_small(cell_map), cell_map.select(coarse_col, fine_col))
    return coarse.join(pairs, coarse_col).drop(coarse_col)


def spatial_mean(cube: DataFrame, value_cols: Sequence[str], by: Sequence[str] = ("date",)) -> DataFrame:
    """Unweighted mean over cells; missing values are left out."""
    return cube.groupBy(*by).agg(*[F.avg(v).alias(v) for v in value_cols])
