"""Array kernels over one (cell, block of days of the year): the part of pooling SQL windows do slowly.

Spark partitions the work; a kernel sees the series of one cell restricted to one block of days of the
year plus its halo, so its input is bounded by the calendar (years x (block + window) values).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

DAYS_IN_BLOCK = 122
LAST_BLOCK = 2  # 122 + 122 + 121 days, 122 on a leap year

_centres: dict[tuple, tuple] = {}  # filled once per worker


class PoolSpec(NamedTuple):
    """How days are pooled: a centred ``window`` of time steps around every day of the year."""

    calendar: str = "noleap"
    window: int = 31

    @property
    def half(self) -> int:
        return self.window // 2


def split_steps(steps: np.ndarray, calendar: str) -> tuple[np.ndarray, np.ndarray]:
    """Year and 0-based day of year of each step."""
    if calendar == "noleap":
        return steps // 365, steps % 365
    days = steps.astype("datetime64[D]")
    years = days.astype("datetime64[Y]")
    return years.astype(int) + 1970, (days - years.astype("datetime64[D]")).astype(int)


def block_span(block: int, spec: PoolSpec) -> tuple[int, int]:
    """First 0-based day of the year of a block, and its length."""
    first_day = block * DAYS_IN_BLOCK
    if block < LAST_BLOCK:
        return first_day, DAYS_IN_BLOCK
    return first_day, (365 if spec.calendar == "noleap" else 366) - first_day


def centres(lo: int, hi: int, block: int, spec: PoolSpec) -> tuple[int, int, np.ndarray]:
    """First year, first 0-based day and the (year, day) table of window centres of a block.

    Entries are positions in the padded series of ``spread``; days the axis lacks point into its
    empty tail. A worker keeps the tables it built: all cells share them.
    """
    key = (lo, hi, block, spec)
    if key not in _centres:
        if len(_centres) >= 32:
            _centres.clear()
        _centres[key] = _build_centres(*key)
    return _centres[key]


def _build_centres(lo: int, hi: int, block: int, spec: PoolSpec) -> tuple[int, int, np.ndarray]:
    steps = np.arange(lo, hi + 1)
    years, days = split_steps(steps, spec.calendar)
    first_day, width = block_span(block, spec)
    mine = (days >= first_day) & (days < first_day + width)
    table = np.full((years[-1] - years[0] + 1, width), steps.size + 3 * spec.half)
    table[years[mine] - years[0], days[mine] - first_day] = steps[mine] - lo + spec.half
    return int(years[0]), first_day, table


def spread(steps: np.ndarray, values: np.ndarray, lo: int, hi: int, spec: PoolSpec) -> np.ndarray:
    """The series on its full axis, NaN where it has no value, padded by half a window at both ends.

    Raises for a step outside the axis and for two values of one step, such as a leap day on a calendar without.
    """
    if len(steps) and (steps.min() < lo or steps.max() > hi):
        raise ValueError(f"days outside the time axis: steps {steps.min()}..{steps.max()}, axis {lo}..{hi}")
    if len(steps) and np.bincount(steps - lo).max() > 1:
        raise ValueError(f"a cell has two values for one day of the {spec.calendar} calendar (leap days or duplicates)")
    series = np.full(hi - lo + 1 + 4 * spec.half + 1, np.nan)
    series[steps - lo + spec.half] = values
    return series


def windows(series: np.ndarray, table: np.ndarray, spec: PoolSpec) -> np.ndarray:
    """(window, year, day) values around every centre."""
    offsets = np.arange(-spec.half, spec.half + 1)
    return series[table[None, :, :] + offsets[:, None, None]]


def sorted_pools(pool: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(day, member) pools over all years in ascending order, NaN last, and their sizes without NaN."""
    flat = pool.transpose(2, 1, 0).reshape(pool.shape[2], -1)
    flat = np.sort(flat, axis=1)
    return flat, np.count_nonzero(~np.isnan(flat), axis=1)


def quantiles(flat: np.ndarray, sizes: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Linearly interpolated quantiles of each sorted pool; NaN for an empty one."""
    position = nodes[None, :] * np.maximum(sizes - 1, 0)[:, None]
    below = np.floor(position).astype(int)
    above = np.minimum(below + 1, np.maximum(sizes - 1, 0)[:, None])
    low = np.take_along_axis(flat, below, axis=1)
    high = np.take_along_axis(flat, above, axis=1)
    return low + (high - low) * (position - below)


def many_pools(series: np.ndarray, steps: np.ndarray, values: np.ndarray, n: int, lo: int, hi: int, block: int, spec: PoolSpec):
    """Pools of ``n`` series at once, from their values alone: (members, sizes), the pool of a (series, day of the block) after the other.

    A pool's members ascend; NaN is none. ``series`` numbers each value's series. Raises as ``spread`` does.
    """
    if len(steps) and (steps.min() < lo or steps.max() > hi):
        raise ValueError(f"days outside the time axis: steps {steps.min()}..{steps.max()}, axis {lo}..{hi}")
    taken = np.sort(series * (hi - lo + 1) + steps - lo)
    if (taken[1:] == taken[:-1]).any():
        raise ValueError(f"a cell has two values for one day of the {spec.calendar} calendar (leap days or duplicates)")
    _, width = block_span(block, spec)
    days = centre_days(lo, hi, block, spec)
    order = np.argsort(values, kind="stable")[: np.count_nonzero(~np.isnan(values))]  # NaN comes last
    day = days[(steps[order] - lo)[:, None] + np.arange(2 * spec.half + 1)]
    reached = day >= 0
    pool = (series[order][:, None] * width + day)[reached]
    members = np.repeat(values[order], reached.sum(axis=1))
    by_pool = np.argsort(pool.astype(np.uint16) if n * width <= 1 << 16 else pool, kind="stable")
    return members[by_pool], np.bincount(pool, minlength=n * width)


def centre_days(lo: int, hi: int, block: int, spec: PoolSpec) -> np.ndarray:
    """Day within the block of every step from half a window before the axis to half a window after it; -1 outside axis or block."""
    key = ("days", lo, hi, block, spec)
    if key not in _centres:
        if len(_centres) >= 32:
            _centres.clear()
        first_day, width = block_span(block, spec)
        day = split_steps(np.arange(lo, hi + 1), spec.calendar)[1] - first_day
        _centres[key] = np.pad(np.where((day >= 0) & (day < width), day, -1), spec.half, constant_values=-1)
    return _centres[key]


def pool_quantiles(members: np.ndarray, sizes: np.ndarray, chosen: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """``quantiles`` of the ``chosen`` pools, none of them empty, of ``many_pools``."""
    start, last = (np.cumsum(sizes) - sizes)[chosen], sizes[chosen] - 1
    position = nodes[None, :] * last[:, None]
    below = np.floor(position).astype(int)
    low = members[start[:, None] + below]
    high = members[start[:, None] + np.minimum(below + 1, last[:, None])]
    return low + (high - low) * (position - below)


def rank_counts(pool: np.ndarray, target: np.ndarray, half_years: int, wanted: slice) -> tuple:
    """For each (year, day) target: members below it, equal to it, and present in its pool.

    The pool of a year holds the windows of the years within ``half_years`` of it. Only the ``wanted``
    years are filled.
    """
    n_years = target.shape[0]
    count = np.uint8 if pool.shape[0] < 256 else np.uint32
    present = (~np.isnan(pool)).view(np.uint8).sum(axis=0, dtype=np.int64)
    below, equal, size = (np.zeros(target.shape, np.int64) for _ in range(3))
    for lag in range(-half_years, half_years + 1):
        first = max(wanted.start, -lag, 0)
        last = min(wanted.stop, n_years - lag, n_years)
        if first >= last:
            continue
        here, there = slice(first, last), slice(first + lag, last + lag)
        members, value = pool[:, there], target[here]
        below[here] += (members < value).view(np.uint8).sum(axis=0, dtype=count)
        equal[here] += (members == value).view(np.uint8).sum(axis=0, dtype=count)
        size[here] += present[there]
    return below, equal, size


def factors(wanted: np.ndarray, base: np.ndarray, kind: str) -> np.ndarray:
    """Adjustment factors from ``base`` to ``wanted``; NaN where a ratio has no value."""
    if kind == "+":
        return wanted - base
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(base == 0, np.nan, wanted / base)
