"""The array kernels against their definitions."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridmend.functions import kernels

values = st.lists(st.one_of(st.none(), st.integers(0, 5)), min_size=12, max_size=12)


@settings(max_examples=60, deadline=None)
@given(st.lists(values, min_size=1, max_size=6), st.integers(0, 3))
def test_ranks(years, half):
    """(window 3, years, days 4) pools; the middle window position is the target."""
    pool = np.array([[np.nan if v is None else float(v) for v in y] for y in years]).reshape(len(years), 3, 4).transpose(1, 0, 2)
    target = pool[1]
    below, equal, size = kernels.rank_counts(pool, target, half, slice(0, len(years)))
    for y in range(len(years)):
        for d in range(4):
            near = pool[:, max(0, y - half) : y + half + 1, d]
            assert below[y, d] == np.sum(near < target[y, d])
            assert equal[y, d] == np.sum(near == target[y, d])
            assert size[y, d] == np.sum(~np.isnan(near))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=30))
def test_quantiles(members):
    pool = np.array([np.nan if v is None else v for v in members]).reshape(1, -1, 1)
    flat, sizes = kernels.sorted_pools(pool)
    nodes = np.array([0.05, 0.5, 0.95])
    got = kernels.quantiles(flat, sizes, nodes)[0]
    known = pool[~np.isnan(pool)]
    assert sizes[0] == known.size
    if known.size:
        assert np.allclose(got, np.quantile(known, nodes), rtol=1e-12, atol=1e-9)
    else:
        assert np.isnan(got).all()


def test_blocks_cover_every_day_once():
    for calendar, lo, hi in (("noleap", 1999 * 365 + 40, 2001 * 365 + 300), ("standard", 10000, 11500)):
        spec = kernels.PoolSpec(calendar, 5)
        seen = np.concatenate([kernels.centres(lo, hi, b, spec)[2].ravel() for b in range(kernels.LAST_BLOCK + 1)])
        inside = np.sort(seen[seen < hi - lo + 1 + 2 * spec.half])
        assert np.array_equal(inside, np.arange(lo, hi + 1) - lo + spec.half)


def test_ratio_to_zero_has_no_value():
    assert np.isnan(kernels.factors(np.array([1.0, 0.0]), np.zeros(2), "*")).all()
    assert kernels.factors(np.array([3.0]), np.array([2.0]), "*")[0] == 1.5
    assert kernels.factors(np.array([3.0]), np.array([2.0]), "+")[0] == 1.0


def test_days_that_would_be_lost_raise():
    spec = kernels.PoolSpec()
    ones = np.ones(2)
    with pytest.raises(ValueError, match="outside"):
        kernels.spread(np.array([4, 11]), ones, 0, 10, spec)
    with pytest.raises(ValueError, match="two values"):
        kernels.spread(np.array([4, 4]), ones, 0, 10, spec)
