"""The best periods of series of long spans: few periods' powers are taken exactly, and the best of all is among them."""

import numpy as np
import pytest

from heliotab.operators import periods
from heliotab.operators.stats import period_grid

_GRID = periods.by_span(5.0, 45.0)


def _series(kind):
    r = np.random.default_rng(5)
    n = {"three": 3, "many": 900}.get(kind, 60)
    t = np.sort(np.round(r.uniform(0, 12000, n), 1))
    if kind == "clumped":
        t = np.sort(np.round(r.integers(0, 600, n) * 20.0 + r.integers(0, 2, n) * 0.1, 1))
    y = r.normal(size=n) * 5 + {"wave": 30 * np.sin(2 * np.pi * t / 17.3), "beyond": 30 * np.sin(2 * np.pi * t / 45.2)}.get(kind, 0)
    return t, y


@pytest.mark.parametrize("kind", ["noise", "wave", "beyond", "three", "many", "clumped"])
def test_the_best_of_all_periods_is_kept(kind):
    t, y = _series(kind)
    d, span, variance = y - y.mean(), float(t[-1] - t[0]), y.var(ddof=1)
    every = np.array(list(period_grid(5.0, 45.0, span)))
    some = periods._may_be_best(t, d, _GRID, span)
    (exact,) = periods._periods(_GRID, np.array([span]), [some])
    assert list(exact) == list(every[some[some < len(every)]]) and len(some) < len(every) // 4
    found, best = periods._greatest(t, d, variance, exact), periods._greatest(t, d, variance, every)
    assert found[0] == best[0] and found[1] == pytest.approx(best[1], rel=1e-12)


def test_groups_of_one_task(spark):
    """Series of long and short spans, and one that has no power, in tasks that take many; a group is one row for Python."""
    kinds = ["noise", "wave", "beyond", "three", "clumped"]
    rows = [(g, float(t), float(y)) for g, k in enumerate(kinds) for t, y in zip(*_series(k))] + [(7, 1.0, 2.0), (7, 9.0, 3.0), (8, 0.0, 1.0), (8, 90.0, 5.0), (8, 190.0, 2.0)]
    out = periods.best_grouped(spark.createDataFrame(rows, "g long, t double, y double"), ["g"], "t", "y", _GRID)
    found = {r.g: (r.period, r.power) for r in out.collect()}
    for g, series in [*((g, _series(k)) for g, k in enumerate(kinds)), (8, (np.array([0.0, 90, 190]), np.array([1.0, 5, 2])))]:
        t, y = series
        best = periods._greatest(t, y - y.mean(), y.var(ddof=1), np.array(list(period_grid(5.0, 45.0, float(t[-1] - t[0])))))
        assert found[g][0] == best[0] and found[g][1] == pytest.approx(best[1], rel=1e-9)
    assert set(found) == {*range(len(kinds)), 8}
    assert "InArrow" in out._jdf.queryExecution().optimizedPlan().toString() and "FlatMapGroups" not in out._jdf.queryExecution().optimizedPlan().toString()
