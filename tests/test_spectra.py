"""Period searches over long series: work grows with rows and periods, and the powers are those of the direct sums."""

import math

import numpy as np

from heliotab.operators import spectra, stats


def test_long_series_in_bounded_work(spark, monkeypatch):
    """Half the rows in one block, the rest over 60,000 units with gaps: 108,001 periods, which the direct sums would take times 6,000 rows."""
    rng = np.random.default_rng(3)
    t = np.concatenate([rng.uniform(100, 110, 3000), rng.uniform(20_000, 60_000, 2998), [0.0, 60_000.0]])
    y = np.sin(2 * math.pi * t / 17.3) + rng.normal(size=len(t))
    df = spark.createDataFrame(list(zip(t.tolist(), y.tolist())), "t double, y double")

    def never(*_):
        raise AssertionError("direct sums")

    monkeypatch.setattr(stats, "_power", never)
    got = {r.period: r.power for r in stats.period_search(df, "t", "y", 5.0, 50.0).collect()}
    grid = list(stats.period_grid(5.0, 50.0, 60_000.0))
    assert sorted(got) == grid and abs(max(got, key=got.get) - 17.3) < 0.01
    d, v = y - y.mean(), y.var(ddof=1)
    for p in (*grid[::9000], grid[-1], max(got, key=got.get)):
        w = 2 * math.pi / p
        a = math.atan2(np.sin(2 * w * t).sum(), np.cos(2 * w * t).sum()) / 2
        c, s = np.cos(w * t - a), np.sin(w * t - a)
        power = ((d @ c) ** 2 / (c @ c) + (d @ s) ** 2 / (s @ s)) / (2 * v)
        assert abs(got[p] - power) < 1e-8 * max(1, power)


def test_waves_are_interpolated_to_rounding():
    x = np.linspace(-1, 1, 1001)
    for a in (0.1, spectra.ARGUMENT, 2 * spectra.ARGUMENT):
        assert np.abs(spectra._weights(x) @ np.exp(1j * a * spectra._X) - np.exp(1j * a * x)).max() < 1e-13
