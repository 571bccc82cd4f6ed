"""Planted sources: alone, blended, in a chain too long for one task, with shapes that vary; and sources without pixels."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.operators import sources

PIXELS = "image int, x int, y int, v double, var double"
GUESS = "image int, id long, x double, y double, flux double, xx double, xy double, yy double"


def field(stars, nx, ny, sky=0.0, seed=None):
    y, x = np.mgrid[0:ny, 0:nx]
    v = np.full((ny, nx), sky)
    for sx, sy, flux, xx, xy, yy in stars:
        d = xx * yy - xy * xy
        dx, dy = x - sx, y - sy
        v = v + flux / (2 * math.pi * math.sqrt(d)) * np.exp(-(yy * dx * dx - 2 * xy * dx * dy + xx * dy * dy) / (2 * d))
    return v if seed is None else v + np.random.default_rng(seed).normal(0, 1, v.shape)


def made(spark, image):
    return spark.createDataFrame([(0, x, y, float(v), 1.0) for (y, x), v in np.ndenumerate(image)], PIXELS)


def guessed(spark, stars, off=0.4, shape=None):
    r = random.Random(3)
    return spark.createDataFrame([(0, n, x + r.uniform(-off, off), y + r.uniform(-off, off), f * r.uniform(0.7, 1.3), *(shape or s)) for n, (x, y, f, *s) in enumerate(stars)], GUESS)


def test_overlaps_are_those_of_all_pairs(spark):
    r = random.Random(2)
    rows = [(n % 2, n, r.uniform(-20, 20), r.uniform(-20, 20), 1.0, 1.0, 0.0, 1.0) for n in range(120)]
    got = [tuple(p) for p in sources.overlapping(spark.createDataFrame(rows, GUESS), ["image"], "id", 3.0).collect()]
    want = {(a[1], b[1]) for a in rows for b in rows if a[1] < b[1] and a[0] == b[0] and math.hypot(a[2] - b[2], a[3] - b[3]) < 3}
    assert len(got) == len(set(got)) and set(got) == want and want


def test_alone_and_blended_sources_come_out(spark):
    """Two blends of two and of three, and one alone, over a sky; by their shapes too."""
    s = (2.0, 0.5, 1.5)
    stars = [(12.2, 11.7, 900.0, *s), (15.1, 12.4, 500.0, *s), (40.6, 12.3, 2000.0, *s), (20.3, 40.2, 800.0, *s), (23.0, 41.9, 700.0, *s), (20.9, 44.1, 1200.0, *s)]
    df = made(spark, field(stars, 60, 60, 5.0))
    for shapes in (False, True):
        out = {r["id"]: r for r in sources.fit(df, guessed(spark, stars, shape=(1.6, 0.2, 1.6) if shapes else None), ["image"], "id", 7.0, shapes, True).collect()}
        assert {n: r["together"] for n, r in out.items()} == {0: 2, 1: 2, 2: 1, 3: 3, 4: 3, 5: 3}
        for n, star in enumerate(stars):
            r = out[n]
            assert r["rest"] and [r[c] for c in ("x", "y", "flux", "xx", "xy", "yy")] == pytest.approx(list(star), rel=1e-5) and r["sky"] == pytest.approx(5, abs=1e-5)


def test_errors_are_those_of_noise(spark):
    s = (2.0, 0.0, 2.0)
    stars = [(20.0 * i + 10.3, 20.0 * j + 9.8, 1000.0, *s) for i in range(7) for j in range(7)]
    out = sources.fit(made(spark, field(stars, 150, 150, seed=11)), guessed(spark, stars), ["image"], "id", 7.0).collect()
    off = np.array([(r["flux"] - 1000) / r["flux_err"] for r in out])
    assert len(out) == 49 and abs(off.mean()) < 0.5 and 0.7 < off.std() < 1.3
    assert abs(sum(r["chi"] for r in out) / sum(r["pixels"] - 3 for r in out) - 1) < 0.05


def test_a_chain_too_long_for_a_task(spark):
    """Forty sources in a row, each four pixels from the next: cut by squares, and still the planted ones; nothing is left of them."""
    s = (1.2, 0.1, 1.0)
    stars = [(6.0 + 4 * n + 0.1 * (n % 3), 10.0 + 0.2 * (n % 5), 500.0 + 20 * n, *s) for n in range(40)]
    df = made(spark, field(stars, 172, 21))
    out = sources.fit(df, guessed(spark, stars, 0.2), ["image"], "id", 6.0, tolerance=1e-5)
    got = {r["id"]: r for r in out.collect()}
    assert max(r["together"] for r in got.values()) <= sources.LARGEST
    for n, star in enumerate(stars):
        assert [got[n][c] for c in ("x", "y", "flux")] == pytest.approx(list(star[:3]), rel=1e-3)
    assert sources.residual(df, out, ["image"], 7.0).agg(F.max(F.abs("v"))).first()[0] < 0.2


def test_shapes_that_vary_over_the_image(spark):
    """Moments from lone stars as planes, one star being a smudge; they hold at the places of others."""
    at = lambda x, y: (1.5 + 0.01 * x, 0.1 + 0.002 * y, 1.4 + 0.004 * x - 0.003 * y)
    stars = [(x, y, 3000.0, *at(x, y)) for x in [10.2 + 22 * k for k in range(6)] for y in [9.7 + 22 * k for k in range(6)]]
    stars[7] = (*stars[7][:3], 6.0, 0.0, 6.0)
    fitted = sources.fit(made(spark, field(stars, 140, 140)), guessed(spark, stars, shape=(2.0, 0.0, 2.0)), ["image"], "id", 8.0, True)
    over = sources.shapes_over(fitted, ["image"], 1, clip=2.5)
    got = sources.with_shapes(guessed(spark, [(33.0, 70.0, 1.0, 9.0, 9.0, 9.0)], 0.0), over, ["image"], 1).first()
    assert [got[c] for c in ("xx", "xy", "yy")] == pytest.approx(list(at(33.0, 70.0)), abs=1e-4)


def test_sources_without_pixels(spark):
    stars = [(5.0, 5.0, 100.0, 1.0, 0.0, 1.0), (300.0, 300.0, 10.0, 1.0, 0.0, 1.0)]
    df = made(spark, field(stars[:1], 12, 12)).unionByName(spark.createDataFrame([(0, 300, 300, float("nan"), 1.0), (0, 301, 300, None, 1.0), (0, 300, 301, 1.0, 0.0)], PIXELS))
    out = {r["id"]: r for r in sources.fit(df, guessed(spark, stars), ["image"], "id", 4.0).collect()}
    assert out[0]["rest"] and not out[1]["rest"] and out[1]["chi"] is None and out[1]["pixels"] == 0
    assert sources.fit(df.limit(0), guessed(spark, stars), ["image"], "id", 4.0).count() == 2
    assert sources.fit(df, guessed(spark, stars).limit(0), ["image"], "id", 4.0).count() == 0
