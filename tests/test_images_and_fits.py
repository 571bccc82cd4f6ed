"""Kernels and fits against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.operators import fits, images


@pytest.mark.parametrize("centre", [True, False])
def test_convolve(spark, centre):
    v = np.random.default_rng(1).normal(size=(6, 7))
    kernel = {(i, j): float(1 + i + 3 * j) for i in (-1, 0, 1) for j in (-1, 0, 1) if centre or (i, j) != (0, 0)}
    df = spark.createDataFrame([("a", x, y, float(v[x, y])) for x in range(6) for y in range(7)], "image string, x int, y int, v double")
    want = np.zeros_like(v)
    padded = np.pad(v, 1)
    for (i, j), k in kernel.items():
        want += k * padded[1 + i : 7 + i, 1 + j : 8 + j]
    got = {(r.x, r.y): r.v for r in images.convolve(df, ["image"], kernel).collect()}
    assert len(got) == v.size and all(np.isclose(got[x, y], want[x, y]) for x, y in got)


def test_fits_find_the_coefficients(spark):
    x, y = np.random.default_rng(2).uniform(0, 10, (2, 200))
    z = 1 + 2 * x - y + 0.5 * x * y
    cheb = np.polynomial.chebyshev.chebval((x - 5) / 5, [3, -1, 0.5, 0.25])
    df = spark.createDataFrame([(*map(float, r),) for r in zip(x, y, z, cheb)] + [(None, 1.0, 5.0, 1.0), (1.0, float("nan"), 5.0, float("nan"))], "x double, y double, z double, c double")
    assert np.allclose(fits.linear_fit(df, fits.powers_2d(F.col("x"), F.col("y"), 2), F.col("z")), [1, 2, 0, -1, 0.5, 0], atol=1e-6)
    assert np.allclose(fits.linear_fit(df, fits.chebyshev_terms(F.col("x"), 0.0, 10.0, 3), F.col("c")), [3, -1, 0.5, 0.25], atol=1e-8)


def test_interpolate(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (1, 10.0, 5.0), (1, 20.0, 1.0)], "k int, x double, y double")
    points = spark.createDataFrame([(1, -1.0), (1, 0.0), (1, 4.0), (1, 10.0), (1, 15.0), (1, 21.0), (2, 1.0)], "k int, x double")
    got = {(r.k, r.x): r.v for r in fits.interpolate(points, nodes, ["k"], "x", "y", "v", extrapolate=False).collect()}
    assert got == {(1, -1.0): None, (1, 0.0): 0.0, (1, 4.0): 2.0, (1, 10.0): 5.0, (1, 15.0): 3.0, (1, 21.0): None, (2, 1.0): None}
    single = nodes.unionByName(spark.createDataFrame([(2, 0.0, 7.0)], nodes.schema))
    got = {(r.k, r.x): r.v for r in fits.interpolate(points, single, ["k"], "x", "y", "v").collect()}
    assert got[1, -1.0] == -0.5 and abs(got[1, 21.0] - 0.6) < 1e-12 and got[1, 15.0] == 3.0 and got[2, 1.0] == 7.0
