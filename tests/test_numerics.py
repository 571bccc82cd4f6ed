"""Splines, small matrices, components, and the light in small images, against plain computations."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.functions import sky
from heliotab.operators import fits, graphs, group_fits, images, matrices, photometry

NAN = float("nan")


def test_spline_is_natural_and_exact_at_nodes(spark):
    r = np.random.default_rng(2)
    x, y = np.sort(r.uniform(0, 10, 9)), r.normal(size=9)
    n, h = len(x), np.diff(x)
    a, b = np.eye(n), np.zeros(n)
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        b[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    m = np.linalg.solve(a, b)

    def value(v):
        i = min(max(np.searchsorted(x, v) - 1, 0), n - 2)
        p, q = (x[i + 1] - v) / h[i], (v - x[i]) / h[i]
        return p * y[i] + q * y[i + 1] + ((p**3 - p) * m[i] + (q**3 - q) * m[i + 1]) * h[i] ** 2 / 6

    nodes = spark.createDataFrame([(1, float(u), float(v)) for u, v in zip(x, y)] + [(2, 1.0, 5.0), (2, 3.0, 9.0), (3, 2.0, 4.0)], "k int, x double, y double")
    at = [*map(float, x), *map(float, np.linspace(x[0], x[-1], 40))]
    points = spark.createDataFrame([(1, v) for v in at] + [(1, -5.0), (1, 99.0), (2, 2.0), (3, 2.0), (3, 2.5), (4, 1.0), (None, 1.0)], "k int, x double")
    got = [(q["k"], q["x"], q["s"]) for q in fits.spline(points, nodes, ["k"], "x", "y", "s").collect()]
    for k, v, s in got:
        if k == 1 and x[0] <= v <= x[-1]:
            assert abs(s - value(v)) < 1e-9
        else:
            assert s == {(2, 2.0): 7.0, (3, 2.0): 4.0}.get((k, v))


def test_matrices_of_every_kind(spark):
    data = [(1, [2.0, 1.0, 1.0, 3.0], [3.0, 5.0]), (2, [1.0, 2.0, 2.0, 4.0], [1.0, 1.0]), (3, None, None), (4, [1.0, NAN, 0.0, 1.0], [1.0, 1.0]), (5, [1.0], [1.0])]
    df = spark.createDataFrame(data, "k int, m array<double>, b array<double>")
    inv = {r["k"]: r for r in matrices.inverse(df, "m", 2).collect()}
    assert abs(inv[1]["determinant"] - 5) < 1e-12 and np.allclose(inv[1]["inverse"], [0.6, -0.2, -0.2, 0.4]) and inv[2]["inverse"] is None and all(inv[k]["determinant"] is None for k in (3, 4, 5))
    out = {r["k"]: r["solution"] for r in matrices.solved(df, "m", "b", 2).collect()}
    assert np.allclose(out[1], [0.8, 1.4]) and out[2] is None and out[3] is None
    s = {r["k"]: r for r in matrices.singular_values(df, "m", 2).collect()}
    u, w, vt = (np.array(s[1][c]) for c in ("u", "w", "vt"))
    assert np.allclose(u.reshape(2, 2) @ np.diag(w) @ vt.reshape(2, 2), [[2, 1], [1, 3]])


@pytest.mark.parametrize("seed", range(2))
def test_components_by_union(spark, seed):
    r = random.Random(seed)
    edges = [(r.randint(0, 150), r.randint(0, 150)) for _ in range(100)] + [(i, i + 1) for i in range(500, 560)] + [(7, 7)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {q["node"]: q["root"] for q in graphs.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_parallax_and_motion_are_found(spark):
    rows = [(k, 2451545.0 + 3652 * i / 40) for k in (1, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "k int, day double").withColumn("ra", F.lit(100.0)).withColumn("dec", F.lit(-30.0)).withColumn("t", (F.col("day") - 2453371) / 365.25)
    px, py = sky.parallax_factors(F.col("ra"), F.col("dec"), F.col("day"))
    df = df.withColumn("px", px).withColumn("py", py)
    assert df.agg(F.max(F.abs("px"))).first()[0] < 1.02
    fit = {q["k"]: q for q in group_fits.motion_and_parallax(df, ["k"], 0.1 + 0.5 * F.col("t") + F.col("k") * F.col("px"), 0.2 - 0.3 * F.col("t") + F.col("k") * F.col("py"), F.col("t"), F.col("px"), F.col("py")).collect()}
    for k in (1, 2):
        assert np.allclose([fit[k][c] for c in ("x0", "mu_x", "y0", "mu_y", "parallax")], [0.1, 0.5, 0.2, -0.3, k]) and fit[k]["n"] == 80


@pytest.fixture(scope="module")
def light(spark):
    """A round light of width 2 at (15, 12) on a level of 3, with a bad pixel."""
    return photometry.gaussian_image(spark, 31, 25, 15.0, 12.0, 2.0, 100.0).withColumn("v", F.col("v") + 3).withColumn("k", F.lit(0))


def test_apertures_rings_and_moments(spark, light):
    places = spark.createDataFrame([(0, 1, 15.0, 12.0), (0, 2, 90.0, 90.0), (9, 3, 15.0, 12.0)], "k int, star int, x double, y double")
    got = photometry.apertures(places, light, ["k"], "star", 7.0, 9.0, 11.0).collect()
    assert len(got) == 1 and abs(got[0]["sky"] - 3) < 0.01 and abs(got[0]["flux"] - 100 * 2 * math.pi * 4) < 10
    m = photometry.moments(light.withColumn("v", F.col("v") - 3), ["k"]).first()
    assert abs(m["x"] - 15) < 1e-6 and abs(m["y"] - 12) < 1e-6 and abs(m["major"] - 2) < 0.01 and abs(m["minor"] - 2) < 0.01
    p = photometry.radial_profile(light.withColumn("v", F.col("v") - 3), ["k"], 15.0, 12.0).orderBy("ring").collect()
    assert [q["ring"] for q in p] == sorted(q["ring"] for q in p) and abs(p[9]["inside"] - 100 * 2 * math.pi * 4) < 5
    assert photometry.petrosian(photometry.radial_profile(light.withColumn("v", F.col("v") - 3), ["k"], 15.0, 12.0), ["k"]).first()["ring"] == 5
    kron = photometry.kron(light.withColumn("v", F.col("v") - 3), ["k"], 15.0, 12.0, 9.0).first()
    assert abs(kron["radius"] - 2 * math.sqrt(math.pi / 2)) < 0.05 and kron["flux"] > 0.9 * 100 * 2 * math.pi * 4


def test_detections_touch(spark):
    bright = [(0, 1, 1), (0, 2, 2), (0, 3, 1), (0, 8, 8), (1, 1, 1)]
    df = spark.createDataFrame([(*b, 5.0) for b in bright] + [(0, 5, 5, 1.0)], "k int, x int, y int, v double")
    got = sorted((q["k"], q["root"], q["n"]) for q in photometry.detections(df, "k", 2.0, 10, 10).collect())
    assert got == [(0, 11, 3), (0, 88, 1), (1, 111, 1)]
    assert photometry.detections(df, "k", 99.0, 10, 10).count() == 0


def test_bad_pixels_and_columns(spark):
    flat = spark.createDataFrame([(0, x, y, 10.0 + (50.0 if x == 3 else 0.0)) for x in range(8) for y in range(6)], "k int, x int, y int, v double")
    assert {q["v"] for q in photometry.level_columns(flat, ["k"], 5.0).where("x NOT IN (2, 4)").collect()} == {10.0}
    spot = flat.withColumn("v", F.when((F.col("x") == 6) & (F.col("y") == 2), 1e9).otherwise(10.0))
    assert {q["v"] for q in photometry.mended(spot, ["k"], F.col("v") > 1e6).collect()} == {10.0}
    over = photometry.overscan_subtracted(flat.withColumn("v", F.col("v") + F.col("y")), ["k"], 6, 7)
    assert {(q["x"], q["v"]) for q in over.collect()} == {(x, 50.0 if x == 3 else 0.0) for x in range(6)}


def test_samples_between_pixels(spark):
    df = spark.createDataFrame([(1, x, y, float(10 * x + y)) for x in range(4) for y in range(3)], "k int, x int, y int, v double")
    points = spark.createDataFrame([(1, 1, 0.5, 0.5), (1, 2, 3.0, 2.0), (1, 3, 3.5, 0.0), (2, 4, 0.0, 0.0)], "k int, id int, x double, y double")
    assert {q["id"]: q["v"] for q in images.sampled(df, points, ["k"], "id").collect()} == {1: 5.5, 2: 32.0}
