"""Moving objects against all triples, areas against sampling, harmonics against quadrature and planted coefficients."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.operators import drizzle, harmonics, tracks


def detections(seed, movers=6, still=10, noise=60, times=6):
    r = random.Random(seed)
    out, kinds = [], {}
    for k in range(movers):
        x, y, vx, vy = r.uniform(0, 60), r.uniform(0, 60), r.uniform(-1.5, 1.5), r.uniform(-1.5, 1.5)
        for t in range(times):
            kinds[len(out)] = k
            out.append((len(out), float(t), x + vx * t + r.uniform(-0.01, 0.01), y + vy * t + r.uniform(-0.01, 0.01)))
    for _ in range(still):
        x, y = r.uniform(0, 60), r.uniform(0, 60)
        out += [(len(out) + t, float(t), x + r.uniform(-0.01, 0.01), y) for t in range(times)]
    for _ in range(noise):
        out.append((len(out), float(r.randrange(times)), r.uniform(0, 60), r.uniform(0, 60)))
    return out, kinds


@pytest.mark.parametrize("seed", [1, 2])
def test_moving_objects_against_all_triples(spark, seed):
    rows, kinds = detections(seed)
    speed, gap, tol = 2.5, 2.0, 0.1
    df = spark.createDataFrame(rows, "id long, t double, x double, y double")
    still = {r["id"] for r in tracks.standing(df, tol).collect()}
    assert still == {a[0] for a in rows for b in rows if a[1] != b[1] and math.hypot(a[2] - b[2], a[3] - b[3]) <= tol}
    moving = [a for a in rows if a[0] not in still]
    own = df.where(~F.col("id").isin(sorted(still)))
    found = tracks.triples(own, tracks.tracklets(own, speed, gap), gap, tol)
    want = set()
    for a in moving:
        for b in moving:
            if 0 < b[1] - a[1] <= gap and math.hypot(b[2] - a[2], b[3] - a[3]) <= speed * (b[1] - a[1]):
                v = [(b[k] - a[k]) / (b[1] - a[1]) for k in (2, 3)]
                want |= {(a[0], b[0], c[0]) for c in moving if 0 < c[1] - b[1] <= gap and math.hypot(*[c[k] - b[k] - v[k - 2] * (c[1] - b[1]) for k in (2, 3)]) <= tol}
    got = [(r["a"], r["b"], r["c"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    lines = {}
    for r in tracks.tracks(found).collect():
        lines.setdefault(r["track"], set()).add(r["id"])
    for k in set(kinds.values()):
        assert any({i for i, o in kinds.items() if o == k and i not in still} <= line for line in lines.values())


def test_a_crowded_field_meets_its_neighbourhood_alone(spark):
    """20,000 detections of two times, of which each has about 0.6 within reach."""
    r = random.Random(9)
    df = spark.createDataFrame([(i, float(i % 2), r.uniform(0, 1000), r.uniform(0, 1000)) for i in range(20_000)], "id long, t double, x double, y double")
    assert 2000 < tracks.tracklets(df, 4.5, 1.0).count() < 12_000


def test_no_detections(spark):
    none = spark.createDataFrame([], "id long, t double, x double, y double")
    assert not tracks.tracks(tracks.triples(none, tracks.tracklets(none, 1.0, 1.0), 1.0, 0.1)).collect() and not tracks.standing(none, 0.1).collect()


@pytest.mark.parametrize("matrix,fraction", [((0.8, 0.3, -0.4, 1.1), 1.0), ((1.0, 0.0, 0.0, 1.0), 0.5), ((0.0, -2.5, 1.7, 0.0), 1.0), ((0.3, 0.1, 0.2, -0.4), 0.7)])
def test_areas_against_sampling(spark, matrix, fraction):
    xx, xy, yx, yy = matrix
    pixels = [(0, 0, 3.0), (1, 0, 5.0), (0, 1, -2.0), (7, -3, 1.0), (2, 2, None), (3, 3, math.nan)]
    out = drizzle.drizzle(spark.createDataFrame([(1, *p) for p in pixels], "image int, x int, y int, v double").withColumn("var", F.lit(2.0)), ["image"], matrix, (0.37, -0.21), fraction=fraction, variance="var").collect()
    assert math.isclose(sum(r["v"] for r in out), 7.0, rel_tol=1e-9)
    assert math.isclose(sum(r["weight"] for r in out), 4 * abs(xx * yy - xy * yx) * fraction**2, rel_tol=1e-9)
    n = 400
    at = (np.arange(n) + 0.5) / n * fraction - fraction / 2
    u, w = np.meshgrid(at, at)
    want = {}
    for x, y, v in pixels[:4]:
        px, py = np.floor(xx * (x + u) + xy * (y + w) + 0.37 + 0.5), np.floor(yx * (x + u) + yy * (y + w) - 0.21 + 0.5)
        cells, counts = np.unique(np.stack([px.ravel(), py.ravel()]), axis=1, return_counts=True)
        for (cx, cy), k in zip(cells.T.astype(int).tolist(), counts.tolist()):
            old = want.get((cx, cy), (0.0, 0.0))
            want[cx, cy] = old[0] + v * k / n**2, old[1] + 2 * (k / n**2) ** 2
    got = {(r["x"], r["y"]): (r["v"], r["variance"]) for r in out}
    for c in set(want) | set(got):
        assert np.allclose(got.get(c, (0, 0)), want.get(c, (0, 0)), atol=0.05)


def test_harmonics_are_orthonormal(spark):
    """By Gauss-Legendre quadrature, exact for these degrees."""
    s, w = np.polynomial.legendre.leggauss(8)
    grid = [(360.0 * i / 16, math.degrees(math.asin(a)), float(b) * 2 * math.pi / 16) for a, b in zip(s, w) for i in range(16)]
    df = spark.createDataFrame(grid, "ra double, dec double, w double")
    own = harmonics.terms(5, F.col("ra"), F.col("dec"))
    y = np.array(df.select(*[c.alias(f"t{i}") for i, c in enumerate(own.values())]).collect())
    assert np.abs(y.T @ (y * np.array([g[2] for g in grid])[:, None]) - np.eye(36)).max() < 1e-12
    both = harmonics.vector_terms(3, F.col("ra"), F.col("dec"))
    e, n = (np.array(df.select(*[v[k].alias(f"t{i}") for i, v in enumerate(both.values())]).collect()) for k in (0, 1))
    weight = np.array([g[2] for g in grid])[:, None]
    assert np.abs(e.T @ (e * weight) + n.T @ (n * weight) - np.eye(30)).max() < 1e-12


def test_planted_coefficients_come_out(spark):
    r = np.random.default_rng(4)
    stars = spark.createDataFrame([(float(r.uniform(0, 360)), float(np.degrees(np.arcsin(r.uniform(-1, 1))))) for _ in range(600)] + [(10.0, None)], "ra double, dec double")
    planted = {k: float(r.normal()) for k in harmonics.degrees_and_orders(5)}
    found = harmonics.fit(stars.withColumn("v", harmonics.apply(planted, F.col("ra"), F.col("dec"))), 5, "ra", "dec", "v")
    assert max(abs(found[k] - planted[k]) for k in planted) < 1e-8
    flow = {(kind, *k): float(r.normal()) for kind in "st" for k in harmonics.degrees_and_orders(2, 1)}
    east, north = harmonics.apply_vectors(flow, F.col("ra"), F.col("dec"))
    found = harmonics.fit_vectors(stars.withColumn("e", east).withColumn("n", north), 2, "ra", "dec", "e", "n")
    assert max(abs(found[k] - flow[k]) for k in flow) < 1e-8
    assert set(harmonics.fit(stars.limit(0).withColumn("v", F.lit(1.0)), 1, "ra", "dec", "v").values()) == {0.0}
