"""Sparse systems against numpy, and maps of images and positions of objects that were planted."""

import numpy as np
import pytest

from heliotab.operators import astrometry, sparse


def system(n, seed):
    r = np.random.default_rng(seed)
    a = np.diag(r.uniform(4, 9, n))
    for _ in range(3 * n):
        i, j = r.integers(0, n, 2)
        if i != j:
            v = r.uniform(-0.5, 0.5)
            a[i, j] += v
            a[j, i] += v
            a[i, i] += abs(v)
            a[j, j] += abs(v)
    return a


def as_table(spark, a, upper=False):
    i, j = np.nonzero(np.triu(a) if upper else a)
    return spark.createDataFrame([(int(x), int(y), float(a[x, y])) for x, y in zip(i, j)], "row long, col long, value double")


def test_conjugate_gradients_of_a_thousand_unknowns(spark):
    a, b = system(1000, 1), np.random.default_rng(2).normal(size=(2, 1000))
    b[1, 5:] = 0
    sides = spark.createDataFrame([(k, i, float(b[k, i])) for k in range(2) for i in range(1000) if b[k, i]], "k int, row long, value double")
    got = sparse.conjugate_gradients(sparse.mirrored(as_table(spark, a, upper=True)), sides, tolerance=1e-12).collect()
    x = np.zeros((2, 1000))
    for r in got:
        x[r["k"], r["row"]] = r["value"]
    assert np.abs(x - np.linalg.solve(a, b.T).T).max() < 1e-9


def test_bordered_systems(spark):
    a, r = system(40, 3), np.random.default_rng(4)
    b, d, f, g = r.normal(size=(40, 2)), np.diag([50.0, 60.0]), r.normal(size=40), r.normal(size=2)
    border = spark.createDataFrame([(k, i, float(b[i, k])) for k in range(2) for i in range(40)], "k int, row long, value double")
    side = spark.createDataFrame([(i, float(f[i])) for i in range(40)], "row long, value double")
    x, y = sparse.bordered(as_table(spark, a), border, d.tolist(), side, g.tolist(), tolerance=1e-12)
    want = np.linalg.solve(np.block([[a, b], [b.T, d]]), np.concatenate([f, g]))
    assert np.allclose([v for _, v in sorted((v["row"], v["value"]) for v in x.collect())], want[:40]) and np.allclose(y, want[40:])


def test_systems_of_nothing(spark):
    none = spark.createDataFrame([], "row long, col long, value double")
    assert not sparse.conjugate_gradients(none, spark.createDataFrame([], "k int, row long, value double")).collect()
    one = spark.createDataFrame([(0, 0, 4.0)], "row long, col long, value double")
    assert [tuple(r) for r in sparse.conjugate_gradients(one, spark.createDataFrame([(0, 0, 0.0)], "k int, row long, value double")).collect()] == [(0, 0, 0.0)]


def planted(order, seed, images=6, objects=80, outliers=0.03):
    """Measures x, y on images whose maps to the sky are polynomials; the inverse is found by iteration."""
    r = np.random.default_rng(seed)
    sky = r.uniform(-1, 1, (objects, 2))
    own = astrometry.terms(order)
    maps = {i: r.normal(0, 0.02, (2, len(own))) for i in range(images)}
    for m in maps.values():
        m[0, own.index((1, 0))] += 1
        m[1, own.index((0, 1))] += 1
    rows = []
    for i, m in maps.items():
        for o in range(objects):
            p = sky[o].copy()
            for _ in range(60):
                p -= np.array([sum(c * p[0] ** a * p[1] ** b for c, (a, b) in zip(m[k], own)) for k in (0, 1)]) - sky[o]
            p += r.normal(0, 1e-5, 2)
            rows.append((i, o, float(p[0] + (0.3 if r.random() < outliers else 0)), float(p[1]), float(r.uniform(0.5, 2))))
    return sky, maps, rows


@pytest.mark.parametrize("order", [1, 2])
def test_planted_maps_come_out(spark, order):
    sky, maps, rows = planted(order, order)
    measures = spark.createDataFrame([*rows, (0, None, 1.0, 1.0, 1.0), (0, 1, None, 1.0, 1.0), (0, 1, 9.0, 9.0, 0.0)], "image int, object int, x double, y double, w double")
    reference = spark.createDataFrame([(o, float(sky[o, 0]), float(sky[o, 1])) for o in range(80) if o % 4], "object int, x double, y double")
    got, positions = astrometry.calibrate(measures, reference, order=order, passes=8)
    got, positions = got.collect(), positions.collect()
    assert len(got) == len(maps) and len(positions) == 80
    for r in got:
        assert np.abs(np.array([r["ax"], r["ay"]]) - maps[r["image"]]).max() < 1e-4 and r["s"] < 3e-5 and 60 < r["n"] < 80
    away = [abs(r["px"] - sky[r["object"], 0]) + abs(r["py"] - sky[r["object"], 1]) for r in positions]
    assert np.quantile(away, 0.9) < 1e-4
    assert {r["object"] for r in positions if r["fixed"]} == {o for o in range(80) if o % 4}


def test_images_with_too_few_measures(spark):
    measures = spark.createDataFrame([(0, 0, 1.0, 2.0, 1.0), (1, 1, 3.0, 4.0, 1.0)], "image int, object int, x double, y double, w double")
    reference = spark.createDataFrame([(0, 1.5, 2.5)], "object int, x double, y double")
    maps, positions = astrometry.calibrate(measures, reference, passes=2)
    maps = {r["image"]: r for r in maps.collect()}
    moved = [a[0] + a[1] * 1.0 + a[2] * 2.0 for a in (maps[0]["ax"], maps[0]["ay"])]
    assert np.allclose(moved, [1.5, 2.5]) and {r["object"]: (r["px"], r["py"]) for r in positions.collect()}[1] == pytest.approx((3.0, 4.0))


def test_joint_offsets_against_least_squares(spark):
    r = np.random.default_rng(8)
    sky, shift = r.uniform(0, 10, (30, 2)), r.normal(0, 1, (5, 2))
    rows = [(i, o, *(float(v) for v in sky[o] - shift[i] + r.normal(0, 0.01, 2)), float(r.uniform(0.5, 2))) for i in range(5) for o in range(30) if r.random() < 0.4]
    known = {o: sky[o] for o in range(0, 30, 6)}
    got = astrometry.joint_offsets(spark.createDataFrame(rows, "image int, object int, x double, y double, w double"), spark.createDataFrame([(o, *map(float, p)) for o, p in known.items()], "object int, x double, y double"), tolerance=1e-12).collect()
    free = sorted({o for _, o, *_ in rows} - set(known))
    a, b = np.zeros((len(rows), 5 + len(free))), np.zeros((len(rows), 2))
    for n, (i, o, x, y, w) in enumerate(rows):
        a[n, i] = w**0.5
        b[n] = [-x * w**0.5, -y * w**0.5]
        if o in known:
            b[n] += known[o] * w**0.5
        else:
            a[n, 5 + free.index(o)] = -(w**0.5)
    want = np.linalg.lstsq(a, b, rcond=None)[0]
    for row in got:
        at = row["row"] // 2 if row["row"] % 2 == 0 else 5 + free.index(row["row"] // 2)
        assert np.allclose([row["dx"], row["dy"]], want[at], atol=1e-8)
