"""Subtraction with planted kernels and against numpy, stacks with planted bad pixels, culled peaks against flooding."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from heliotab.operators import peaks, stacking, subtraction

PIXELS = "image int, x int, y int, v double"


def rows_of(image, number=0):
    return [(number, x, y, float(v)) for (y, x), v in np.ndenumerate(image)]


def spread(image, k):
    """Plain convolution; null where the kernel leaves the image."""
    h = k.shape[0] // 2
    out = np.full(image.shape, np.nan)
    for y in range(h, image.shape[0] - h):
        for x in range(h, image.shape[1] - h):
            out[y, x] = sum(k[j + h, i + h] * image[y - j, x - i] for j in range(-h, h + 1) for i in range(-h, h + 1))
    return out


@pytest.fixture(scope="module")
def sky():
    r = np.random.default_rng(4)
    return r.poisson(30, (80, 90)).astype(float) + 500 * (r.random((80, 90)) < 0.02)


def test_kernels_share_no_light_but_the_first():
    k = subtraction.kernels([(0.9, 2), (2.0, 2)], 5)
    assert k.shape == (12, 11, 11) and np.allclose(k.sum(axis=(1, 2)), [1] + [0] * 11)


def test_planted_kernel_and_background_with_a_bad_stamp_and_a_new_source(spark, sky):
    """The kernel grows wider along x over the image; one stamp holds a source that isn't in the reference. Tiles of 64 pixels meet inside the image."""
    basis = subtraction.kernels([(0.9, 0), (1.6, 2)], 3)
    c = np.array([1.3, 0.2, 0.05, 0.3, -0.1, 0.02, 0.15])[: len(basis)]
    target = spread(sky, np.tensordot(c, basis, 1))
    slope = spread(sky, basis[3])
    y, x = np.mgrid[0:80, 0:90]
    target = target + 0.4 * (x - 45) / 45 * slope + 7 + 3 * (y - 40) / 45
    target[40, 65] += 4000.0
    df = subtraction.pair(spark.createDataFrame(rows_of(sky), PIXELS), spark.createDataFrame(rows_of(target), PIXELS), ["image"])
    centres = [(0, n, x, y) for n, (x, y) in enumerate((x, y) for x in range(10, 85, 11) for y in range(10, 75, 10))]
    stamps = spark.createDataFrame(centres, "image int, stamp int, x int, y int")
    model = subtraction.Model(basis, 1, 1, (45.0, 40.0), 45.0)
    found = subtraction.fit(subtraction.in_stamps(df, stamps, ["image"], 4), ["image"], model)
    bad = sum(abs(x - 65) <= 4 and abs(y - 40) <= 4 for _, _, x, y in centres)
    assert bad > 0 and found.first()["stamps"] == len(centres) - bad
    left = {(r["x"], r["y"]): r["v"] for r in subtraction.difference(df, ["image"], model, found).collect()}
    assert len(left) == (80 - 6) * (90 - 6)
    assert left.pop((65, 40)) == pytest.approx(4000, abs=1e-5) and max(map(abs, left.values())) < 1e-5
    k = {(r["i"], r["j"]): r["k"] for r in subtraction.kernel_at(found, ["image"], model, 45.0, 40.0).collect()}
    want = np.tensordot(c, basis, 1)
    assert all(k[i, j] == pytest.approx(want[j + 3, i + 3], abs=1e-7) for i in range(-3, 4) for j in range(-3, 4))


def test_subtraction_is_the_least_squares_of_numpy(spark, sky):
    r = np.random.default_rng(8)
    target = r.poisson(40, sky.shape).astype(float)
    basis = subtraction.kernels([(1.0, 1)], 2)
    df = subtraction.pair(spark.createDataFrame(rows_of(sky), PIXELS), spark.createDataFrame(rows_of(target), PIXELS), ["image"]).withColumn("stamp", F.lit(3))
    model = subtraction.Model(basis)
    found = subtraction.fit(df, ["image"], model, rounds=1)
    light = np.stack([spread(sky, k) for k in basis] + [np.where(np.isnan(spread(sky, basis[0])), np.nan, 1.0)])
    inside = ~np.isnan(light[0])
    want = np.linalg.lstsq(light[:, inside].T, target[inside], rcond=None)[0]
    assert np.allclose(found.first()["coefficients"], want, rtol=1e-7)


def test_subtraction_of_odd_images(spark):
    """Null and NaN pixels are as missing ones; no pixels give no fit and no difference."""
    model = subtraction.Model(subtraction.kernels([(1.0, 0)], 1), fill=0.0)
    one = [(0, x, y, 1.0 + (x * y) % 5, 2.0 + (x * y) % 5) for x in range(-3, 4) for y in range(-3, 4)] + [(0, 9, 9, None, 5.0), (0, 10, 10, 1.0, None), (0, 11, 9, float("nan"), float("nan"))]
    df = spark.createDataFrame(one, "image int, x int, y int, r double, v double").withColumn("stamp", F.lit(0))
    found = subtraction.fit(df, ["image"], model)
    assert found.count() == 1 and subtraction.difference(df, ["image"], model, found).count() == 50
    empty = df.limit(0)
    nothing = subtraction.fit(empty, ["image"], model)
    assert nothing.count() == 0 and subtraction.difference(empty, ["image"], model, nothing).count() == 0


KERNEL = {(i, j): k for i in (-1, 0, 1) for j in (-1, 0, 1) for k in [(2 - abs(i)) * (2 - abs(j)) / 16]}


def test_stack_rejects_what_a_kernel_spread_and_keeps_single_outliers(spark):
    r = random.Random(5)
    images = {(n, x, y): 100 + r.gauss(0, 1) for n in range(6) for x in range(20) for y in range(15)}
    for (i, j), k in KERNEL.items():
        images[2, 8 + i, 7 + j] += 4000 * k
        images[4, 9 + i, 7 + j] += 3000 * k
    images[1, 15, 3] += 60
    df = spark.createDataFrame([(*p, v, 1.0) for p, v in images.items()], "image int, x int, y int, v double, var double")
    odd = stacking.deviant(df, [], "image", 6.0, 4)
    got = {tuple(p) for p in odd.select("image", "x", "y").collect()}
    want = {(2, 8 + i, 7 + j) for i, j in KERNEL} | {(4, 9 + i, 7 + j) for i, j in KERNEL} | {(1, 15, 3)}
    assert got == want
    mask = stacking.rejected(df, [], "image", 6.0, 4, KERNEL, 0.9, 0.05)
    gone = {tuple(p) for p in mask.select("image", "x", "y").collect()}
    assert (1, 15, 3) not in gone and {p for p in gone if p[0] == 2} == {(2, 8 + i, 7 + j) for i, j in KERNEL}
    out = {(p["x"], p["y"]): p for p in stacking.stacked(df, [], "image", mask).collect()}
    assert len(out) == 300 and all(abs(p["v"] - 100) < 3 for k, p in out.items() if k != (15, 3))
    assert out[8, 7]["n"] == 4 and out[8, 7]["var"] == pytest.approx(0.25)


def test_stacks_of_two_and_of_nothing(spark):
    schema = "image int, x int, y int, v double, var double"
    two = spark.createDataFrame([(0, 1, 1, 5.0, 1.0), (1, 1, 1, 5000.0, 1.0), (2, 1, 1, None, 1.0), (3, 1, 1, float("nan"), 1.0), (4, 1, 1, 7.0, 0.0)], schema)
    assert stacking.deviant(two, [], "image", 3.0, 3).count() == 0
    assert stacking.stacked(two, [], "image", stacking.rejected(two, [], "image", 3.0, 3, KERNEL, 0.5, 0.1)).first()["n"] == 2
    assert stacking.rejected(two.limit(0), [], "image", 3.0, 3, KERNEL, 0.5, 0.1).count() == 0


def saddles(image):
    """By flooding: from falling levels, the first at which a higher peak is in reach."""
    rank = {(x, y): (v, -(y * 100 + x)) for (y, x), v in np.ndenumerate(image) if v >= 0}
    near = lambda p: [(p[0] + i, p[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (p[0] + i, p[1] + j) in rank]
    out = {}
    for p in rank:
        if all(rank[n] < rank[p] for n in near(p)):
            out[p] = None
            for level in sorted({v for v, _ in rank.values() if v <= rank[p][0]}, reverse=True):
                seen, todo = {p}, [p]
                while todo:
                    for n in near(todo.pop()):
                        if n not in seen and rank[n][0] >= level:
                            seen.add(n)
                            todo.append(n)
                if any(rank[s] > rank[p] for s in seen):
                    out[p] = level
                    break
    return out


@pytest.mark.parametrize("seed,levels", [(1, 50), (2, 4), (3, 1000)])
def test_merge_tree_against_flooding(spark, seed, levels):
    """Random values with many ties, with few, and with holes that part the footprints."""
    r = np.random.default_rng(seed)
    image = r.integers(0, levels, (14, 16)).astype(float)
    image[r.random(image.shape) < 0.25] = -1
    tree = peaks.merge_tree(spark.createDataFrame(rows_of(image), PIXELS), "image", 0.0, 100, 100)
    assert {(p["x"], p["y"]): p["saddle"] for p in tree.collect()} == saddles(image)


def test_peaks_in_a_row_and_two_images(spark):
    """Peaks that rise along a row die one into the next; images don't touch; a lone pixel is a peak."""
    ridge = [(0, x, 0, float(x if x % 2 == 0 else x - 1.5)) for x in range(21)] + [(1, 0, 0, 3.0), (1, 30, 5, float("nan")), (1, 31, 5, None)]
    tree = peaks.merge_tree(spark.createDataFrame(ridge, PIXELS), "image", -5.0, 50, 10)
    got = {(p["image"], p["x"]): p["saddle"] for p in tree.collect()}
    assert got == {(0, x): (None if x == 20 else x - 0.5) for x in range(0, 21, 2)} | {(1, 0): None}
    kept = peaks.culled(tree, F.lit(0.4), 1.0)
    assert {p["x"] for p in kept.where("image = 0").collect()} == set(range(0, 21, 2))
    assert {p["x"] for p in peaks.culled(tree, F.lit(0.6), 1.0).where("image = 0").collect()} == {20}
    assert peaks.merge_tree(spark.createDataFrame([], PIXELS), "image", 0.0, 5, 5).count() == 0
