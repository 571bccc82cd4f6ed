"""Planted turns, scales and shifts of star lists."""

import math
import random

import pytest

from heliotab.operators import patterns


def lists(seed, images=4, n=60, extra=20, scale=1.0):
    r = random.Random(seed)
    stars, refs, maps = [], [], {}
    for k in range(images):
        t, p, q = math.radians(r.uniform(-4, 4)), r.uniform(-80, 80), r.uniform(-80, 80)
        a, b = scale * math.cos(t), scale * math.sin(t)
        maps[k] = a, b, p, q
        for i in range(n):
            x, y, mag = r.uniform(0, 500), r.uniform(0, 500), r.uniform(10, 20)
            stars.append((k, i, x, y, mag))
            refs.append((k, 1000 + i, a * x - b * y + p + r.gauss(0, 0.05), b * x + a * y + q + r.gauss(0, 0.05), mag + r.gauss(0, 0.2)))
        for i in range(extra):
            stars.append((k, 500 + i, r.uniform(0, 500), r.uniform(0, 500), r.uniform(10, 20)))
            refs.append((k, 2000 + i, r.uniform(0, 500), r.uniform(0, 500), r.uniform(10, 20)))
    return stars, refs, maps


COLUMNS = "image int, id int, x double, y double, mag double"


@pytest.mark.parametrize("scale", [1.0, 1.04])
def test_planted_maps_are_found(spark, scale):
    stars, refs, maps = lists(int(scale * 100), scale=scale)
    got = patterns.match(spark.createDataFrame([*stars, (9, 1, 1.0, 1.0, 1.0), (0, 7, None, 1.0, 1.0)], COLUMNS), spark.createDataFrame(refs, COLUMNS), scales=(1.0, 1.02, 1.04), bin_=6.0).collect()
    assert {r["image"] for r in got} == set(maps)
    for r in got:
        a, b, p, q = maps[r["image"]]
        assert abs(r["a"] - a) < 1e-3 and abs(r["b"] - b) < 1e-3 and abs(r["p"] - p) < 0.3 and abs(r["q"] - q) < 0.3 and r["n"] >= 60


def test_a_wider_pass_finds_what_the_brightest_miss(spark):
    """The brightest stars of both lists have nothing in common."""
    stars, refs, maps = lists(5, images=1, extra=0)
    r = random.Random(6)
    stars += [(0, 5000 + i, r.uniform(0, 500), r.uniform(0, 500), 1.0) for i in range(30)]
    refs += [(0, 6000 + i, r.uniform(0, 500), r.uniform(0, 500), 1.0) for i in range(30)]
    (got,) = patterns.match(spark.createDataFrame(stars, COLUMNS), spark.createDataFrame(refs, COLUMNS), brightest=15, share=0.6).collect()
    assert got["used"] > 30 and abs(got["p"] - maps[0][2]) < 0.3 and got["n"] >= 60


def test_nearest_against_all(spark):
    r = random.Random(7)
    own = [(0, i, r.uniform(0, 30), r.uniform(0, 30), 1.0) for i in range(80)]
    ref = [(0, i, r.uniform(0, 30), r.uniform(0, 30), 1.0) for i in range(80)]
    maps = spark.createDataFrame([(0, 1.0, 0.0, 0.5, -0.5)], "image int, a double, b double, p double, q double")
    got = {x["id"]: x["ref"] for x in patterns.nearest(spark.createDataFrame(own, COLUMNS), spark.createDataFrame(ref, COLUMNS), maps, 2.0).collect()}
    want = {}
    for _, i, x, y, _ in own:
        d, j = min((math.hypot(x + 0.5 - u, y - 0.5 - v), j) for _, j, u, v, _ in ref)
        if d <= 2.0:
            want[i] = j
    assert got == want


def test_no_lists(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert not patterns.match(none, none).collect()


@pytest.mark.parametrize("block", [3, 512])
def test_nearest_vectors_against_all(spark, block, monkeypatch):
    """Ties, repeated vectors and nulls; blocks of few queries."""
    from heliotab.operators import vectors

    monkeypatch.setattr(vectors, "BLOCK", block)
    r = random.Random(11)
    rows = [(i, [r.choice([0.0, 1.0, 2.5]) for _ in range(4)]) for i in range(70)] + [(70, None)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(3)
    got = {x["query"]: (x["id"], x["distance"]) for x in vectors.nearest(df, df.where("id % 5 = 0"), "id", "v").collect()}
    want = {}
    for i, a in rows[:70:5]:
        want[i] = min((round(math.dist(a, b), 6), j) for j, b in rows[:70] if j != i)[::-1]
    assert got == want
