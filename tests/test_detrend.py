"""Planted shutters and fringes."""

import math

import numpy as np
import pytest

from heliotab.operators import detrend


def test_planted_shutter(spark):
    """Each pixel has an offset of its own; all are divided by one that is open longer, as in a flat of several times."""
    offset = lambda image, x, y: 0.02 * x - 0.01 * y + 0.1 * image
    rows = [(i, x, y, t, (1 + 0.1 * x) * (t + offset(i, x, y)) / (t + 0.35)) for i in (0, 1) for x in range(6) for y in range(5) for t in (1.0, 2.0, 4.0, 8.0, 16.0)]
    rows += [(0, 50, 50, 3.0, 2.0), (0, 51, 50, 1.0, None), (1, 51, 50, 1.0, float("nan"))]
    df = spark.createDataFrame(rows, "image int, x int, y int, t double, v double")
    reference = detrend.shutter_reference(df, ["image"], "t")
    assert {r["image"]: r["reference"] for r in reference.collect()} == {0: pytest.approx(0.35, abs=1e-8), 1: pytest.approx(0.35, abs=1e-8)}
    found = detrend.shutter(df, ["image"], "t", reference)
    for r in found.collect():
        if r["x"] < 50:
            assert (r["scale"], r["offset"]) == (pytest.approx(1 + 0.1 * r["x"]), pytest.approx(offset(r["image"], r["x"], r["y"]), abs=1e-7))
        else:
            assert r["scale"] is None and r["offset"] is None
    mended = detrend.shutter_corrected(df, found, ["image"], "t")
    assert mended.count() == len(rows)
    for r in mended.where("x < 50").collect():
        assert r["v"] == pytest.approx((1 + 0.1 * r["x"]) * r["t"] / (r["t"] + 0.35), abs=1e-7)
    assert detrend.shutter(df.limit(0), ["image"], "t", reference).count() == 0


def test_planted_fringes(spark):
    """Two templates in different shares, with stars on top that clipping leaves out; an image without pixels to fit stays."""
    share = {0: (3.0, -1.5), 1: (0.5, 2.0)}
    rows = []
    for i, (a, b) in share.items():
        for x in range(30):
            for y in range(20):
                f, g = math.sin(x * 0.7 + y * 0.2), math.cos(y * 0.9 - x * 0.1)
                rows.append((i, x, y, 10.0 * (i + 1) + a * f + b * g + (500.0 if (x, y) in ((3, 4), (20, 11)) else 0.0), f, g))
    rows += [(2, 0, 0, 5.0, None, 1.0), (2, 1, 0, 6.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "image int, x int, y int, v double, f double, g double")
    found = detrend.fringes(df, ["image"], ["f", "g"], 4.0)
    got = {r["image"]: r["c"] for r in found.collect()}
    assert got[2] is None and all(got[i] == pytest.approx([10.0 * (i + 1), *share[i]], abs=1e-8) for i in share)
    left = detrend.without_fringes(df, found, ["image"], ["f", "g"]).collect()
    assert len(left) == len(rows) and sorted(r["v"] for r in left if r["image"] == 2) == [5.0, 6.0]
    assert np.allclose([r["v"] for r in left if r["image"] < 2 and (r["x"], r["y"]) not in ((3, 4), (20, 11))], [10.0 * (r["image"] + 1) for r in left if r["image"] < 2 and (r["x"], r["y"]) not in ((3, 4), (20, 11))])
