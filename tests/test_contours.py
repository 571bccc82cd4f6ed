"""Contours of planted light, of random pixels walked by hand, and of odd images."""

import math

import numpy as np
import pytest

from heliotab.operators import contours

PIXELS = "image int, x int, y int, v double"


def made(spark, image, number=0, x0=0, y0=0):
    return spark.createDataFrame([(number, x + x0, y + y0, float(v)) for (y, x), v in np.ndenumerate(image)], PIXELS)


def test_ellipses_of_planted_light(spark):
    """An elliptical Gaussian far from the origin, and a hollow of the same shape in another image; a finer grid than the light's width, so straight pieces follow it closely."""
    a = math.radians(25)
    y, x = np.mgrid[0:120, 0:120] - 60.3
    u, w = x * math.cos(a) + y * math.sin(a), y * math.cos(a) - x * math.sin(a)
    light = 100 * np.exp(-0.5 * ((u / 24) ** 2 + (w / 12) ** 2))
    df = made(spark, light, 0, 5000, 7000).unionByName(made(spark, 100 - light, 1, 5000, 7000))
    pieces = contours.labelled(contours.segments(df, "image", 50.0, 8000, 8000))
    got = {r["image"]: r for r in contours.ellipses(pieces, "image", 8000, 8000).collect()}
    scale = math.sqrt(2 * math.log(2))
    for image, sign in ((0, 1), (1, -1)):
        r = got[image]
        assert r["area"] == pytest.approx(sign * math.pi * 24 * 12 * scale**2, rel=2e-3)
        assert (r["x"], r["y"]) == (pytest.approx(5060.3, abs=0.01), pytest.approx(7060.3, abs=0.01))
        assert (r["major"], r["minor"], r["angle"]) == (pytest.approx(24 * scale, rel=2e-3), pytest.approx(12 * scale, rel=2e-3), pytest.approx(25, abs=0.1))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_contours_walked_by_hand(spark, seed):
    """Saddles abound, some pixels are missing, and contours leave the image."""
    r = np.random.default_rng(seed)
    image = np.where(r.random((13, 17)) < 0.05, np.nan, r.integers(0, 9, (13, 17)).astype(float))
    pieces = contours.labelled(contours.segments(made(spark, image), "image", 4.5, 20, 20))
    rows = pieces.collect()
    cuts = 0
    for y in range(12):
        for x in range(16):
            c = [image[y, x], image[y, x + 1], image[y + 1, x + 1], image[y + 1, x]]
            if not np.isnan(c).any():
                cuts += sum((c[k] >= 4.5) != (c[k - 1] >= 4.5) for k in range(4)) // 2
    assert len(rows) == cuts and len({p["a"] for p in rows}) == len(rows) == len({p["b"] for p in rows})
    for p in rows:
        for n, x, y in ((p["a"], p["ax"], p["ay"]), (p["b"], p["bx"], p["b_y"])):
            px, py, up = n // 2 % 20, n // 2 // 20, n % 2
            v, w = image[py, px], image[py + up, px + 1 - up]
            assert (x - px, y - py) == ((0, pytest.approx((4.5 - v) / (w - v))) if up else (pytest.approx((4.5 - v) / (w - v)), 0))
        mx, my = (p["ax"] + p["bx"]) / 2, (p["ay"] + p["b_y"]) / 2
        x, y = int(mx), int(my)
        cell = image[y : y + 2, x : x + 2]
        if (cell[0, 0] >= 4.5) == (cell[1, 1] >= 4.5) != (cell[0, 1] >= 4.5) == (cell[1, 0] >= 4.5):
            lone = {(px, py) for px in (0, 1) for py in (0, 1) if abs(mx - x - px) < 0.5 and abs(my - y - py) < 0.5}
            assert all((cell[py, px] >= 4.5) != (cell.mean() >= 4.5) for px, py in lone)
    on, into = {p["a"]: p["b"] for p in rows}, {p["b"] for p in rows}
    want, seen = {}, set()
    for start in [n for n in on if n not in into] + sorted(on):
        if start in seen:
            continue
        way, n = [start], on.get(start)
        seen.add(start)
        while n is not None and n != start:
            way.append(n)
            seen.add(n)
            n = on.get(n)
        want[min(way)] = (n is not None, way)
    where = {n: (x, y) for p in rows for n, x, y in ((p["a"], p["ax"], p["ay"]), (p["b"], p["bx"], p["b_y"]))}
    got = {}
    for p in contours.points(pieces, "image").orderBy("ring", "ordinal").collect():
        got.setdefault(p["ring"], (p["closed"], []))[1].append((p["ordinal"], p["x"], p["y"]))
    assert got == {k: (closed, [(i, *where[n]) for i, n in enumerate(way)]) for k, (closed, way) in want.items()}
    assert any(c for c, _ in want.values()) and not all(c for c, _ in want.values())


def test_images_without_contours(spark):
    for df in (made(spark, np.ones((4, 4))), made(spark, np.array([[1.0, 9.0]])), made(spark, np.ones((2, 2))).limit(0)):
        pieces = contours.labelled(contours.segments(df, "image", 5.0, 10, 10))
        assert pieces.count() == 0 and contours.points(pieces, "image").count() == 0 and contours.ellipses(pieces, "image", 10, 10).count() == 0
