"""Fits with known answers, Fourier transforms against numpy, images over the pole and the seam, and upkeep of small catalogues."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliotab.functions import sky, strings
from heliotab.operators import catalogue, footprints, fourier, group_fits, images, periods, series
from heliotab.operators.calibrate import weighted_offsets

NAN, INF = float("nan"), float("inf")


def test_clipped_line_ignores_outliers_and_keeps_weights_with_their_rows(spark):
    r = random.Random(1)
    data = [(g, float(x), 3.0 * g + 2 * x + r.gauss(0, 0.1) * (1 + x % 3), 1.0 + x % 3) for g in (1, 2, None) if g for x in range(60)] + [(1, float(x), 1e4, 1.0) for x in (5, 6)]
    data += [(None, float(x), 7.0 - x, 1.0) for x in range(5)] + [(3, 1.0, 1.0, 1.0)] * 4 + [(1, NAN, 1.0, 1.0), (1, 2.0, INF, 1.0), (1, 3.0, 1.0, None), (1, 3.0, 1e9, 0.0)]
    df = spark.createDataFrame(data, "g int, x double, y double, s double")
    fit = {x["g"]: x for x in group_fits.polynomial(df, ["g"], F.col("x"), F.col("y"), 1, sigma=F.col("s"), clip=3.0, passes=6).collect()}
    assert abs(fit[1]["c"][0] - 3) < 0.2 and abs(fit[1]["c"][1] - 2) < 0.02 and fit[1]["n"] <= 60
    assert abs(fit[2]["c"][0] - 6) < 0.2 and np.allclose(fit[None]["c"], [7, -1]) and fit[3]["c"] is None
    robust = {x["g"]: x for x in group_fits.polynomial(df, ["g"], F.col("x"), F.col("y"), 1, robust=True, passes=25).collect()}
    assert abs(robust[1]["c"][1] - 2) < 0.05
    assert group_fits.polynomial(df.limit(0), ["g"], F.col("x"), F.col("y"), 2, clip=2.0).count() == 0


@pytest.mark.parametrize("shape,p,start", [("gaussian", [1.0, 5.0, 3.0, 0.7], [0.5, 4.0, 2.5, 1.0]), ("lorentzian", [0.5, 4.0, -1.0, 1.3], [0.0, 3.0, -0.5, 1.0]), ("sigmoid", [2.0, 3.0, 1.0, 0.4], [1.5, 2.0, 0.5, 1.0]), ("maxwellian", [3.0, 1.6], [2.0, 1.0])])
def test_shapes_are_found(spark, shape, p, start):
    x = np.linspace(-3, 6, 181) if shape != "maxwellian" else np.linspace(0, 8, 161)
    df = spark.createDataFrame([(g, float(v)) for g in (1, 2) for v in x], "g int, x double")
    value = group_fits.SHAPES[shape](F.col("x"), [F.lit(v) for v in p])[0]
    df = df.withColumn("y", value * F.col("g") if shape == "maxwellian" else value)
    begin = spark.createDataFrame([(1, start), (2, start), (9, start)], "g int, p array<double>")
    got = {r["g"]: r for r in group_fits.nonlinear(df, ["g"], F.col("x"), F.col("y"), shape, begin).collect()}
    assert np.allclose(got[1]["p"], p, rtol=1e-5) and got[1]["n"] == len(x) and got[9]["p"] is None
    if shape == "maxwellian":
        assert np.allclose(got[2]["p"], [6.0, 1.6], rtol=1e-5)


@pytest.mark.parametrize("n", [1, 7, 12, 100])
def test_fourier_is_numpys(spark, n):
    r = np.random.default_rng(n)
    values = {g: r.normal(size=n) + 1j * r.normal(size=n) for g in ("a", None)}
    df = spark.createDataFrame([(g, i, float(z.real), float(z.imag)) for g, x in values.items() for i, z in enumerate(x)], "g string, at long, re double, im double")
    out = fourier.fft(df, ["g"], "at", "re", "im", n)
    for g, x in values.items():
        got = {q["k"]: complex(q["re"], q["im"]) for q in out.collect() if q["g"] == g}
        assert np.allclose([got[k] for k in range(n)], np.fft.fft(x))
    back = {(q["g"], q["k"]): complex(q["re"], q["im"]) for q in fourier.fft(out, ["g"], "k", "re", "im", n, inverse=True).collect()}
    assert all(np.allclose([back[g, k] for k in range(n)], x) for g, x in values.items())


def test_images_over_the_pole_and_the_seam(spark):
    pictures = spark.createDataFrame([(1, 359.5, 0.0, 2.0, 1.0, 0.0), (2, 90.0, 89.5, 1.0, 1.0, 30.0), (3, 180.0, -45.0, 2.0, 0.5, 90.0)], "image int, ra0 double, dec0 double, half_x double, half_y double, angle double")
    stars = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 0.0), (3, 270.0, 89.9), (4, 180.0, -43.5), (5, 182.5, -45.0), (6, 358.0, 0.9)], "id int, ra double, dec double")
    got = sorted((r["image"], r["id"]) for r in footprints.containing(stars, pictures, "ra", "dec", 2.3).collect())
    assert got == [(1, 1), (1, 6), (2, 3), (3, 4)]
    cells = footprints.coverage(pictures, 0.5, 2.3, "image").collect()
    assert {r["n"] for r in cells} == {1} and sum(r["low"] == 1 for r in cells) == 8 * 4
    assert len({(r["ra"], r["dec"]) for r in cells}) == len(cells) and any(r["dec"] > 89.5 for r in cells)


def test_coordinates_of_known_places(spark):
    df = spark.createDataFrame([(192.85948, 27.12825), (266.40499, -28.93617), (90.0, 23.4392911)], "ra double, dec double")
    g = df.select(*[c.alias(n) for c, n in zip(sky.galactic(F.col("ra"), F.col("dec")), "lb")]).collect()
    assert abs(g[0]["b"] - 90) < 1e-4 and (g[1]["l"] < 0.01 or g[1]["l"] > 359.99) and abs(g[1]["b"]) < 0.01
    e = df.select(*[c.alias(n) for c, n in zip(sky.ecliptic(F.col("ra"), F.col("dec")), "lb")]).collect()
    assert abs(e[2]["l"] - 90) < 1e-9 and abs(e[2]["b"]) < 1e-9
    day = spark.sql("SELECT timestamp'2000-01-01 12:00:00' AS t").select(sky.julian_date(F.col("t")).alias("jd"), sky.sidereal_hours(sky.julian_date(F.col("t")), 0.0).alias("s")).first()
    assert day["jd"] == 2451545.0 and abs(day["s"] - 18.697374558) < 1e-6


def test_match_once_and_merge(spark):
    a = spark.createDataFrame([(1, 10.0, 0.0), (2, 10.0003, 0.0), (3, 50.0, 0.0)], "src int, ra0 double, dec0 double")
    b = spark.createDataFrame([(7, 10.0001, 0.0), (8, 200.0, 5.0)], "id int, ra double, dec double")
    got = catalogue.match_once(a, b, "src", "id", 2.0, ("ra0", "dec0"), ("ra", "dec")).collect()
    assert [(r["src"], r["id"]) for r in got] == [(1, 7)]
    first = spark.createDataFrame([(1, 10.0, 0.0, 2, 5.0), (2, 80.0, 0.0, 1, 1.0)], "id int, ra double, dec double, n int, mag double")
    second = spark.createDataFrame([(101, 10.0001, 0.0, 2, 7.0), (102, 30.0, 0.0, 4, 9.0)], first.schema)
    out = {r["id"]: (r["n"], r["mag"], r["ra"]) for r in catalogue.merged(first, second, "id", "n", ["mag"], 2.0, ("ra", "dec")).collect()}
    assert out == {1: (4, 6.0, 10.0), 2: (1, 1.0, 80.0), 102: (4, 9.0, 30.0)}


def test_means_follow_new_values(spark):
    old = spark.createDataFrame([(1, 2, 5.0), (2, 1, 1.0)], "k int, n long, mean double")
    new = spark.createDataFrame([(1, 8.0), (1, None), (3, 4.0)], "k int, v double")
    assert sorted(tuple(r) for r in catalogue.updated_means(old, new, "k", "n", "mean", "v").select("k", "n", "mean").collect()) == [(1, 3, 6.0), (2, 1, 1.0), (3, 1, 4.0)]


def test_offsets_are_recovered_in_spite_of_outliers(spark):
    r = random.Random(4)
    a, b = [r.gauss(0, 1) for _ in range(12)], [r.gauss(5, 1) for _ in range(6)]
    rows = [(i, j, a[i] + b[j] + r.gauss(0, 0.01), 1.0 + r.random()) for i in range(12) for j in range(6) for _ in range(5)] + [(i, 0, 900.0, 1.0) for i in range(4)]
    df = spark.createDataFrame(rows + [(None, 1, 2.0, 1.0), (1, 1, NAN, 1.0), (1, 1, 5.0, 0.0)], "i int, j int, v double, w double")
    first, second = weighted_offsets(df, "i", "j", "v", "w", clip=3.0, passes=20)
    ea, eb = ({r[0]: r["effect"] for r in x.collect()} for x in (first, second))
    assert all(abs((ea[i] + eb[j]) - (a[i] + b[j])) < 0.05 for i in range(12) for j in range(6))
    empty, _ = weighted_offsets(df.limit(0), "i", "j", "v", "w")
    assert empty.count() == 0


def test_periods_of_each_object(spark):
    rows = [(g, float(t), math.sin(2 * math.pi * t / p)) for g, p in ((1, 15.0), (2, 8.0)) for t in range(200)] + [(3, 1.0, 1.0)] * 5 + [(1, NAN, 1.0)]
    df = spark.createDataFrame(rows, "g int, t double, y double").withColumn("w", F.lit(1.0))
    grid = [5 * 1.01**k for k in range(150)]
    for found in (periods.grouped(df, ["g"], "t", "y", lambda span: grid), periods.floating_mean(df, ["g"], "t", "y", "w", lambda span: grid)):
        best = {r["g"]: r["period"] for r in periods.best(found, ["g"]).collect()}
        assert abs(best[1] - 15) < 0.3 and abs(best[2] - 8) < 0.2


def test_pixels(spark):
    df = spark.createDataFrame([(1, x, y, float(10 * x + y)) for x in range(4) for y in range(3)], "k int, x int, y int, v double")
    up = {(r["x"], r["y"]): r["v"] for r in images.expand(df, ["k"], 2).collect()}
    assert up[0, 0] == 0 and up[3, 2] == 16 and up[6, 4] == 32 and len(up) == 7 * 5
    moved = {(r["x"], r["y"]): r["v"] for r in images.subpixel_shift(df, ["k"], 0.5, 0.0).collect()}
    assert moved[1, 0] == 5 and (0, 0) not in moved
    assert [(r["x"], r["y"]) for r in images.local_maxima(df, ["k"], 0.0).collect()] == [(3, 2)]
    turned = {(r["x"], r["y"]): r["v"] for r in images.rotate(df, ["k"], 90.0, 0.0, 0.0).collect()}
    assert turned[-2, 3] == 32
    flat = df.withColumn("v", F.lit(2.0))
    assert all(abs(r["v"] - 2) < 1e-12 for r in images.gaussian_smooth(flat, ["k"], 1.0).collect())
    assert images.grow(df.where("x = 3 AND y = 2"), ["k"], 1).count() == 9


def test_series_verbs(spark):
    df = spark.createDataFrame([(g, i, v) for g, x in ((1, [3.0, 1.0, 4.0, 1.0, 5.0]), (None, [2.0])) for i, v in enumerate(x)], "g int, i int, v double")
    rolled = {(r["g"], r["i"]): r["r"] for r in series.roll_first(df, ["g"], ["i"], "v", "r").collect()}
    assert [rolled[1, i] for i in range(5)] == [1.0, 4.0, 1.0, 5.0, 3.0] and rolled[None, 0] == 2.0
    assert sorted((r["g"], r["k"], r["v"]) for r in series.pop_first(df.where("g = 1"), ["g"], ["i"], "k").collect()) == [(1, 0, 1.0), (1, 1, 4.0), (1, 2, 1.0), (1, 3, 5.0)]
    assert [(r["bin"], r["total"]) for r in series.bins_of(df, ["g"], ["i"], "v", 2).orderBy("bin").collect()] == [(0, 4.0), (1, 5.0)]
    assert [(r["x"], r["y"]) for r in series.peak(spark.createDataFrame([(1, 0, 7.0), (1, 1, 7.0), (1, 2, NAN), (1, 9, 99.0)], "g int, i int, v double"), ["g"], "i", "v", 0, 5).collect()] == [(1, 7.0)]
    at = series.threshold(series.cumulative(df, ["g"], ["i"], "v", "t"), ["g"], ["i"], "i", "t", 6.0).collect()
    assert [(r["g"], r["at"]) for r in at] == [(1, 1.5)]
    numbered = series.numbered(spark.range(1000).withColumn("v", (F.col("id") * 7919) % 1000), ["v"], "n").collect()
    assert sorted(r["n"] for r in numbered) == list(range(1000)) and all(r["n"] == r["v"] for r in numbered)
    total = series.running_total(spark.range(300), "id", "id", "t", 4, 8).collect()
    assert all(r["t"] == r["id"] * (r["id"] + 1) // 2 for r in total)


def test_words(spark):
    df = spark.createDataFrame([("a/b/c",), ("c",), ("",), ("/",), (None,), ("1.5e3",), ("-7",), (".",)], "s string")
    s = F.col("s")
    got = df.select(strings.basename(s).alias("b"), strings.dirname(s).alias("d"), strings.pop(s, "/")[0].alias("h"), strings.pop(s, "/")[1].alias("t"), strings.is_number(s).alias("n"), strings.is_int(s).alias("i"), strings.find(s, "b").alias("f")).collect()
    assert tuple(got[0]) == ("c", "a/b", "a", "b/c", False, False, 2) and tuple(got[1]) == ("c", "c", "c", "", False, False, -1)
    assert [r["n"] for r in got] == [False, False, False, False, None, True, True, False] and [r["i"] for r in got][5:7] == [False, True] and set(got[4]) == {None}


def test_checkpoints_need_a_shared_folder_on_clusters():
    from heliotab.operators import store

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://somewhere"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(RuntimeError):
        store.shared_folder(Cluster)


def test_best_periods_are_kept_where_they_are_found(spark, monkeypatch):
    rows = [(g, (i * 7 % 50) * 1.3 + i * 0.01, math.sin(2 * math.pi * i / (3 + g))) for g in (1, 2, 3) for i in range(20 * g)] + [(None, 1.0, 2.0), (None, 3.0, 5.0), (None, 9.0, 4.0), (4, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, t double, y double")
    grid = periods.by_span(2.0, 9.0)
    monkeypatch.setattr(periods, "_ROWS", 40)  # the group of 60 rows goes by sums
    expected = {r["g"]: r for r in periods.best(periods.grouped(df, ["g"], "t", "y", grid), ["g"]).collect()}
    out = periods.best_grouped(df, ["g"], "t", "y", grid)
    got = {r["g"]: r for r in out.collect()}
    assert set(got) == set(expected) == {1, 2, 3, None}
    assert all(math.isclose(got[g]["period"], expected[g]["period"]) and math.isclose(got[g]["power"], expected[g]["power"], rel_tol=1e-9) for g in got)
