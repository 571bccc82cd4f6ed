"""Edge cases by hand: NaN, infinities, empty tables, ties, the poles and the seam of the sky."""

import math

import pytest
from pyspark.sql import functions as F

from heliotab.functions import sem, sky
from heliotab.operators import bins, joins, series, stats
from heliotab.sources import text

NAN, INF = float("nan"), float("inf")


def test_division_and_comparison(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (6.0, 3.0), (NAN, 1.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    got = df.select(sem.fdiv(a, b).alias("q"), sem.gt(a, b).alias("gt"), sem.ne(a, b).alias("ne"), sem.eq(a, a).alias("same"), sem.true(a).alias("t")).collect()
    assert [r["q"] for r in got[:2]] == [INF, -INF] and math.isnan(got[2]["q"]) and got[3]["q"] == 2
    assert [r["gt"] for r in got] == [True, False, False, True, False]
    assert got[4]["ne"] and not got[4]["same"] and got[4]["t"]


def test_integer_division_truncates(spark):
    got = spark.createDataFrame([(-7, 2), (7, 2), (1, 0)], "a long, b long").select(sem.idiv(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [-3, 3, None]


def test_logarithms(spark):
    got = spark.createDataFrame([(0.0,), (-1.0,), (100.0,), (None,)], "x double").select(sem.log10(F.col("x"))).collect()
    assert got[0][0] == -INF and math.isnan(got[1][0]) and got[2][0] == 2 and got[3][0] is None


def test_histogram_of_100(spark):
    x = [4.5 if 45 <= i < 55 else 0.05 + 0.1 * i for i in range(101)]
    df = spark.createDataFrame([(v,) for v in x + [NAN, None]], "x double")
    got = {r["bin"]: r["n"] for r in bins.histogram(df, "x", 0.0, 10.0, 0.1).collect()}
    assert len(got) == 100 and got[10] == 1 and sum(got.values()) == 101 and got[45] + got[44] >= 10 and got[99] == 2


def test_histogram_clamps_infinities_and_empty(spark):
    df = spark.createDataFrame([(-INF,), (INF,), (3.0,)], "x double")
    assert [r["n"] for r in bins.histogram(df, "x", 0.0, 3.0, 1.0).orderBy("bin").collect()] == [1, 0, 2]
    assert [r["n"] for r in bins.histogram(df.limit(0), "x", 0.0, 2.0, 1.0).collect()] == [0, 0]


def test_join_first_match(spark):
    left = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6)], "id int")
    right = spark.createDataFrame([(5, 0), (3, 1), (1, 2), (6, 3), (3, 4)], "id int, place int").withColumn("order", F.col("place"))
    got = {r["id"]: r["place"] for r in joins.first_match(left, right, "id", "order", "place").collect()}
    assert got == {1: 2, 2: -1, 3: 1, 4: -1, 5: 0, 6: 3}


def test_band_is_open_and_skips_nan(spark):
    a = spark.createDataFrame([(0.0,), (5.0,), (NAN,)], "x double")
    b = spark.createDataFrame([(1.0,), (0.999,), (5.5,), (NAN,)], "y double")
    got = sorted((r["x"], r["y"]) for r in joins.band(a, b, "x", "y", 1.0).collect() if not math.isnan(r["x"]))
    assert got == [(0.0, 0.999), (5.0, 5.5)]


def test_sky_over_the_pole_and_the_seam(spark):
    a = spark.createDataFrame([(1, 359.9999, 0.0), (2, 10.0, 89.9999), (3, 90.0, -45.0)], "src int, ra0 double, dec0 double")
    b = spark.createDataFrame([(7, 0.0001, 0.0), (8, 190.0, 89.9999), (9, 95.0, -45.0)], "id int, ra double, dec double")
    got = sorted((r["src"], r["id"], r["arcsec"] and round(r["arcsec"], 2)) for r in joins.sky_nearest(a, b, "src", 2.0, ("ra0", "dec0"), ("ra", "dec"), "id").collect())
    assert got == [(1, 7, 0.72), (2, 8, 0.72), (3, -2, None)]
    far = joins.sky_nearest(spark.createDataFrame([(4, 200.0, 5.0)], a.schema), b, "src", 2.0, ("ra0", "dec0"), ("ra", "dec"), "id").first()
    assert far["id"] == -1


def test_nearest_without_a_partner_is_minus_one(spark):
    a = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, NAN), (4, None)], "k int, x double")
    b = spark.createDataFrame([(7, 1.0), (8, -0.5), (9, 0.5)], "t int, y double")
    assert {r["k"]: r["t"] for r in joins.nearest_within(a, b, "k", "x", "y", 1.0, "t").collect()} == {1: 8, 2: -1, 3: -1, 4: -1}


def test_sexagesimal(spark):
    df = spark.createDataFrame([(-0.5,), (12.582,), (89.99999999,)], "x double")
    wide = spark.createDataFrame([(182.5,), (359.9,), (-123.0,)], "x double").select(sky.to_sexagesimal(F.col("x")).alias("s")).collect()
    assert [r["s"] for r in wide] == ["182:30:00.00", "359:54:00.00", "-123:00:00.00"]
    got = df.select(sky.to_sexagesimal(F.col("x")).alias("s")).withColumn("x", sky.from_sexagesimal(F.col("s"))).collect()
    assert [r["s"] for r in got] == ["-00:30:00.00", "12:34:55.20", "90:00:00.00"] and abs(got[0]["x"] + 0.5) < 1e-9


def test_plateau_peak_is_its_last_sample(spark):
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate([1, 3, 3, 2, 5, 5, 5, 7, 7])], "g int, o int, v double")
    assert [r["o"] for r in series.peaks(df, ["g"], ["o"], "v").collect()] == [2]


def test_clipping_removes_outliers(spark):
    df = spark.createDataFrame([(1, float(v)) for v in [10, 11, 9, 10, 10.5, 9.5] * 5 + [1000]], "g int, v double")
    r = stats.clipped(df, ["g"], "v", 3.0, 3).first()
    assert r["n"] == 30 and abs(r["mean"] - 10) < 1e-9


def test_period_is_found(spark):
    df = spark.createDataFrame([(float(t), math.sin(2 * math.pi * t / 15)) for t in range(101)], "t double, y double")
    grid = [5 * 1.02**k for k in range(110)]
    best = stats.period_power(df, "t", "y", grid).orderBy(F.desc("power")).first()
    assert abs(best["period"] - 15) < 0.5


def test_period_between_coarse_grid_points_is_found(spark):
    data = [(i, 3 + math.sin(2 * math.pi * i / 10 / 16.4) + i % 7 / 10) for i in range(10_001)]
    rows = spark.createDataFrame(data, "event_id long, value double").select((F.col("event_id") / 10.0).alias("t"), "value")
    got = {r["period"]: r["power"] for r in stats.period_search(rows, "t", "value", 5.0, 50.0).collect()}
    grid = [5.0]
    while (p := grid[-1] * (1 + 0.1 * grid[-1] / 1000)) < 50:
        grid.append(p)
    assert sorted(got) == grid and len(grid) > 1700
    assert abs(max(got, key=got.get) - 16.4) < 0.02

    mean = sum(y for _, y in data) / len(data)
    variance = sum((y - mean) ** 2 for _, y in data) / (len(data) - 1)
    for p in (grid[0], grid[700], max(got, key=got.get), grid[-1]):
        w = 2 * math.pi / p
        tau = math.atan2(sum(math.sin(w * i / 5) for i, _ in data), sum(math.cos(w * i / 5) for i, _ in data)) / (2 * w)
        c, s = ([f(w * (i / 10 - tau)) for i, _ in data] for f in (math.cos, math.sin))
        power = sum(sum((y - mean) * x for (_, y), x in zip(data, v)) ** 2 / sum(x * x for x in v) for v in (c, s)) / (2 * variance)
        assert abs(got[p] - power) <= 1e-6 * max(1, power)


def test_no_span_gives_no_periods(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 1.0), (NAN, 1.0)], "t double, y double")
    assert stats.period_search(df, "t", "y", 5.0, 50.0).count() == 0 and stats.period_search(df.limit(0), "t", "y", 5.0, 50.0).count() == 0


def test_roll_collects_no_group(spark):
    data = [(g, i, None if i == 4 else 10.0 * i) for g, size in ((1, 5), (None, 2), (3, 1)) for i in range(size)]
    df = spark.createDataFrame(data, "g int, o int, v double")
    for n in (1, 3):
        out = series.shift(df, ["g"], ["o"], "v", "r", n, roll=True)
        assert out.columns == ["g", "o", "v", "r"] and "collect_list" not in out._jdf.queryExecution().toString()
        own = {g: [v for k, _, v in data if k == g] for g in (1, None, 3)}
        assert {(r["g"], r["o"]): r["r"] for r in out.collect()} == {(g, i): v[(i - n) % len(v)] for g, v in own.items() for i in range(len(v))}


def test_streams_end_in_files(spark, tmp_path):
    from heliotab.streaming import events

    rows = spark.range(40).selectExpr("id AS event_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, CAST(id AS INT) * 7) AS ts", "id % 3 AS user_id")
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = events.event_stream(spark, str(tmp_path / "in"))
    once = events.finished(stream.select("user_id").dropDuplicates(["user_id"]), "append")
    counts = events.finished(stream.groupBy("user_id").count(), "complete")
    assert sorted(r["user_id"] for r in once.collect()) == [0, 1, 2] and sorted(tuple(r) for r in counts.collect()) == [(0, 14), (1, 13), (2, 13)]
    assert all(x.inputFiles() and all(f.endswith(".parquet") for f in x.inputFiles()) for x in (once, counts))
    latest = events.finished(stream.groupBy("user_id").count(), "update", ("user_id",))
    assert sorted(tuple(r) for r in latest.collect()) == [(0, 14), (1, 13), (2, 13)]
    none = events.finished(stream.where("user_id > 5").select("user_id").dropDuplicates(["user_id"]), "append")
    assert none.count() == 0 and none.columns == ["user_id"]


def test_region_of_tiles(spark, tmp_path):
    df = spark.createDataFrame([(1, 359.5, 0.0), (2, 0.5, 0.0), (3, 180.0, 0.0), (4, 0.5, 80.0)], "id int, ra double, dec double")
    text.write_tiles(df, str(tmp_path / "sky"), "ra", "dec")
    got = text.read_region(spark, str(tmp_path / "sky"), "ra", "dec", 359.0, 1.0, -5.0, 5.0)
    assert sorted(r["id"] for r in got.collect()) == [1, 2]


def test_metadata_text(spark, tmp_path):
    (tmp_path / "m").write_text("# head\n\nEXPTIME F32 30.5 # seconds\nNAME STR a b c\n")
    got = sorted(tuple(r) for r in text.read_metadata(spark, str(tmp_path / "m")).collect())
    assert got == [("EXPTIME", "F32", "30.5", "seconds"), ("NAME", "STR", "a b c", "")]


def test_special_functions(spark):
    x = [-40.3, -5.5, -2.0, -1.99999, -0.5, -1e-9, 0.0, 1e-300, 0.1, 0.49, 0.5, 1.0, 1.5, 2.0, 2.0001, 3.3, 5.9, 6.0, 27.0, 171.5, 1e6, INF, -INF, NAN, None]
    got = spark.createDataFrame([(v,) for v in x], "x double").select("x", sem.erf(F.col("x")).alias("e"), sem.lgamma(F.col("x")).alias("g")).collect()
    for v, r in zip(x, got):
        if v is None or math.isnan(v):
            assert (r["e"] is None and r["g"] is None) if v is None else (math.isnan(r["e"]) and math.isnan(r["g"]))
            continue
        assert abs(r["e"] - math.erf(v)) < 5e-15
        want = INF if abs(v) == INF or v <= 0 and v == math.floor(v) else math.lgamma(v)
        assert r["g"] == want or abs(r["g"] - want) < 1e-12 * max(1, abs(want)), v


def test_integer_division_is_exact(spark):
    data = [(9007199254740993, 1, 9007199254740993), (9223372036854775807, 3, 3074457345618258602), (-9223372036854775807, 2, -4611686018427387903), (-(2**63), -1, None), (7, -1, -7), (5, 0, None)]
    got = spark.createDataFrame(data, "a long, b long, q long").select(sem.idiv(F.col("a"), F.col("b")).alias("r"), "q").collect()
    assert all(r["r"] == r["q"] for r in got)


def test_extremes_of_nan(spark):
    got = spark.createDataFrame([(NAN, 1.0), (1.0, NAN), (1.0, 2.0), (None, 1.0)], "a double, b double").select(sem.maximum(F.col("a"), F.col("b")).alias("h"), sem.minimum(F.col("a"), F.col("b")).alias("l")).collect()
    assert all(math.isnan(r[k]) for r in got[:2] for k in "hl") and tuple(got[2]) == (2.0, 1.0) and tuple(got[3]) == (None, None)


def test_random_numbers_follow_their_laws(spark):
    from heliotab.operators import sampling

    df = spark.range(20_000)
    r = df.select(sampling.uniform(F.col("id"), 1).alias("u"), sampling.gaussian(F.col("id"), 1, 2.0, 3.0).alias("g")).agg(F.avg("u"), F.min("u"), F.max("u"), F.avg("g"), F.stddev("g")).first()
    assert abs(r[0] - 0.5) < 0.01 and 0 <= r[1] < r[2] < 1 and abs(r[3] - 2) < 0.1 and abs(r[4] - 3) < 0.1
    means = [x["mean"] for x in sampling.bootstrap(df.withColumn("one", F.lit(1)), ["one"], F.col("id"), F.col("id"), 50).collect()]
    assert abs(sum(means) / 50 - 9999.5) < 40 and 15 < (sum((m - 9999.5) ** 2 for m in means) / 50) ** 0.5 < 80


def test_order_statistics_of_groups(spark):
    import random

    import numpy as np

    from heliotab.operators import ranks

    r = random.Random(1)
    groups = {1: [r.gauss(0, 1) for _ in range(500)], 2: [5.0] * 300 + [r.choice([4.0, 6.0, 1e6]) for _ in range(50)], None: [3.0, 1.0], 3: [7.0]}
    df = spark.createDataFrame([(g, v) for g, x in groups.items() for v in x] + [(1, NAN), (1, INF), (2, None), (4, NAN)], "g int, v double")
    got = {x["g"]: x for x in ranks.quantiles(df, ["g"], "v", {"q1": 0.16, "m": 0.5, "top": 1.0}).collect()}
    assert set(got) == set(groups)
    for g, x in groups.items():
        assert np.allclose([got[g]["q1"], got[g]["m"], got[g]["top"]], np.quantile(x, [0.16, 0.5, 1.0]), rtol=1e-12)
    n = F.col("n")
    inner = {x["g"]: (x["value"], x["used"]) for x in ranks.window_mean(df, ["g"], "v", F.floor(n * 0.25), F.ceil(n * 0.75)).collect()}
    for g, x in groups.items():
        part = sorted(x)[int(len(x) * 0.25) : math.ceil(len(x) * 0.75)]
        assert inner[g][1] == len(part) and abs(inner[g][0] - sum(part) / len(part)) < 1e-9
    assert {x["g"]: x["mode"] for x in ranks.modes(df, ["g"], "v").collect()}[3] == 7.0
    assert ranks.quantiles(df.limit(0), ["g"], "v", {"m": 0.5}).count() == 0


@pytest.mark.parametrize("many", [10_000, 50])
def test_ranks_of_skewed_groups(spark, many, monkeypatch):
    """One value far off, ties, a constant, few values and a null group, with brackets that must be narrowed several times."""
    import numpy as np

    from heliotab.operators import ranks

    monkeypatch.setattr(ranks, "MANY", many)
    r = np.random.default_rng(1)
    groups = {"skewed": [*r.lognormal(0, 3, 30_000), 1e15], "ties": r.integers(0, 5, 15_000), "constant": [2.0] * 12_000, "few": r.normal(size=15), "one": [3.0], None: r.normal(size=2001)}
    df = spark.createDataFrame([(g, float(x)) for g, own in groups.items() for x in own], "g string, v double")
    wanted = {"a": 0.0, "q": 0.16, "m": 0.5, "t": 0.999, "z": 1.0}
    for x in ranks.quantiles(df, ["g"], "v", wanted).collect():
        assert np.allclose([x[k] for k in wanted], [np.quantile(groups[x["g"]], q) for q in wanted.values()], rtol=1e-12)
    n = F.col("n")
    for x in ranks.window_mean(df, ["g"], "v", F.floor(n * 0.25), F.ceil(n * 0.75)).collect():
        own = np.sort(groups[x["g"]])
        own = own[len(own) // 4 : -(-len(own) * 3 // 4)]
        assert np.isclose(x["value"], own.mean()) and x["used"] == len(own)
