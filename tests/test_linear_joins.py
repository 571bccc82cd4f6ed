"""Nearest values and chains against brute force, and that they make no pairs."""

import random

from heliotab.operators import graphs, joins


def test_nearest_values_without_pairs(spark):
    rng = random.Random(5)
    xs = [(i, rng.randrange(-4000, 4000) / 100) for i in range(200)] + [(900, None), (901, 8.0), (902, 500.0)]
    ys = [(i, rng.randrange(-4000, 4000) / 100) for i in range(150)] + [(150, 7.5), (149, 8.5), (151, 7.5), (152, None), (153, 504.0)]
    left, right = spark.createDataFrame(xs, "k long, x double"), spark.createDataFrame(ys, "t long, y double")
    out = joins.nearest_within(left, right, "k", "x", "y", 4.0, "t")
    expected = {k: min(((abs(x - y), t) for t, y in ys if y is not None and abs(x - y) < 4.0), default=(0, -1))[1] if x is not None else -1 for k, x in xs}
    assert {r["k"]: r["t"] for r in out.collect()} == expected
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_chains_by_cells(spark, monkeypatch):
    rng = random.Random(6)
    points = [(i, rng.randrange(0, 60000) / 10) for i in range(300)] + [(1000 + i, 7.0) for i in range(500)] + [(2000, 9000.0), (2001, 9012.0), (2002, 9023.9), (2003, None)]
    made = []
    whole = graphs.components
    monkeypatch.setattr(graphs, "components", lambda edges: (made.append(edges.count()), whole(edges))[1])
    got = {r["k"]: r["root"] for r in graphs.chains(spark.createDataFrame(points, "k long, x double"), "k", "x", 12.0).collect()}
    expected, last, run = {2003: 2003}, None, []
    for x, k in sorted((x, k) for k, x in points if x is not None):
        if last is not None and x - last >= 12.0:
            expected.update(dict.fromkeys(run, min(run)))
            run = []
        run.append(k)
        last = x
    expected.update(dict.fromkeys(run, min(run)))
    assert got == expected
    assert made[0] <= 3 * len(points) // 2  # not the 125,000 pairs of equal numbers


def test_full_join_of_few_keys_is_dealt(spark):
    left = spark.createDataFrame([(i % 2, i) for i in range(90)] + [(7, 100), (None, 101)], "a int, s long")
    right = spark.createDataFrame([(i % 3, i) for i in range(30)] + [(None, 50)], "b int, c long")
    out = joins.full_of_few_keys(left, right, "a", "b", ["s"], rows=8).select("a", "b", "s", "c")
    expected = left.join(right, left["a"] == right["b"], "full").select("a", "b", "s", "c")
    assert out.exceptAll(expected).count() == 0 and expected.exceptAll(out).count() == 0


def test_nearest_stars_of_a_dense_field_are_met_in_small_cells(spark, monkeypatch):
    """All stars are found by cells far smaller than the reach, but for one that stands away from the others."""
    from heliotab.operators import patterns, store

    places = [(0, i, float(i % 40), float(i // 40)) for i in range(1600)]
    reference = spark.createDataFrame([(*p, 1.0) for p in places], "image int, id long, x double, y double, mag double")
    stars = spark.createDataFrame([(0, i, x + 0.25, y, 1.0) for _, i, x, y in places] + [(0, 5000, 49.0, 39.0, 1.0)], "image int, id long, x double, y double, mag double")
    maps = spark.createDataFrame([(0, 1.0, 0.0, 0.0, 0.0)], "image int, a double, b double, p double, q double")
    steps = []
    monkeypatch.setattr(patterns, "written", lambda df: steps.append(store.written(df)) or steps[-1])
    found = {r.id: (r.ref, r.off) for r in patterns.nearest(stars, reference, maps, 15.0).collect()}
    assert found == {i: (i, 0.25) for _, i, _, _ in places} | {5000: (1599, 10.0)}
    assert steps[0].count() == 1600 and steps[1].count() == 1  # found within two units; one is left for wider cells
