"""Rows that are sent to many cells are merged: Spark counts them as few and would broadcast them through the driver."""

import pytest

from heliotab.operators import graphs, joins, sources, store, tracks


@pytest.fixture
def plans(spark, monkeypatch, capsys):
    """The plans of all tables that an operator writes, and of what it returns."""
    found = []

    def explained(df):
        capsys.readouterr()
        df.explain()
        found.append(capsys.readouterr().out)
        return df

    def written(df):
        return store.written(explained(df))

    for module in (graphs, joins, sources, tracks):
        monkeypatch.setattr(module, "written", written)
    return found, explained


def _few(spark, tmp_path, rows, schema, name="t"):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return spark.read.parquet(f"{tmp_path}/{name}.parquet")


def test_moving_objects(spark, tmp_path, plans):
    found, explained = plans
    rows = _few(spark, tmp_path, [(i, float(i), 1.0 * i, 0.5 * i) for i in range(4)] + [(9, 1.0, 50.0, 50.0)], "id long, t double, x double, y double")
    explained(tracks.standing(rows, 0.05))
    lines = explained(tracks.triples(rows, tracks.tracklets(rows, 3.0, 2.0), 2.0, 0.05))
    tracks.tracks(explained(lines))
    assert {(r.a, r.b, r.c) for r in lines.collect()} == {(0, 1, 2), (1, 2, 3), (0, 1, 3), (0, 2, 3)}
    assert not any("BroadcastHashJoin" in line and ("cx" in line or "node" in line) for p in found for line in p.splitlines())


def test_blended_sources(spark, tmp_path, plans):
    found, _ = plans
    pixels = _few(spark, tmp_path, [(0, x, y, 1.0, 1.0) for x in range(8) for y in range(8)], "image int, x long, y long, v double, var double", "pixels")
    guesses = _few(spark, tmp_path, [(0, k, 3.0 + k, 3.0, 50.0, 1.5, 0.0, 1.5) for k in range(2)], "image int, id long, x double, y double, flux double, xx double, xy double, yy double", "guesses")
    out = sources.fit(pixels, guesses, ["image"], "id", 3.0)
    assert [r.together for r in out.collect()] == [2, 2]
    assert not any("BroadcastHashJoin" in p for p in found)
