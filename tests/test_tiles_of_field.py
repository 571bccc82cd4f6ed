"""Triples and tracks that are found tile by tile are those of pairs, over borders of tiles and in tiles of many detections."""

import random

import pytest

from heliotab.operators import tracks

_SCHEMA = "id long, t double, x double, y double"


def _field(kind):
    """Movers over four tiles (of some 24 units), a crowd, and for some times that are all different."""
    r = random.Random(4)
    rows = [(20 * k + e, float(e), 24.2 * (k % 3) + (k - 6) * 0.41 * e - 5, 24.2 * (k % 2) + 0.29 * e * (k % 7 - 3)) for k in range(12) for e in range(8)]
    rows += [(1000 + i, float(r.randrange(8)), r.randrange(-300, 500) / 10, r.randrange(-200, 400) / 10) for i in range(400)]
    if kind == "times":
        rows = [(i, t + (0.013 * (i // 20) if i < 1000 else r.random()), x, y) for i, t, x, y in rows]
    return rows


@pytest.mark.parametrize("kind", ["exposures", "times", "crowds"])
def test_triples_and_tracks_of_tiles(kind, spark, monkeypatch):
    if kind == "crowds":
        monkeypatch.setattr(tracks, "_CROWD", 20)
    rows = spark.createDataFrame(_field(kind), _SCHEMA)
    pairs = tracks.triples(rows, tracks.tracklets(rows, 3.0, 2.0), 2.0, 0.05)
    lines = tracks.lines(rows, 3.0, 2.0, 0.05)
    expected = sorted(map(tuple, pairs.collect()))
    assert sorted(map(tuple, lines.collect())) == expected and len(expected) > 100
    assert sorted(map(tuple, tracks.tracks_of(rows, 3.0, 2.0, 0.05).collect())) == sorted(map(tuple, tracks.tracks(pairs).collect()))


def test_pairs_are_not_shuffled(spark):
    """What is sent to tiles grows with the detections, where pairs grow with their square; rows without a place are left out."""
    rows = spark.createDataFrame([(i, float(i % 8), (i * 37 % 101) / 50, (i * 53 % 103) / 50) for i in range(300)] + [(900, 1.0, None, 0.0), (901, 1.0, float("nan"), 0.0)], _SCHEMA)
    tiles = tracks._tiles(rows, 3.0, 2.0, 0.05).collect()
    assert sum(len(r["_rows"]) for r in tiles) <= 4 * 300 and sum(x["mine"] for r in tiles for x in r["_rows"]) == 300
    assert tracks.tracklets(rows, 3.0, 2.0).count() > 10_000
    assert "Join" not in tracks.lines(rows, 3.0, 2.0, 0.05)._jdf.queryExecution().optimizedPlan().toString().replace("Join LeftOuter", "")


def test_no_triples(spark):
    rows = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 1.0, 50.0, 50.0)], _SCHEMA)
    assert tracks.lines(rows, 3.0, 2.0, 0.05).count() == 0 and tracks.tracks_of(rows, 3.0, 2.0, 0.05).count() == 0
    assert tracks.tracks_of(rows.limit(0), 3.0, 2.0, 0.05).count() == 0
