"""Sets of sources are fitted many at once, from one row a set, and their pixels are made in several tasks."""

import math

import numpy as np
from pyspark.sql import functions as F

from heliotab.operators import sources, store


def test_sets_of_different_sizes_in_one_batch():
    """Two sets of two sources, one of which has pixels left out (weight 0, whatever they hold), and one that can't be told from the sky."""
    planted = np.array([[[9.0, 5.2, 6.1], [7.0, 8.4, 6.6]], [[3.0, 6.0, 5.0], [4.0, 4.1, 9.2]], [[0.0, 5.0, 5.0], [0.0, 9.0, 9.0]]])
    y, x = (np.repeat(g.ravel()[None].astype(float), 3, axis=0) for g in np.mgrid[0:14, 0:14])
    shape = (0.5, 0.1, 0.6)
    v = sum(planted[:, k, :1] * np.exp(-0.5 * (shape[0] * (x - planted[:, k, 1:2]) ** 2 + 2 * shape[1] * (x - planted[:, k, 1:2]) * (y - planted[:, k, 2:]) + shape[2] * (y - planted[:, k, 2:]) ** 2)) for k in (0, 1))
    w = np.ones_like(v)
    w[1, ::7], v[1, ::7] = 0.0, 1e6
    start = np.concatenate([planted + [[[-0.5, 0.3, -0.2]]], np.broadcast_to(shape, (3, 2, 3))], axis=2)
    p, s, errors, chi, rest = sources._solve(x, y, v, w, start, False, False)
    assert rest.all() and np.abs(p[:2, :, :3] - planted[:2]).max() < 1e-6 and np.abs(p[2, :, 0]).max() < 1e-6
    assert chi.max() < 1e-9 and errors.shape == (3, 2) and not s.any()


def test_a_set_is_one_row_and_pixels_are_dealt(spark, tmp_path, monkeypatch, capsys):
    """Lone sources, pairs and one of three, from one small file: no group of rows goes to Python, and the sources' pixels don't stay in the one task that reads the file."""
    stars = [(0, 10 * k + i, 20.0 * k + 8 + 3 * i, 9.0 + i, 100.0 + k, 1.5, 0.1, 1.2) for k in range(9) for i in range(1 + k % 3)]
    y, x = np.mgrid[0:20, 0:190]
    image = sum(f / (2 * math.pi * math.sqrt(a * c - b * b)) * np.exp(-(c * (x - sx) ** 2 - 2 * b * (x - sx) * (y - sy) + a * (y - sy) ** 2) / (2 * (a * c - b * b))) for _, _, sx, sy, f, a, b, c in stars)
    pixels = spark.createDataFrame([(0, i, j, float(v), 1.0) for (j, i), v in np.ndenumerate(image)], "image int, x long, y long, v double, var double")
    spark.createDataFrame(stars, "image int, id long, x double, y double, flux double, xx double, xy double, yy double").coalesce(1).write.parquet(f"{tmp_path}/stars.parquet")
    guesses = spark.read.parquet(f"{tmp_path}/stars.parquet").withColumn("x", F.col("x") + 0.2).withColumn("flux", F.col("flux") * 0.9)
    plans = []

    def written(df):
        capsys.readouterr()
        df.explain()
        plans.append(capsys.readouterr().out)
        return store.written(df)

    monkeypatch.setattr(sources, "written", written)
    got = {r.id: (r.x, r.flux, r.together, r.rest) for r in sources.fit(pixels, guesses, ["image"], "id", 5.0).collect()}
    assert all(got[s[1]][3] and abs(got[s[1]][0] - s[2]) < 1e-4 and abs(got[s[1]][1] - s[4]) < 1e-2 and got[s[1]][2] == 1 + s[1] // 10 % 3 for s in stars) and len(got) == len(stars)
    assert not any("InPandas" in p for p in plans) and any("MapInArrow" in p for p in plans)
    dealt = [p for p in plans if "Generate explode" in p and "_cx" in p and "pixels" not in p]
    assert dealt and all("REPARTITION_BY_NUM" in p for p in dealt)
