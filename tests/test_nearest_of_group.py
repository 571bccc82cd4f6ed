"""Nearest partners of a group against all pairs: crowded and lonely groups, poles, seams, ties and nulls."""

import math
import random

from heliotab.operators import joins


def apart(a, b):
    (l1, b1), (l2, b2) = [(math.radians(p[0]), math.radians(p[1])) for p in (a, b)]
    return 2 * math.asin(math.sqrt(min(1.0, math.sin((b2 - b1) / 2) ** 2 + math.cos(b1) * math.cos(b2) * math.sin((l2 - l1) / 2) ** 2)))


def test_nearest_of_group_against_all_pairs(spark):
    r = random.Random(6)
    spot = lambda: (r.uniform(0, 360), math.degrees(math.asin(r.uniform(-1, 1))))
    left = [(n, n % 5, *spot()) for n in range(60)] + [(100, 0, 0.01, 89.99), (101, 1, 359.99, 0.0), (102, 9, 1.0, 1.0), (103, None, 1.0, 1.0), (104, 1, None, 2.0), (105, 4, 200.0, -10.0)]
    # The first group has 400, the last a single one on the far side; all of group 3 are in one spot, twice.
    right = [(n, 0, *spot()) for n in range(400)] + [(1000 + n, 1 + n % 2, *spot()) for n in range(40)] + [(2000 + n, 3, 10.0 + n // 2 * 0.01, 20.0) for n in range(50)] + [(3000, 4, 20.0, 10.0), (4000, 5, 1.0, 1.0), (4001, None, 1.0, 1.0), (4002, 1, 1.0, None)]
    df = lambda rows, p, q, k: spark.createDataFrame(rows, f"{k} long, g int, {p} double, {q} double")
    got = {x["id"]: (x["other"], x["radians"]) for x in joins.nearest_of_group(df(left, "a", "d", "id"), df(right, "ra", "dec", "other"), "g", "id", ("a", "d"), ("ra", "dec"), "other").collect()}
    want = {}
    for n, g, *p in left:
        near = [(round(apart(p, o), 12), m) for m, h, *o in right if None not in (g, *p, *o) and g == h]
        if near:
            want[n] = min(near)
    assert got.keys() == want.keys() and 102 not in got
    assert all(got[n][0] == want[n][1] and abs(got[n][1] - want[n][0]) < 1e-9 for n in want)


def test_nearest_of_no_rows(spark):
    left, right = spark.createDataFrame([(1, 1, 0.0, 0.0)], "id long, g int, a double, d double"), spark.createDataFrame([(1, 1, 0.0, 0.0)], "other long, g int, ra double, dec double")
    for a, b in ((left, right.limit(0)), (left.limit(0), right)):
        assert joins.nearest_of_group(a, b, "g", "id", ("a", "d"), ("ra", "dec"), "other").count() == 0
