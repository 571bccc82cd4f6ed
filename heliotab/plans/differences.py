"""Differences, stacks, peaks and contours of the images made of lineitem, and sources made of customers."""

import math

from pyspark.sql import functions as F

from heliotab.operators import contours, detrend, peaks, sources, stacking, subtraction
from heliotab.plans.fields import _projected
from heliotab.plans.images_and_fits import _COUNTS, _IMAGE, _image
from heliotab.plans.registry import query, table


def _counts(spark, d):
    return _image(spark, d, F.count("*").cast("double"))


def _gauss(sigma: float, factor: str = "1") -> str:
    return f"coalesce(sum(a.v * {factor} * exp(-((r.x - a.x) ** 2 + (r.y - a.y) ** 2) / {2 * sigma**2}::DOUBLE)), 0)"


_LIGHT = f"""SELECT r.x * 100 + r.y AS id, 0 AS part, any_value(r.v) AS v0, any_value(r.v) AS v, {_gauss(0.7)} AS t0, {_gauss(1.5)} AS t1, {_gauss(1.5, '(r.x - a.x)')} AS t2, {_gauss(1.5, '(r.y - a.y)')} AS t3, 1.0::DOUBLE AS t4
  FROM ({_COUNTS}) r LEFT JOIN ({_COUNTS}) a ON a.image = 'A' AND a.x BETWEEN r.x - 2 AND r.x + 2 AND a.y BETWEEN r.y - 2 AND r.y + 2 WHERE r.image = 'R' GROUP BY r.x, r.y"""


@query(_projected(_LIGHT, 5, "SELECT (id // 100)::INT AS x, (id % 100)::INT AS y, round(v, 5) + 0.0 AS v"))
def image_difference(spark, d):
    """The image of one flag less that of another through the kernel, of two Gaussians and a slope, and the background that fit best."""
    counts = _counts(spark, d)
    both = subtraction.pair(counts.where("image = 'A'").select(F.lit(1).alias("field"), "x", "y", "v"), counts.where("image = 'R'").select(F.lit(1).alias("field"), "x", "y", "v"), ["field"])
    model = subtraction.Model(subtraction.kernels([(0.7, 0), (1.5, 1)], 2), fill=0.0)
    found = subtraction.fit(both.withColumn("stamp", F.lit(0)), ["field"], model, rounds=1)
    return subtraction.difference(both, ["field"], model, found).select("x", "y", (F.round("v", 5) + 0.0).alias("v"))


_CLIP, _KERNEL, _THRESHOLD, _POOR = 1.7013, {(0, 0): 0.4, (1, 0): 0.15, (-1, 0): 0.15, (0, 1): 0.15, (0, -1): 0.15}, 0.35, 0.2
_EIGHT = "SELECT CAST(l_suppkey % 8 AS INT) AS image, CAST(l_quantity AS INT) AS x, CAST(round(l_discount * 100) AS INT) AS y, CAST(count(*) AS DOUBLE) AS v FROM lineitem GROUP BY ALL"


def _deviant_sql(rows: str, out: str) -> str:
    """The worst image of each pixel, by sums over the others."""
    return f"{out} AS MATERIALIZED (SELECT max((off, image)) AS m, x, y FROM (SELECT *, (v - (s - 1) / (w - 1 / v)) ** 2 / (v + 1 / (w - 1 / v)) AS off FROM (SELECT *, count(*) OVER p AS n, sum(1 / v) OVER p AS w, sum(v / v) OVER p AS s FROM {rows} WINDOW p AS (PARTITION BY x, y)) WHERE n >= 3) GROUP BY x, y HAVING max(off) > {_CLIP**2}::DOUBLE)"


def _spread_sql(mask: str, limit: float, out: str) -> str:
    parts = " UNION ALL ".join(f"SELECT image, x + {i} AS x, y + {j} AS y, {k}::DOUBLE AS k FROM {mask}" for (i, j), k in _KERNEL.items())
    return f"{out} AS (SELECT image, x, y FROM ({parts}) GROUP BY ALL HAVING sum(k) > {limit})"


@query(f"""WITH e AS ({_EIGHT}), {_deviant_sql('e', 'd1')}, f AS (SELECT e.* FROM e JOIN d1 USING (x, y) WHERE image <> m[2]), {_deviant_sql('f', 'd2')},
  b AS (SELECT m[2] AS image, x, y FROM d1 UNION ALL SELECT m[2], x, y FROM d2), {_spread_sql('b', _THRESHOLD, 's')}, {_spread_sql('s', _POOR, 'g')}
  SELECT x, y, count(*) AS n, round(sum(v / v) / sum(1 / v), 6) AS v FROM e ANTI JOIN g USING (image, x, y) GROUP BY x, y""".replace("m[2]", "struct_extract(m, 2)"))
def stack_rejected(spark, d):
    """Eight images by supplier, stacked without the pixels that deviate in two rounds and are confirmed by a kernel, and what it spreads them to."""
    c = F.col
    eight = table(spark, d, "lineitem").groupBy((c("l_suppkey") % 8).cast("int").alias("image"), c("l_quantity").cast("int").alias("x"), F.round(c("l_discount") * 100).cast("int").alias("y")).agg(F.count("*").cast("double").alias("v")).withColumn("var", c("v"))
    mask = stacking.rejected(eight, [], "image", _CLIP, 2, _KERNEL, _THRESHOLD, _POOR)
    return stacking.stacked(eight, [], "image", mask).select("x", "y", "n", F.round("v", 6).alias("v"))


_NUMBERED = f"SELECT CASE image WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS image, x, y, v, (CASE image WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END * 11 + y) * 51 + x AS node FROM ({_COUNTS})"
_NEAR = "AND n.x BETWEEN {0}.x - 1 AND {0}.x + 1 AND n.y BETWEEN {0}.y - 1 AND {0}.y + 1"


def _numbered(spark, d):
    return _counts(spark, d).withColumn("image", F.when(F.col("image") == "A", 0).when(F.col("image") == "N", 1).otherwise(2))


@query(f"""WITH RECURSIVE i AS MATERIALIZED ({_NUMBERED}), p AS MATERIALIZED (SELECT a.*, a.v - 2 * sqrt(a.v + (0.01 * a.v) ** 2) AS level FROM i a WHERE NOT EXISTS (SELECT 1 FROM i n WHERE n.image = a.image {_NEAR.format('a')} AND (n.v > a.v OR (n.v = a.v AND n.node < a.node)))),
  w AS (SELECT image, node, v, level, x, y, false AS higher FROM p UNION SELECT w.image, w.node, w.v, w.level, n.x, n.y, n.v > w.v OR (n.v = w.v AND n.node < w.node) FROM w JOIN i n ON n.image = w.image {_NEAR.format('w')} AND n.v >= w.level AND NOT w.higher)
  SELECT image, x, y, v FROM p WHERE node NOT IN (SELECT node FROM w WHERE higher)""")
def culled_peaks(spark, d):
    """Peaks of the counts that rise two sigmas, with a padding of a hundredth, above the saddle to a higher one."""
    tree = peaks.merge_tree(_numbered(spark, d), "image", 1.0, 51, 11)
    return peaks.culled(tree, F.sqrt("v"), 2.0, 0.01).select("image", "x", "y", "v")


_LEVEL = 5.5e6
_MONEY = f"SELECT CASE image WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS image, x, y, v FROM ({_IMAGE.replace('sum(round(l_extendedprice * 100))', 'sum(round(l_extendedprice * 100)) / count(*)')})"


def _number_sql(x: str, y: str, upright: int) -> str:
    return f"((image * 11 + {y}) * 51 + {x}) * 2 + {upright}"


#: Each way through a cell, by its corners (high ones as bits, counted against the clock from the lower left) and, at saddles, by whether the middle is high.
_WAYS = [(1, 0, 3), (2, 1, 0), (4, 2, 1), (8, 3, 2), (3, 1, 3), (6, 2, 0), (12, 3, 1), (9, 0, 2), (7, 2, 3), (14, 3, 0), (13, 0, 1), (11, 1, 2)]
_SADDLES = [(5, True, 0, 1), (5, True, 2, 3), (5, False, 0, 3), (5, False, 2, 1), (10, True, 1, 2), (10, True, 3, 0), (10, False, 1, 0), (10, False, 3, 2)]
_PLACES = ["{'n': " + _number_sql("x", "y", 0) + ", 'x': x + (l - p) / (q - p), 'y': y::DOUBLE}", "{'n': " + _number_sql("(x + 1)", "y", 1) + ", 'x': (x + 1)::DOUBLE, 'y': y + (l - q) / (r - q)}", "{'n': " + _number_sql("x", "(y + 1)", 0) + ", 'x': x + (l - s) / (r - s), 'y': (y + 1)::DOUBLE}", "{'n': " + _number_sql("x", "y", 1) + ", 'x': x::DOUBLE, 'y': y + (l - p) / (s - p)}"]
_PIECES = f"""m AS MATERIALIZED ({_MONEY}), c AS MATERIALIZED (SELECT a.image, a.x, a.y, a.v AS p, b.v AS q, c.v AS r, d.v AS s, {_LEVEL}::DOUBLE AS l, (a.v >= l)::INT + 2 * (b.v >= l)::INT + 4 * (c.v >= l)::INT + 8 * (d.v >= l)::INT AS k, (a.v + b.v + c.v + d.v) / 4 >= l AS mid
    FROM m a JOIN m b ON b.image = a.image AND b.x = a.x + 1 AND b.y = a.y JOIN m c ON c.image = a.image AND c.x = a.x + 1 AND c.y = a.y + 1 JOIN m d ON d.image = a.image AND d.x = a.x AND d.y = a.y + 1),
  g AS MATERIALIZED ({" UNION ALL ".join([f"SELECT image, {_PLACES[a]} AS a, {_PLACES[b]} AS b FROM c WHERE k = {k}" for k, a, b in _WAYS] + [f"SELECT image, {_PLACES[a]} AS a, {_PLACES[b]} AS b FROM c WHERE k = {k} AND mid = {m}" for k, m, a, b in _SADDLES])}),
  e AS (SELECT a.n AS n, b.n AS m FROM g UNION SELECT e.n, g.b.n FROM e JOIN g ON g.a.n = e.m), z AS (SELECT n, min(m) AS low FROM e GROUP BY n HAVING count(*) FILTER (m = n) > 0)"""


def _contours(spark, d):
    """The contours of the mean prices of pixels, in cents."""
    mean = _image(spark, d, F.sum(F.round(F.col("l_extendedprice") * 100)) / F.count("*"))
    rows = mean.withColumn("image", F.when(F.col("image") == "A", 0).when(F.col("image") == "N", 1).otherwise(2))
    return contours.labelled(contours.segments(rows, "image", _LEVEL, 51, 11))


@query(f"""WITH RECURSIVE {_PIECES}, h AS (SELECT g.a.n AS n, image, g.a AS place, true AS closed FROM g JOIN z ON z.n = g.a.n AND z.low = g.a.n UNION ALL SELECT g.a.n, image, g.a, false FROM g WHERE g.a.n NOT IN (SELECT g.b.n FROM g)),
  w AS (SELECT n AS start, n, image, place, closed, 0::BIGINT AS ordinal FROM h UNION ALL SELECT w.start, g.b.n, w.image, g.b, w.closed, w.ordinal + 1 FROM w JOIN g ON g.a.n = w.n AND g.b.n <> w.start)
  SELECT image, (min(n) OVER (PARTITION BY start))::BIGINT AS ring, ordinal, closed, round(place.x, 6) AS x, round(place.y, 6) AS y FROM w""")
def contour_points(spark, d):
    """The places along each contour, in order."""
    return contours.points(_contours(spark, d), "image").select("image", "ring", "ordinal", "closed", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(f"""WITH RECURSIVE {_PIECES} SELECT image, low::BIGINT AS ring, count(*) AS n, round(sum(g.a.x * g.b.y - g.b.x * g.a.y) / 2, 5) + 0.0 AS area FROM g JOIN z ON z.n = g.a.n GROUP BY image, low""")
def contour_rings(spark, d):
    """The closed contours and their areas."""
    return contours.ellipses(_contours(spark, d), "image", 51, 11).select("image", "ring", "n", (F.round("area", 5) + 0.0).alias("area"))


#: Four images of pairs of customers, some four pixels apart, each pair on a place of its own.
_X, _Y = "(c_custkey // 8 % 40 * 30 + 15 + c_custkey // 4 % 2 * 3.5 + c_custkey % 7 * 0.1)", "(c_custkey // 320 * 30 + 15 + c_custkey // 4 % 2 * 2.5 + c_custkey % 9 * 0.1)"
_XX, _XY, _YY = 1.7, 0.3, 1.2


@query(f"SELECT (c_custkey % 4)::INT AS image, c_custkey AS id, round({_X}::DOUBLE, 4) AS x, round({_Y}::DOUBLE, 4) AS y, round(c_acctbal + 2000, 2) AS flux, (SELECT count(*) FROM customer o WHERE o.c_custkey % 4 = c.c_custkey % 4 AND o.c_custkey // 8 = c.c_custkey // 8) AS together FROM customer c")
def blended_sources(spark, d):
    """Places and fluxes of blended sources, found again by joint fits from guesses that are off by a third of a pixel and a fifth of the light. The images are made of customers' light."""
    place = [e.replace("//", "div").replace("3.5", "3.5D").replace("2.5", "2.5D").replace("0.1", "0.1D") for e in (_X, _Y)]
    stars = table(spark, d, "customer").selectExpr("CAST(c_custkey % 4 AS INT) AS image", "c_custkey AS id", f"{place[0]} AS sx", f"{place[1]} AS sy", "c_acctbal + 2000 AS flux")
    steps = F.sequence(F.lit(-10), F.lit(10))
    dealt = stars.repartition(max(spark.sparkContext.defaultParallelism, stars.count() // sources.STARS), "image", F.floor(F.col("sx") / 64), F.floor(F.col("sy") / 64))  # a star is 441 pixels
    lit = dealt.withColumn("i", F.explode(steps)).withColumn("j", F.explode(steps)).withColumn("x", F.floor("sx") + F.col("i")).withColumn("y", F.floor("sy") + F.col("j"))
    dx, dy, area = F.col("x") - F.col("sx"), F.col("y") - F.col("sy"), _XX * _YY - _XY**2
    light = F.col("flux") / (2 * math.pi * math.sqrt(area)) * F.exp(-(_YY * dx * dx - 2 * _XY * dx * dy + _XX * dy * dy) / (2 * area))
    pixels = lit.groupBy("image", "x", "y").agg(F.sum(light).alias("v")).withColumn("var", F.lit(1.0))
    guess = stars.select("image", "id", (F.col("sx") + 0.3).alias("x"), (F.col("sy") - 0.2).alias("y"), (F.col("flux") * 0.8).alias("flux"), F.lit(_XX).alias("xx"), F.lit(_XY).alias("xy"), F.lit(_YY).alias("yy"))
    out = sources.fit(pixels, guess, ["image"], "id", 6.0)
    return out.select("image", "id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"), F.round("flux", 2).alias("flux"), "together")


_TIMES = "SELECT l_returnflag AS image, CAST(l_quantity AS INT) AS x, CAST(round(l_discount * 100) AS INT) AS y, CAST(l_linenumber AS DOUBLE) AS t, CAST(count(*) AS DOUBLE) AS v FROM lineitem GROUP BY ALL"


@query(f"SELECT image, x, y, count(*) AS n, round(regr_slope(v * (t + 0.5), t), 6) + 0.0 AS scale, round(regr_intercept(v * (t + 0.5), t), 5) + 0.0 AS level FROM ({_TIMES}) GROUP BY image, x, y HAVING count(*) > 1")
def shutter_map(spark, d):
    """The scale of each pixel and its level at time 0, line numbers taken as times, for a reference open by half a unit longer."""
    c = F.col
    times = table(spark, d, "lineitem").groupBy(c("l_returnflag").alias("image"), c("l_quantity").cast("int").alias("x"), F.round(c("l_discount") * 100).cast("int").alias("y"), c("l_linenumber").alias("t")).agg(F.count("*").cast("double").alias("v"))
    reference = times.select("image").distinct().withColumn("reference", F.lit(0.5))
    out = detrend.shutter(times, ["image"], "t", reference).where("n > 1")
    return out.select("image", "x", "y", "n", (F.round("scale", 6) + 0.0).alias("scale"), (F.round("level", 5) + 0.0).alias("level"))


@query(f"WITH i AS (SELECT *, sin(x * 0.7::DOUBLE + y * 0.2::DOUBLE) AS f FROM ({_COUNTS})), s AS (SELECT image, regr_slope(v, f) AS k FROM i GROUP BY image) SELECT image, x, y, round(v - k * f, 5) + 0.0 AS v FROM i JOIN s USING (image)")
def image_without_fringes(spark, d):
    """The counts without the share of a wave that they hold."""
    waves = _counts(spark, d).withColumn("f", F.sin(F.col("x") * 0.7 + F.col("y") * 0.2))
    return detrend.without_fringes(waves, detrend.fringes(waves, ["image"], ["f"], None), ["image"], ["f"]).select("image", "x", "y", (F.round("v", 5) + 0.0).alias("v"))
