"""Small matrices, splines, bits, rotations, samples of images along lines, parallaxes, tiles, and streams of means."""

import math

from pyspark.sql import Window, functions as F

from heliotab.functions import sem, sky
from heliotab.operators import fits, group_fits, images, matrices, ranks
from heliotab.plans.images_and_fits import _COUNTS, _image, _nodes
from heliotab.plans.registry import query, same, table
from heliotab.plans.sky_and_series import _STARS, _sky
from heliotab.plans.streams import _stream
from heliotab.streaming import events

_M = "SELECT l_returnflag AS f, CAST(count(*) AS DOUBLE) / 1000 AS a, sum(l_discount) / 100 AS b, sum(l_tax) / 100 AS c, sum(l_discount * l_discount) / 10 AS d, sum(l_discount * l_tax) / 10 AS e, sum(l_tax * l_tax) / 10 AS g FROM lineitem GROUP BY l_returnflag"


def _matrices(spark, d):
    c = F.col
    sums = table(spark, d, "lineitem").groupBy(c("l_returnflag").alias("f")).agg((F.count("*") / 1000).alias("a"), (F.sum("l_discount") / 100).alias("b"), (F.sum("l_tax") / 100).alias("c"), (F.sum(c("l_discount") * c("l_discount")) / 10).alias("d"), (F.sum(c("l_discount") * c("l_tax")) / 10).alias("e"), (F.sum(c("l_tax") * c("l_tax")) / 10).alias("g"))
    return sums.select("f", F.array("a", "b", "c", "b", "d", "e", "c", "e", "g").alias("m"), F.array("a", "b", "c").alias("first"))


@query(f"SELECT f, round(a * (d * g - e * e) - b * (b * g - e * c) + c * (b * e - d * c), 6) AS determinant, TRUE AS undone, TRUE AS first FROM ({_M})")
def matrix_inverse(spark, d):
    """Determinants of a matrix for each flag; whether the inverse undoes it; whether its first row as the right side is solved by the first axis."""
    out = matrices.solved(matrices.inverse(_matrices(spark, d), "m", 3), "m", "first", 3)
    trace = sum(F.get("m", F.lit(3 * i + k)) * F.get("inverse", F.lit(3 * k + i)) for i in range(3) for k in range(3))
    near = lambda i, v: F.abs(F.get("solution", F.lit(i)) - v) < 1e-6
    return out.select("f", F.round("determinant", 6).alias("determinant"), (F.abs(trace - 3) < 1e-6).alias("undone"), (near(0, 1.0) & near(1, 0.0) & near(2, 0.0)).alias("first"))


@query(f"SELECT f, round(sqrt(a * a + d * d + g * g + 2 * (b * b + c * c + e * e)), 6) AS norm, round(abs(a * (d * g - e * e) - b * (b * g - e * c) + c * (b * e - d * c)), 6) AS volume FROM ({_M})")
def matrix_singular_values(spark, d):
    """The norm and the volume that singular values give."""
    w = lambda i: F.get("w", F.lit(i))
    out = matrices.singular_values(_matrices(spark, d), "m", 3)
    return out.select("f", F.round(F.sqrt(w(0) * w(0) + w(1) * w(1) + w(2) * w(2)), 6).alias("norm"), F.round(w(0) * w(1) * w(2), 6).alias("volume"))


@query()
def spline_levels(spark, d):
    """Levels between purchases on a natural cubic spline."""
    points, nodes = _nodes(spark, d)
    return fits.spline(points, nodes, ["user_id"], "t", "v", "level").select("event_id", F.round("level", 4).alias("level"))


same("expr_bits", "SELECT p_partkey, p_size | 4 AS put, p_size & ~4 AS cleared, CAST((p_size & 4) <> 0 AS INT) AS tested, p_size ^ 255 AS turned, bit_count(p_size) AS n, shiftleft(p_size, 2) AS up, shiftright(p_size, 1) AS down FROM {part}", ("part",), "SELECT p_partkey, p_size | 4 AS put, p_size & ~4 AS cleared, CAST((p_size & 4) <> 0 AS INT) AS tested, xor(p_size, 255) AS turned, CAST(bit_count(p_size) AS INT) AS n, p_size << 2 AS up, p_size >> 1 AS down FROM part")
same("expr_digests", "SELECT p_partkey, md5(p_name) AS digest, base64(CAST(p_brand AS BINARY)) AS code FROM {part}", ("part",), "SELECT p_partkey, md5(p_name) AS digest, to_base64(encode(p_brand)) AS code FROM part")


@query("SELECT p_partkey, round(exp(lgamma(41) - lgamma(p_size % 41 + 1) - lgamma(41 - p_size % 41)) / 1e6, 3) AS ways FROM part")
def binomial(spark, d):
    """Ways to choose k of 40, in millions."""
    k = (F.col("p_size") % 41).cast("double")
    return table(spark, d, "part").select("p_partkey", F.round(F.exp(math.lgamma(41) - sem.lgamma(k + 1) - sem.lgamma(41 - k)) / 1e6, 3).alias("ways"))


@query(f"SELECT id, round(x, 8) AS x, round(y * cos(radians(25)) - z * sin(radians(25)), 8) AS y, round(y * sin(radians(25)) + z * cos(radians(25)), 8) AS z, round((degrees(atan2(y, x)) + 360) % 360, 6) AS angle, round(sqrt(x * x + y * y), 8) AS r FROM (SELECT id, cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z FROM {_STARS})")
def sky_rotation(spark, d):
    """Unit vectors turned about the x axis, and the polar coordinates of their projections."""
    _, stars = _sky(spark, d)
    x, y, z = sky.unit_vector(F.col("ra"), F.col("dec"))
    v = stars.select("id", x.alias("x"), y.alias("y"), z.alias("z"))
    turned = sky.rotated(F.col("x"), F.col("y"), F.col("z"), "x", 25.0)
    return v.select("id", *[F.round(c, 8).alias(n) for c, n in zip(turned, "xyz")], F.round(F.pmod(F.degrees(F.atan2("y", "x")), F.lit(360.0)), 6).alias("angle"), F.round(F.hypot("x", "y"), 8).alias("r"))


@query(f"SELECT CAST(floor(x / 10) AS INT) AS ix, CAST(floor(y / 10) AS INT) AS iy, count(*) AS n FROM (SELECT degrees(cos(radians(dec)) * sin(radians(ra - 120)) / c) AS x, degrees((cos(radians(45)) * sin(radians(dec)) - sin(radians(45)) * cos(radians(dec)) * cos(radians(ra - 120))) / c) AS y FROM (SELECT *, sin(radians(45)) * sin(radians(dec)) + cos(radians(45)) * cos(radians(dec)) * cos(radians(ra - 120)) AS c FROM {_STARS}) WHERE c > 0) WHERE abs(x) < 80 AND abs(y) < 80 GROUP BY ALL")
def sky_plane_histogram(spark, d):
    """Stars counted in cells of a projection."""
    _, stars = _sky(spark, d)
    x, y = sky.tangent_plane(F.col("ra"), F.col("dec"), 120.0, 45.0)
    places = stars.select(x.alias("x"), y.alias("y")).where("abs(x) < 80 AND abs(y) < 80")
    return places.groupBy(F.floor(F.col("x") / 10).cast("int").alias("ix"), F.floor(F.col("y") / 10).cast("int").alias("iy")).agg(F.count("*").alias("n"))


@query(f"WITH i AS ({_COUNTS}), p AS (SELECT k, 2 + k * 0.75 AS x, 1.25 + k * 0.125 AS y FROM (SELECT unnest(range(60)) AS k)) SELECT i.image AS image, k, round(sum(v * (1 - abs(i.x - p.x)) * (1 - abs(i.y - p.y))), 6) AS v FROM p JOIN i ON abs(i.x - p.x) < 1 AND abs(i.y - p.y) < 1 GROUP BY i.image, k HAVING sum((1 - abs(i.x - p.x)) * (1 - abs(i.y - p.y))) > 0.999999")
def image_line_cut(spark, d):
    """Each image along a line, interpolated."""
    own = _image(spark, d, F.count("*").cast("double"))
    line = own.select("image").distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(59)))).select("image", F.col("k").cast("bigint").alias("k"), (2 + F.col("k") * 0.75).alias("x"), (1.25 + F.col("k") * 0.125).alias("y"))
    return images.sampled(own, line, ["image"], "k").select("image", "k", F.round("v", 6).alias("v"))


@query()
def parallax_fit(spark, d):
    """Motion and parallax of objects with five measures or more, from positions that hold the planted values user_id % 7 + 1, so they must come out."""
    day = sky.julian_date(F.col("ts"))
    rows = table(spark, d, "events").select("user_id", day.alias("day"), (F.col("user_id") * 3.7 % 360).alias("ra"), (F.col("user_id") % 90 - 45).alias("dec"))
    px, py = sky.parallax_factors(F.col("ra"), F.col("dec"), F.col("day"))
    rows = rows.withColumn("px", px).withColumn("py", py).withColumn("t", (F.col("day") - 2460311.0) / 365.25).withColumn("p", F.col("user_id") % 7 + 1)
    out = group_fits.motion_and_parallax(rows, ["user_id", "p"], 2 * F.col("t") + F.col("p") * F.col("px"), 1 - F.col("t") + F.col("p") * F.col("py"), F.col("t"), F.col("px"), F.col("py"))
    return out.where("n >= 10 AND parallax IS NOT NULL").select("user_id", F.round("parallax", 2).alias("parallax"), (F.abs(F.col("parallax") - F.col("p")) < 0.05).alias("as_planted"))


@query(f"SELECT CAST(floor(ra / 10) * 10 AS DOUBLE) AS r_min, CAST(floor(ra / 10) * 10 + 10 AS DOUBLE) AS r_max, CAST(floor((dec + 90) / 10) * 10 - 90 AS DOUBLE) AS d_min, CAST(floor((dec + 90) / 10) * 10 - 80 AS DOUBLE) AS d_max, count(*) AS n FROM {_STARS} GROUP BY ALL")
def tile_boundaries(spark, d):
    """The boundaries of the tiles that hold objects."""
    _, stars = _sky(spark, d)
    r, c = F.floor(F.col("ra") / 10) * 10.0, F.floor((F.col("dec") + 90) / 10) * 10.0 - 90
    return stars.groupBy(r.alias("r_min"), (r + 10).alias("r_max"), c.alias("d_min"), (c + 10).alias("d_max")).agg(F.count("*").alias("n"))


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS v FROM events")
def boxcar(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(-3, 3)
    return table(spark, d, "events").select("event_id", F.round(F.avg("value").over(w), 6).alias("v"))


@query("SELECT event_type, CAST(n - 2 * floor(n * 0.05) AS BIGINT) AS used, round(m, 6) AS value FROM (SELECT event_type, any_value(n) AS n, avg(value) AS m FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events) WHERE k >= floor(n * 0.05) AND k < n - floor(n * 0.05) GROUP BY event_type)")
def reject_extremes(spark, d):
    """Means without the lowest and the highest twentieth."""
    n = F.col("n")
    out = ranks.window_mean(table(spark, d, "events"), ["event_type"], "value", F.floor(n * 0.05), n - F.floor(n * 0.05))
    return out.select("event_type", F.col("used").cast("bigint").alias("used"), F.round("value", 6).alias("value"))


@query("SELECT user_id, count(*) AS n, round(sum(value), 4) AS total, max(ts) AS last FROM events GROUP BY user_id")
def stream_means(spark, d):
    """Counts, sums and the last instant of each user, brought up to date as events come in."""
    sums = _stream(spark, d).groupBy("user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.max("ts").alias("last"))
    return events.finished(sums, "update", ("user_id",)).select("user_id", "n", F.round("total", 4).alias("total"), "last")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_once_each(spark, d):
    """Each user's first event of each type; keys are forgotten when the watermark is ten years past them."""
    once = events.once_each(_stream(spark, d).select("ts", "user_id", "event_type"), ["user_id", "event_type"], "3650 days")
    return events.finished(once.select("user_id", "event_type"), "append")
