"""Boxes, statistics, peaks, resampling, stacks and transforms of the images and cubes made of lineitem."""

from pyspark.sql import functions as F

from heliotab.operators import bins, fourier, images, series, stats
from heliotab.plans.images_and_fits import _COUNTS, _IMAGE, _image
from heliotab.plans.registry import query, table


def _counts(spark, d):
    return _image(spark, d, F.count("*").cast("double"))


def _r(df, digits, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


@query(f"SELECT image, x, y, CASE WHEN v < 2000000 THEN 2000000 WHEN v > 9000000 THEN 9000000 ELSE v END::DOUBLE AS v FROM ({_IMAGE})")
def image_clip(spark, d):
    return _image(spark, d).withColumn("v", series.clip(F.col("v"), 2e6, 2e6, 9e6, 9e6))


@query(f"SELECT image, x, avg(v) AS mean, median(v) AS median FROM ({_IMAGE}) WHERE x BETWEEN 5 AND 24 AND y BETWEEN 2 AND 8 GROUP BY image, x")
def image_cut(spark, d):
    """The mean and the median of a strip, along x."""
    strip = images.box(_image(spark, d), 5, 2, 20, 7)
    return images.collapse(strip, ["image", "x"]).select("image", "x", "mean").join(images.collapse_median(strip, ["image", "x"]), ["image", "x"])


@query(f"SELECT image, CAST(x - 5 AS INT) AS x, CAST(y + 1 AS INT) AS y, v FROM ({_IMAGE}) WHERE x BETWEEN 5 AND 24 AND y BETWEEN 2 AND 8")
def image_extract(spark, d):
    return images.box(_image(spark, d), 5, 2, 20, 7, 0, 3)


@query(f"SELECT image, count(*) AS n, min(v) AS low, max(v) AS high, avg(v) AS mean, median(v) AS median, round(stddev_samp(v), 6) AS sigma FROM ({_COUNTS}) WHERE x BETWEEN 10 AND 39 GROUP BY image")
def image_stats(spark, d):
    out = stats.summary(images.box(_counts(spark, d), 10, 0, 30, 11), ["image"], "v")
    return out.select("image", "n", "low", "high", "mean", "median", F.round("sigma", 6).alias("sigma"))


@query(f"SELECT CAST(r AS INT) AS bin, r * 1000000.0::DOUBLE AS x_low, coalesce(n, 0) AS n FROM (SELECT unnest(range(20)) AS r) LEFT JOIN (SELECT CAST(least(greatest(trunc(v / 1000000), 0), 19) AS INT) AS b, count(*) AS n FROM ({_IMAGE}) GROUP BY b) ON b = r")
def image_histogram(spark, d):
    return bins.histogram(_image(spark, d), "v", 0, 20_000_000, 1_000_000)


@query(f"WITH i AS ({_IMAGE}) SELECT a.image, a.x, a.y, a.v FROM i a LEFT JOIN i b ON a.image = b.image AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND (a.x <> b.x OR a.y <> b.y) GROUP BY ALL HAVING a.v >= 5000000 AND (max(b.v) IS NULL OR a.v > max(b.v))")
def image_peaks(spark, d):
    return images.local_maxima(_image(spark, d), ["image"], 5e6)


def _smooth_sql(axis: str, rows: str) -> str:
    other = "y" if axis == "x" else "x"
    return f"SELECT a.image, a.x, a.y, sum(b.v * exp(-0.5 * power((a.{axis} - b.{axis}) / 1.2, 2))) / sum(exp(-0.5 * power((a.{axis} - b.{axis}) / 1.2, 2))) AS v FROM {rows} a JOIN {rows} b ON a.image = b.image AND a.{other} = b.{other} AND abs(a.{axis} - b.{axis}) <= 4 GROUP BY a.image, a.x, a.y"


@query(f"WITH i AS ({_COUNTS}), h AS ({_smooth_sql('x', 'i')}) SELECT image, x, y, round(v, 6) AS v FROM ({_smooth_sql('y', 'h')})")
def image_smooth(spark, d):
    return _r(images.gaussian_smooth(_counts(spark, d), ["image"], 1.2), 6, "v")


@query(f"WITH i AS ({_COUNTS}), p AS (SELECT image, x + i + 1 AS x, y + j - 1 AS y, v, (CASE i WHEN 1 THEN 0.25 ELSE 0.75 END) * (CASE j WHEN 1 THEN 0.5 ELSE 0.5 END) AS k FROM i, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j)) SELECT image, CAST(x AS INT) AS x, CAST(y AS INT) AS y, CAST(sum(v * k) AS DOUBLE) AS v FROM p GROUP BY ALL HAVING sum(k) > 0.999")
def image_shift(spark, d):
    """Moved by 1.25 and -0.5 pixels."""
    return images.subpixel_shift(_counts(spark, d), ["image"], 1.25, -0.5)


@query(f"WITH i AS ({_COUNTS}), s AS (SELECT unnest(range(-3, 4)) AS s), p AS (SELECT image, x * 4 + a.s AS x, y * 4 + b.s AS y, v, (1 - abs(a.s) / 4.0::DOUBLE) * (1 - abs(b.s) / 4.0::DOUBLE) AS k FROM i, s a, s b) SELECT image, CAST(x AS INT) AS x, CAST(y AS INT) AS y, round(sum(v * k), 6) AS v FROM p GROUP BY ALL HAVING sum(k) > 0.999")
def image_expand(spark, d):
    """Four pixels for one, interpolated."""
    return _r(images.expand(_counts(spark, d), ["image"], 4), 6, "v")


@query(f"SELECT image, CAST(floor(25 + (x - 25) * cos(radians(30)) - (y - 5) * sin(radians(30)) + 0.5) AS INT) AS x, CAST(floor(5 + (x - 25) * sin(radians(30)) + (y - 5) * cos(radians(30)) + 0.5) AS INT) AS y, round(avg(v), 6) AS v FROM ({_COUNTS}) GROUP BY ALL")
def image_rotate(spark, d):
    return _r(images.rotate(_counts(spark, d), ["image"], 30.0, 25.0, 5.0), 6, "v")


@query(f"SELECT image, count(v) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sigma FROM ({_COUNTS}) WHERE sqrt(power(x - 20, 2) + power(y - 5, 2)) >= 2 AND sqrt(power(x - 20, 2) + power(y - 5, 2)) < 6.5 GROUP BY image")
def image_radial(spark, d):
    return _r(images.annulus(_counts(spark, d), ["image"], 20.0, 5.0, 2.0, 6.5), 6, "mean", "sigma")


@query(f"SELECT image, CAST(floor((x * cos(radians(37)) + y * sin(radians(37))) / 2) AS INT) AS bin, round(avg(v), 6) AS mean FROM ({_COUNTS}) GROUP BY ALL")
def image_section(spark, d):
    return _r(images.section(_counts(spark, d), ["image"], 37.0, 2.0), 6, "mean")


@query(f"SELECT x, y, count(v) AS n, round(avg(v), 4) AS mean, median(v) AS median, round(sum(v * (1 + ascii(image) % 3)) / sum(1 + ascii(image) % 3), 4) AS wtmean FROM ({_IMAGE}) GROUP BY x, y")
def image_stack(spark, d):
    """The images of all flags, pixel by pixel."""
    out = images.stack(_image(spark, d).withColumn("w", 1 + F.ascii("image") % 3), "w")
    return _r(out, 4, "mean", "wtmean")


@query(f"SELECT DISTINCT image, CAST(x + i AS INT) AS x, CAST(y + j AS INT) AS y FROM ({_IMAGE}), (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j) WHERE v > 9000000")
def image_grow(spark, d):
    """The mask of bright pixels, grown by one."""
    return images.grow(_image(spark, d).withColumn("v", (F.col("v") > 9e6).cast("double")), ["image"], 1)


@query("SELECT CAST(o % 60 AS INT) AS x, CAST(o // 60 AS INT) AS y, v FROM (SELECT s_suppkey AS o, s_acctbal AS v FROM supplier)")
def vector_to_image(spark, d):
    return images.from_vector(table(spark, d, "supplier"), "s_suppkey", "s_acctbal", 60)


@query(f"SELECT image, CAST(y * 51 + x AS BIGINT) AS ordinal, v FROM ({_IMAGE})")
def image_to_vector(spark, d):
    return images.to_vector(_image(spark, d), ["image"], 51)


@query("SELECT CAST(z AS INT) AS z, CAST(x AS INT) AS x, CAST(y AS INT) AS y, 1.5::DOUBLE AS v FROM (SELECT unnest(range(3)) AS z), (SELECT unnest(range(7)) AS x), (SELECT unnest(range(5)) AS y)")
def image_create(spark, d):
    return images.create(spark, 7, 5, 3, 1.5)


@query(f"SELECT image, x, y, CASE WHEN y = 4 THEN x * 2.0::DOUBLE ELSE v END AS v FROM ({_IMAGE})")
def image_set_row(spark, d):
    """A vector put into a row of each image."""
    vector = spark.range(51).select(F.col("id").cast("int").alias("x"), (F.col("id") * 2.0).alias("new"))
    own = _image(spark, d)
    return own.join(F.broadcast(vector), "x", "left").select("image", "x", "y", F.when(F.col("y") == 4, F.col("new")).otherwise(F.col("v")).alias("v"))


@query(f"SELECT x, v FROM ({_IMAGE}) WHERE image = 'A' AND y = 3")
def image_row(spark, d):
    """One row of one plane of the cube, as a vector."""
    return _image(spark, d).where("image = 'A' AND y = 3").select("x", "v")


@query(f"SELECT x, y, sum(v) AS v FROM (SELECT x, y, v FROM ({_IMAGE}) UNION ALL SELECT CAST(p_size AS INT), 20, CAST(count(*) AS DOUBLE) FROM part GROUP BY p_size) GROUP BY x, y")
def cube_squash(spark, d):
    """The cube of all flags' images, with a plane of part sizes laid on, summed along z."""
    cube = _image(spark, d).withColumnRenamed("image", "z")
    plane = table(spark, d, "part").groupBy(F.col("p_size").cast("int").alias("x")).agg(F.count("*").cast("double").alias("v")).select(F.lit("P").alias("z"), "x", F.lit(20).alias("y"), "v")
    return images.squash(cube.unionByName(plane), "z")


@query("WITH c AS (SELECT CAST(floor(l_quantity / 5) AS INT) AS x, CAST(floor(l_extendedprice / 10000) AS INT) AS y, count(*) AS v FROM lineitem WHERE l_quantity < 50 AND l_extendedprice < 100000 GROUP BY ALL), s AS (SELECT unnest([-1, 0, 1]) AS s) SELECT CAST(x + a.s AS INT) AS x, CAST(y + b.s AS INT) AS y, CAST(sum(v) AS BIGINT) AS v FROM c, s a, s b WHERE x + a.s BETWEEN 0 AND 9 AND y + b.s BETWEEN 0 AND 9 GROUP BY 1, 2")
def spread_density(spark, d):
    return images.spread_density(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", (0, 50, 5), (0, 100000, 10000), 1)


@query("WITH m AS (SELECT l_returnflag AS i, CAST(l_linenumber AS INT) AS j, CAST(count(*) AS DOUBLE) AS v FROM lineitem GROUP BY ALL) SELECT a.i AS i, b.i AS j, sum(a.v * b.v) AS v FROM m a JOIN m b ON a.j = b.j GROUP BY a.i, b.i")
def matrix_product(spark, d):
    """The matrix of flags by line numbers times its transpose."""
    m = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("i"), F.col("l_linenumber").cast("int").alias("j")).agg(F.count("*").cast("double").alias("v"))
    return images.multiply(m, m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v"))


@query("WITH s AS (SELECT o_orderpriority AS p, o_orderkey % 360 AS n, CAST(count(*) AS DOUBLE) AS v FROM orders GROUP BY ALL), k AS (SELECT unnest(range(360)) AS k) SELECT p, k, round(sum(v * cos(2 * pi() * ((k * n) % 360) / 360)), 5) + 0.0 AS re, round(-sum(v * sin(2 * pi() * ((k * n) % 360) / 360)), 5) + 0.0 AS im FROM s, k GROUP BY p, k")
def fourier_1d(spark, d):
    """The spectrum of each priority's counts by order number modulo 360."""
    rows = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("p"), (F.col("o_orderkey") % 360).alias("n")).agg(F.count("*").alias("v"))
    out = fourier.fft(rows, ["p"], "n", "v", None, 360)
    return out.select("p", "k", (F.round("re", 5) + 0.0).alias("re"), (F.round("im", 5) + 0.0).alias("im"))


@query(f"WITH i AS ({_COUNTS}), kx AS (SELECT unnest(range(51)) AS kx), ky AS (SELECT unnest(range(11)) AS ky) SELECT image, kx, ky, round(sum(v * cos(2 * pi() * (kx * x / 51.0::DOUBLE + ky * y / 11.0::DOUBLE))), 4) + 0.0 AS re, round(-sum(v * sin(2 * pi() * (kx * x / 51.0::DOUBLE + ky * y / 11.0::DOUBLE))), 4) + 0.0 AS im FROM i, kx, ky GROUP BY image, kx, ky")
def fourier_2d(spark, d):
    """Rows first, then columns."""
    along = fourier.fft(_counts(spark, d), ["image", "y"], "x", "v", None, 51)
    out = fourier.fft(along, ["image", "k"], "y", "re", "im", 11).toDF("image", "kx", "ky", "re", "im")
    return out.select("image", "kx", "ky", (F.round("re", 4) + 0.0).alias("re"), (F.round("im", 4) + 0.0).alias("im"))
