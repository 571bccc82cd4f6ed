"""Reduction of the images made of lineitem, and the light in them."""

from pyspark.sql import functions as F

from heliotab.operators import graphs, photometry
from heliotab.plans.images_and_fits import _COUNTS, _image
from heliotab.plans.registry import query, table


def _counts(spark, d):
    return _image(spark, d, F.count("*").cast("double"))


def _r(df, digits, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


@query(f"WITH i AS ({_COUNTS}), o AS (SELECT image, y, median(v) AS m FROM i WHERE x BETWEEN 46 AND 50 GROUP BY image, y) SELECT image, x, y, v - coalesce(m, 0) AS v FROM i LEFT JOIN o USING (image, y) WHERE x NOT BETWEEN 46 AND 50")
def overscan(spark, d):
    return photometry.overscan_subtracted(_counts(spark, d), ["image"], 46, 50)


@query(f"WITH i AS (SELECT *, (x * 7 + y * 3) % 13 = 0 AS bad FROM ({_COUNTS})), m AS (SELECT a.image, a.x, a.y, avg(b.v) AS m FROM i a JOIN i b ON a.image = b.image AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND NOT b.bad AND (a.x <> b.x OR a.y <> b.y) GROUP BY ALL) SELECT image, x, y, round(CASE WHEN bad THEN coalesce(m, v) ELSE v END, 6) AS v FROM i LEFT JOIN m USING (image, x, y)")
def mended_pixels(spark, d):
    return _r(photometry.mended(_counts(spark, d), ["image"], (F.col("x") * 7 + F.col("y") * 3) % 13 == 0), 6, "v")


@query(f"WITH i AS ({_COUNTS}), m AS (SELECT image, x, median(v) AS m FROM i GROUP BY image, x), o AS (SELECT image, x, m - (lag(m) OVER w + lead(m) OVER w) / 2 AS off FROM m WINDOW w AS (PARTITION BY image ORDER BY x)) SELECT image, x, y, v - CASE WHEN abs(off) > 2 THEN off ELSE 0 END AS v FROM i LEFT JOIN o USING (image, x)")
def level_columns(spark, d):
    return photometry.level_columns(_counts(spark, d), ["image"], 2.0)


@query(f"SELECT image, CAST(x // 10 AS INT) AS x, CAST(y // 4 AS INT) AS y, median(v) AS median FROM ({_COUNTS}) GROUP BY ALL")
def median_map(spark, d):
    return photometry.median_map(_counts(spark, d), ["image"], 10, 4)


_GRID = "(SELECT a.r AS x, b.r AS y FROM (SELECT unnest(range(30)) AS r) a, (SELECT unnest(range(20)) AS r) b)"


@query(f"SELECT CAST(x AS INT) AS x, CAST(y AS INT) AS y, round(5 * exp(-(power(x - 14.5, 2) + power(y - 9.0, 2)) / 18), 9) AS v FROM {_GRID}")
def gaussian_image(spark, d):
    return _r(photometry.gaussian_image(spark, 30, 20, 14.5, 9.0, 3.0, 5.0), 9, "v")


@query(f"SELECT CAST(x AS INT) AS x, CAST(y AS INT) AS y, round(avg(exp(-(4 - 1 / 3.0::DOUBLE) * power(sqrt(power(x + (i.k + 0.5) / 4 - 0.5 - 14.5, 2) + power(y + (j.k + 0.5) / 4 - 0.5 - 9, 2)) / 4, 0.5))), 9) AS v FROM {_GRID}, (SELECT unnest(range(4)) AS k) i, (SELECT unnest(range(4)) AS k) j GROUP BY x, y")
def sersic_image(spark, d):
    return _r(photometry.sersic_image(spark, 30, 20, 14.5, 9.0, 4.0, 2.0, parts=4), 9, "v")


_RADIUS = "sqrt(power((x - 20) * cos(radians(20)) + (y - 5) * sin(radians(20)), 2) + power(((y - 5) * cos(radians(20)) - (x - 20) * sin(radians(20))) / 0.5, 2))"


@query(f"SELECT image, ring, n, flux, round(flux / n, 6) AS mean, CAST(sum(flux) OVER w AS DOUBLE) AS inside FROM (SELECT image, CAST(floor({_RADIUS} / 2.1) AS INT) AS ring, count(*) AS n, sum(v) AS flux FROM ({_COUNTS}) GROUP BY ALL) WINDOW w AS (PARTITION BY image ORDER BY ring)")
def radial_profile(spark, d):
    """By elliptical rings, with the curve of growth."""
    return _r(photometry.radial_profile(_counts(spark, d), ["image"], 20.0, 5.0, 2.1, 0.5, 20.0), 6, "mean").select("image", "ring", "n", "flux", "mean", "inside")


_BRIGHT = f"(SELECT image, x, y, v * exp(-(power(x - 20, 2) + power(y - 5, 2)) / 20.0::DOUBLE) AS v FROM ({_COUNTS}))"


def _bright(spark, d):
    """The images with a light at (20, 5)."""
    r2 = F.pow(F.col("x") - 20, F.lit(2.0)) + F.pow(F.col("y") - 5, F.lit(2.0))
    return _counts(spark, d).withColumn("v", F.col("v") * F.exp(-r2 / 20))


@query(f"WITH p AS (SELECT image, ring, flux / n AS mean, sum(flux) OVER w AS inside, sum(n) OVER w AS m FROM (SELECT image, CAST(floor(sqrt(power(x - 20, 2) + power(y - 5, 2))) AS INT) AS ring, count(*) AS n, sum(v) AS flux FROM {_BRIGHT} GROUP BY ALL) WINDOW w AS (PARTITION BY image ORDER BY ring)) SELECT image, ring, round(inside, 4) AS inside FROM p WHERE mean < 0.2 * inside / m QUALIFY row_number() OVER (PARTITION BY image ORDER BY ring) = 1")
def petrosian_radius(spark, d):
    return _r(photometry.petrosian(photometry.radial_profile(_bright(spark, d), ["image"], 20.0, 5.0), ["image"]), 4, "inside")


@query(f"WITH b AS (SELECT *, sqrt(power(x - 20, 2) + power(y - 5, 2)) AS r FROM {_BRIGHT}), k AS (SELECT image, sum(r * v) / sum(v) AS radius FROM b WHERE r < 9.5 GROUP BY image) SELECT image, round(radius, 6) AS radius, round(sum(v), 4) AS flux FROM b JOIN k USING (image) WHERE r < 2.5 * radius GROUP BY image, radius")
def kron_flux(spark, d):
    return _r(_r(photometry.kron(_bright(spark, d), ["image"], 20.0, 5.0, 9.5), 6, "radius"), 4, "flux")


@query(f"SELECT image, CAST(least(floor((degrees(atan2(y - 5.2, x - 20.3)) + 360) % 360 * 8 / 360), 7) AS INT) AS sector, CAST(floor(sqrt(power(x - 20.3, 2) + power(y - 5.2, 2)) / 3) AS INT) AS ring, count(*) AS n, round(avg(v), 6) AS mean FROM ({_COUNTS}) GROUP BY ALL")
def sector_profiles(spark, d):
    return _r(photometry.sectors(_counts(spark, d), ["image"], 20.3, 5.2, 8, 3.0), 6, "mean")


@query(f"WITH i AS ({_COUNTS}), p AS (SELECT DISTINCT image, k, 4.3 + k * 3 AS x0, 5.2 - k % 2 AS y0 FROM i, (SELECT unnest(range(15)) AS k)), n AS (SELECT image, k, v, sqrt(power(x - x0, 2) + power(y - y0, 2)) AS r FROM p JOIN i USING (image)) SELECT image, k, count(CASE WHEN r <= 2.5 THEN 1 END) AS n, round(sum(CASE WHEN r <= 2.5 THEN v END) - count(CASE WHEN r <= 2.5 THEN 1 END) * coalesce(median(CASE WHEN r >= 3 AND r < 5 THEN v END), 0), 6) AS flux, median(CASE WHEN r >= 3 AND r < 5 THEN v END) AS sky FROM n GROUP BY image, k HAVING count(CASE WHEN r <= 2.5 THEN 1 END) > 0")
def aperture_photometry(spark, d):
    """Light within 2.5 pixels of given places, less the sky of a ring around them."""
    own = _counts(spark, d)
    places = own.select("image").distinct().withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(14)))).select("image", "k", (4.3 + F.col("k") * 3).alias("x"), (5.2 - F.col("k") % 2).alias("y"))
    return _r(photometry.apertures(places, own, ["image"], "k", 2.5, 3.0, 5.0), 6, "flux").withColumn("k", F.col("k").cast("bigint"))


@query(f"WITH s AS (SELECT image, sum(v) AS f, sum(v * x) / sum(v) AS x, sum(v * y) / sum(v) AS y, sum(v * x * x) / sum(v) AS a, sum(v * x * y) / sum(v) AS b, sum(v * y * y) / sum(v) AS c FROM ({_COUNTS}) GROUP BY image), m AS (SELECT image, f, x, y, a - x * x AS xx, b - x * y AS xy, c - y * y AS yy FROM s) SELECT image, f AS flux, round(x, 6) AS x, round(y, 6) AS y, round(sqrt((xx + yy) / 2 + sqrt(power((xx - yy) / 2, 2) + xy * xy)), 6) AS major, round(sqrt((xx + yy) / 2 - sqrt(power((xx - yy) / 2, 2) + xy * xy)), 6) AS minor, round(degrees(atan2(2 * xy, xx - yy)) / 2, 4) AS angle FROM m")
def light_moments(spark, d):
    out = photometry.moments(_counts(spark, d), ["image"])
    return _r(_r(out, 6, "x", "y", "major", "minor"), 4, "angle").select("image", "flux", "x", "y", "major", "minor", "angle")


@query(f"SELECT image, count(*) AS n, sum(v) AS flux FROM ({_COUNTS}) WHERE y >= 1 AND x <= 40 AND (30 - 40) * (y - 9) - (9 - 9) * (x - 40) >= 0 AND (10 - 30) * (y - 9) - (1 - 9) * (x - 30) >= 0 GROUP BY image")
def contour_flux(spark, d):
    """The light inside the contour (10, 1), (40, 1), (40, 9), (30, 9)."""
    return photometry.contour_flux(_counts(spark, d), ["image"], [(10, 1), (40, 1), (40, 9), (30, 9)])


@query(f"WITH RECURSIVE b AS (SELECT CAST(ascii(image) % 3 AS INT) AS image, x, y, v, (ascii(image) % 3 * 11 + y) * 51 + x AS node FROM ({_COUNTS}) WHERE v >= (SELECT 1.15 * avg(v) FROM ({_COUNTS}))), e AS (SELECT p.node AS a, q.node AS b FROM b p JOIN b q ON p.image = q.image AND abs(p.x - q.x) <= 1 AND abs(p.y - q.y) <= 1), r AS (SELECT node, node AS root FROM b UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a) SELECT image, CAST(m.root AS BIGINT) AS root, count(*) AS n, sum(v) AS flux, max(v) AS peak FROM (SELECT node, min(root) AS root FROM r GROUP BY node) m JOIN b USING (node) GROUP BY image, m.root")
def detections(spark, d):
    """Groups of touching bright pixels."""
    own = _counts(spark, d)
    level = own.agg(1.15 * F.avg("v")).first()[0]
    return photometry.detections(own.withColumn("image", (F.ascii("image") % 3).cast("int")), "image", level, 51, 11)


@query(f"SELECT image, CAST(floor(0.9 * x + 0.2 * y + 3 + 0.5) AS INT) AS x, CAST(floor(-0.1 * x + 1.1 * y + 5 + 0.5) AS INT) AS y, round(avg(v), 6) AS v FROM (SELECT image, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y, v FROM ({_COUNTS})) GROUP BY ALL")
def image_transform(spark, d):
    return _r(photometry.affine(_counts(spark, d), ["image"], 0.9, 0.2, -0.1, 1.1, 3.0, 5.0), 6, "v")


_TRACE = f"SELECT image, x, sum(v) AS flux FROM ({_COUNTS}) WHERE abs(y - (0.05 * x + 3)) <= 2.01 GROUP BY image, x"


@query(f"WITH s AS ({_TRACE}) SELECT a.image AS image, count(*) AS n, round(regr_slope(a.flux, b.flux), 6) AS scale, round(regr_intercept(a.flux, b.flux), 4) AS off FROM s a JOIN (SELECT x, sum(v) AS flux FROM ({_COUNTS}) WHERE abs(y - (0.05 * x + 3)) <= 2.01 GROUP BY x) b ON a.x = b.x GROUP BY a.image")
def spectra(spark, d):
    """The spectrum of each image along a trace, and the line that takes that of all to it."""
    own = photometry.spectrum(_counts(spark, d), ["image"], 0.05, 3.0, 2.01)
    total = own.groupBy("x").agg(F.sum("flux").alias("flux"))
    out = photometry.spectrum_scale(own, total, ["image"], ["x"], "flux")
    return out.select("image", "n", F.round("scale", 6).alias("scale"), F.round("offset", 4).alias("off"))


@query("WITH RECURSIVE p AS (SELECT s.s_suppkey AS a, t.s_suppkey AS b FROM supplier s, supplier t WHERE abs(s.s_acctbal - t.s_acctbal) < 12), r AS (SELECT s_suppkey AS node, s_suppkey AS root FROM supplier UNION SELECT p.b, r.root FROM r JOIN p ON r.node = p.a) SELECT node AS s_suppkey, min(root) AS cluster FROM r GROUP BY node")
def clusters_by_distance(spark, d):
    """Suppliers whose balances lie within 12 of each other, and so on from one to the next."""
    own = table(spark, d, "supplier").select(F.col("s_suppkey").alias("a"), F.col("s_acctbal").alias("x"))
    return graphs.chains(own, "a", "x", 12.0).select(F.col("a").alias("s_suppkey"), F.col("root").alias("cluster"))
