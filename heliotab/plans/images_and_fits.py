"""Images made of lineitem (an image a return flag, quantity by discount, pixels in whole cents so that sums are exact), and fits."""

from pyspark.sql import functions as F

from heliotab.operators import fits, images
from heliotab.plans.registry import query, table

_IMAGE = "SELECT l_returnflag AS image, CAST(l_quantity AS INT) AS x, CAST(round(l_discount * 100) AS INT) AS y, CAST(sum(round(l_extendedprice * 100)) AS DOUBLE) AS v FROM lineitem GROUP BY ALL"

_COUNTS = _IMAGE.replace("CAST(sum(round(l_extendedprice * 100)) AS DOUBLE)", "CAST(count(*) AS DOUBLE)")


def _image(spark, d, pixel=None):
    c = F.col
    return table(spark, d, "lineitem").groupBy(c("l_returnflag").alias("image"), c("l_quantity").cast("int").alias("x"), F.round(c("l_discount") * 100).cast("int").alias("y")).agg((F.sum(F.round(c("l_extendedprice") * 100)).cast("double") if pixel is None else pixel).alias("v"))


@query(f"SELECT image, CAST((x + 5) % 51 AS INT) AS x, CAST((y + 8) % 11 AS INT) AS y, v FROM ({_IMAGE})")
def image_roll(spark, d):
    return images.roll(_image(spark, d), 5, -3, 51, 11)


@query(f"SELECT image, x, y, CASE WHEN x BETWEEN 10 AND 19 AND y BETWEEN 2 AND 5 THEN -1.0::DOUBLE ELSE v END AS v FROM ({_IMAGE})")
def image_zap(spark, d):
    return images.zap(_image(spark, d), 10, 2, 10, 4, -1.0)


@query(f"SELECT image, y, avg(v) AS mean, count(v) AS n, sum(v) AS total FROM ({_IMAGE}) GROUP BY image, y")
def image_collapse(spark, d):
    return images.collapse(_image(spark, d), ["image", "y"])


@query(f"SELECT image, CAST(x // 4 AS INT) AS x, CAST(y // 4 AS INT) AS y, avg(v) AS v FROM ({_IMAGE}) GROUP BY image, x // 4, y // 4")
def image_rebin(spark, d):
    return images.rebin(_image(spark, d), ["image"], 4)


@query(f"""WITH i AS ({_COUNTS}), k AS (SELECT a.range - 1 AS dx, b.range - 1 AS dy, (2 - abs(a.range - 1)) * (2 - abs(b.range - 1)) / 16.0::DOUBLE AS k FROM range(3) a, range(3) b)
  SELECT i.image, i.x, i.y, sum(n.v * k) AS v FROM i, k JOIN i n ON n.image = i.image AND n.x = i.x + dx AND n.y = i.y + dy GROUP BY i.image, i.x, i.y""")
def image_convolve(spark, d):
    kernel = {(i, j): (2 - abs(i)) * (2 - abs(j)) / 16 for i in (-1, 0, 1) for j in (-1, 0, 1)}
    return images.convolve(_image(spark, d, F.count("*").cast("double")), ["image"], kernel)


_NODES = """WITH n AS (SELECT user_id, ts, max(value) AS v FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts),
  m AS (SELECT *, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER w AS bt, lag(v) OVER w AS bv, lead(epoch_us(ts)) OVER w AS nt, lead(v) OVER w AS nv FROM n WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  e AS (SELECT event_id, epoch_us(e.ts) AS t, a.t AS t0, a.v AS v0, a.bt AS abt, a.bv AS abv, b.t AS bt, b.v AS bv, b.nt AS bnt, b.nv AS bnv FROM (SELECT * FROM events WHERE event_type <> 'purchase') e ASOF LEFT JOIN m a ON e.user_id = a.user_id AND e.ts >= a.ts ASOF LEFT JOIN m b ON e.user_id = b.user_id AND e.ts <= b.ts)"""


def _nodes(spark, d):
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return events.where("event_type <> 'purchase'").select("event_id", "user_id", "t"), events.where("event_type = 'purchase'").groupBy("user_id", "t").agg(F.max("value").alias("v"))


@query(f"""{_NODES} SELECT event_id, round(CASE WHEN t0 IS NULL AND bt IS NULL THEN NULL WHEN t0 = bt THEN v0 WHEN t0 IS NULL AND bnt IS NULL THEN bv WHEN bt IS NULL AND abt IS NULL THEN v0
  WHEN t0 IS NULL THEN bv + (t - bt)::DOUBLE * (bnv - bv) / (bnt - bt) WHEN bt IS NULL THEN v0 + (t - t0)::DOUBLE * (abv - v0) / (abt - t0) ELSE v0 + (t - t0)::DOUBLE * (bv - v0) / (bt - t0) END, 4) AS level FROM e""")
def interpolate(spark, d):
    """Levels between purchases, and beyond the first and the last of them on the line through the outermost two."""
    points, nodes = _nodes(spark, d)
    return fits.interpolate(points, nodes, ["user_id"], "t", "v", "level").select("event_id", F.round("level", 4).alias("level"))


@query(f"{_NODES} SELECT event_id, round(CASE WHEN t0 = bt THEN v0 ELSE v0 + (t - t0)::DOUBLE * (bv - v0) / (bt - t0) END, 6) AS level FROM e")
def interpolate_inside(spark, d):
    """The same without values outside."""
    points, nodes = _nodes(spark, d)
    return fits.interpolate(points, nodes, ["user_id"], "t", "v", "level", extrapolate=False).select("event_id", F.round("level", 6).alias("level"))


_U = "((2 * l_quantity - 51) / 49)"


@query("SELECT l_orderkey, l_linenumber, round(fitted, 4) AS fitted FROM (" + fits.projection_sql("SELECT *, l_extendedprice AS y FROM lineitem", ["1.0", _U, f"2 * {_U} * {_U} - 1", f"4 * power({_U}, 3) - 3 * {_U}"]) + ")")
def chebyshev_fit(spark, d):
    lines = table(spark, d, "lineitem")
    terms = fits.chebyshev_terms(F.col("l_quantity"), 1.0, 50.0, 3)
    c = fits.linear_fit(lines, terms, F.col("l_extendedprice"))
    return lines.select("l_orderkey", "l_linenumber", F.round(fits.applied(terms, c), 4).alias("fitted"))


_TERMS_2D = ["1.0", "l_quantity", "l_quantity * l_quantity", "l_discount", "l_quantity * l_discount", "l_discount * l_discount"]


@query("SELECT l_orderkey, l_linenumber, round(fitted, 3) AS fitted FROM (" + fits.projection_sql("SELECT *, l_extendedprice AS y FROM lineitem", _TERMS_2D) + ")")
def fit_2d(spark, d):
    lines = table(spark, d, "lineitem")
    terms = fits.powers_2d(F.col("l_quantity"), F.col("l_discount"), 2)
    c = fits.linear_fit(lines, terms, F.col("l_extendedprice"))
    return lines.select("l_orderkey", "l_linenumber", F.round(fits.applied(terms, c), 3).alias("fitted"))


@query("SELECT l_orderkey, l_linenumber, round(fitted, 3) AS fitted FROM (" + fits.projection_sql("SELECT *, l_extendedprice AS y FROM lineitem", ["1.0", "l_quantity", "l_discount", "l_tax"]) + ")")
def fit_3d(spark, d):
    """A plane over three coordinates, and its values."""
    lines = table(spark, d, "lineitem")
    terms = fits.powers_nd([F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")], 1)
    c = fits.linear_fit(lines, terms, F.col("l_extendedprice"))
    return lines.select("l_orderkey", "l_linenumber", F.round(fits.applied(terms, c), 3).alias("fitted"))
