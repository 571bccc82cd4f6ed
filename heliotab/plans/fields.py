"""Moving objects among detections made of events, drizzled images made of lineitem, and harmonics over the stars made of customers."""

import math

from pyspark.sql import functions as F

from heliotab.operators import drizzle, harmonics, patterns, tracks
from heliotab.operators.store import written
from heliotab.plans.images_and_fits import _IMAGE, _image
from heliotab.plans.registry import query, table
from heliotab.plans.sky_and_series import _STARS, _sky

#: Eight exposures; every fifth object moves, every seventh stands still, the others flicker at places of their own.
_OBJECT = "(event_id // 8)"
_DETECTIONS = f"""SELECT event_id AS id, CAST(event_id % 8 AS DOUBLE) AS t,
  CASE WHEN {_OBJECT} % 5 = 0 THEN {_OBJECT} * 377 % 1009 + ({_OBJECT} % 11 - 5) * 0.37 * (event_id % 8) WHEN {_OBJECT} % 7 = 0 THEN {_OBJECT} * 377 % 1009 ELSE event_id * 7919 % 10007 * 0.1 END::DOUBLE AS x,
  CASE WHEN {_OBJECT} % 5 = 0 THEN {_OBJECT} * 611 % 1013 + ({_OBJECT} % 13 - 6) * 0.29 * (event_id % 8) WHEN {_OBJECT} % 7 = 0 THEN {_OBJECT} * 611 % 1013 ELSE event_id * 6007 % 10009 * 0.1 END::DOUBLE AS y FROM events"""
_SPEED, _GAP, _TOLERANCE = 3.0, 2.0, 0.05
_TRIPLES = f"""WITH d AS ({_DETECTIONS}),
  m AS (SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM d o WHERE o.t <> d.t AND o.x BETWEEN d.x - 1 AND d.x + 1 AND sqrt((o.x - d.x) ** 2 + (o.y - d.y) ** 2) <= {_TOLERANCE})),
  p AS (SELECT a.id AS a, b.id AS b, b.t, b.x, b.y, (b.x - a.x) / (b.t - a.t) AS vx, (b.y - a.y) / (b.t - a.t) AS vy FROM m a JOIN m b ON b.t > a.t AND b.t <= a.t + {_GAP} AND b.x BETWEEN a.x - 6 AND a.x + 6 AND sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2) <= {_SPEED} * (b.t - a.t)),
  r AS (SELECT p.a, p.b, c.id AS c, vx, vy FROM p JOIN m c ON c.t > p.t AND c.t <= p.t + {_GAP} AND c.x BETWEEN p.x - 7 AND p.x + 7 AND sqrt((c.x - p.x - vx * (c.t - p.t)) ** 2 + (c.y - p.y - vy * (c.t - p.t)) ** 2) <= {_TOLERANCE})"""


def _moving(spark, d):
    """Detections that don't stand still. Places are hundredths, exact as in the SQL, since some are just at the tolerance."""
    object_ = F.expr("event_id div 8")
    e = table(spark, d, "events").select("event_id", object_.alias("o"), (F.col("event_id") % 8).cast("double").alias("t"))
    place = lambda p, q, r, s, a, b: F.when(F.col("o") % 5 == 0, F.col("o") * p % q * 100 + (F.col("o") % r - r // 2) * s * (F.col("event_id") % 8)).when(F.col("o") % 7 == 0, F.col("o") * p % q * 100).otherwise(F.col("event_id") * a % b * 10) / F.lit(100.0)
    found = e.select(F.col("event_id").alias("id"), "t", place(377, 1009, 11, 37, 7919, 10007).alias("x"), place(611, 1013, 13, 29, 6007, 10009).alias("y"))
    return written(found.join(tracks.standing(found, _TOLERANCE).hint("merge"), "id", "left_anti"))


@query(_TRIPLES + " SELECT a, b, c, round(vx, 4) + 0.0 AS vx, round(vy, 4) + 0.0 AS vy FROM r")
def moving_triples(spark, d):
    """Three detections on a line at one speed, of what doesn't stand still."""
    return tracks.lines(_moving(spark, d), _SPEED, _GAP, _TOLERANCE).select("a", "b", "c", (F.round("vx", 4) + 0.0).alias("vx"), (F.round("vy", 4) + 0.0).alias("vy"))


@query(_TRIPLES.replace("WITH d", "WITH RECURSIVE d") + """, l AS (SELECT DISTINCT x.b || '-' || x.c AS n, x.a || '-' || x.b AS m FROM r x), n AS (SELECT a || '-' || b AS n, a, b FROM r UNION SELECT b || '-' || c, b, c FROM r),
  k AS (SELECT n, m FROM l UNION ALL SELECT m, n FROM l), w AS (SELECT n, n AS o FROM n UNION SELECT w.n, k.m FROM w JOIN k ON k.n = w.o), t AS (SELECT w.n, min(least(o.a, o.b)) AS track FROM w JOIN n o ON o.n = w.o GROUP BY w.n)
  SELECT DISTINCT track, unnest([n.a, n.b]) AS id FROM t JOIN n ON n.n = t.n""")
def moving_tracks(spark, d):
    """The detections of each moving object, linked by triples with two in common."""
    return tracks.tracks_of(_moving(spark, d), _SPEED, _GAP, _TOLERANCE)


_SX, _SY, _DX, _DY, _FRACTION = 0.7, 1.3, 3.25, -1.5, 0.8


def _overlap(c: str, size: float, shift: float) -> str:
    return f"greatest(0, least({size}::DOUBLE * {c} + {shift} + {size * _FRACTION / 2}, o{c} + 0.5) - greatest({size}::DOUBLE * {c} + {shift} - {size * _FRACTION / 2}, o{c} - 0.5))"


@query(f"""WITH i AS ({_IMAGE}), o AS (SELECT image, v, ox, oy, {_overlap('x', _SX, _DX)} * {_overlap('y', _SY, _DY)} AS a, a / {_SX * _SY * _FRACTION**2} AS part FROM i, range(-4, 60) t(ox), range(-4, 60) u(oy) WHERE abs(ox - {_SX} * x - {_DX}) < 2 AND abs(oy - {_SY} * y - {_DY}) < 2)
  SELECT image, ox::INT AS x, oy::INT AS y, round(sum(v * part), 1) AS v, round(sum(a), 6) AS weight, round(sum(v * part * part), 1) AS variance FROM o WHERE a > 1e-12 GROUP BY ALL""")
def drizzled_image(spark, d):
    """The images made of lineitem on a grid that is finer along x and coarser along y, with shrunk pixels, weights and variances."""
    out = drizzle.drizzle(_image(spark, d).withColumn("var", F.col("v")), ["image"], (_SX, 0.0, 0.0, _SY), (_DX, _DY), fraction=_FRACTION, variance="var")
    return out.select("image", "x", "y", F.round("v", 1).alias("v"), F.round("weight", 6).alias("weight"), F.round("variance", 1).alias("variance"))


@query(f"SELECT image, round(sum(v)) AS v, round(count(*) * 0.97, 4) AS weight FROM ({_IMAGE}) GROUP BY image")
def drizzled_turned(spark, d):
    """What an image turned by 30 degrees holds: all values and all area of the pixels."""
    a = math.radians(30)
    out = drizzle.drizzle(_image(spark, d), ["image"], (math.cos(a), -0.97 * math.sin(a), math.sin(a), 0.97 * math.cos(a)), (5.0, 7.5))
    return out.groupBy("image").agg(F.round(F.sum("v")).alias("v"), F.round(F.sum("weight"), 4).alias("weight"))


def _projected(rows: str, n: int, out: str) -> str:
    """The fit of v by t0 to t(n - 1), by projections one after the other: what is left of v and of all later terms once each term is taken out."""
    q = [f"WITH g0 AS MATERIALIZED ({rows})"]
    for k in range(n):
        later = [f"t{j}" for j in range(k + 1, n)] + ["v"]
        q.append(f"c{k} AS (SELECT " + ", ".join(f"sum(t{k} * {x}) / sum(t{k} * t{k}) AS c{x}" for x in later) + f" FROM g{k})")
        q.append(f"g{k + 1} AS MATERIALIZED (SELECT id, part, v0, " + ", ".join(f"{x} - c{x} * t{k} AS {x}" for x in later) + f" FROM g{k}, c{k})")
    return ", ".join(q) + f" {out} FROM g{n}"


_XYZ = f"(SELECT id, ra, dec, cos(radians(dec)) * cos(radians(ra)) AS x, cos(radians(dec)) * sin(radians(ra)) AS y, sin(radians(dec)) AS z, c_acctbal AS v FROM {_STARS} JOIN customer ON c_custkey = id)"


@query(_projected(f"SELECT id, 0 AS part, v AS v0, v, 1.0::DOUBLE AS t0, x AS t1, y AS t2, z AS t3, x * y AS t4, y * z AS t5, x * z AS t6, z * z - 1.0 / 3 AS t7, x * x - y * y AS t8 FROM {_XYZ}", 9, "SELECT id, round(v0 - v, 4) AS v"))
def harmonic_field(spark, d):
    """The field of second degree that fits the balances of the customers that stars are made of, at each star."""
    stars = _sky(spark, d)[1].select("id", "ra", "dec").join(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal"), "id")
    found = harmonics.fit(stars, 2, "ra", "dec", "c_acctbal")
    return stars.select("id", F.round(harmonics.apply(found, F.col("ra"), F.col("dec")), 4).alias("v"))


_FLOW = f"""(SELECT id, part, v AS v0, v, CASE part WHEN 0 THEN -sin(l) ELSE -sin(b) * cos(l) END AS t0, CASE part WHEN 0 THEN cos(l) ELSE -sin(b) * sin(l) END AS t1, CASE part WHEN 0 THEN 0 ELSE cos(b) END AS t2,
  CASE part WHEN 0 THEN sin(b) * cos(l) ELSE -sin(l) END AS t3, CASE part WHEN 0 THEN sin(b) * sin(l) ELSE cos(l) END AS t4, CASE part WHEN 0 THEN -cos(b) ELSE 0 END AS t5
  FROM (SELECT id, part, radians(ra) AS l, radians(dec) AS b, CASE part WHEN 0 THEN v / 1000 ELSE (id % 17)::DOUBLE END AS v FROM {_XYZ}, range(2) t(part) WHERE abs(dec) < 90))"""


@query(_projected(f"SELECT * FROM {_FLOW}", 6, "SELECT id, round(max(CASE part WHEN 0 THEN v0 - v END), 5) AS east, round(max(CASE part WHEN 1 THEN v0 - v END), 5) AS north") + " GROUP BY id")
def harmonic_flow(spark, d):
    """The rotation and the flow between poles that fit two columns taken as motions best, at each star."""
    stars = _sky(spark, d)[1].select("id", "ra", "dec").join(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal") / 1000).alias("e")), "id").withColumn("n", (F.col("id") % 17).cast("double")).where("abs(dec) < 90")
    found = harmonics.fit_vectors(stars, 1, "ra", "dec", "e", "n")
    east, north = harmonics.apply_vectors(found, F.col("ra"), F.col("dec"))
    return stars.select("id", F.round(east, 5).alias("east"), F.round(north, 5).alias("north"))


#: Four images of customers, each turned and shifted against its reference.
_TURN, _P, _Q = "radians(c_custkey % 4 * 1.7 - 2.6)", "(c_custkey % 4 * 31 - 40)", "(25 - c_custkey % 4 * 17)"


@query(f"SELECT (c_custkey % 4)::INT AS image, count(*) AS n, round(any_value(cos({_TURN})), 4) AS a, round(any_value(sin({_TURN})), 4) AS b, round(any_value({_P}), 2)::DOUBLE AS p, round(any_value({_Q}), 2)::DOUBLE AS q FROM customer GROUP BY ALL")
def matched_lists(spark, d):
    """The turn and shift between star lists made of customers and their references, found blind."""
    stars = table(spark, d, "customer").selectExpr("CAST(c_custkey % 4 AS INT) AS image", "c_custkey AS id", "c_acctbal AS mag", "c_custkey * 7919 % 10007 / 20D AS x", "c_custkey * 6007 % 10009 / 20D AS y", f"{_TURN} AS turn", f"{_P} AS p", f"{_Q} AS q")
    reference = stars.selectExpr("image", "id", "cos(turn) * x - sin(turn) * y + p AS x", "sin(turn) * x + cos(turn) * y + q AS y", "mag")
    out = patterns.match(stars, reference)
    return out.select("image", "n", F.round("a", 4).alias("a"), F.round("b", 4).alias("b"), F.round("p", 2).alias("p"), F.round("q", 2).alias("q"))
