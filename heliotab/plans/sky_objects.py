"""Coordinates and times, images on the sky, and what the catalogue's commands say of objects and their measures.

Stars are customers at derived positions, images are suppliers (with a centre, sizes, an angle and a date), measures are orders and events.
"""

from pyspark.sql import functions as F

from heliotab.functions import libm, sky
from heliotab.operators import footprints, joins, periods
from heliotab.operators.store import written
from heliotab.plans.registry import query, same, table
from heliotab.plans.sky_and_series import _STARS, _exact, _sky

_OB = "radians(23.4392911)"
_LON = f"((degrees(atan2(sin(radians(ra)) * cos(radians(dec)) * cos({_OB}) + sin(radians(dec)) * sin({_OB}), cos(radians(ra)) * cos(radians(dec)))) % 360 + 360) % 360)"
_LAT = f"degrees(asin(sin(radians(dec)) * cos({_OB}) - cos(radians(dec)) * sin(radians(ra)) * sin({_OB})))"


def _stars(spark, d):
    return _sky(spark, d)[1]


def _rounded(df, digits, *columns):
    for c in columns:
        df = df.withColumn(c, F.round(c, digits))
    return df


@query(f"SELECT id, round({_LON}, 6) AS lon, round({_LAT}, 6) AS lat FROM {_STARS}")
def sky_ecliptic(spark, d):
    lon, lat = sky.ecliptic(F.col("ra"), F.col("dec"))
    return _rounded(_stars(spark, d).select("id", lon.alias("lon"), lat.alias("lat")), 6, "lon", "lat")


@query(f"SELECT id, TRUE AS galactic, TRUE AS ecliptic FROM {_STARS}")
def sky_back_and_forth(spark, d):
    """Whether galactic and ecliptic coordinates lead back to the position."""
    rows, here = _stars(spark, d), (F.col("ra"), F.col("dec"))
    same_ = lambda there: sky.separation_arcsec(*here, *there) < 1e-4
    return rows.select("id", same_(sky.from_galactic(*sky.galactic(*here))).alias("galactic"), same_(sky.from_ecliptic(*sky.ecliptic(*here))).alias("ecliptic"))


_L = "(((122.93192 - degrees(atan2(cos(radians(dec)) * sin(radians(ra - 192.85948)), sin(radians(dec)) * cos(radians(27.12825)) - cos(radians(dec)) * sin(radians(27.12825)) * cos(radians(ra - 192.85948))))) % 360 + 360) % 360)"


@query(f"SELECT id, round({_L}, 6) AS l FROM {_STARS}")
def sky_galactic_longitude(spark, d):
    return _stars(spark, d).select("id", F.round(sky.galactic(F.col("ra"), F.col("dec"))[0], 6).alias("l"))


def _angle(x: str) -> float:
    return sum(c * 0.25**k for k, c in enumerate(sky.PRECESSION[x], 1)) / 3600


_A = f"(radians(ra) + radians({_angle('zeta')}))"
_TH = f"radians({_angle('theta')})"


@query(f"SELECT id, round(((degrees(atan2(cos(radians(dec)) * sin({_A}), cos({_TH}) * cos(radians(dec)) * cos({_A}) - sin({_TH}) * sin(radians(dec)))) + {_angle('z')}) % 360 + 360) % 360, 6) AS ra, round(degrees(asin(sin({_TH}) * cos(radians(dec)) * cos({_A}) + cos({_TH}) * sin(radians(dec)))), 6) AS dec FROM {_STARS}")
def sky_precess(spark, d):
    """Positions of J2000 at the equinox of 2025."""
    ra, dec = sky.precessed(F.col("ra"), F.col("dec"), 25.0)
    return _rounded(_stars(spark, d).select("id", ra.alias("ra"), dec.alias("dec")), 6, "ra", "dec")


@query("SELECT event_id, CAST(floor((epoch_us(ts) / 86400e6 + 40587.0) * 86400 + 0.25) AS BIGINT) AS mjd, CAST(floor((epoch_us(ts) / 86400e6 + 2440587.5) * 86400 + 0.25) AS BIGINT) AS jd, TRUE AS back, round((280.46061837 + 360.98564736629 * (epoch_us(ts) / 86400e6 + 2440587.5 - 2451545.0) - 155.5) / 15 % 24, 5) AS lst FROM events")
def sky_times(spark, d):
    """Julian dates of events, in whole seconds, whether they lead back, and sidereal time at 155.5 degrees west."""
    ts = F.col("ts").cast("timestamp")
    off = F.abs(F.unix_micros(sky.from_mjd(sky.mjd(ts))) - F.unix_micros(ts)) <= 10
    return table(spark, d, "events").select("event_id", F.floor(sky.mjd(ts) * 86400 + 0.25).alias("mjd"), F.floor(sky.julian_date(ts) * 86400 + 0.25).alias("jd"), off.alias("back"), F.round(sky.sidereal_hours(sky.julian_date(ts), -155.5), 5).alias("lst"))


_H = "radians(ra - 180)"
_LA = "radians(20.7)"


@query(f"SELECT id, round(degrees(asin(sin(radians(dec)) * sin({_LA}) + cos(radians(dec)) * cos({_LA}) * cos({_H}))), 6) AS alt, round((degrees(atan2(-cos(radians(dec)) * sin({_H}), sin(radians(dec)) * cos({_LA}) - cos(radians(dec)) * sin({_LA}) * cos({_H}))) + 360) % 360, 6) AS az FROM {_STARS}")
def sky_horizon(spark, d):
    """Altitude and azimuth at latitude 20.7 of stars whose hour angle is their right ascension less 180 degrees, a difference of decimals as in the SQL: near the zenith azimuths turn fast."""
    alt, az = libm.altitude_azimuth((F.col("ra") - 180).cast("double"), F.col("dec"), 20.7)
    return _exact(spark, d)[1].select("id", alt.alias("alt"), az.alias("az")).select("id", libm.rounded(F.col("alt"), 6).alias("alt"), libm.rounded(F.col("az"), 6).alias("az"))


_D = "(sin(radians(45)) * sin(radians(dec)) + cos(radians(45)) * cos(radians(dec)) * cos(radians(ra - 120)))"


@query(f"SELECT id, CASE WHEN {_D} > 0 THEN round(degrees(cos(radians(dec)) * sin(radians(ra - 120)) / {_D}), 5) END AS x, CASE WHEN {_D} > 0 THEN round(degrees((cos(radians(45)) * sin(radians(dec)) - sin(radians(45)) * cos(radians(dec)) * cos(radians(ra - 120))) / {_D}), 5) END AS y, {_D} > 0 AS back FROM {_STARS}")
def sky_plane(spark, d):
    """Standard coordinates about (120, 45), and whether they lead back."""
    ra, dec = F.col("ra"), F.col("dec")
    x, y = sky.tangent_plane(ra, dec, 120.0, 45.0)
    rows = _stars(spark, d).select("id", "ra", "dec", x.alias("x"), y.alias("y"))
    back = F.coalesce(sky.separation_arcsec(ra, dec, *sky.plane_sky(F.col("x"), F.col("y"), F.lit(120.0), F.lit(45.0))) < 1e-3, F.lit(False))
    return rows.select("id", F.round("x", 5).alias("x"), F.round("y", 5).alias("y"), back.alias("back"))


_IMAGES = "(SELECT s_suppkey AS image, (s_suppkey * 37.7 + 0.2) % 360 AS ra0, (s_acctbal % 80) * CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END AS dec0, 3.0 + s_suppkey % 4 AS half_x, 2.5 AS half_y, (s_suppkey * 13) % 180 AS angle, s_nationkey AS chip FROM supplier)"
_LARGEST = 6.6
_DEPTH = "(sin(radians(dec0)) * sin(radians(dec)) + cos(radians(dec0)) * cos(radians(dec)) * cos(radians(ra - ra0)))"
_X = f"degrees(cos(radians(dec)) * sin(radians(ra - ra0)) / {_DEPTH})"
_Y = f"degrees((cos(radians(dec0)) * sin(radians(dec)) - sin(radians(dec0)) * cos(radians(dec)) * cos(radians(ra - ra0))) / {_DEPTH})"
_IN = f"({_DEPTH} > 0 AND abs({_X} * cos(radians(angle)) - {_Y} * sin(radians(angle))) <= half_x AND abs({_X} * sin(radians(angle)) + {_Y} * cos(radians(angle))) <= half_y)"


def _images(spark, d):
    return table(spark, d, "supplier").selectExpr("s_suppkey AS image", "(s_suppkey * 377 + 2) % 3600 / 10D AS ra0", "(s_acctbal % 80) * CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END AS dec0", "CAST(3 + s_suppkey % 4 AS DOUBLE) AS half_x", "2.5D AS half_y", "CAST((s_suppkey * 13) % 180 AS DOUBLE) AS angle", "s_nationkey AS chip")


@query(f"SELECT image, id FROM {_IMAGES} i, {_STARS} s WHERE {_IN}")
def stars_in_images(spark, d):
    """The stars in each image; by star, the images that hold it."""
    return footprints.containing(_stars(spark, d), _images(spark, d), "ra", "dec", _LARGEST).select("image", "id")


@query(f"SELECT i.image AS image, o_orderkey, o_totalprice FROM {_IMAGES} i, {_STARS} s, orders WHERE o_custkey = s.id AND month(o_orderdate) % 4 = i.image % 4 AND {_IN}")
def image_measures(spark, d):
    """One column of the measures that belong to each image: of stars that it holds, at its time."""
    measures = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("id"), (F.month("o_orderdate") % 4).alias("time"))
    listed = written(footprints.listed(measures, ["id", "time"], "o_orderkey").join(_stars(spark, d).hint("merge"), "id"))
    images = _images(spark, d).withColumn("time", (F.col("image") % 4).cast("int"))
    return footprints.containing(listed, images, "ra", "dec", _LARGEST, ["time"]).select("image", F.explode("rows").alias("m")).select("image", "m.o_orderkey", "m.o_totalprice")


@query(f"SELECT ra, dec, count(*) AS n, min(chip) AS low, max(chip) AS high FROM {_IMAGES} i, (SELECT a.r * 2 + 1.0 AS ra, b.r * 2 - 89.0 AS dec FROM (SELECT unnest(range(180)) AS r) a, (SELECT unnest(range(90)) AS r) b) g WHERE abs(dec - dec0) < 8 AND {_IN} GROUP BY ra, dec")
def sky_coverage(spark, d):
    """How many images hold each point of a grid of two degrees, with the least and the greatest chip."""
    return footprints.coverage(_images(spark, d), 2.0, _LARGEST, "chip")


@query(f"SELECT CAST(floor(ra / 15) AS BIGINT) AS cell_ra, CAST(floor((dec + 90) / 15) AS BIGINT) AS cell_dec, count(*) AS n, 1 AS covered FROM {_STARS} s JOIN (SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) >= 2 AND count_if(o_orderstatus = 'F') >= 2) o ON o_custkey = id GROUP BY 1, 2")
def object_coverage(spark, d):
    """Density and coverage of objects with two measures or more, two of them good."""
    good = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f")).where("n >= 2 AND f >= 2").select("id")
    cells = _stars(spark, d).join(good, "id").groupBy(F.floor(F.col("ra") / 15).alias("cell_ra"), F.floor((F.col("dec") + 90) / 15).alias("cell_dec"))
    return cells.agg(F.count("*").alias("n")).withColumn("covered", F.lit(1))


@query(f"SELECT id, printf('r%03d.d%+03d', CAST(floor(ra / 10) * 10 AS INT), CAST(floor((dec + 90) / 10) * 10 - 90 AS INT)) AS tile FROM {_STARS}")
def tile_names(spark, d):
    """The name of the catalogue tile at each position."""
    return _stars(spark, d).select("id", sky.fields_of(F.col("ra"), F.col("dec"), 10.0).alias("tile"))


@query("SELECT cell_x, cell_y, count(*) AS n, round(avg(dx), 6) AS dx, round(avg(dy), 6) AS dy FROM (SELECT CAST(floor(l_quantity / 10) AS INT) AS cell_x, CAST(floor(l_extendedprice / 20000) AS INT) AS cell_y, l_tax - 0.04 AS dx, l_discount - 0.05 AS dy FROM lineitem) GROUP BY cell_x, cell_y")
def residual_map(spark, d):
    """Mean residuals over the cells of the focal plane."""
    rows = table(spark, d, "lineitem").select(F.floor(F.col("l_quantity") / 10).cast("int").alias("cell_x"), F.floor(F.col("l_extendedprice") / 20000).cast("int").alias("cell_y"), (F.col("l_tax") - 0.04).alias("dx"), (F.col("l_discount") - 0.05).alias("dy"))
    return rows.groupBy("cell_x", "cell_y").agg(F.count("*").alias("n"), F.round(F.avg("dx"), 6).alias("dx"), F.round(F.avg("dy"), 6).alias("dy"))


#: Images with a scale beyond a factor of 1.05 from the nominal one.
same("bad_images", "SELECT s_suppkey, s_acctbal FROM {supplier} WHERE NOT (s_acctbal BETWEEN 4500 / 1.05 AND 4500 * 1.05)", ("supplier",))
@query("SELECT e.event_id, arg_max(c.event_id, (c.ts, c.event_id)) AS calibration FROM events e JOIN events c ON e.user_id = c.user_id AND c.event_type = 'click' AND e.event_type = 'purchase' AND c.ts <= e.ts AND c.ts > e.ts - INTERVAL 30 DAYS GROUP BY e.event_id")
def valid_calibration(spark, d):
    """The calibration of each measure: the latest of its user's that began before it, if within 30 days. Both are merged in order; no pairs are made."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    steps = events.where("event_type = 'click'").groupBy("user_id", F.col("ts").alias("at")).agg(F.struct(F.col("ts").alias("at"), F.max("event_id").alias("id")).alias("c"))
    found = joins.bracket(events.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), steps, ["user_id"], "ts", "at", "c")
    return found.where("c.at > ts - INTERVAL 30 DAYS").select("event_id", F.col("c.id").alias("calibration"))


@query("WITH m AS (SELECT o_custkey, list(epoch_us(o_orderdate) / 86400e6 ORDER BY o_orderdate, o_orderkey) AS t, list(o_totalprice ORDER BY o_orderdate, o_orderkey) AS v FROM orders GROUP BY o_custkey HAVING count(*) = 3), s AS (SELECT o_custkey, (v[2] - v[1]) / (t[2] - t[1]) AS a, (v[3] - v[2]) / (t[3] - t[2]) AS b FROM m WHERE t[2] > t[1] AND t[3] > t[2]) SELECT o_custkey, round((a - b) / (a + b), 4) AS change, round((a + b) / 2, 2) AS slope FROM s WHERE abs(a + b) > 1e-9")
def slope_change(spark, d):
    """Objects with exactly three measures: how the slope changes between them, and the mean slope."""
    day = F.unix_micros(F.col("o_orderdate").cast("timestamp")) / 86_400e6
    rows = table(spark, d, "orders").select("o_custkey", F.struct(day.alias("t"), F.col("o_orderkey"), F.col("o_totalprice").alias("v")).alias("m"))
    three = rows.groupBy("o_custkey").agg(F.count("*").alias("n"), F.min("m").alias("p"), F.max("m").alias("r"), F.sum("m.t").alias("t"), F.sum("m.v").alias("v"), F.sum("m.o_orderkey").alias("k")).where("n = 3")
    middle = {"t": F.col("t") - F.col("p.t") - F.col("r.t"), "v": F.col("v") - F.col("p.v") - F.col("r.v")}
    s = three.select("o_custkey", (middle["t"] - F.col("p.t")).alias("u"), (F.col("r.t") - middle["t"]).alias("w"), (middle["v"] - F.col("p.v")).alias("x"), (F.col("r.v") - middle["v"]).alias("y")).where("u > 1e-9 AND w > 1e-9")
    s = s.select("o_custkey", (F.col("x") / F.col("u")).alias("a"), (F.col("y") / F.col("w")).alias("b")).where("abs(a + b) > 1e-9")
    return s.select("o_custkey", F.round((F.col("a") - F.col("b")) / (F.col("a") + F.col("b")), 4).alias("change"), F.round((F.col("a") + F.col("b")) / 2, 2).alias("slope"))


_GRID = "(SELECT 5 * power(9, unnest(range(1024)) / 1023.0::DOUBLE) AS p)"
_EACH = "SELECT user_id, event_id / 10.0::DOUBLE AS t, value AS y FROM events"


@query(f"""WITH RECURSIVE r AS ({_EACH}), s AS (SELECT user_id, avg(y) AS m, var_samp(y) AS v, max(t) - min(t) AS span FROM r GROUP BY user_id HAVING count(*) >= 3 AND var_samp(y) > 0),
  g AS (SELECT user_id, 5.0::DOUBLE AS p, span FROM s WHERE span > 0 UNION ALL SELECT user_id, p * (1 + 0.1 * p / span), span FROM g WHERE p * (1 + 0.1 * p / span) < 45),
  a AS (SELECT user_id, p, atan2(sum(sin(4 * pi() / p * t)), sum(cos(4 * pi() / p * t))) / 2 AS a FROM g JOIN r USING (user_id) GROUP BY user_id, p),
  w AS (SELECT user_id, p, (power(sum((y - m) * cos(2 * pi() / p * t - a)), 2) / sum(power(cos(2 * pi() / p * t - a), 2)) + power(sum((y - m) * sin(2 * pi() / p * t - a)), 2) / sum(power(sin(2 * pi() / p * t - a), 2))) / (2 * any_value(v)) AS power FROM a JOIN r USING (user_id) JOIN s USING (user_id) GROUP BY user_id, p)
  SELECT user_id, round(p, 6) AS period, round(power, 4) AS power FROM w QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY power DESC, p) = 1""")
def object_periods(spark, d):
    """The period of most power of each object's series, over the grid that fits its span."""
    rows = table(spark, d, "events").select("user_id", (F.col("event_id") / 10.0).alias("t"), F.col("value").alias("y"))
    best = periods.best_grouped(rows, ["user_id"], "t", "y", periods.by_span(5.0, 45.0))
    return _rounded(_rounded(best, 6, "period"), 4, "power")


@query(f"""WITH r AS (SELECT event_type AS k, event_id / 10.0::DOUBLE AS t, value AS y, 1 / (power(1 + event_id % 5, 2) + 0.01) AS w FROM events), g AS {_GRID},
  c AS (SELECT k, p, sum(w) AS W, sum(w * y) / sum(w) AS Y, sum(w * y * y) / sum(w) AS YY, sum(w * cos(2 * pi() / p * t)) / sum(w) AS C, sum(w * sin(2 * pi() / p * t)) / sum(w) AS S, sum(w * y * cos(2 * pi() / p * t)) / sum(w) AS YC, sum(w * y * sin(2 * pi() / p * t)) / sum(w) AS YS, sum(w * power(cos(2 * pi() / p * t), 2)) / sum(w) AS CC, sum(w * cos(2 * pi() / p * t) * sin(2 * pi() / p * t)) / sum(w) AS CS FROM r, g GROUP BY k, p),
  e AS (SELECT k, p, YY - Y * Y AS yy, YC - Y * C AS yc, YS - Y * S AS ys, CC - C * C AS cc, 1 - CC - S * S AS ss, CS - C * S AS cs FROM c)
  SELECT k AS event_type, round(p, 6) AS period, round((ss * yc * yc + cc * ys * ys - 2 * cs * yc * ys) / (yy * (cc * ss - cs * cs)), 7) AS power FROM e""")
def floating_mean_periods(spark, d):
    """The power over 1,024 logarithmic periods with a mean that is fitted along, by weights 1 / (sigma^2 + 0.01)."""
    rows = table(spark, d, "events").select("event_type", (F.col("event_id") / 10.0).alias("t"), F.col("value").alias("y"), (1 / (F.pow(1 + F.col("event_id") % 5, F.lit(2)) + 0.01)).alias("w"))
    out = periods.floating_mean(rows, ["event_type"], "t", "y", "w", periods.logarithmic(5.0, 45.0))
    return _rounded(_rounded(out, 6, "period"), 7, "power")
