"""Maps of images and positions of objects that fit each other, over measures made of events: twelve images with planted offsets, turns and scales, a fiftieth of the measures far off, a tenth of the objects known."""

from pyspark.sql import functions as F

from heliotab.operators import astrometry, sparse
from heliotab.plans.registry import query, table

_X, _Y = "(user_id * 37 % 1000) / 10.0", "(user_id * 91 % 1000) / 10.0"
_NOISE = "(value - floor(value) - 0.5) * 0.02"
_MEASURES = f"""SELECT event_id % 12 AS image, user_id AS object, 1.0 + event_id % 3 AS w,
  {_X} * (1 + 0.0001 * (event_id % 12)) - 0.3 * (event_id % 5) + 0.001 * (event_id % 12) * {_Y} + {_NOISE} + CASE WHEN event_id % 50 = 7 THEN 5 ELSE 0 END AS x,
  {_Y} * (1 - 0.0002 * (event_id % 12)) + 0.2 * (event_id % 4) - 0.001 * (event_id % 12) * {_X} - {_NOISE} AS y FROM {{events}}"""
_REFERENCE = f"SELECT DISTINCT user_id AS object, {_X} AS x, {_Y} AS y FROM {{events}} WHERE user_id % 10 = 0"


def _tables(spark, d):
    events = table(spark, d, "events")
    return spark.sql(_MEASURES.replace("10.0", "10D").replace("event_id % 3 AS w", "CAST(event_id % 3 AS DOUBLE) AS w"), events=events), spark.sql(_REFERENCE.replace("10.0", "10D"), events=events)


def _passes(n: int, out: str) -> str:
    """n turns of maps of first order and positions, written out."""
    q = [f"WITH m AS MATERIALIZED (SELECT image, object, w::DOUBLE AS w, x::DOUBLE AS x, y::DOUBLE AS y FROM ({_MEASURES.format(events='events')})), ref AS ({_REFERENCE.format(events='events')})"]
    q.append("p0 AS MATERIALIZED (SELECT object, coalesce(any_value(ref.x::DOUBLE), avg(m.x)) AS px, coalesce(any_value(ref.y::DOUBLE), avg(m.y)) AS py, any_value(ref.x) IS NOT NULL AS fixed, 0 AS n FROM m LEFT JOIN ref USING (object) GROUP BY object)")
    q.append("a0 AS MATERIALIZED (SELECT DISTINCT image, 0.0::DOUBLE AS x0, 1.0::DOUBLE AS x1, 0.0::DOUBLE AS x2, 0.0::DOUBLE AS y0, 0.0::DOUBLE AS y1, 1.0::DOUBLE AS y2, NULL::DOUBLE AS s, 0 AS n FROM m)")
    rows = "SELECT m.*, px - (x0 + x1 * x + x2 * y) AS dx, py - (y0 + y1 * x + y2 * y) AS dy, x0 + x1 * x + x2 * y AS mx, y0 + y1 * x + y2 * y AS my, s FROM m JOIN a{a} USING (image) JOIN p{p} USING (object)"
    near = "s IS NULL OR sqrt(dx * dx + dy * dy) <= 3 * s"
    det = "(s0 * (s3 * s5 - s4 * s4) - s1 * (s1 * s5 - s4 * s2) + s2 * (s1 * s4 - s3 * s2))"
    for k in range(1, n + 1):
        sums = "sum(w) AS s0, sum(w * x) AS s1, sum(w * y) AS s2, sum(w * x * x) AS s3, sum(w * x * y) AS s4, sum(w * y * y) AS s5, sum(w * (dx * dx + dy * dy)) AS sdd, count(*) AS n, " + ", ".join(f"sum(w * d{c}) AS {c}t0, sum(w * d{c} * x) AS {c}t1, sum(w * d{c} * y) AS {c}t2" for c in "xy")
        q.append(f"f{k} AS MATERIALIZED (SELECT image, {sums} FROM ({rows.format(a=k - 1, p=k - 1)}) WHERE {near} GROUP BY image)")
        c = {}
        for a in "xy":
            t = [f"{a}t{i}" for i in range(3)]
            c[a] = [f"({t[0]} * (s3 * s5 - s4 * s4) + {t[1]} * (s2 * s4 - s1 * s5) + {t[2]} * (s1 * s4 - s2 * s3)) / {det}", f"({t[0]} * (s2 * s4 - s1 * s5) + {t[1]} * (s0 * s5 - s2 * s2) + {t[2]} * (s1 * s2 - s0 * s4)) / {det}", f"({t[0]} * (s1 * s4 - s3 * s2) + {t[1]} * (s2 * s1 - s0 * s4) + {t[2]} * (s0 * s3 - s1 * s1)) / {det}"]
        left = "sdd - " + " - ".join(f"c{a}{i} * {a}t{i}" for a in "xy" for i in range(3))
        q.append(f"c{k} AS (SELECT *, " + ", ".join(f"{c[a][i]} AS c{a}{i}" for a in "xy" for i in range(3)) + f" FROM f{k})")
        q.append(f"a{k} AS MATERIALIZED (SELECT image, " + ", ".join(f"a.{a}{i} + c{a}{i} AS {a}{i}" for a in "xy" for i in range(3)) + f", sqrt(greatest({left}, 0) / s0) AS s, c.n FROM a{k - 1} a JOIN c{k} c USING (image))")
        q.append(f"q{k} AS (SELECT object, sum(w * mx) / sum(w) AS nx, sum(w * my) / sum(w) AS ny, count(*) AS n FROM ({rows.format(a=k, p=k - 1)}) WHERE {near} GROUP BY object)")
        q.append(f"p{k} AS MATERIALIZED (SELECT object, CASE WHEN fixed THEN px ELSE coalesce(nx, px) END AS px, CASE WHEN fixed THEN py ELSE coalesce(ny, py) END AS py, fixed, coalesce(q.n, 0) AS n FROM p{k - 1} LEFT JOIN q{k} q USING (object))")
    return ", ".join(q) + " " + out


@query(_passes(3, "SELECT image, n, round(x0, 5) AS x0, round(x1, 7) AS x1, round(x2, 7) AS x2, round(y0, 5) AS y0, round(y1, 7) AS y1, round(y2, 7) AS y2, round(s, 6) AS s FROM a3"))
def astrometric_maps(spark, d):
    """The map of each image after three turns."""
    maps, _ = astrometry.calibrate(*_tables(spark, d), passes=3, tolerance=0.0)
    return maps.select("image", "n", *[F.round(F.get(f"a{c}", F.lit(i)), 7 if i else 5).alias(f"{c}{i}") for c in "xy" for i in range(3)], F.round("s", 6).alias("s"))


@query(_passes(3, "SELECT object, n, fixed, round(px, 5) AS px, round(py, 5) AS py FROM p3"))
def astrometric_positions(spark, d):
    """The position of each object after three turns."""
    _, positions = astrometry.calibrate(*_tables(spark, d), passes=3, tolerance=0.0)
    return positions.select("object", "n", "fixed", F.round("px", 5).alias("px"), F.round("py", 5).alias("py"))


_SIDES = f"""WITH m AS ({_MEASURES.format(events='events')}), ref AS ({_REFERENCE.format(events='events')}), r AS (SELECT m.*, ref.x AS fx, ref.y AS fy FROM m LEFT JOIN ref USING (object)),
  s AS (SELECT 0 AS k, 2 * image AS row, w * (coalesce(fx, 0) - x) AS v FROM r UNION ALL SELECT 1, 2 * image, w * (coalesce(fy, 0) - y) FROM r UNION ALL SELECT 0, 2 * object + 1, w * x FROM r WHERE fx IS NULL UNION ALL SELECT 1, 2 * object + 1, w * y FROM r WHERE fx IS NULL)
  SELECT k, row, round(sum(v::DOUBLE), 3) + 0.0 AS value FROM s GROUP BY k, row"""


@query(_SIDES)
def joint_offsets(spark, d):
    """Shifts of images and positions of objects solved at once by conjugate gradients: the sparse matrix times the solution, which must be the right side."""
    matrix, sides = astrometry.offset_equations(*_tables(spark, d))
    solved = sparse.conjugate_gradients(matrix, sides, tolerance=1e-11)
    return sparse.product(matrix, solved).select("k", "row", (F.round("value", 3) + 0.0).alias("value"))
