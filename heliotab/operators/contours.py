"""Iso-contours: segments of marching squares, joined to rings by pointer doubling, and the ellipses that rings amount to."""

from pyspark.sql import Column, DataFrame, functions as F

from heliotab.operators.graphs import components
from heliotab.operators.store import written


def segments(df: DataFrame, by: str, level: float, nx: int, ny: int) -> DataFrame:
    """(by, a, ax, ay, b, bx, b_y): the pieces of the contour in each cell between four pixels (by, x, y, v), from place a to place b with the pixels at or above the level on the left. a and b are numbers of the edges between neighbouring pixels, which neighbouring cells share.

    Where opposite corners of a cell are high, the mean of the four says whether they are joined. Cells without all four pixels, NaN counted as missing, have none, so contours end there. Images have at most nx by ny pixels, from 0 on, and `by` is a number of the image from 0 on. Each pixel is sent to its four cells and combined before the shuffle.
    """
    corners = ((0, 0), (1, 0), (1, 1), (0, 1))
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for k, (i, j) in enumerate(corners)])
    sent = df.where(~F.isnan("v")).select(by, "x", "y", "v", F.explode(around).alias("_p"))
    cells = sent.groupBy(by, (F.col("x") - F.col("_p.i")).alias("x"), (F.col("y") - F.col("_p.j")).alias("y")).agg(*[F.max(F.when(F.col("_p.k") == k, F.col("v"))).alias(f"v{k}") for k in range(4)])
    high = [F.col(f"v{k}") >= level for k in range(4)]
    mixed = cells.where(~(high[0] & high[1] & high[2] & high[3]) & (high[0] | high[1] | high[2] | high[3]) & (F.col("v0") + F.col("v1") + F.col("v2") + F.col("v3")).isNotNull())
    x, y = F.col("x").cast("bigint"), F.col("y").cast("bigint")

    def place(edge: int) -> Column:
        low, up = ((0, 1), (1, 2), (3, 2), (0, 3))[edge]
        i, j = corners[low]
        part = (F.lit(float(level)) - F.col(f"v{low}")) / (F.col(f"v{up}") - F.col(f"v{low}"))
        upright = edge % 2
        number = (((F.col(by).cast("bigint") * ny + y + j) * nx + x + i) * 2 + upright).alias("n")
        return F.struct(number, (x + i + (F.lit(0.0) if upright else part)).alias("x"), (y + j + (part if upright else F.lit(0.0))).alias("y"))

    leaves = [~high[e] & high[(e + 1) % 4] for e in range(4)]
    joined = (F.col("v0") + F.col("v1") + F.col("v2") + F.col("v3")) / 4 >= level
    pieces = []
    for e in range(4):
        onward, back = (F.coalesce(*[F.when(leaves[(e + k) % 4], place((e + k) % 4)) for k in ways]) for ways in ((1, 2, 3), (3, 2, 1)))
        pieces.append(F.when(high[e] & ~high[(e + 1) % 4], F.struct(place(e).alias("a"), F.when(joined, onward).otherwise(back).alias("b"))))
    found = mixed.select(by, F.explode(F.array(*pieces)).alias("_s")).where("_s IS NOT NULL")
    return found.select(by, F.col("_s.a.n").alias("a"), F.col("_s.a.x").alias("ax"), F.col("_s.a.y").alias("ay"), F.col("_s.b.n").alias("b"), F.col("_s.b.x").alias("bx"), F.col("_s.b.y").alias("b_y"))


def labelled(pieces: DataFrame) -> DataFrame:
    """The pieces with the least number of a place on their contour as `ring`, and whether it closes. A contour closes if it has as many pieces as places."""
    pieces = written(pieces)
    roots = written(components(pieces.select("a", "b")))
    of_ring = pieces.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ring")), "a")
    sizes = of_ring.groupBy("ring").agg(F.count("*").alias("_pieces")).join(roots.groupBy(F.col("root").alias("ring")).agg(F.count("*").alias("_places")), "ring")
    return of_ring.join(sizes.select("ring", (F.col("_pieces") == F.col("_places")).alias("closed")), "ring")


def points(pieces: DataFrame, by: str) -> DataFrame:
    """(by, ring, ordinal, closed, x, y) of labelled pieces: the places along each contour, from 0 on; a ring begins at its least number, and its first place isn't repeated at the end.

    A ring is cut before its first place; each place then learns how far the end is, in steps that double, so there are as many rounds, each a join, as the logarithm of the longest contour.
    """
    pieces = written(pieces)
    places = pieces.select(by, "ring", "closed", F.col("a").alias("node"), F.col("ax").alias("x"), F.col("ay").alias("y")).unionByName(pieces.where("NOT closed").select(by, "ring", "closed", F.col("b").alias("node"), F.col("bx").alias("x"), F.col("b_y").alias("y")))
    places = places.groupBy(by, "ring", "closed", "node").agg(F.min("x").alias("x"), F.min("y").alias("y"))
    steps = pieces.select(F.col("a").alias("node"), F.when(~F.col("closed") | (F.col("b") != F.col("ring")), F.col("b")).alias("to"))
    steps = written(places.select("node").join(steps, "node", "left").select("node", "to", F.when(F.col("to").isNotNull(), 1).otherwise(0).cast("bigint").alias("d")))
    while steps.where("to IS NOT NULL").limit(1).count():
        on = steps.select(F.col("node").alias("to"), F.col("to").alias("_to"), F.col("d").alias("_d"))
        steps = written(steps.join(on, "to", "left").select("node", F.col("_to").alias("to"), (F.col("d") + F.coalesce("_d", F.lit(0))).alias("d")))
    sizes = places.groupBy("ring").agg(F.count("*").alias("_n"))
    return places.join(steps.select("node", "d"), "node").join(sizes, "ring").select(by, "ring", (F.col("_n") - 1 - F.col("d")).alias("ordinal"), "closed", "x", "y")


def ellipses(pieces: DataFrame, by: str, nx: int, ny: int) -> DataFrame:
    """(by, ring, n, area, x, y, major, minor, angle) of the closed contours among labelled pieces: the area (below zero around a hollow), its centre, and the semi-axes and angle (degrees) of the ellipse with the same second moments. They are sums over the pieces, combined before the shuffle, about the place that the ring's number names, so nothing cancels far from the origin. Rings without area have no centre."""
    x0, y0 = F.expr(f"(ring div 2) % {nx}"), F.expr(f"((ring div 2) div {nx}) % {ny}")
    ax, ay, bx, b_y = F.col("ax") - x0, F.col("ay") - y0, F.col("bx") - x0, F.col("b_y") - y0
    c = ax * b_y - bx * ay
    sums = pieces.where("closed").groupBy(by, "ring").agg(
        F.count("*").alias("n"),
        (F.sum(c) / 2).alias("area"),
        (F.sum(c * (ax + bx)) / 6).alias("_x"),
        (F.sum(c * (ay + b_y)) / 6).alias("_y"),
        (F.sum(c * (ax * ax + ax * bx + bx * bx)) / 12).alias("_xx"),
        (F.sum(c * (ay * ay + ay * b_y + b_y * b_y)) / 12).alias("_yy"),
        (F.sum(c * (ax * b_y + 2 * ax * ay + 2 * bx * b_y + bx * ay)) / 24).alias("_xy"),
    )
    of = lambda s: F.when(F.col("area") != 0, F.col(s) / F.col("area"))
    mx, my = of("_x"), of("_y")
    m = sums.select(by, "ring", "n", "area", (mx + x0).alias("x"), (my + y0).alias("y"), (of("_xx") - mx * mx).alias("_xx"), (of("_yy") - my * my).alias("_yy"), (of("_xy") - mx * my).alias("_xy"))
    half, root = (F.col("_xx") + F.col("_yy")) / 2, F.hypot((F.col("_xx") - F.col("_yy")) / 2, F.col("_xy"))
    return m.withColumn("major", 2 * F.sqrt(half + root)).withColumn("minor", 2 * F.sqrt(F.greatest(half - root, F.lit(0.0)))).withColumn("angle", F.degrees(F.atan2(2 * F.col("_xy"), F.col("_xx") - F.col("_yy"))) / 2).drop("_xx", "_yy", "_xy")
