"""Blind matches of star lists: the turn, scale and shift between an image's stars and those of a reference, found by votes."""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from heliotab.operators.store import written


def _brightest(stars: DataFrame, first: int, last: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("image").orderBy("mag", "id"))
    return stars.withColumn("_r", rank).where((F.col("_r") <= last) & (F.col("_r") > first)).drop("_r")


def _sums(pairs: DataFrame) -> DataFrame:
    """The similarity of least squares for each image's pairs (x, y, u, v): u = a x - b y + p, v = b x + a y + q, and n."""
    c = F.col
    s = pairs.groupBy("image").agg(F.count("*").alias("n"), *[F.avg(k).alias(k) for k in ("x", "y", "u", "v")], F.avg(c("x") * c("u") + c("y") * c("v")).alias("dot"), F.avg(c("x") * c("v") - c("y") * c("u")).alias("cross"), F.avg(c("x") * c("x") + c("y") * c("y")).alias("size"))
    spread = c("size") - c("x") * c("x") - c("y") * c("y")
    s = s.where(spread > 0).withColumn("a", (c("dot") - c("x") * c("u") - c("y") * c("v")) / spread).withColumn("b", (c("cross") - c("x") * c("v") + c("y") * c("u")) / spread)
    return s.select("image", "n", "a", "b", (c("u") - c("a") * c("x") + c("b") * c("y")).alias("p"), (c("v") - c("b") * c("x") - c("a") * c("y")).alias("q"))


def _moved(x: str, y: str) -> tuple[Column, Column]:
    return F.col("a") * F.col(x) - F.col("b") * F.col(y) + F.col("p"), F.col("b") * F.col(x) + F.col("a") * F.col(y) + F.col("q")


def _voted(stars: DataFrame, reference: DataFrame, turns: list[float], scales: list[float], bin_: float) -> DataFrame:
    """(image, a, b, p, q, n): for each image the turn, scale and shift with the most votes, made better by the pairs that voted for them. Each pair votes, for each trial turn and scale, for the four overlapping cells of twice the bin that hold its shift, so that no peak falls on an edge."""
    c = F.col
    trials = F.array(*[F.struct(F.lit(s * math.cos(t)).alias("a"), F.lit(s * math.sin(t)).alias("b")) for t in turns for s in scales])
    ref = reference.select("image", c("id").alias("ref"), c("x").alias("u"), c("y").alias("v"))
    pairs = stars.select("image", "id", "x", "y").join(ref, "image").withColumn("t", F.explode(trials)).select("*", "t.a", "t.b").drop("t")
    pairs = pairs.withColumn("dx", c("u") - c("a") * c("x") + c("b") * c("y")).withColumn("dy", c("v") - c("b") * c("x") - c("a") * c("y"))
    cells = F.array(*[F.struct((F.floor(c("dx") / bin_) - i).alias("i"), (F.floor(c("dy") / bin_) - j).alias("j")) for i in (0, 1) for j in (0, 1)])
    votes = pairs.withColumn("c", F.explode(cells)).groupBy("image", "a", "b", "c").agg(F.count("*").alias("votes"))
    best = votes.groupBy("image").agg(F.min(F.struct(-c("votes"), "b", "a", "c")).alias("m")).select("image", c("m.a").alias("a"), c("m.b").alias("b"), c("m.c").alias("c"))
    inside = (c("dx") >= c("c.i") * bin_) & (c("dx") < (c("c.i") + 2) * bin_) & (c("dy") >= c("c.j") * bin_) & (c("dy") < (c("c.j") + 2) * bin_)
    return _sums(pairs.join(best, ["image", "a", "b"]).where(inside))


def nearest(stars: DataFrame, reference: DataFrame, maps: DataFrame, reach: float) -> DataFrame:
    """(image, id, x, y, ref, u, v, off): for each star, moved by its image's map, the nearest star of the reference within reach, by cells; of equals the least id. Cells are first so small that the densest image has about four stars in reach, were they spread evenly; stars that find none go on with three times that, up to the reach, so a dense field makes no more pairs a star than a sparse one. Runs jobs while the plan is built."""
    c = F.col
    u, v = _moved("x", "y")
    rest = stars.join(maps.select("image", "a", "b", "p", "q"), "image").withColumn("mu", u).withColumn("mv", v).select("image", "id", "x", "y", "mu", "mv")
    area = (F.max("x") - F.min("x")) * (F.max("y") - F.min("y"))
    each = reference.groupBy("image").agg(F.count("*").alias("n"), area.alias("area")).where("area > 0").agg(F.min(c("area") / c("n"))).first()[0]
    radius = min(reach, math.sqrt(4 * each / math.pi)) if each else reach
    found = []
    while True:
        size = radius * 1.0001
        near = F.array(*[F.struct((F.floor(c("mu") / size) + i).alias("i"), (F.floor(c("mv") / size) + j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
        own = rest.withColumn("c", F.explode(near))
        ref = reference.select("image", c("id").alias("ref"), c("x").alias("u"), c("y").alias("v"), F.struct(F.floor(c("x") / size).alias("i"), F.floor(c("y") / size).alias("j")).alias("c"))
        met = own.join(ref.hint("merge"), ["image", "c"]).withColumn("off", F.hypot(c("mu") - c("u"), c("mv") - c("v"))).where(c("off") <= radius)
        best = met.groupBy("image", "id", "x", "y").agg(F.min(F.struct("off", "ref", "u", "v")).alias("m")).select("image", "id", "x", "y", "m.ref", "m.u", "m.v", "m.off")
        if radius >= reach:
            return reduce(DataFrame.unionByName, [*found, best])
        found.append(written(best))
        rest = written(rest.join(found[-1].select("image", "id").hint("merge"), ["image", "id"], "left_anti"))
        radius = min(3 * radius, reach)


def match(stars: DataFrame, reference: DataFrame, *, turn: float = 5.0, step: float = 1.0, scales: tuple[float, ...] = (1.0,), bin_: float = 5.0, reach: float = 1.0, brightest: int = 30, share: float = 0.5, widest: int = 480) -> DataFrame:
    """(image, a, b, p, q, n, used): for each image the map u = a x - b y + p, v = b x + a y + q of its stars (image, id, x, y, mag) to those of the reference with the same image, the stars that it brings within reach of one, and the brightest stars that voted.

    Pairs are made between the `brightest` stars of both lists alone, and vote for shifts in bins at each turn, in degrees from -turn to turn by steps, and scale. The winner is fitted to its voters, then twice to all stars within reach of their nearest ones (three times the bin at first), which verifies it. An image in which fewer than `share` of its stars, or of the reference's, if these are fewer, come within reach is tried again with twice as many, up to `widest` or all. Images that never come so far have their best map with its n. Rows with nulls are left out; images without stars, or without a reference, give no row. Magnitudes rise to the faint; equal ones go by id.
    """
    turns = [math.radians(-turn + i * step) for i in range(round(2 * turn / step) + 1)]
    stars, reference = (written(df.select("image", "id", *[F.col(k).cast("double").alias(k) for k in ("x", "y", "mag")]).dropna()) for df in (stars, reference))
    sizes = stars.groupBy("image").agg(F.count("*").alias("stars")).join(reference.groupBy("image").agg(F.count("*").alias("refs")), "image")
    left, done, k = written(sizes), None, brightest
    while True:
        own = stars.join(left.select("image"), "image", "left_semi")
        maps = _voted(_brightest(own, 0, k), _brightest(reference.join(left.select("image"), "image", "left_semi"), 0, k), turns, list(scales), bin_)
        for wide in (3 * bin_, reach):
            maps = written(_sums(nearest(own, reference, maps, wide)))
        n = nearest(own, reference, maps, reach).groupBy("image").agg(F.count("*").alias("n"))
        new = written(left.join(maps.drop("n"), "image").join(n, "image", "left").withColumn("n", F.coalesce("n", F.lit(0))).withColumn("used", F.lit(k)))
        good = F.col("n") >= share * F.least("stars", "refs")
        ended = new if k >= widest else new.where(good | (F.greatest("stars", "refs") <= k))
        done = ended if done is None else done.unionByName(ended)
        left = written(left.join(ended.select("image"), "image", "left_anti"))
        if k >= widest or not left.limit(1).count():
            return done.select("image", "a", "b", "p", "q", "n", "used")
        k *= 2
