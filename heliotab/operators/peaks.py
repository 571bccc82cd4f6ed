"""Peaks inside footprints, culled by the saddles between them: the merge tree of an image of any size, by joins of equal places."""

from pyspark.sql import DataFrame, functions as F

from heliotab.operators.store import written


def _roots(steps: DataFrame) -> DataFrame:
    """(node, to): each node's last node along the steps (node, to); a node that isn't in the steps is a last one. Steps are doubled, so the rounds are the logarithm of the longest way."""
    steps = written(steps.select("node", "to"))
    while True:
        on = steps.select(F.col("node").alias("to"), F.col("to").alias("_on"))
        new = written(steps.join(on, "to", "left").select("node", F.coalesce("_on", "to").alias("to"), F.col("_on").isNotNull().alias("_moved")))
        steps = new.select("node", "to")
        if not new.where("_moved").limit(1).count():
            return steps


def merge_tree(df: DataFrame, by: str, least: float, nx: int, ny: int) -> DataFrame:
    """(by, x, y, v, peak, saddle, into): the peaks of the pixels from `least` on; saddle: the highest level at which one can walk from the peak, to neighbours along axes or at corners, to a higher peak, and into: a higher peak met there. Both are null for the highest peak of a footprint. Of equal values the pixel of the lower number is the higher; NaN and null aren't pixels. Images have at most nx by ny pixels, and `by` is a number of the image from 0 on.

    Each pixel steps to its highest neighbour until it is at a peak; pixels at peaks of different pixels give the saddle between two, combined before the shuffle. Then each round takes every peak whose highest saddle leads to a higher peak into that one: no way out of it is higher, so this is its saddle. Every round merges at least the highest saddle of each footprint; the rounds are few unless the peaks rise in order of their saddles.
    """
    number = (F.col(by).cast("bigint") * ny + F.col("y")) * nx + F.col("x")
    bright = written(df.where((F.col("v") >= least) & ~F.isnan("v")).select(by, "x", "y", "v", number.alias("node")))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((1, 0), (0, 1), (1, 1), (-1, 1))])
    sent = bright.select(by, F.col("node").alias("a"), F.col("v").alias("va"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.explode(steps).alias("_p"))
    edges = sent.select(by, "a", "va", (F.col("_x") + F.col("_p.i")).alias("x"), (F.col("_y") + F.col("_p.j")).alias("y")).join(bright.select(by, "x", "y", F.col("node").alias("b"), F.col("v").alias("vb")), [by, "x", "y"]).select("a", "va", "b", "vb")
    edges = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("vb").alias("va"), F.col("a").alias("b"), F.col("va").alias("vb"))))

    rank = lambda v, node: F.struct(F.col(v).alias("v"), (-F.col(node)).alias("n"))
    climbing = written(edges.where(rank("vb", "b") > rank("va", "a")).groupBy("a").agg(F.max(rank("vb", "b")).alias("_m")).select(F.col("a").alias("node"), (-F.col("_m.n")).alias("to")))
    basins = _roots(climbing)

    at = lambda c, p: basins.select(F.col("node").alias(c), F.col("to").alias(p))
    borders = edges.join(at("a", "p"), "a", "left").join(at("b", "q"), "b", "left").select(F.coalesce("p", "a").alias("p"), F.coalesce("q", "b").alias("q"), F.least("va", "vb").alias("s"))
    height = bright.select("node", "v")
    links = borders.where("p <> q").groupBy("p", "q").agg(F.max("s").alias("s"))
    for c in ("p", "q"):
        links = links.join(height.select(F.col("node").alias(c), F.col("v").alias(f"v{c}")), c)
    links = written(links.select("p", "vp", "q", "vq", "s"))

    merged = None
    while True:
        best = links.groupBy("p", "vp").agg(F.max(F.struct("s", F.col("vq").alias("v"), (-F.col("q")).alias("n"))).alias("_m"))
        down = written(best.where(F.struct("_m.v", "_m.n") > rank("vp", "p")).select(F.col("p").alias("node"), F.col("_m.s").alias("saddle"), (-F.col("_m.n")).alias("to"), F.col("_m.v").alias("_v")))
        if not down.limit(1).count():
            break
        found = down.select("node", "saddle", F.col("to").alias("into"))
        merged = found if merged is None else merged.unionByName(found)
        ends = _roots(down)
        ends = written(ends.join(height.select(F.col("node").alias("to"), "v"), "to"))
        for c in ("p", "q"):
            end = ends.select(F.col("node").alias(c), F.col("to").alias("_to"), F.col("v").alias("_v"))
            links = links.join(end, c, "left").withColumn(c, F.coalesce("_to", c)).withColumn(f"v{c}", F.coalesce("_v", f"v{c}")).drop("_to", "_v")
        links = written(links.where("p <> q").groupBy("p", "vp", "q", "vq").agg(F.max("s").alias("s")).select("p", "vp", "q", "vq", "s"))

    tops = bright.join(climbing.select("node"), "node", "left_anti")
    if merged is None:
        merged = down.select("node", "saddle", F.col("to").alias("into"))
    return tops.join(merged, "node", "left").select(by, "x", "y", "v", F.col("node").alias("peak"), "saddle", "into")


def culled(tree: DataFrame, sigma, sigmas: float, padding: float = 0.0, lowest: float = float("-inf"), highest: float = float("inf")) -> DataFrame:
    """The peaks of a merge tree that rise enough above their saddles: a peak goes if a higher one is met at or above v - sigmas * hypot(sigma, padding * v), a level that is held between lowest and highest. sigma: a column expression, such as the root of v; null or NaN keeps the peak, and so does a peak's being the highest of its footprint."""
    level = F.greatest(F.lit(lowest), F.least(F.lit(highest), F.col("v") - sigmas * F.hypot(sigma, padding * F.col("v"))))
    return tree.where(F.col("saddle").isNull() | sigma.isNull() | F.isnan(sigma) | (F.col("saddle") < level))
