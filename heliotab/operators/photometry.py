"""Reduction of images (rows of by, x, y, v), and light inside apertures, rings and contours."""

import math

from pyspark.sql import DataFrame, Window, functions as F

from heliotab.operators import images, ranks
from heliotab.operators.graphs import components


def overscan_subtracted(df: DataFrame, by: list[str], first: int, last: int, axis: str = "y") -> DataFrame:
    """Each row (axis y) or column (axis x) less the median of its overscan, which lies from `first` to `last` along the other axis and goes."""
    other = "x" if axis == "y" else "y"
    level = ranks.quantiles(df.where(F.col(other).between(first, last)), [*by, axis], "v", {"_level": 0.5})
    rest = df.where(~F.col(other).between(first, last))
    return ranks.join_groups(rest, level, [*by, axis], "left").withColumn("v", F.col("v") - F.coalesce("_level", F.lit(0.0))).drop("_level")


def mended(df: DataFrame, by: list[str], bad) -> DataFrame:
    """Pixels for which `bad` holds become the mean of their good neighbours of eight; without any, they are left as they are."""
    marked = df.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j])
    sent = marked.where("NOT _bad").select(*by, "v", (F.col("x")).alias("_x"), F.col("y").alias("_y"), F.explode(steps).alias("_p"))
    means = sent.groupBy(*by, (F.col("_x") + F.col("_p.i")).alias("x"), (F.col("_y") + F.col("_p.j")).alias("y")).agg(F.avg("v").alias("_mean"))
    both = ranks.join_groups(marked, means, [*by, "x", "y"], "left")
    return both.withColumn("v", F.when(F.col("_bad"), F.coalesce("_mean", "v")).otherwise(F.col("v"))).drop("_bad", "_mean")


def level_columns(df: DataFrame, by: list[str], limit: float, axis: str = "x") -> DataFrame:
    """Columns (axis x) or rows whose median departs by more than `limit` from the mean of its two neighbours' medians are shifted to that mean."""
    medians = ranks.quantiles(df, [*by, axis], "v", {"_m": 0.5})
    w = Window.partitionBy(*by).orderBy(axis)
    both = (F.lag("_m").over(w) + F.lead("_m").over(w)) / 2
    off = medians.withColumn("_off", F.col("_m") - both).select(*by, axis, F.when(F.abs(F.col("_off")) > limit, F.col("_off")).otherwise(0.0).alias("_off"))
    return ranks.join_groups(df, off, [*by, axis], "left").withColumn("v", F.col("v") - F.coalesce("_off", F.lit(0.0))).drop("_off")


def median_map(df: DataFrame, by: list[str], nx: int, ny: int) -> DataFrame:
    """(by, x, y, median) of cells of nx by ny pixels."""
    cell = lambda c, n: F.floor(F.col(c) / n).cast("int")
    return ranks.quantiles(df.withColumn("x", cell("x", nx)).withColumn("y", cell("y", ny)), [*by, "x", "y"], "v", {"median": 0.5})


def gaussian_image(spark, nx: int, ny: int, x0: float, y0: float, sigma: float, height: float = 1.0) -> DataFrame:
    r2 = F.pow(F.col("x") - x0, F.lit(2.0)) + F.pow(F.col("y") - y0, F.lit(2.0))
    return images.create(spark, nx, ny).select("x", "y", (height * F.exp(-r2 / (2 * sigma * sigma))).alias("v"))


def sersic_image(spark, nx: int, ny: int, x0: float, y0: float, radius: float, index: float, height: float = 1.0, parts: int = 1) -> DataFrame:
    """height * exp(-b (r / radius)^(1 / index)) with b = 2 index - 1/3, averaged over parts by parts points of each pixel."""
    step = F.array(*[F.lit((k + 0.5) / parts - 0.5) for k in range(parts)])
    points = images.create(spark, nx, ny).select("x", "y", F.explode(step).alias("_i")).withColumn("_j", F.explode(step))
    r = F.hypot(F.col("x") + F.col("_i") - x0, F.col("y") + F.col("_j") - y0)
    return points.groupBy("x", "y").agg(F.avg(height * F.exp(-(2 * index - 1 / 3) * F.pow(r / radius, F.lit(1 / index)))).alias("v"))


def _radius(x0: float, y0: float, ratio: float, degrees: float):
    a = math.radians(degrees)
    dx, dy = F.col("x") - x0, F.col("y") - y0
    return F.hypot(dx * math.cos(a) + dy * math.sin(a), (dy * math.cos(a) - dx * math.sin(a)) / ratio)


def radial_profile(df: DataFrame, by: list[str], x0: float, y0: float, delta: float = 1.0, ratio: float = 1.0, degrees: float = 0.0) -> DataFrame:
    """(by, ring, n, flux, mean, inside, inside_n) by rings of elliptical radius: of each ring, and summed from the centre through it."""
    ring = F.floor(_radius(x0, y0, ratio, degrees) / delta).cast("int")
    rings = df.where(~F.isnan("v")).groupBy(*by, ring.alias("ring")).agg(F.count("*").alias("n"), F.sum("v").alias("flux"), F.avg("v").alias("mean"))
    w = Window.partitionBy(*by).orderBy("ring")
    return rings.withColumn("inside", F.sum("flux").over(w)).withColumn("inside_n", F.sum("n").over(w))


def petrosian(profile: DataFrame, by: list[str], ratio: float = 0.2) -> DataFrame:
    """(by, ring, inside): the first ring whose mean falls below `ratio` times the mean inside, and the flux inside."""
    low = profile.where(F.col("mean") < ratio * F.col("inside") / F.col("inside_n"))
    return low.groupBy(*by).agg(F.min(F.struct("ring", "inside")).alias("_m")).select(*by, "_m.ring", "_m.inside")


def kron(df: DataFrame, by: list[str], x0: float, y0: float, limit: float, scale: float = 2.5) -> DataFrame:
    """(by, radius, flux): the mean radius of light within the limit, and the flux within `scale` times it."""
    r = F.hypot(F.col("x") - x0, F.col("y") - y0)
    first = df.where(r < limit).groupBy(*by).agg((F.sum(r * F.col("v")) / F.sum("v")).alias("radius"))
    held = ranks.join_groups(df, first, by).where(r < scale * F.col("radius"))
    return held.groupBy(*by, "radius").agg(F.sum("v").alias("flux"))


def sectors(df: DataFrame, by: list[str], x0: float, y0: float, count: int, delta: float) -> DataFrame:
    """(by, sector, ring, n, mean): rings cut into `count` equal angles, from the x axis on."""
    angle = F.pmod(F.degrees(F.atan2(F.col("y") - y0, F.col("x") - x0)), F.lit(360.0))
    ring = F.floor(F.hypot(F.col("x") - x0, F.col("y") - y0) / delta).cast("int")
    return df.groupBy(*by, F.least(F.floor(angle * count / 360), F.lit(count - 1)).cast("int").alias("sector"), ring.alias("ring")).agg(F.count("*").alias("n"), F.avg("v").alias("mean"))


def apertures(positions: DataFrame, df: DataFrame, by: list[str], key: str, radius: float, inner: float, outer: float) -> DataFrame:
    """(by, key, n, flux, sky): the pixels within a radius of each position (by, key, x, y), less the sky, the median of a ring around it. A position is sent to the pixels around it, so the join is one of equal pixels."""
    reach = math.ceil(outer)
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    sent = positions.select(*by, key, F.col("x").alias("_x0"), F.col("y").alias("_y0"), F.explode(steps).alias("_i")).withColumn("_j", F.explode(steps))
    place = lambda c, k: (F.floor(F.col(c) + 0.5) + F.col(k)).cast("int")
    near = sent.withColumn("x", place("_x0", "_i")).withColumn("y", place("_y0", "_j")).join(df, [*by, "x", "y"])
    near = near.withColumn("_r", F.hypot(F.col("x") - F.col("_x0"), F.col("y") - F.col("_y0")))
    group = [*by, key]
    level = ranks.quantiles(near.where((F.col("_r") >= inner) & (F.col("_r") < outer)), group, "v", {"sky": 0.5})
    sums = near.where(F.col("_r") <= radius).groupBy(*group).agg(F.count("*").alias("n"), F.sum("v").alias("_s"))
    both = ranks.join_groups(sums, level, group, "left")
    return both.select(*group, "n", (F.col("_s") - F.col("n") * F.coalesce("sky", F.lit(0.0))).alias("flux"), "sky")


def moments(df: DataFrame, by: list[str]) -> DataFrame:
    """(by, flux, x, y, xx, xy, yy, major, minor, angle): centre and second moments of the light, and the axes and angle (degrees) of the ellipse that has them."""
    v, x, y = F.col("v"), F.col("x"), F.col("y")
    s = df.groupBy(*by).agg(F.sum(v).alias("flux"), (F.sum(v * x) / F.sum(v)).alias("x"), (F.sum(v * y) / F.sum(v)).alias("y"), (F.sum(v * x * x) / F.sum(v)).alias("_xx"), (F.sum(v * x * y) / F.sum(v)).alias("_xy"), (F.sum(v * y * y) / F.sum(v)).alias("_yy"))
    s = s.select(*by, "flux", "x", "y", (F.col("_xx") - x * x).alias("xx"), (F.col("_xy") - x * y).alias("xy"), (F.col("_yy") - y * y).alias("yy"))
    half, root = (F.col("xx") + F.col("yy")) / 2, F.sqrt(F.pow((F.col("xx") - F.col("yy")) / 2, F.lit(2.0)) + F.col("xy") * F.col("xy"))
    return s.withColumn("major", F.sqrt(half + root)).withColumn("minor", F.sqrt(F.greatest(half - root, F.lit(0.0)))).withColumn("angle", F.degrees(F.atan2(2 * F.col("xy"), F.col("xx") - F.col("yy"))) / 2)


def contour_flux(df: DataFrame, by: list[str], corners: list[tuple[float, float]]) -> DataFrame:
    """(by, n, flux) of the pixels inside a convex contour whose corners go round against the clock; borders count."""
    inside = F.lit(True)
    for (ax, ay), (bx, by_) in zip(corners, corners[1:] + corners[:1]):
        inside = inside & ((bx - ax) * (F.col("y") - ay) - (by_ - ay) * (F.col("x") - ax) >= 0)
    return df.where(inside).groupBy(*by).agg(F.count("*").alias("n"), F.sum("v").alias("flux"))


def detections(df: DataFrame, by: str, least: float, nx: int, ny: int) -> DataFrame:
    """(by, root, n, flux, peak): groups of pixels from `least` on that touch along x, along y or at corners; root: the number of the group's first pixel. Images have at most nx by ny pixels, and `by` is a number of the image from 0 on."""
    bright = df.where(F.col("v") >= least).select(by, "x", "y", "v", ((F.col(by).cast("bigint") * ny + F.col("y")) * nx + F.col("x")).alias("node"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((1, 0), (0, 1), (1, 1), (-1, 1))])
    sent = bright.select(by, F.col("node").alias("a"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.explode(steps).alias("_p"))
    edges = sent.select(by, "a", (F.col("_x") + F.col("_p.i")).alias("x"), (F.col("_y") + F.col("_p.j")).alias("y")).join(bright.select(by, "x", "y", F.col("node").alias("b")), [by, "x", "y"]).select("a", "b")
    roots = components(edges)
    found = bright.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return found.groupBy(by, "root").agg(F.count("*").alias("n"), F.sum("v").alias("flux"), F.max("v").alias("peak"))


def affine(df: DataFrame, by: list[str], a: float, b: float, c: float, d: float, x0: float, y0: float) -> DataFrame:
    """Pixels at (a x + b y + x0, c x + d y + y0), each to the nearest place; pixels that meet are averaged."""
    x, y = F.col("x"), F.col("y")
    return df.groupBy(*by, F.floor(a * x + b * y + x0 + 0.5).cast("int").alias("_x"), F.floor(c * x + d * y + y0 + 0.5).cast("int").alias("_y")).agg(F.avg("v").alias("v")).select(*by, F.col("_x").alias("x"), F.col("_y").alias("y"), "v")


def spectrum(df: DataFrame, by: list[str], slope: float, offset: float, half: float) -> DataFrame:
    """(by, x, flux) along a straight trace y = slope x + offset: the pixels within `half` of it, summed across."""
    return df.where(F.abs(F.col("y") - (slope * F.col("x") + offset)) <= half).groupBy(*by, "x").agg(F.sum("v").alias("flux"))


def spectrum_scale(first: DataFrame, second: DataFrame, by: list[str], on: list[str], flux: str) -> DataFrame:
    """(by, n, scale, offset): for each group of the first, the line that takes the second spectrum to it, by least squares over the columns in `on` that both have."""
    both = first.select(*{*by, *on}, F.col(flux).alias("_y")).join(second.select(*on, F.col(flux).alias("_x")), on)
    return both.groupBy(*by).agg(F.count("*").alias("n"), F.regr_slope("_y", "_x").alias("scale"), F.regr_intercept("_y", "_x").alias("offset"))
