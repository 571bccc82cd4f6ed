"""Images as rows (keys of the image, x, y, v): kernels, boxes and axes without a task that holds a whole image."""

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliotab.operators import ranks


def roll(df: DataFrame, dx: int, dy: int, nx: int, ny: int) -> DataFrame:
    """Pixels moved by (dx, dy), around the borders."""
    return df.withColumn("x", F.pmod(F.col("x") + dx, F.lit(nx))).withColumn("y", F.pmod(F.col("y") + dy, F.lit(ny)))


def zap(df: DataFrame, x: int, y: int, nx: int, ny: int, value: float = 0.0) -> DataFrame:
    """The box of nx by ny pixels from (x, y) on set to a value."""
    inside = F.col("x").between(x, x + nx - 1) & F.col("y").between(y, y + ny - 1)
    return df.withColumn("v", F.when(inside, F.lit(float(value))).otherwise(F.col("v")))


def collapse(df: DataFrame, by: list[str]) -> DataFrame:
    """Mean, n and sum of the pixels of each row, column or image, without NaN and nulls."""
    v = F.when(~F.isnan("v"), F.col("v"))
    return df.groupBy(*by).agg(F.avg(v).alias("mean"), F.count(v).alias("n"), F.sum(v).alias("total"))


def rebin(df: DataFrame, by: list[str], factor: int) -> DataFrame:
    """Blocks of factor by factor pixels, averaged without NaN and nulls."""
    cell = lambda c: F.floor(F.col(c) / factor).cast("int").alias(c)
    return df.groupBy(*by, cell("x"), cell("y")).agg(F.avg(F.when(~F.isnan("v"), F.col("v"))).alias("v"))


def convolve(df: DataFrame, by: list[str], kernel: dict[tuple[int, int], float], normalise: bool = False) -> DataFrame:
    """Each pixel that is there becomes the sum of kernel[(i, j)] times the pixel at (x + i, y + j); pixels that aren't there count as 0 or, with normalise, as the mean of the others. Each pixel is sent to its neighbours and summed before the shuffle, so images may be of any size."""
    parts = F.array(*[F.struct(F.lit(-i).alias("i"), F.lit(-j).alias("j"), F.lit(float(k)).alias("k")) for (i, j), k in kernel.items()])
    sent = df.select(*by, "x", "y", "v", F.explode(parts).alias("p"))
    own = (F.col("p.i") == 0) & (F.col("p.j") == 0)
    sums = sent.groupBy(*by, (F.col("x") + F.col("p.i")).alias("x"), (F.col("y") + F.col("p.j")).alias("y")).agg(F.sum(F.col("v") * F.col("p.k")).alias("_s"), F.sum("p.k").alias("_k"), F.max(own.cast("int")).alias("_there"))
    whole = float(sum(kernel.values()))
    if (0, 0) not in kernel:
        return sums.join(df.select(*by, "x", "y"), [*by, "x", "y"], "left_semi").select(*by, "x", "y", (F.col("_s") * whole / F.col("_k") if normalise else F.col("_s")).alias("v"))
    return sums.where("_there = 1").select(*by, "x", "y", (F.col("_s") * whole / F.col("_k") if normalise else F.col("_s")).alias("v"))


def box(df: DataFrame, x: int, y: int, nx: int, ny: int, to_x: int | None = None, to_y: int | None = None) -> DataFrame:
    """The pixels of a box of nx by ny from (x, y) on, moved so that its corner is at (to_x, to_y) if given."""
    inside = df.where(F.col("x").between(x, x + nx - 1) & F.col("y").between(y, y + ny - 1))
    if to_x is not None:
        inside = inside.withColumn("x", F.col("x") + (to_x - x))
    return inside if to_y is None else inside.withColumn("y", F.col("y") + (to_y - y))


def collapse_median(df: DataFrame, by: list[str]) -> DataFrame:
    """The median of the pixels of each row, column or image, without NaN and nulls."""
    return ranks.quantiles(df, by, "v", {"median": 0.5})


def local_maxima(df: DataFrame, by: list[str], least: float) -> DataFrame:
    """Pixels from `least` on that are above all of their eight neighbours that are there. Each pixel is sent to its neighbours and reduced to their maximum before the shuffle."""
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    sent = df.where(~F.isnan("v")).select(*by, "x", "y", "v", F.explode(around).alias("p"))
    own = (F.col("p.i") == 0) & (F.col("p.j") == 0)
    found = sent.groupBy(*by, (F.col("x") + F.col("p.i")).alias("x"), (F.col("y") + F.col("p.j")).alias("y")).agg(F.max(F.when(own, F.col("v"))).alias("v"), F.max(F.when(~own, F.col("v"))).alias("_around"))
    return found.where(F.col("v").isNotNull() & (F.col("v") >= least) & (F.col("_around").isNull() | (F.col("v") > F.col("_around")))).drop("_around")


def gaussian_smooth(df: DataFrame, by: list[str], sigma: float) -> DataFrame:
    """Smoothing by a Gaussian of three sigmas' reach, along x, then along y; pixels that aren't there don't count."""
    n = max(1, round(3 * sigma))
    weights = {k: math.exp(-0.5 * (k / sigma) ** 2) for k in range(-n, n + 1)}
    total = sum(weights.values())
    along = convolve(df, by, {(k, 0): w / total for k, w in weights.items()}, normalise=True)
    return convolve(along, by, {(0, k): w / total for k, w in weights.items()}, normalise=True)


def subpixel_shift(df: DataFrame, by: list[str], dx: float, dy: float) -> DataFrame:
    """Pixels moved by (dx, dy): whole pixels first, the rest by bilinear weights; only pixels with all four sources there."""
    ix, iy = math.floor(dx), math.floor(dy)
    fx, fy = dx - ix, dy - iy
    parts = F.array(*[F.struct(F.lit(i + ix).alias("i"), F.lit(j + iy).alias("j"), F.lit((fx if i else 1 - fx) * (fy if j else 1 - fy)).alias("k")) for i in (0, 1) for j in (0, 1)])
    return _gathered(df, by, parts, 1)


def expand(df: DataFrame, by: list[str], scale: int) -> DataFrame:
    """The image at `scale` pixels for one, by bilinear interpolation between pixels: pixel (x, y) is at (scale * x, scale * y). Only where all sources are there."""
    n = range(-scale + 1, scale)
    parts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit((1 - abs(i) / scale) * (1 - abs(j) / scale)).alias("k")) for i in n for j in n])
    return _gathered(df, by, parts, scale)


def _gathered(df: DataFrame, by: list[str], parts, scale: int) -> DataFrame:
    """Each pixel adds k times its value to (scale * x + i, scale * y + j); pixels with less than a whole weight are left out."""
    sent = df.select(*by, "x", "y", "v", F.explode(parts).alias("p")).where("p.k > 0")
    at = lambda c, k: (F.col(c) * scale + F.col(f"p.{k}")).cast("int").alias(c)
    sums = sent.groupBy(*by, at("x", "i"), at("y", "j")).agg(F.sum(F.col("v") * F.col("p.k")).alias("v"), F.sum("p.k").alias("_k"))
    return sums.where(F.col("_k") > 1 - 1e-9).drop("_k")


def rotate(df: DataFrame, by: list[str], degrees: float, x0: float, y0: float) -> DataFrame:
    """Pixels turned about (x0, y0), each to the nearest place; pixels that meet are averaged."""
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    dx, dy = F.col("x") - x0, F.col("y") - y0
    place = lambda v, name: F.floor(v + 0.5).cast("int").alias(name)
    return df.groupBy(*by, place(x0 + dx * c - dy * s, "x"), place(y0 + dx * s + dy * c, "y")).agg(F.avg("v").alias("v"))


def annulus(df: DataFrame, by: list[str], x0: float, y0: float, inner: float, outer: float) -> DataFrame:
    """n, mean and sigma of the pixels at a distance from inner to below outer."""
    r = F.hypot(F.col("x") - x0, F.col("y") - y0)
    v = F.when(~F.isnan("v"), F.col("v"))
    return df.where((r >= inner) & (r < outer)).groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sigma"))


def section(df: DataFrame, by: list[str], degrees: float, delta: float = 1.0) -> DataFrame:
    """(by, bin, mean): pixels averaged along the direction across an angle."""
    a = math.radians(degrees)
    place = F.floor((F.col("x") * math.cos(a) + F.col("y") * math.sin(a)) / delta).cast("int")
    return df.groupBy(*by, place.alias("bin")).agg(F.avg(F.when(~F.isnan("v"), F.col("v"))).alias("mean"))


def stack(df: DataFrame, weight: str | None = None) -> DataFrame:
    """(x, y, n, mean, median) over all images, and wtmean if a column of weights is named."""
    v = F.when(~F.isnan("v"), F.col("v"))
    w = F.when(v.isNotNull(), F.col(weight)) if weight else None
    sums = df.groupBy("x", "y").agg(F.count(v).alias("n"), F.avg(v).alias("mean"), *([(F.sum(v * w) / F.sum(w)).alias("wtmean")] if weight else []))
    return sums.join(ranks.quantiles(df, ["x", "y"], "v", {"median": 0.5}), ["x", "y"], "left")


def grow(df: DataFrame, by: list[str], n: int) -> DataFrame:
    """(by, x, y) of all places within n pixels, along x and y, of a pixel that isn't 0."""
    reach = F.sequence(F.lit(-n), F.lit(n))
    marked = df.where((F.col("v") != 0) | F.isnan("v")).select(*by, "x", "y")
    return marked.withColumn("_i", F.explode(reach)).withColumn("_j", F.explode(reach)).select(*by, (F.col("x") + F.col("_i")).alias("x"), (F.col("y") + F.col("_j")).alias("y")).distinct()


def from_vector(df: DataFrame, ordinal: str, value: str, nx: int) -> DataFrame:
    """(x, y, v) of values by their ordinals, nx to a row."""
    return df.select((F.col(ordinal) % nx).cast("int").alias("x"), F.floor(F.col(ordinal) / nx).cast("int").alias("y"), F.col(value).alias("v"))


def to_vector(df: DataFrame, by: list[str], nx: int) -> DataFrame:
    """(by, ordinal, v), row after row."""
    return df.select(*by, (F.col("y") * nx + F.col("x")).cast("bigint").alias("ordinal"), "v")


def create(spark: SparkSession, nx: int, ny: int, nz: int = 1, value: float = 0.0) -> DataFrame:
    """An image, or a cube, of one value, made from a range."""
    k = F.col("id")
    return spark.range(nx * ny * nz).select(F.floor(k / (nx * ny)).cast("int").alias("z"), (k % nx).cast("int").alias("x"), (F.floor(k / nx) % ny).cast("int").alias("y"), F.lit(float(value)).alias("v"))


def squash(df: DataFrame, along: str) -> DataFrame:
    """A cube (z, x, y, v) summed along an axis."""
    return df.groupBy(*[c for c in ("z", "x", "y") if c != along]).agg(F.sum("v").alias("v"))


def spread_density(df: DataFrame, x: str, y: str, x_axis: tuple[float, float, float], y_axis: tuple[float, float, float], reach: int) -> DataFrame:
    """(x, y, v): how many points fall within so many cells, along both axes, of each cell; points outside the axes (start, end, delta) don't count. Points are counted by cell before they are spread."""
    cell = lambda c, a: F.when((F.col(c) >= a[0]) & (F.col(c) < a[1]), F.floor((F.col(c) - a[0]) / a[2])).cast("int")
    counted = df.select(cell(x, x_axis).alias("x"), cell(y, y_axis).alias("y")).dropna().groupBy("x", "y").agg(F.count("*").alias("v"))
    n = [round((a[1] - a[0]) / a[2]) for a in (x_axis, y_axis)]
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    sent = counted.withColumn("_i", F.explode(steps)).withColumn("_j", F.explode(steps)).select((F.col("x") + F.col("_i")).alias("x"), (F.col("y") + F.col("_j")).alias("y"), "v")
    return sent.where(F.col("x").between(0, n[0] - 1) & F.col("y").between(0, n[1] - 1)).groupBy("x", "y").agg(F.sum("v").alias("v"))


def multiply(a: DataFrame, b: DataFrame) -> DataFrame:
    """The product of two matrices of rows (i, j, v): a join of equal inner indices, summed by cell before the shuffle."""
    left, right = a.select("i", F.col("j").alias("k"), F.col("v").alias("_a")), b.select(F.col("i").alias("k"), "j", F.col("v").alias("_b"))
    return left.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("_a") * F.col("_b")).alias("v"))


def sampled(df: DataFrame, points: DataFrame, by: list[str], key: str) -> DataFrame:
    """(by, key, v): the image at each point (by, key, x, y), by bilinear interpolation between the four pixels around it; points without all of those that count are left out."""
    parts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    fx, fy = F.col("x") - F.floor("x"), F.col("y") - F.floor("y")
    weight = F.when(F.col("p.i") == 1, fx).otherwise(1 - fx) * F.when(F.col("p.j") == 1, fy).otherwise(1 - fy)
    sent = points.select(*by, key, "x", "y", F.explode(parts).alias("p")).select(*by, key, (F.floor("x") + F.col("p.i")).cast("int").alias("x"), (F.floor("y") + F.col("p.j")).cast("int").alias("y"), weight.alias("_w")).where("_w > 0")
    return sent.join(df, [*by, "x", "y"]).groupBy(*by, key).agg(F.sum(F.col("v") * F.col("_w")).alias("v"), F.sum("_w").alias("_w")).where(F.col("_w") > 1 - 1e-9).drop("_w")
