"""Point sources on images as elliptical Gaussians: damped least squares in two dimensions, sources that overlap fitted together, and shapes that vary over the image."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from heliotab.operators.fits import powers_2d
from heliotab.operators.graphs import components
from heliotab.operators.group_fits import linear
from heliotab.operators.store import written

#: Sources that one task fits together at most, where the field isn't denser than that in a square of four radii.
LARGEST = 12
#: Sources whose pixels and fits one task has, about.
STARS = 4096
_SET = ["_set", "_cx", "_cy"]
_SHAPE = ["xx", "xy", "yy"]


def overlapping(sources: DataFrame, by: list[str], key: str, reach: float) -> DataFrame:
    """(a, b) of sources (by, key, x, y) of an image closer than `reach`: a join of equal cells of that size, each source sent to the cells around its own. Keys are unique over all images."""
    cell = lambda c: F.floor(F.col(c) / reach)
    near = lambda c: F.explode(F.sequence(cell(c) - 1, cell(c) + 1))
    left = sources.select(*by, F.col(key).alias("a"), F.col("x").alias("_ax"), F.col("y").alias("_ay"), near("x").alias("_i"), F.col("y")).withColumn("_j", near("y")).drop("y")
    right = sources.select(*by, F.col(key).alias("b"), F.col("x").alias("_bx"), F.col("y").alias("_by"), cell("x").alias("_i"), cell("y").alias("_j"))
    both = left.join(right.hint("merge"), [*by, "_i", "_j"]).where("a < b")
    return both.where(F.hypot(F.col("_ax") - F.col("_bx"), F.col("_ay") - F.col("_by")) < reach).select("a", "b")


def _solve(x: np.ndarray, y: np.ndarray, v: np.ndarray, w: np.ndarray, start: np.ndarray, shapes: bool, sky: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Height, place and inverse shape of each source (start: set, source, 6), and the sky: by damped least squares, of many sets at once (x, y, v, w: set, pixel; w is 0 where a set has fewer pixels). With the heights' errors, chi-square and whether it came to rest."""
    n, free = start.shape[1], 6 if shapes else 3

    def model(at: np.ndarray, p: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dx, dy = x[at, :, None] - p[:, None, :, 1], y[at, :, None] - p[:, None, :, 2]
        a, b, c = (p[:, None, :, k] for k in (3, 4, 5))
        e = np.exp(-0.5 * (a * dx * dx + 2 * b * dx * dy + c * dy * dy))
        f = p[:, None, :, 0] * e
        slopes = [e, f * (a * dx + b * dy), f * (b * dx + c * dy)] + ([-f * dx * dx / 2, -f * dx * dy, -f * dy * dy / 2] if shapes else [])
        j = np.stack(slopes, axis=3).reshape(len(at), x.shape[1], n * free)
        return f.sum(axis=2) + s[:, None], np.concatenate([j, np.ones((*j.shape[:2], 1))], axis=2) if sky else j

    every = np.arange(len(x))
    p, s, damp, rest = start.copy(), np.zeros(len(x)), np.full(len(x), 1e-3), np.zeros(len(x), dtype=bool)
    f, j = model(every, p, s)
    chi, light = (w * (v - f) ** 2).sum(axis=1), (w * v * v).sum(axis=1)
    on = every
    for _ in range(200):
        turned = j[on].transpose(0, 2, 1)
        normal, slope = turned @ (w[on, :, None] * j[on]), turned @ (w[on] * (v[on] - f[on]))[:, :, None]
        axis = np.arange(normal.shape[1])
        normal[:, axis, axis] += damp[on, None] * np.maximum(normal[:, axis, axis], 1e-300)
        step = (np.linalg.pinv(normal, rcond=1e-15) @ slope)[:, :, 0]
        q = p[on]
        q[:, :, :free] += step[:, : n * free].reshape(-1, n, free)
        t = s[on] + (step[:, -1] if sky else 0.0)
        sound = ((q[:, :, 3] > 0) & (q[:, :, 3] * q[:, :, 5] > q[:, :, 4] ** 2)).all(axis=1)
        tried, q, t = on[sound], q[sound], t[sound]
        g, k = model(tried, q, t)
        new = np.full(len(x), math.inf)
        new[tried] = (w[tried] * (v[tried] - g) ** 2).sum(axis=1)
        good = new[tried] <= chi[tried]
        at = tried[good]
        rest[at] = chi[at] - new[at] <= 1e-12 * chi[at] + 1e-18 * light[at]
        p[at], s[at], f[at], j[at], chi[at] = q[good], t[good], g[good], k[good], new[at]
        worse = np.isin(on, at, invert=True)
        damp[on] = np.where(worse, damp[on] * 10, damp[on] / 10)
        on = on[~(rest[on] | (damp[on] > 1e12))]
        if not len(on):
            break
    spread = np.linalg.pinv(j.transpose(0, 2, 1) @ (w[:, :, None] * j))
    errors = np.sqrt(np.maximum(np.diagonal(spread, axis1=1, axis2=2), 0.0))[:, : n * free : free]
    return p, s, errors, chi, rest | (damp > 1e12)


def _lists(column: pa.ListArray) -> tuple[pa.StructArray, np.ndarray]:
    """The structs of all lists one after the other, and where each list begins and ends; null lists are empty."""
    return column.flatten(), np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))])


def _alike(sets: np.ndarray, stars: np.ndarray, pixels: np.ndarray, free: int) -> Iterator[np.ndarray]:
    """The sets, in order of stars and pixels, in runs of as many stars each, whose slopes have some 250,000 numbers at most or are of one set."""
    i = 0
    while i < len(sets):
        j = i + 1
        while j < len(sets) and stars[sets[j]] == stars[sets[i]] and (j + 1 - i) * pixels[sets[j]] * stars[sets[i]] * free <= 250_000:
            j += 1
        yield sets[i:j]
        i = j


def fit(pixels: DataFrame, sources: DataFrame, by: list[str], key: str, radius: float, shapes: bool = False, sky: bool = False, rounds: int = 20, tolerance: float = 1e-4) -> DataFrame:
    """(by, key, x, y, flux, flux_err, xx, xy, yy, sky, chi, pixels, together, rest): the sources (by, key, x, y, flux, xx, xy, yy; the first guesses) fitted to the pixels (by, x, y, v, var) within the radius of them. xx, xy, yy are the second moments of a Gaussian; they are fitted with `shapes` and held else, and a constant sky for each fit with `sky`. flux_err holds the shape. chi and pixels are of all `together` that were fitted at once; rest: the fit came to rest.

    Sources closer than two radii are fitted together, through chains of them. A chain of more than LARGEST is cut by squares of four radii: each part is fitted with the light of the others taken off as last known, round by round, until no place moves by more than the tolerance; so no task holds a crowded field. A set goes to its task as one row, of lists of its stars and of its light: groups of rows cost more than their fits. Sources sent to all their pixels count as few rows with Spark, so their joins are merges and nothing is broadcast. Keys are whole numbers, unique over all images. Without more good pixels than unknowns, the guesses come back with chi null and rest false. Runs jobs while the plan is built.
    """
    names = [*by, key, "x", "y", "flux", *_SHAPE]
    own = written(sources.select(*by, key, *[F.col(c).cast("double").alias(c) for c in names[len(by) + 1 :]]))
    roots = components(overlapping(own, by, key, 2 * radius))
    chained = own.join(roots.select(F.col("node").alias(key), F.col("root").alias("_set")).hint("merge"), key, "left").withColumn("_set", F.coalesce("_set", key))
    long_ = chained.groupBy("_set").agg((F.count("*") > LARGEST).alias("_cut"))
    cell = lambda c: F.when(F.col("_cut"), F.floor(F.col(c) / (4 * radius))).otherwise(0)
    now = written(chained.join(long_.hint("merge"), "_set").withColumn("_cx", cell("x")).withColumn("_cy", cell("y")).select(*names, *_SET, "_cut"))
    cut = now.where("_cut").limit(1).count() > 0

    reach = F.sequence(F.lit(-math.ceil(radius)), F.lit(math.ceil(radius)))
    tasks = max(own.sparkSession.sparkContext.defaultParallelism, own.count() // STARS)  # stated: stars are few for their pixels, and would be put together
    dealt = now.select(*by, key, *_SET, F.col("x").alias("_x"), F.col("y").alias("_y")).repartition(tasks, *_SET)
    sent = dealt.withColumn("_i", F.explode(reach)).withColumn("_j", F.explode(reach))
    at = lambda c, k: (F.floor(F.col(c) + 0.5) + F.col(k)).cast("bigint")
    cover = sent.withColumn("x", at("_x", "_i")).withColumn("y", at("_y", "_j")).where(F.hypot(F.col("x") - F.col("_x"), F.col("y") - F.col("_y")) <= radius)
    cover = written(cover.select(*by, "x", "y", key, *_SET)) if cut else cover.select(*by, "x", "y", key, *_SET)
    good = pixels.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.col("var") > 0) & ~F.isnan("var"))
    seen = written(cover.select(*by, "x", "y", *_SET).distinct().join(good.select(*by, F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"), "v", "var").hint("merge"), [*by, "x", "y"]))

    columns = [*names, "flux_err", "sky", "chi", "pixels", "together", "rest"]
    found = ["x", "y", "flux", "flux_err", *_SHAPE, "sky", "chi"]
    held = [*by, key, *_SET, "_cut"]
    schema = StructType([*[StructField(c, now.schema[c].dataType) for c in held], *[StructField(c, DoubleType()) for c in found], StructField("pixels", LongType()), StructField("together", LongType()), StructField("rest", BooleanType())])

    def joint(batches):
        """Fits each row of a batch: the stars of a set and its light, as lists."""
        for batch in batches:
            stars, n = _lists(batch.column("_stars"))
            light, m = _lists(batch.column("_light"))
            number = lambda rows, c: rows.field(c).to_numpy(zero_copy_only=False).astype(float)
            guess, seen_ = {c: number(stars, c) for c in ("x", "y", "flux", *_SHAPE)}, {c: number(light, c) for c in ("x", "y", "v", "var")}
            out = {c: guess.get(c, np.empty(0)).copy() if c in guess else np.full(n[-1], np.nan) for c in found}
            rest = np.zeros(n[-1], dtype=bool)
            sizes, pixels_ = np.diff(n), np.diff(m)
            able = np.flatnonzero(pixels_ > sizes * (6 if shapes else 3) + sky)
            able = able[np.lexsort((pixels_[able], sizes[able]))]
            for some in _alike(able, sizes, pixels_, 6 if shapes else 3):
                stars_at, light_at = n[some][:, None] + np.arange(sizes[some[0]]), m[some][:, None] + np.arange(pixels_[some].max())
                there = light_at < m[some + 1][:, None]
                light_at = np.where(there, light_at, 0)
                flux, gx, gy, xx, xy, yy = (guess[c][stars_at] for c in ("flux", "x", "y", *_SHAPE))
                area = xx * yy - xy**2
                start = np.stack([flux / (2 * np.pi * np.sqrt(area)), gx, gy, yy / area, -xy / area, xx / area], axis=2)
                p, s, errors, chi, rest[stars_at.T] = _solve(*(np.where(there, seen_[c][light_at], 0.0) for c in "xyv"), np.where(there, 1 / seen_["var"][light_at], 0.0), start, shapes, sky)
                inverse = p[:, :, 3] * p[:, :, 5] - p[:, :, 4] ** 2
                size = 2 * np.pi / np.sqrt(inverse)
                for c, value in zip(found, (p[:, :, 1], p[:, :, 2], p[:, :, 0] * size, errors * size, p[:, :, 5] / inverse, -p[:, :, 4] / inverse, p[:, :, 3] / inverse, s[:, None], chi[:, None])):
                    out[c][stars_at] = value
            each = np.repeat(np.arange(len(n) - 1), np.diff(n))
            own = [stars.field(c) if c in (*by, key, "_cut") else batch.column(c).take(pa.array(each)) for c in held]
            counts = [pa.array(x[each]) for x in (pixels_, sizes)]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array(out[c]) for c in found], *counts, pa.array(rest)], names=schema.names)

    for _ in range(rounds if cut else 1):
        light = seen
        if cut:
            dx, dy, area = F.col("x") - F.col("_x"), F.col("y") - F.col("_y"), F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
            shone = F.col("flux") / (2 * math.pi * F.sqrt(area)) * F.exp(-(F.col("yy") * dx * dx - 2 * F.col("xy") * dx * dy + F.col("xx") * dy * dy) / (2 * area))
            each = cover.join(now.where("_cut").select(key, F.col("x").alias("_x"), F.col("y").alias("_y"), "flux", *_SHAPE).hint("merge"), key)
            mine = written(each.groupBy(*by, "x", "y", *_SET).agg(F.sum(shone).alias("_mine")))
            every = mine.groupBy(*by, "x", "y").agg(F.sum("_mine").alias("_all"))
            light = seen.join(mine.join(every.hint("merge"), [*by, "x", "y"]).hint("merge"), [*by, "x", "y", *_SET], "left").withColumn("v", F.col("v") - F.coalesce(F.col("_all") - F.col("_mine"), F.lit(0.0))).drop("_all", "_mine")
        stars = now.repartition(tasks, *_SET).groupBy(*_SET).agg(F.collect_list(F.struct(*names, "_cut")).alias("_stars"))
        packed = light.repartition(tasks, *_SET).groupBy(*_SET).agg(F.collect_list(F.struct("x", "y", "v", "var")).alias("_light"))
        new = written(stars.join(packed.hint("merge"), _SET, "left").mapInArrow(joint, schema))
        moved = cut and new.where("_cut").join(now.select(key, F.col("x").alias("_x"), F.col("y").alias("_y")).hint("merge"), key).where(F.hypot(F.col("x") - F.col("_x"), F.col("y") - F.col("_y")) > tolerance).limit(1).count()
        now = new
        if not moved:
            break
    whole = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)
    return now.select(*names, *[whole(c) for c in ("flux_err", "sky", "chi")], "pixels", "together", "rest").select(*columns)


def shapes_over(fitted: DataFrame, by: list[str], order: int, clip: float = 3.0, passes: int = 4) -> DataFrame:
    """(by, moment, c, n, chi): polynomials over the image of the second moments of fitted stars, clipped; moment is xx, xy or yy. Images with too few stars have c null."""
    long_ = fitted.where("rest").select(*by, F.col("x").alias("_x"), F.col("y").alias("_y"), F.explode(F.create_map(*[e for m in _SHAPE for e in (F.lit(m), F.col(m))])).alias("moment", "_v"))
    return linear(long_, [*by, "moment"], powers_2d(F.col("_x"), F.col("_y"), order), F.col("_v"), clip=clip, passes=passes)


def with_shapes(sources: DataFrame, over: DataFrame, by: list[str], order: int) -> DataFrame:
    """The sources with the moments xx, xy, yy that the polynomials give at their places; sources of images without these are left out."""
    found = over.groupBy(*by).agg(*[F.max(F.when(F.col("moment") == m, F.col("c"))).alias(f"_{m}") for m in _SHAPE])
    value = lambda m: sum((F.get(f"_{m}", F.lit(i)) * t for i, t in enumerate(powers_2d(F.col("x"), F.col("y"), order))), F.lit(0.0))
    return sources.drop(*_SHAPE).join(found, by).select("*", *[value(m).alias(m) for m in _SHAPE]).drop(*[f"_{m}" for m in _SHAPE])


def residual(pixels: DataFrame, fitted: DataFrame, by: list[str], radius: float) -> DataFrame:
    """The pixels less the light of the fitted sources within the radius of each."""
    reach = F.sequence(F.lit(-math.ceil(radius)), F.lit(math.ceil(radius)))
    sent = fitted.select(*by, F.col("x").alias("_x"), F.col("y").alias("_y"), "flux", *_SHAPE, F.explode(reach).alias("_i")).withColumn("_j", F.explode(reach))
    place = lambda c, k: (F.floor(F.col(c) + 0.5) + F.col(k)).cast("bigint")
    cover = sent.withColumn("x", place("_x", "_i")).withColumn("y", place("_y", "_j"))
    dx, dy, area = F.col("x") - F.col("_x"), F.col("y") - F.col("_y"), F.col("xx") * F.col("yy") - F.col("xy") * F.col("xy")
    shone: Column = F.col("flux") / (2 * math.pi * F.sqrt(area)) * F.exp(-(F.col("yy") * dx * dx - 2 * F.col("xy") * dx * dy + F.col("xx") * dy * dy) / (2 * area))
    light = cover.where(F.hypot(dx, dy) <= radius).groupBy(*by, "x", "y").agg(F.sum(shone).alias("_light"))
    return pixels.join(light.hint("merge"), [*by, "x", "y"], "left").withColumn("v", F.col("v") - F.coalesce("_light", F.lit(0.0))).drop("_light")
