"""Statistics of samples, robust ones among them."""

import math
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heliotab.functions import sem
from heliotab.operators import ranks
from heliotab.operators.spectra import wave_sums
from heliotab.operators.store import written


def summary(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """n, total, mean, sigma, low, high, skewness, kurtosis, median, mode and binned_median of the finite values of each group; the last two are lower edges of bins, of which there are 1000 from low to high. The sums are written to the shared folder, since the others begin with them."""
    v = F.col(value)
    sums = df.where(sem.is_finite(v)).groupBy(*by).agg(F.count(v).alias("n"), F.sum(v).alias("total"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sigma"), F.min(v).alias("low"), F.max(v).alias("high"), F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis"))
    sums = written(sums)
    limits = sums.select(*by, "n", F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high"))
    out = ranks.join_groups(sums, ranks.quantiles(df, by, value, {"median": 0.5}, limits), by, "left")
    return ranks.join_groups(out, ranks.modes(df, by, value, limits), by, "left")


def clipped(df: DataFrame, by: list[str], value: str, nsigma: float = 3.0, passes: int = 3) -> DataFrame:
    """n, mean and sigma of each group after `passes` passes, each over the values within nsigma sigmas of the last mean. Each pass is one aggregation and one join with its result."""
    rows = df.where(sem.is_finite(F.col(value))).select(*by, F.col(value).alias("v"))
    stats = None
    for _ in range(passes):
        kept = rows
        if stats is not None:
            limits = stats.select(*by, F.col("mean").alias("m"), F.coalesce("sigma", F.lit(0.0)).alias("s"))
            kept = rows.join(limits, by).where(F.abs(F.col("v") - F.col("m")) <= nsigma * F.col("s"))
        stats = kept.groupBy(*by).agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("sigma"))
    return stats


def weighted_mean(df: DataFrame, by: list[str], value: str, sigma: str) -> DataFrame:
    """(value, variance): the mean with weights 1 / sigma^2 and 1 over their sum; rows that aren't finite are left out, and tiny sigmas are raised to the least normal float."""
    v, s = F.col(value), F.greatest(F.abs(F.col(sigma)), F.lit(1.17549435e-38))
    w = 1 / (s * s)
    return df.where(sem.is_finite(v) & sem.is_finite(F.col(sigma))).groupBy(*by).agg((F.sum(v * w) / F.sum(w)).alias("value"), (1 / F.sum(w)).alias("variance"))


def irls(df: DataFrame, by: list[str], value: str, sigma: str, passes: int = 10, tolerance: float = 1e-4) -> DataFrame:
    """The mean with Cauchy weights 1 / (1 + d^2), d in sigmas from the last mean, from the weighted mean on. A group ends where its mean changes by less than the tolerance times its size, all end after so many passes. Each pass is one aggregation, whose result, a row a group, is written to the shared folder."""
    v, s = F.col(value), F.col(sigma)
    rows = df.where(sem.is_finite(v) & (s > 0)).select(*by, v.alias("v"), s.alias("s"))
    now = written(rows.groupBy(*by).agg((F.sum(F.col("v") / F.col("s") ** 2) / F.sum(1 / F.col("s") ** 2)).alias("value")).withColumn("done", F.lit(False)))
    for _ in range(passes):
        d = (F.col("v") - F.col("value")) / F.col("s")
        w = 1 / (1 + d * d) / F.col("s") ** 2
        new = ranks.join_groups(rows, now.where("NOT done"), by).groupBy(*by).agg((F.sum(F.col("v") * w) / F.sum(w)).alias("new"))
        ended = F.col("done") | (F.abs(F.col("new") - F.col("value")) < tolerance * F.abs(F.col("new")))
        now = written(ranks.join_groups(now, new, by, "left").select(*by, F.coalesce("new", "value").alias("value"), ended.alias("done")))
        if not now.where("NOT done").limit(1).count():
            break
    return now.select(*by, "value")


def polynomial_fit(df: DataFrame, x: str, y: str, order: int, weight: str | None = None) -> list[float]:
    """Coefficients from the constant on, by normal equations: one aggregation of 3 * order + 2 sums; only those come to the driver."""
    w = F.col(weight) if weight else F.lit(1.0)
    finite = df.where(sem.is_finite(F.col(x).cast("double")) & sem.is_finite(F.col(y).cast("double")))
    sums = finite.agg(*[F.sum(w * F.pow(F.col(x), F.lit(float(k)))) for k in range(2 * order + 1)], *[F.sum(w * F.col(y) * F.pow(F.col(x), F.lit(float(k)))) for k in range(order + 1)]).first()
    s, t = sums[: 2 * order + 1], sums[2 * order + 1 :]
    return np.linalg.solve([[s[i + j] for j in range(order + 1)] for i in range(order + 1)], t).tolist()


def apply_polynomial(x, coefficients: list[float]):
    """The polynomial's value, by Horner's rule."""
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + c
    return out


#: Rows of which a task combines the sums by period; of the matrices that it works on, rows and periods.
_TASK_ROWS, _ROWS, _PERIODS = 8192, 512, 256


def period_grid(low: float, high: float, span: float) -> Iterator[float]:
    """Periods from low on, below high, for times over a span: each is P + 0.1 P^2 / span after the last, a tenth of a peak's width. None if the span is 0."""
    p = low
    while span > 0 and p < high:
        yield p
        p *= 1 + 0.1 * p / span


def period_search(df: DataFrame, t: str, y: str, low: float, high: float) -> DataFrame:
    """(period, power) as from period_power, over the grid that fits the span of t. Rows are added up by blocks of time, at a few frequencies each, from which the sums at all periods follow, so work grows with rows and periods and not with their product."""
    rows = df.where(_both_finite(t, y)).select(F.col(t).cast("double").alias("t"), F.col(y).cast("double").alias("y"))
    first, last, count, mean, variance = rows.agg(F.min("t"), F.max("t"), F.count("*"), F.avg("y"), F.var_samp("y")).first()
    span = 0.0 if first is None else last - first
    if not span > 0 or low >= high:
        return df.sparkSession.createDataFrame([], "period double, power double")
    sums = wave_sums(rows.select("t", (F.col("y") - mean).alias("d")), first, last, low, high, lambda p: period_grid(p, high, span))
    return _normalized(sums, count, variance)


def period_power(df: DataFrame, t: str, y: str, periods: list[float]) -> DataFrame:
    """(period, power): the Lomb-Scargle power of y over t at each period. Rows are combined by period before the shuffle; those that aren't finite are left out."""
    return _power(df, t, y, lambda: map(float, periods))


def _both_finite(t: str, y: str):
    return sem.is_finite(F.col(t).cast("double")) & sem.is_finite(F.col(y).cast("double"))


def _power(df: DataFrame, t: str, y: str, grid: Callable[[], Iterator[float]]) -> DataFrame:
    rows = df.where(_both_finite(t, y)).select(F.col(t).cast("double").alias("t"), F.col(y).cast("double").alias("y"))
    count, mean, variance = rows.agg(F.count("*"), F.avg("y"), F.var_samp("y")).first()

    def sums(batches):
        for batch in batches:
            at, d = batch.column(0).to_numpy(), batch.column(1).to_numpy() - mean
            periods = grid()
            while some := list(islice(periods, _PERIODS)):
                w = 2 * math.pi / np.array(some)
                total = np.zeros((4, len(some)))
                for i in range(0, len(at), _ROWS):
                    a = np.outer(at[i : i + _ROWS], w)
                    s, c = np.sin(a), np.cos(a)
                    total += d[i : i + _ROWS] @ c, d[i : i + _ROWS] @ s, np.einsum("ij,ij->j", s, s), np.einsum("ij,ij->j", s, c)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.float64()), *map(pa.array, total)], names=["period", "yc", "ys", "ss", "sc"])

    spread = rows.repartition(max(1, -(-count // _TASK_ROWS)))
    by = spread.mapInArrow(sums, "period double, yc double, ys double, ss double, sc double").groupBy("period").agg(*[F.sum(x).alias(x) for x in ("yc", "ys", "ss", "sc")])
    return _normalized(by.withColumn("c2", float(count) - 2 * F.col("ss")).withColumn("s2", 2 * F.col("sc")), count, variance)


def _normalized(by: DataFrame, count: int, variance: float | None) -> DataFrame:
    """(period, power) from sums of y cos w t, y sin w t, cos 2 w t and sin 2 w t."""
    n = F.lit(float(count))
    by = by.withColumn("a", F.atan2("s2", "c2") / 2).withColumn("h", F.hypot("c2", "s2"))  # w tau, and the sum of cos 2 (w t - w tau)
    yc = F.col("yc") * F.cos("a") + F.col("ys") * F.sin("a")
    ys = F.col("ys") * F.cos("a") - F.col("yc") * F.sin("a")
    both = sem.fdiv(yc * yc, (n + F.col("h")) / 2) + sem.fdiv(ys * ys, (n - F.col("h")) / 2)
    return by.select("period", sem.fdiv(both, F.lit(2.0) * F.lit(variance).cast("double")).alias("power"))
