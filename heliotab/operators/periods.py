"""Periods of many series at once: each task adds the sines and cosines of its rows to sums by group and period, which are then added up. Grids are made where they are used, from two or three numbers of a group."""

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from heliotab.functions import sem
from heliotab.operators.ranks import join_groups
from heliotab.operators.stats import period_grid

#: Rows of a group that one task adds up; periods worked on at once, and rows given back at once.
_ROWS, _PERIODS, _OUT = 8192, 512, 100_000
#: 10 span / period at the grid's end from which periods are sorted out before their powers are taken; periods held at once that may be best; rows times span of a task.
LONG, _HELD, _WORK = 500.0, 4_000_000, 3e10


def logarithmic(low: float, high: float, count: int = 1024) -> Callable[[float], np.ndarray]:
    """The same periods for every group, each larger than the last by the same factor."""
    return lambda span: low * (high / low) ** (np.arange(count) / max(count - 1, 1))


class Spanned:
    """The periods that fit the span of a group's times: a tenth of a peak's width apart."""

    def __init__(self, low: float, high: float):
        self.low, self.high = low, high

    def __call__(self, span: float) -> np.ndarray:
        return np.array(list(period_grid(self.low, self.high, span)), dtype=float)


def by_span(low: float, high: float) -> Spanned:
    return Spanned(low, high)


def _steps(u: np.ndarray) -> np.ndarray:
    """A function of u = 10 span / period that falls by 1 from each period of the grid to the next, to O(u^-4): u goes to u^2 / (u + 1)."""
    return u + np.log(u) + (0.5 + (-1 / 3 + 13 / 36 / u) / u) / u


def _slope(u: np.ndarray) -> np.ndarray:
    return 1 / (1 + (1 + (-0.5 + (2 / 3 - 13 / 12 / u) / u) / u) / u)


def _at(u0: float, k: np.ndarray) -> np.ndarray:
    """u of the grid that begins with u0, after k steps."""
    goal = _steps(u0) - k
    u = goal - np.log(goal)
    for _ in range(4):
        u = u - (_steps(u) - goal) * _slope(u)
    return u


def _may_be_best(t: np.ndarray, d: np.ndarray, grid: Spanned, span: float) -> np.ndarray:
    """Numbers, in order, of all periods of the grid whose power may be the greatest.

    The powers at all periods are taken in single precision, of sums that are matrix products: within a run of periods the frequencies are a middle and even steps from it, so exp(i w t) is a product of two factors. What that and the precision may be wrong by is a bound for each run, and a period is kept unless its power is below another's by more than both bounds. The power is (n |Y|^2 - Re(Y^2 conj Z)) / (n^2 - |Z|^2) over the variance, with the sums Y of d exp(i w t) and Z of exp(2 i w t).
    """
    n, total = len(t), float(np.abs(d).sum())
    t = t - (t.min() + t.max()) / 2
    u0, scale = 10 * span / grid.low, 0.2 * math.pi / span
    count = math.ceil(float(_steps(u0) - _steps(10 * span / grid.high))) + 1
    half, runs = (64, 8) if count < 100_000 else (256, 64)
    middles = _at(u0, np.arange(half - 0.5, count + half, 2 * half))
    slopes, even, best = _slope(middles), None, 0.0
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for b in range(0, len(middles), runs):
        u, slope = middles[b : b + runs], slopes[b : b + runs]
        own = (slope[0] + slope[-1]) / 2
        if even is None or np.abs(slope - even).max() * half > max(0.006, 1.01 * np.abs(slope - own).max() * half):
            even = own
            phase = np.outer(t, even * scale * (np.arange(half) + 0.5))
            c, s = np.cos(phase), np.sin(phase)
            turns = [np.hstack(x).astype(np.float32) for x in ((c, s), (c * c - s * s, 2 * c * s))]
        off = 0.1 * math.pi * (np.abs(slope - even).max() * half + 0.6 * (half / (u.min() - half)) ** 2 + 1e-6)
        phase = np.outer(u * scale, t)
        c, s = np.cos(phase), np.sin(phase)
        (yr, yi), (zr, zi) = (_both_ways(np.vstack(x).astype(np.float32) @ w, half) for x, w in zip(((c * d, s * d), (c * c - s * s, 2 * c * s)), turns))
        rr, ii = yr * yr, yi * yi
        power = n * (rr + ii) - (rr - ii) * zr - 2 * yr * yi * zi
        under = n * n - zr * zr - zi * zi
        high = math.sqrt(float((rr + ii).max())) * 1.00001
        small = 1.2e-7 * (n + 8)
        y, z = (off + small) * total, (2 * off + small) * n
        wrong, loose = 4 * n * (high + y) * y + 2 * n * y * y + (high + 2 * y) ** 2 * z + 1e-6 * n * (high + y) ** 2, 2 * n * z + z * z + 1e-6 * n * n
        least = (power - wrong) / (under + loose)
        if b + runs >= len(middles):  # what is beyond the grid, and its last two, say nothing of the others
            number = (b + np.arange(len(u)))[:, None] * 2 * half + np.arange(half)
            least[0][number[:, ::-1] >= count - 2] = least[1][number + half >= count - 2] = 0.0
        best = max(best, float(least.max()))
        there = np.flatnonzero(power + wrong >= np.float32(best * 0.999999) * (under - loose))
        side, run, step = np.unravel_index(there, power.shape)
        sure = under.ravel()[there] - loose
        kept.append(((b + run) * 2 * half + np.where(side == 0, half - 1 - step, half + step), np.where(sure > 0, (power.ravel()[there] + wrong) / np.where(sure > 0, sure, 1), math.inf)))
    found, most = (np.concatenate(x) for x in zip(*kept))
    found = np.sort(found[most >= best * 0.999999])
    return found[found < count]


def _both_ways(product: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Real and imaginary sums (side, run, step), of a product of [real; imaginary] and [cosines, sines]: on the side before the middle, where frequencies are higher, and on the side after it."""
    n = len(product) // 2
    rc, rs, ic, is_ = product[:n, :half], product[:n, half:], product[n:, :half], product[n:, half:]
    return np.stack([rc - is_, rc + is_]), np.stack([ic + rs, ic - rs])


def _periods(grid: Spanned, spans: np.ndarray, numbers: list[np.ndarray]) -> list[np.ndarray]:
    """The periods of these numbers of the grid of each span, each found from the last as period_grid does, of all spans at once; those that aren't below the highest are left out."""
    sizes = [len(x) for x in numbers]
    at, of = np.concatenate(numbers), np.repeat(np.arange(len(numbers)), sizes)
    order = np.argsort(at, kind="stable")
    ends = np.searchsorted(at[order], np.arange(0, at.max() + _PERIODS + 1, _PERIODS))
    out, p, step, held = np.empty(len(at)), np.full(len(spans), grid.low), np.empty(len(spans)), np.empty((_PERIODS, len(spans)))
    for k, (i, j) in enumerate(zip(ends[:-1], ends[1:])):
        for row in held:
            row[:] = p
            np.multiply(p, 0.1, out=step)
            np.divide(step, spans, out=step)
            np.add(step, 1.0, out=step)
            np.multiply(p, step, out=p)
        some = order[i:j]
        out[some] = held[at[some] - k * _PERIODS, of[some]]
    return [x[x < grid.high] for x in np.split(out, np.cumsum(sizes)[:-1])]


def _greatest(t: np.ndarray, d: np.ndarray, variance: float, periods: np.ndarray) -> tuple[float | None, float]:
    """The period of the greatest power, the first of equals, and that power; None where no power is finite."""
    n, found = len(t), (None, -math.inf)
    for k in range(0, len(periods), _PERIODS):
        some, sums = periods[k : k + _PERIODS], 0.0
        for r in range(0, n, 1024):
            phase = np.outer(t[r : r + 1024], 2 * math.pi / some)
            c, s = np.cos(phase), np.sin(phase)
            sums = sums + np.stack([d[r : r + 1024] @ c, d[r : r + 1024] @ s, (c * c - s * s).sum(axis=0), (2 * s * c).sum(axis=0)])
        yc, ys, c2, s2 = sums
        a, h = np.arctan2(s2, c2) / 2, np.hypot(c2, s2)
        with np.errstate(all="ignore"):
            power = ((yc * np.cos(a) + ys * np.sin(a)) ** 2 / ((n + h) / 2) + (ys * np.cos(a) - yc * np.sin(a)) ** 2 / ((n - h) / 2)) / (2 * variance)
        power[~np.isfinite(power)] = -math.inf
        if power.max() > found[1]:
            found = float(some[power.argmax()]), float(power.max())
    return found


def _summed(rows: DataFrame, by: list[str], names: list[str], terms: Callable, grid: Callable[[float], np.ndarray]) -> DataFrame:
    """(by, period, names): sums of terms(values, cosines, sines) of each group's rows at each of its periods. rows: by, _t, _span, _n and values. A group's rows go to a task for each _ROWS of them."""
    values = [c for c in rows.columns if c not in (*by, "_t", "_span", "_n")]
    dealt = rows.withColumn("_part", F.pmod(F.xxhash64("_t", *values), F.ceil(F.col("_n") / _ROWS))).repartition(*by, "_part").sortWithinPartitions(*by).drop("_part")
    schema = StructType([*[rows.schema[c] for c in by], *[StructField(c, DoubleType()) for c in ("period", *names)]])

    def run(batches):
        known: tuple[float, np.ndarray] = (math.nan, np.zeros(0))
        held, size = [], 0
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in by])) if by else [()] * batch.num_rows
            starts = [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]]
            t, spans = batch.column("_t").to_numpy(), batch.column("_span").to_numpy()
            own = {c: batch.column(c).to_numpy() for c in values}
            for i, j in zip(starts, [*starts[1:], len(keys)]):
                if spans[i] != known[0]:
                    known = spans[i], np.asarray(grid(float(spans[i])), dtype=float)
                periods = known[1]
                if not len(periods):
                    continue
                sums = np.zeros((len(names), len(periods)))
                for k in range(0, len(periods), _PERIODS):
                    for r in range(i, j, 1024):
                        rows_ = slice(r, min(j, r + 1024))
                        phase = np.outer(t[rows_], 2 * math.pi / periods[k : k + _PERIODS])
                        sums[:, k : k + _PERIODS] += terms({c: v[rows_] for c, v in own.items()}, np.cos(phase), np.sin(phase))
                at = pa.array(np.full(len(periods), i))
                held.append(pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in by], pa.array(periods), *map(pa.array, sums)], names=schema.names))
                size += len(periods)
                if size >= _OUT:
                    yield from held
                    held, size = [], 0
        yield from held

    return dealt.mapInArrow(run, schema).groupBy(*by, "period").agg(*[F.sum(c).alias(c) for c in names])


def _limited(df: DataFrame, by: list[str], **columns: str) -> tuple[DataFrame, DataFrame]:
    """(rows, limits): the finite rows with by and the columns as doubles, and _n and _span of each group."""
    rows = df.select(*by, *[F.col(c).cast("double").alias(k) for k, c in columns.items()])
    for k in columns:
        rows = rows.where(sem.is_finite(F.col(k)))
    return rows, rows.groupBy(*by).agg(F.count("*").alias("_n"), (F.max("_t") - F.min("_t")).alias("_span"), F.avg("_y").alias("_m"), F.var_samp("_y").alias("_v"))


def grouped(df: DataFrame, by: list[str], t: str, y: str, grid: Callable[[float], np.ndarray]) -> DataFrame:
    """(by, period, power): the Lomb-Scargle power of each group with three finite rows or more and values that differ, at the periods of grid(span)."""
    rows, limits = _limited(df, by, _t=t, _y=y)
    limits = limits.where("_n >= 3 AND _v > 0")
    both = join_groups(rows, limits, by).select(*by, "_t", "_span", "_n", (F.col("_y") - F.col("_m")).alias("d"))
    terms = lambda v, c, s: np.stack([v["d"] @ c, v["d"] @ s, (c * c - s * s).sum(axis=0), (2 * s * c).sum(axis=0)])
    sums = join_groups(_summed(both, by, ["yc", "ys", "c2", "s2"], terms, grid), limits.select(*by, "_n", "_v"), by)
    a, h, n = F.atan2("s2", "c2") / 2, F.hypot("c2", "s2"), F.col("_n")
    yc = F.col("yc") * F.cos(a) + F.col("ys") * F.sin(a)
    ys = F.col("ys") * F.cos(a) - F.col("yc") * F.sin(a)
    return sums.select(*by, "period", ((sem.fdiv(yc * yc, (n + h) / 2) + sem.fdiv(ys * ys, (n - h) / 2)) / (2 * F.col("_v"))).alias("power"))


def floating_mean(df: DataFrame, by: list[str], t: str, y: str, weight: str, grid: Callable[[float], np.ndarray]) -> DataFrame:
    """(by, period, power): the part of the weighted variance that a sine with a mean of its own explains at each period of grid(span), 0 to 1. Weights must be above 0."""
    rows, limits = _limited(df.where(F.col(weight) > 0), by, _t=t, _y=y, w=weight)
    sides = rows.groupBy(*by).agg(F.sum("w").alias("_w"), (F.sum(F.col("w") * F.col("_y")) / F.sum("w")).alias("_my"))
    both = join_groups(join_groups(rows, limits.select(*by, "_span", "_n"), by), sides, by).withColumn("d", F.col("_y") - F.col("_my"))

    def terms(v, c, s):
        w, wd = v["w"], v["w"] * v["d"]
        return np.stack([w @ c, w @ s, wd @ c, wd @ s, w @ (c * c), w @ (c * s)])

    sums = _summed(both.select(*by, "_t", "_span", "_n", "w", "d"), by, ["C", "S", "YC", "YS", "CC", "CS"], terms, grid)
    yy = both.groupBy(*by).agg(F.first("_w").alias("_w"), (F.sum(F.col("w") * F.col("d") * F.col("d")) / F.sum("w")).alias("_yy"))
    m: dict[str, Column] = {k: F.col(k) / F.col("_w") for k in ("C", "S", "YC", "YS", "CC", "CS")}
    cc, ss, cs, yc, ys = m["CC"] - m["C"] * m["C"], 1 - m["CC"] - m["S"] * m["S"], m["CS"] - m["C"] * m["S"], m["YC"], m["YS"]
    return join_groups(sums, yy, by).select(*by, "period", sem.fdiv(ss * yc * yc + cc * ys * ys - 2 * cs * yc * ys, F.col("_yy") * (cc * ss - cs * cs)).alias("power"))


def best(powers: DataFrame, by: list[str]) -> DataFrame:
    """(by, period, power) of the greatest power of each group, the shortest period of equals."""
    top = powers.where(sem.is_finite(F.col("power"))).groupBy(*by).agg(F.max(F.struct(F.col("power"), (-F.col("period")).alias("p"))).alias("_m"))
    return top.select(*by, (-F.col("_m.p")).alias("period"), F.col("_m.power").alias("power"))


def best_grouped(df: DataFrame, by: list[str], t: str, y: str, grid: Callable[[float], np.ndarray]) -> DataFrame:
    """The same as best(grouped(...)). A group of up to _ROWS rows goes to one task as one row, and the task keeps the best period alone, so what is shuffled grows with the rows and not with rows times periods; larger groups go by sums. Of a long grid by span, sums of single precision first tell which periods can't be the best; only the others' powers are taken exactly."""
    rows, limits = _limited(df, by, _t=t, _y=y)
    limits = limits.where("_n >= 3 AND _v > 0")
    few = limits.where(F.col("_n") <= _ROWS)
    small = join_groups(rows, few, by).select(*by, "_t", "_span", "_v", (F.col("_y") - F.col("_m")).alias("d"))
    schema = StructType([*[small.schema[c] for c in by], StructField("period", DoubleType()), StructField("power", DoubleType())])

    def run(batches):
        for batch in batches:
            held = batch.column("_rows")
            ends = np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy(zero_copy_only=False))])
            at, d = (held.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("_t", "d"))
            spans, variances = (batch.column(c).to_numpy() for c in ("_span", "_v"))
            own = lambda i: (at[ends[i] : ends[i + 1]], d[ends[i] : ends[i + 1]])
            tops: list[tuple[float | None, float]] = [(None, 0.0)] * len(spans)
            late: dict[int, np.ndarray] = {}

            def settle():
                if late:
                    for i, some in zip(late, _periods(grid, spans[list(late)], list(late.values()))):
                        tops[i] = _greatest(*own(i), variances[i], some)
                    late.clear()

            for i, span in enumerate(spans):
                if isinstance(grid, Spanned) and 10 * span / grid.high >= LONG:
                    late[i] = _may_be_best(*own(i), grid, float(span))
                    if sum(map(len, late.values())) > _HELD:
                        settle()
                else:
                    tops[i] = _greatest(*own(i), variances[i], np.asarray(grid(float(span)), dtype=float))
            settle()
            found = pa.array([i for i, x in enumerate(tops) if x[0] is not None], pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(found) for c in by], *[pa.array([x[k] for x in tops if x[0] is not None], pa.float64()) for k in (0, 1)]], names=schema.names)

    cores = df.sparkSession.sparkContext.defaultParallelism
    n, work = few.agg(F.sum("_n"), F.sum(F.col("_n") * F.col("_span"))).first()
    parts = max(2 * cores, int((work or 0) / _WORK), (n or 0) // (64 * _ROWS)) if isinstance(grid, Spanned) else max(2 * cores, (n or 0) // _ROWS)  # stated: rows are few for their work, and would be put together
    one = small.repartition(parts, *by).groupBy(*by).agg(F.first("_span").alias("_span"), F.first("_v").alias("_v"), F.collect_list(F.struct("_t", "d")).alias("_rows"))
    ours = one.mapInArrow(run, schema)
    large = limits.where(F.col("_n") > _ROWS).select(*by)
    if not large.limit(1).count():
        return ours
    return ours.unionByName(best(grouped(join_groups(df, large, by), by, t, y, grid), by))
