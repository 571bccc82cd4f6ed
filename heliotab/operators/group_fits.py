"""Fits of many groups at once. A group's rows are reduced to sums before the shuffle; one row a group is solved by numpy, in batches; what a pass finds is written to the shared folder."""

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from heliotab.functions import sem
from heliotab.operators.ranks import join_groups
from heliotab.operators.store import written


def _solved(sums: DataFrame, by: list[str], n: int) -> DataFrame:
    """(by, c, n, chi) from rows of (by, m, t, yy, n): c solves the normal equations, null where they have no single solution; chi is the weighted sum of squared residuals."""
    schema = StructType([*(sums.schema[c] for c in by), StructField("c", ArrayType(DoubleType())), StructField("n", sums.schema["n"].dataType), StructField("chi", DoubleType())])
    names = [f"b{i}" for i in range(len(by))]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out, chi = [], []
            for m, t, yy in zip(frame["m"], frame["t"], frame["yy"]):
                a, b = np.array(m, dtype=float).reshape(n, n), np.array(t, dtype=float)
                scale = np.sqrt(np.maximum(np.diag(a), 1e-300))
                whole = np.linalg.matrix_rank(a / np.outer(scale, scale), tol=1e-11) == n
                c = np.linalg.solve(a, b) if whole else None
                out.append(None if c is None else c.tolist())
                chi.append(None if c is None else float(max(0.0, yy - c @ b)))
            yield frame[names].assign(c=out, n=frame["n"], chi=chi)

    renamed = sums.select(*[F.col(c).alias(b) for c, b in zip(by, names)], "m", "t", "yy", "n")
    inner = StructType([StructField(b, f.dataType) for b, f in zip(names, schema.fields)] + schema.fields[len(by) :])
    return renamed.mapInPandas(solve, inner).toDF(*schema.names)


def _sums(rows: DataFrame, by: list[str], terms: int, weight: Column) -> DataFrame:
    t = [F.col(f"t{i}") for i in range(terms)]
    pairs = [F.sum(weight * a * b) for a in t for b in t]
    return rows.groupBy(*by).agg(F.array(*pairs).alias("m"), F.array(*[F.sum(weight * a * F.col("y")) for a in t]).alias("t"), F.sum(weight * F.col("y") * F.col("y")).alias("yy"), F.count("*").alias("n"))


def value_of(c: Column, terms: int) -> Column:
    """The fitted value of a row with t0, t1, ..., by the coefficients c."""
    return sum((F.get(c, F.lit(i)) * F.col(f"t{i}") for i in range(terms)), F.lit(0.0))


def linear(df: DataFrame, by: list[str], terms: list[Column], y: Column, sigma: Column | None = None, clip: float | None = None, passes: int = 3, robust: bool = False) -> DataFrame:
    """(by, c, n, chi): least-squares coefficients of the terms for each group, weighted by 1 / sigma^2 where a sigma is given.

    clip: each pass but the first leaves out the rows whose residual is beyond so many standard deviations of those of the last fit (with weights, of residuals in sigmas). robust: each pass but the first weighs the rows by 1 / (1 + d^2) too, d being the residual in standard deviations (Cauchy). Weights belong to their rows whatever is left out. Rows with a null, NaN or infinity don't count.
    """
    n = len(terms)
    rows = df.select(*by, *[t.cast("double").alias(f"t{i}") for i, t in enumerate(terms)], y.cast("double").alias("y"), (F.lit(1.0) if sigma is None else sigma.cast("double")).alias("s"))
    all_ = sum((F.col(c) for c in rows.columns if c not in by), F.lit(0.0))
    rows = rows.where(sem.is_finite(all_) & (F.col("s") > 0))
    w = 1 / (F.col("s") * F.col("s"))
    now = _solved(_sums(rows, by, n, w), by, n)
    for _ in range(passes - 1 if clip is not None or robust else 0):
        now = written(now)
        sd = F.sqrt(F.col("chi") / F.greatest(F.col("n") - n, F.lit(1)))
        known = join_groups(rows, now.select(*by, "c", sd.alias("sd")), by)
        d = (F.col("y") - value_of(F.col("c"), n)) / F.col("s")
        if clip is not None:
            known = known.where(F.abs(d) <= clip * F.col("sd") + 1e-12)
        weight = w / (1 + F.when(F.col("sd") > 0, d * d / (F.col("sd") * F.col("sd"))).otherwise(0.0)) if robust else w
        now = _solved(_sums(known.where("c IS NOT NULL"), by, n, weight), by, n).unionByName(now.where("c IS NULL"))
    return now


def polynomial(df: DataFrame, by: list[str], x: Column, y: Column, order: int, **options) -> DataFrame:
    """As linear(), with the powers of x."""
    return linear(df, by, [F.pow(x, F.lit(float(k))) for k in range(order + 1)], y, **options)


#: Shapes by name: the value, and its derivatives by the parameters, as functions of x and of the list of parameters.
SHAPES: dict[str, Callable[[Column, list[Column]], tuple[Column, list[Column]]]] = {}


def _shape(f):
    SHAPES[f.__name__] = f
    return f


@_shape
def gaussian(x, p):
    """Background, height, centre, width."""
    u = (x - p[2]) / p[3]
    e = F.exp(-u * u / 2)
    return p[0] + p[1] * e, [F.lit(1.0), e, p[1] * e * u / p[3], p[1] * e * u * u / p[3]]


@_shape
def lorentzian(x, p):
    """Background, height, centre, half width."""
    u = (x - p[2]) / p[3]
    q = 1 / (1 + u * u)
    return p[0] + p[1] * q, [F.lit(1.0), q, 2 * p[1] * q * q * u / p[3], 2 * p[1] * q * q * u * u / p[3]]


@_shape
def sigmoid(x, p):
    """Background, height, centre, width."""
    e = 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -(x - p[2]) / p[3]))))
    slope = p[1] * e * (1 - e)
    return p[0] + p[1] * e, [F.lit(1.0), e, -slope / p[3], -slope * (x - p[2]) / (p[3] * p[3])]


@_shape
def maxwellian(x, p):
    """Height and scale: height * (x / scale)^2 * exp(-(x / scale)^2 / 2)."""
    u = x / p[1]
    e = F.exp(-u * u / 2)
    return p[0] * u * u * e, [u * u * e, p[0] * e * u * u * (u * u - 2) / p[1]]


def nonlinear(df: DataFrame, by: list[str], x: Column, y: Column, shape: str, start: DataFrame, sigma: Column | None = None, passes: int = 30, tolerance: float = 1e-10) -> DataFrame:
    """(by, p, chi, n): the parameters of a shape for each group by Levenberg and Marquardt's method, from `start` (by, p: an array) on.

    Each pass sums the normal equations and the misfit of the current trial, a row a group; where the trial is better than the last, it is kept and the damping falls, else the damping rises. Groups end where a step changes the misfit by less than the tolerance, all after so many passes.
    """
    many = start.select(F.size("p")).first()
    if many is None:
        return start.select(*by, "p", F.lit(None).cast("double").alias("chi"), F.lit(0).cast("long").alias("n"))
    m = many[0]
    rows = df.select(*by, x.cast("double").alias("x"), y.cast("double").alias("y"), (F.lit(1.0) if sigma is None else sigma.cast("double")).alias("s"))
    rows = rows.where(sem.is_finite(F.col("x") + F.col("y") + F.col("s")) & (F.col("s") > 0))
    kept = StructType([*(start.schema[c] for c in by), *StructType.fromDDL("p array<double>, chi double, n long, trial array<double>, matrix array<double>, side array<double>, damping double, done boolean")])
    names = [f"b{i}" for i in range(len(by))]
    inner = StructType([StructField(b, f.dataType) for b, f in zip(names, kept.fields)] + kept.fields[len(by) :])
    state = start.select(*by, F.lit(None).cast("array<double>").alias("p"), F.lit(None).cast("double").alias("chi"), F.lit(0).cast("long").alias("n"), F.col("p").cast("array<double>").alias("trial"), *[F.lit(None).cast("array<double>").alias(c) for c in ("matrix", "side")], F.lit(1e-3).alias("damping"), F.lit(False).alias("done"))

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out = []
            for r in frame.to_dict("records"):
                p, chi, matrix, side, damping, done, n = r["p"], r["chi"], r["matrix"], r["side"], r["damping"], r["done"], r["n"]
                if not done:
                    new = r["new_chi"]
                    fits = r["new_n"] and new is not None and math.isfinite(new)
                    if fits and (p is None or new <= chi):
                        done = p is not None and chi - new <= tolerance * max(chi, 1e-300)
                        p, chi, matrix, side, n = r["trial"], new, r["new_matrix"], r["new_side"], r["new_n"]
                        damping = max(damping / 10, 1e-12)
                    else:
                        damping *= 10
                        done = p is None or damping > 1e12
                trial = p
                if not done:
                    a, b = np.array(matrix, dtype=float).reshape(m, m), np.array(side, dtype=float)
                    a = a + damping * np.diag(np.maximum(np.diag(a), 1e-12))
                    trial = (np.array(p, dtype=float) + np.linalg.lstsq(a, b, rcond=None)[0]).tolist()
                out.append([*(r[b] for b in names), p, chi, n, trial, matrix, side, damping, done])
            yield pd.DataFrame(out, columns=inner.names).astype({"n": "int64", "chi": "float64"})

    for _ in range(passes):
        state = written(state)
        known = join_groups(rows, state.where("NOT done").select(*by, "trial"), by)
        value, slopes = SHAPES[shape](F.col("x"), [F.get("trial", F.lit(i)) for i in range(m)])
        known = known.select(*by, ((F.col("y") - value) / F.col("s")).alias("r"), *[(g / F.col("s")).alias(f"g{i}") for i, g in enumerate(slopes)])
        g = [F.col(f"g{i}") for i in range(m)]
        sums = known.groupBy(*by).agg(F.sum(F.col("r") * F.col("r")).alias("new_chi"), F.count("*").alias("new_n"), F.array(*[F.sum(a * b) for a in g for b in g]).alias("new_matrix"), F.array(*[F.sum(a * F.col("r")) for a in g]).alias("new_side"))
        both = join_groups(state, sums, by, "left").withColumn("new_n", F.coalesce("new_n", F.lit(0)))
        both = both.select(*[F.col(c).alias(b) for c, b in zip(by, names)], *[c for c in both.columns if c not in by])
        state = written(both.mapInPandas(step, inner).toDF(*kept.names))
        if not state.where("NOT done").limit(1).count():
            break
    return state.select(*by, "p", "chi", "n")


def motion_and_parallax(df: DataFrame, by: list[str], x: Column, y: Column, t: Column, factor_x: Column, factor_y: Column, sigma: Column | None = None, **options) -> DataFrame:
    """(by, x0, mu_x, y0, mu_y, parallax, n, chi): positions along two axes as a start, a motion and a parallax that both share, by one least-squares fit; options as in linear(). n counts both coordinates of each row."""
    zero = F.lit(0.0)
    s = F.lit(1.0) if sigma is None else sigma
    halves = [F.struct(v.cast("double").alias("v"), *[k.cast("double").alias(f"k{i}") for i, k in enumerate(terms)], s.cast("double").alias("s")) for v, terms in ((x, (F.lit(1.0), t, zero, zero, factor_x)), (y, (zero, zero, F.lit(1.0), t, factor_y)))]
    rows = df.select(*by, F.explode(F.array(*halves)).alias("h")).select(*by, "h.*")
    out = linear(rows, by, [F.col(f"k{i}") for i in range(5)], F.col("v"), sigma=F.col("s"), **options)
    return out.select(*by, *[F.get("c", F.lit(i)).alias(name) for i, name in enumerate(("x0", "mu_x", "y0", "mu_y", "parallax"))], "n", "chi")


def ellipse(df: DataFrame, by: list[str], x: Column, y: Column) -> DataFrame:
    """(by, x, y, major, minor, angle, n): the ellipse through the points of each group by least squares on a x^2 + b x y + c y^2 + d x + e y = 1, with its half axes and the angle of the longer one in degrees, -90 to 90; null where the points lie on none. Points should lie around the origin."""
    fit = linear(df, by, [x * x, x * y, y * y, x, y], F.lit(1.0))
    a, b, c, d, e = (F.get("c", F.lit(i)) for i in range(5))
    under = F.when(4 * a * c - b * b > 0, 4 * a * c - b * b)
    x0, y0 = (b * e - 2 * c * d) / under, (b * d - 2 * a * e) / under
    level = 1 + a * x0 * x0 + b * x0 * y0 + c * y0 * y0
    half, root = (a + c) / 2, F.hypot((a - c) / 2, b / 2)
    angle = F.degrees(F.atan2(-b, c - a)) / 2
    return fit.select(*by, x0.alias("x"), y0.alias("y"), F.sqrt(level / (half - root)).alias("major"), F.sqrt(level / (half + root)).alias("minor"), angle.alias("angle"), "n")


def best_template(df: DataFrame, templates: DataFrame, by: list[str], band: str, value: str, sigma: str, name: str) -> DataFrame:
    """(by, name, scale, chi): the template (name, band, value) that fits each group's values best, with its scale by weighted least squares. Templates are few: they are broadcast by band, and each group keeps one row a template."""
    t = templates.select(F.col(name), F.col(band), F.col(value).alias("_t"))
    w = 1 / (F.col(sigma) * F.col(sigma))
    v = F.col(value)
    sums = df.join(F.broadcast(t), band).groupBy(*by, name).agg(F.sum(w * v * F.col("_t")).alias("vt"), F.sum(w * F.col("_t") * F.col("_t")).alias("tt"), F.sum(w * v * v).alias("vv"))
    fit = sums.where("tt > 0").select(*by, name, (F.col("vt") / F.col("tt")).alias("scale"), (F.col("vv") - F.col("vt") * F.col("vt") / F.col("tt")).alias("chi"))
    return fit.groupBy(*by).agg(F.min(F.struct("chi", name, "scale")).alias("_m")).select(*by, f"_m.{name}", "_m.scale", "_m.chi")
