"""Subtraction of images whose light is spread differently: a kernel takes the reference to the target, as a sum of Gaussians times polynomials whose coefficients vary over the image.

Pixels are rows (keys of the image, x, y, r, v, stamp): r of the reference, v of the target, and the number of the stamp that the pixel is fitted in (null: in none). A task holds one tile of TILE by TILE pixels and what the kernel reaches around it, so images may be of any size.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from heliotab.operators.store import written

TILE = 64


def kernels(widths: list[tuple[float, int]], half: int) -> np.ndarray:
    """(n, side, side) of Gaussians by their sigma, each times all u^a v^b up to a degree. The first has a sum of one and all others of none, so the first's coefficient alone is the scale of the light."""
    u = np.arange(-half, half + 1.0)
    out: list[np.ndarray] = []
    for sigma, degree in widths:
        g = np.exp(-0.5 * (u / sigma) ** 2)
        for a in range(degree + 1):
            for b in range(degree + 1 - a):
                k = np.outer(g * u**b, g * u**a)
                if a % 2 or b % 2:
                    out.append(k / np.sqrt((k * k).sum()))
                else:
                    out.append(k / k.sum() - (out[0] if out else 0.0))
    return np.stack(out)


def pair(reference: DataFrame, target: DataFrame, by: list[str]) -> DataFrame:
    """The pixels (by, x, y, r, v) of both images, of either where the other lacks one."""
    return reference.select(*by, "x", "y", F.col("v").alias("r")).join(target.select(*by, "x", "y", "v"), [*by, "x", "y"], "full")


def in_stamps(df: DataFrame, stamps: DataFrame, by: list[str], half: int) -> DataFrame:
    """The pixels with the number of their stamp: of the stamps (by, stamp, x, y) whose centre is within `half` along both axes the least, null without one. A stamp is sent to its pixels, and those are joined by equal places."""
    reach = F.sequence(F.lit(-half), F.lit(half))
    sent = stamps.withColumn("_i", F.explode(reach)).withColumn("_j", F.explode(reach))
    places = sent.groupBy(*by, (F.col("x") + F.col("_i")).alias("x"), (F.col("y") + F.col("_j")).alias("y")).agg(F.min("stamp").cast("bigint").alias("stamp"))
    return df.join(places, [*by, "x", "y"], "left")


class Model:
    """What is fitted: kernels, the order over the image of their coefficients and of the background, places scaled by (x - centre) / scale, and the value that counts where the reference has no pixel (None: pixels whose kernel reaches such a place are neither fitted nor subtracted)."""

    def __init__(self, kernels: np.ndarray, order: int = 0, background: int = 0, centre: tuple[float, float] = (0.0, 0.0), scale: float = 1.0, fill: float | None = None):
        self.kernels, self.order, self.background, self.centre, self.scale, self.fill = kernels, order, background, centre, scale, fill
        self.half = kernels.shape[1] // 2
        self.size = len(kernels) * len(self._terms(order)) + len(self._terms(background))

    @staticmethod
    def _terms(order: int) -> list[tuple[int, int]]:
        return [(a, b) for a in range(order + 1) for b in range(order + 1 - a)]

    def design(self, tile: pd.DataFrame, x0: int, y0: int) -> tuple[np.ndarray, pd.DataFrame]:
        """A row of terms for each target pixel of the tile at (x0, y0), and those pixels."""
        side = TILE + 2 * self.half
        grid = np.full((side, side), np.nan if self.fill is None else self.fill)
        there = tile[tile.r.notna()]
        grid[there.y - y0 + self.half, there.x - x0 + self.half] = there.r
        own = tile[tile.x.between(x0, x0 + TILE - 1) & tile.y.between(y0, y0 + TILE - 1) & tile.v.notna()]
        row, column = (own.y - y0).to_numpy(), (own.x - x0).to_numpy()
        windows = np.lib.stride_tricks.sliding_window_view(grid, self.kernels.shape[1:])[row, column]
        light = np.einsum("pyx,kyx->pk", windows, self.kernels[:, ::-1, ::-1], optimize=True)
        sx, sy = ((own[c].to_numpy() - m) / self.scale for c, m in zip("xy", self.centre))
        over = lambda order: np.stack([sx**a * sy**b for a, b in self._terms(order)], axis=1)
        terms = np.hstack([(light[:, :, None] * over(self.order)[:, None, :]).reshape(len(own), len(self.kernels) * len(self._terms(self.order))), over(self.background)])
        whole = ~np.isnan(terms).any(axis=1)
        return terms[whole], own[whole]


def _tiled(df: DataFrame, by: list[str], half: int, *columns: str) -> DataFrame:
    """The pixels by tile; those within the kernel's reach of a border go to the neighbours too."""
    near = lambda c: F.explode(F.sequence(F.floor((F.col(c) - half) / TILE), F.floor((F.col(c) + half) / TILE)))
    real = lambda c: F.when(~F.isnan(c), F.col(c).cast("double")).alias(c)
    rows = df.select(*by, F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"), real("r"), real("v"), *columns)
    return rows.withColumn("_tx", near("x")).withColumn("_ty", near("y"))


def _fields(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def fit(df: DataFrame, by: list[str], model: Model, clip: float = 3.0, rounds: int = 5) -> DataFrame:
    """(by, coefficients, stamps): the least squares over the pixels of all stamps that are kept, and how many these are.

    Pixels are read once: each tile gives the normal equations of each of its stamps. A round adds up those of the stamps that are left, element by element and before the shuffle, solves one system an image, and leaves the stamps out of the next whose root of mean squares is above `clip` times the median of the image's; they come back once they fit, and stamps that the fit meets to a millionth stay. It ends when the same stamps are left out again, or after so many rounds. Images without a pixel to fit have no row. Runs a few jobs while the plan is built.
    """
    m = model.size

    def equations(tile: pd.DataFrame) -> pd.DataFrame:
        terms, own = model.design(tile, int(tile._tx.iloc[0]) * TILE, int(tile._ty.iloc[0]) * TILE)
        out = []
        stamp, v = own.stamp.to_numpy(dtype=float), own.v.to_numpy()
        for s in np.unique(stamp[~np.isnan(stamp)]):
            t, y = terms[stamp == s], v[stamp == s]
            out.append((*tile[by].iloc[0], int(s), np.concatenate([(t.T @ t).ravel(), t.T @ y, [y @ y, len(y)]])))
        return pd.DataFrame(out, columns=[*by, "stamp", "sums"])

    keys = _fields(df, by)
    parts = written(_tiled(df, by, model.half, F.col("stamp").cast("bigint").alias("stamp")).groupBy(*by, "_tx", "_ty").applyInPandas(equations, f"{keys}, stamp bigint, sums array<double>"))

    def solved(sums: pd.DataFrame) -> pd.DataFrame:
        s = sums.sort_values("pos").s.to_numpy()
        c = np.linalg.lstsq(s[: m * m].reshape(m, m), s[m * m : m * m + m], rcond=1e-14)[0]
        return pd.DataFrame([(*sums[by].iloc[0], c)], columns=[*by, "coefficients"])

    def residuals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s, c = np.stack(b.sums) if len(b) else np.zeros((0, m * m + m + 2)), np.stack(b.coefficients) if len(b) else np.zeros((0, m))
            left = s[:, -2] - 2 * (c * s[:, m * m : -2]).sum(axis=1) + np.einsum("ni,nij,nj->n", c, s[:, : m * m].reshape(-1, m, m), c)
            yield b[[*by, "stamp"]].assign(left=np.maximum(left, 0.0), light=s[:, -2], n=s[:, -1])

    kept, last = parts, None
    for k in range(rounds):
        sums = kept.select(*by, F.posexplode("sums").alias("pos", "s")).where(F.col("pos") < m * m + m).groupBy(*by, "pos").agg(F.sum("s").alias("s"))
        found = written(sums.groupBy(*by).applyInPandas(solved, f"{keys}, coefficients array<double>"))
        if k == rounds - 1:
            break
        each = parts.join(found, by).mapInPandas(residuals, f"{keys}, stamp bigint, left double, light double, n double")
        each = written(each.groupBy(*by, "stamp").agg((F.sum("left") / F.sum("n")).alias("square"), (F.sum("light") / F.sum("n")).alias("light")))
        middle = each.groupBy(*by).agg(F.percentile_approx("square", 0.5, 10000).alias("middle"))
        bad = written(each.join(middle, by).where((F.col("square") > clip * clip * F.col("middle")) & (F.col("square") > 1e-12 * F.col("light"))).select(*by, "stamp"))
        if not (bad if last is None else bad.exceptAll(last).union(last.exceptAll(bad))).limit(1).count():
            break
        kept, last = parts.join(bad, [*by, "stamp"], "left_anti"), bad
    return found.join(kept.groupBy(*by).agg(F.countDistinct("stamp").alias("stamps")), by)


def difference(df: DataFrame, by: list[str], model: Model, found: DataFrame) -> DataFrame:
    """(by, x, y, v): the target's pixels less the reference through the kernel and the background. Images without a fit have no rows."""
    types = {c: df.schema[c].dataType.simpleString() for c in ("x", "y")}

    def left(tile: pd.DataFrame) -> pd.DataFrame:
        terms, own = model.design(tile, int(tile._tx.iloc[0]) * TILE, int(tile._ty.iloc[0]) * TILE)
        return own[[*by, "x", "y"]].assign(v=own.v.to_numpy() - terms @ np.asarray(tile.coefficients.iloc[0]))

    rows = _tiled(df, by, model.half).join(found.select(*by, "coefficients"), by)
    out = rows.groupBy(*by, "_tx", "_ty").applyInPandas(left, f"{_fields(df, by)}, x bigint, y bigint, v double")
    return out.select(*by, F.col("x").cast(types["x"]).alias("x"), F.col("y").cast(types["y"]).alias("y"), "v")


def kernel_at(found: DataFrame, by: list[str], model: Model, x: float, y: float) -> DataFrame:
    """(by, i, j, k): the kernel of each image at a place; light at (x, y) of the reference goes to (x + i, y + j)."""
    over = np.array([((x - model.centre[0]) / model.scale) ** a * ((y - model.centre[1]) / model.scale) ** b for a, b in model._terms(model.order)])
    flat = np.einsum("nij,t->ntij", model.kernels, over).reshape(-1, *model.kernels.shape[1:])
    j, i = np.mgrid[-model.half : model.half + 1, -model.half : model.half + 1]

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for n, c in zip(b[by].itertuples(index=False), b.coefficients):
                k = np.tensordot(np.asarray(c)[: len(flat)], flat, 1)
                yield pd.DataFrame({**dict(zip(by, n)), "i": i.ravel(), "j": j.ravel(), "k": k.ravel()})

    return found.mapInPandas(spread, f"{_fields(found, by)}, i int, j int, k double")
