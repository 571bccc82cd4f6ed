"""Grouping by bins of numbers."""

from pyspark.sql import Column, DataFrame, functions as F

from heliotab.functions import sem
from heliotab.operators import ranks


def bin_count(start: float, end: float, delta: float) -> int:
    return int((end - start) / (delta if start <= end else -abs(delta)))


def clamped_bin(x: Column, start: float, end: float, delta: float) -> Column:
    """The bin of x; what lies outside falls into the first or last bin; null for NaN and null."""
    step = delta if start <= end else -abs(delta)
    n = bin_count(start, end, delta)
    place = F.least(F.greatest((x - start) / step, F.lit(-1.0)), F.lit(float(n)))
    return F.when(x.isNotNull() & ~F.isnan(x), F.least(F.greatest(place.cast("bigint"), F.lit(0)), F.lit(n - 1)).cast("int"))


def dense(df: DataFrame, key: str, n: int, fill: dict) -> DataFrame:
    """A row for each of 0 to n - 1, missing ones filled."""
    every = df.sparkSession.range(n).select(F.col("id").cast("int").alias(key))
    return every.join(df, key, "left").fillna(fill)


def histogram(df: DataFrame, x: str, start: float, end: float, delta: float) -> DataFrame:
    """(bin, x_low, n) of all bins."""
    step = delta if start <= end else -abs(delta)
    n = bin_count(start, end, delta)
    counted = df.select(clamped_bin(F.col(x), start, end, delta).alias("bin")).where("bin IS NOT NULL").groupBy("bin").agg(F.count("*").alias("n"))
    return dense(counted, "bin", n, {"n": 0}).select("bin", (F.lit(start) + F.col("bin") * step).cast("double").alias("x_low"), "n")


def histogram_nd(df: DataFrame, axes: list[tuple[str, float, float, float]]) -> DataFrame:
    """Counts in the cells of several axes (column, start, end, delta) that have rows: b0, b1, ..., n."""
    keys = [clamped_bin(F.col(x), s, e, d).alias(f"b{i}") for i, (x, s, e, d) in enumerate(axes)]
    cells = df.select(*keys).dropna()
    return cells.groupBy(*cells.columns).agg(F.count("*").alias("n"))


def accumulate(df: DataFrame, key: str, value: str, start: float, end: float, delta: float, mean: bool = False) -> DataFrame:
    """(bin, value): the sum, or the mean, of the values whose keys fall into each clamped bin; empty bins have 0, or NaN for the mean."""
    n = bin_count(start, end, delta)
    agg = F.avg("v") if mean else F.sum("v")
    summed = df.select(clamped_bin(F.col(key), start, end, delta).alias("bin"), F.col(value).alias("v")).where("bin IS NOT NULL").groupBy("bin").agg(agg.alias("value"))
    return dense(summed, "bin", n, {"value": sem.NAN if mean else 0.0})


def inner_mean(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, used): the mean of each group's sorted finite values from place n / 4 up to 3 n / 4, rounded outwards."""
    return ranks.window_mean(df, by, value, F.floor(F.col("n") * 0.25), F.ceil(F.col("n") * 0.75))


def list_mean(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, value, used): the mean of each group's sorted finite values from place n / 4 + 1/2 up to 3 n / 4 + 1/4, cut to whole places; of all, where there are two or three; a single value gives none."""
    n = F.col("n")
    few = n <= 3
    found = ranks.window_mean(df, by, value, F.when(few, 0).otherwise(F.floor(n * 0.25 + 0.5)), F.when(n < 2, 0).when(few, n).otherwise(F.floor(n * 0.75 + 0.25)))
    return found


def gridify(df: DataFrame, x: str, y: str, z: str, x_axis: tuple[float, float, float], y_axis: tuple[float, float, float]) -> DataFrame:
    """(ix, iy, value, n): the mean of z in each cell; points outside the axes (start, end, delta) are dropped."""

    def cell(c: str, axis: tuple[float, float, float]) -> Column:
        return F.when((F.col(c) >= axis[0]) & (F.col(c) < axis[1]), F.floor((F.col(c) - axis[0]) / axis[2])).cast("int")

    return df.select(cell(x, x_axis).alias("ix"), cell(y, y_axis).alias("iy"), F.col(z).alias("z")).where("ix IS NOT NULL AND iy IS NOT NULL").groupBy("ix", "iy").agg(F.avg("z").alias("value"), F.count("*").alias("n"))


def grouped_by_edges(df: DataFrame, x: str, value: str, edges: list[float]) -> DataFrame:
    """(bin, n, mean, median) for each pair of neighbouring edges, both included, so a value on an edge counts twice. The edges are a literal array: no join."""
    pairs = F.array(*[F.struct(F.lit(i).alias("bin"), F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for i, (a, b) in enumerate(zip(edges, edges[1:]))])
    hits = df.select(F.col(value).alias("v"), F.explode(F.filter(pairs, lambda p: F.col(x).between(p["a"], p["b"]))).alias("p")).select(F.col("p.bin").alias("bin"), "v")
    means = hits.groupBy("bin").agg(F.count("*").alias("n"), F.avg("v").alias("mean"))
    return means.join(ranks.quantiles(hits, ["bin"], "v", {"median": 0.5}), "bin", "left")
