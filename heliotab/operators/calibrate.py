"""Zero points by alternating means: values are taken as the sum of an effect of one key and an effect of another."""

from pyspark.sql import DataFrame, functions as F

from heliotab.functions import sem
from heliotab.operators.store import written


def alternating_means(df: DataFrame, first: str, second: str, value: str, passes: int) -> tuple[DataFrame, DataFrame]:
    """(effects of the first key, of the second), each (key, effect), after so many passes from 0 on.

    The table is reduced to sums for each pair of keys once; passes work on these. The lineage grows by two joins a pass: cut it by a written table for many passes.
    """
    cells = df.groupBy(first, second).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    a = cells.select(first).distinct().withColumn("effect", F.lit(0.0))
    b = None
    for _ in range(passes):
        b = _effects(cells, a, first, second)
        a = _effects(cells, b, second, first)
    return a, b


def _effects(cells: DataFrame, known: DataFrame, by: str, of: str) -> DataFrame:
    return cells.join(known, by).groupBy(of).agg((F.sum(F.col("s") - F.col("n") * F.col("effect")) / F.sum("n")).alias("effect"))


def weighted_offsets(df: DataFrame, first: str, second: str, value: str, weight: str, clip: float = 3.0, passes: int = 10, tolerance: float = 1e-4) -> tuple[DataFrame, DataFrame]:
    """(effects of the first key, of the second), each (key, effect), by alternating weighted means of what the other leaves.

    After each pass, rows whose residual is beyond `clip` weighted standard deviations of all are left out of the next one. Ends when no effect of the second key changes by more than the tolerance, or after so many passes. Effects are written to the shared folder after each pass; the rows are read once a pass for each step.
    """
    rows = df.select(F.col(first).alias("_a"), F.col(second).alias("_b"), F.col(value).cast("double").alias("_v"), F.col(weight).cast("double").alias("_w")).where(sem.is_finite(F.col("_v")) & (F.col("_w") > 0) & F.col("_a").isNotNull() & F.col("_b").isNotNull())
    mean = lambda kept, known, key, of: kept.join(known, key).groupBy(of).agg((F.sum(F.col("_w") * (F.col("_v") - F.col("effect"))) / F.sum("_w")).alias("effect"))
    a, b, kept = rows.select("_a").distinct().withColumn("effect", F.lit(0.0)), None, rows
    for k in range(passes):
        new = written(mean(kept, a, "_a", "_b"))
        a = written(mean(kept, new, "_b", "_a"))
        moved = None if b is None else new.join(b.withColumnRenamed("effect", "old"), "_b").agg(F.max(F.abs(F.col("effect") - F.col("old")))).first()[0]
        b = new
        if k == passes - 1 or (moved is not None and moved <= tolerance):
            break
        residual = F.col("_v") - F.col("ea") - F.col("eb")
        known = lambda r: r.join(a.withColumnRenamed("effect", "ea"), "_a").join(b.withColumnRenamed("effect", "eb"), "_b")
        spread = known(kept).agg(F.sqrt(F.sum(F.col("_w") * residual * residual) / F.sum("_w"))).first()[0]
        kept = known(rows).where(F.abs(residual) <= clip * (spread or 0.0)).select("_a", "_b", "_v", "_w")
    return a.select(F.col("_a").alias(first), "effect"), (b if b is not None else rows.select("_b", F.lit(0.0).alias("effect")).limit(0)).select(F.col("_b").alias(second), "effect")
