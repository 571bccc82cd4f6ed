"""Random numbers, samples and resampling by hashes of keys: the same in every run, at any partitioning, and without a shuffle."""

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F


def uniform(key: Column, seed: Column | int) -> Column:
    """From 0 to below 1, by the first 52 bits of the MD5 of `key:seed`."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(":"), seed.cast("string"))), 1, 13), 16, 10).cast("bigint") / float(1 << 52)


def gaussian(key: Column, seed: int, mean: float = 0.0, sigma: float = 1.0) -> Column:
    """Normal deviates, from two uniform numbers of neighbouring seeds (Box and Muller)."""
    return mean + sigma * F.sqrt(-2 * F.log(1 - uniform(key, seed))) * F.cos(2 * math.pi * uniform(key, seed + 1))


def poisson_weight(u: Column, most: int = 4) -> Column:
    """0 to `most` with the probabilities of a Poisson variable of mean 1, by a uniform number; the last takes what is beyond."""
    steps = list(accumulate(math.exp(-1) / math.factorial(k) for k in range(most)))
    out = F.lit(most)
    for k in range(most - 1, -1, -1):
        out = F.when(u < steps[k], k).otherwise(out)
    return out


def bootstrap(df: DataFrame, by: list[str], key: Column, value: Column, replicas: int) -> DataFrame:
    """(by, replica, weight, total, mean) of each bootstrap replica: each row counts in it with a Poisson weight of its own. Weighted sums are combined before the shuffle."""
    w = poisson_weight(uniform(F.col("_key"), F.col("replica")))
    rows = df.select(*by, key.alias("_key"), value.cast("double").alias("_v"), F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))).alias("replica")).withColumn("_w", w)
    sums = rows.groupBy(*by, "replica").agg(F.sum("_w").alias("weight"), F.sum(F.col("_w") * F.col("_v")).alias("total"))
    return sums.withColumn("mean", F.col("total") / F.when(F.col("weight") > 0, F.col("weight")))
