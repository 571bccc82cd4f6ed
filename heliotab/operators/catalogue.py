"""Upkeep of a catalogue of objects: new detections find their objects, means follow, catalogues merge."""

from pyspark.sql import Column, DataFrame, functions as F

from heliotab.operators import joins


def match_once(sources: DataFrame, objects: DataFrame, source: str, target: str, radius_arcsec: float, a: tuple[str, str], b: tuple[str, str]) -> DataFrame:
    """(source, target, arcsec): each source goes to its nearest object within the radius, and an object takes the nearest of the sources that come to it, so both are used once at most; the least number wins among equals. Both choices are minima, combined before the shuffle."""
    nearest = joins.nearest(sources, objects, source, target, radius_arcsec, a, b).select(source, f"_m.{target}", "_m.arcsec")
    return nearest.groupBy(target).agg(F.min(F.struct("arcsec", source)).alias("m")).select(f"m.{source}", target, "m.arcsec")


def updated_means(objects: DataFrame, news: DataFrame, key: str, n: str, mean: str, value: str) -> DataFrame:
    """The objects with n and mean over their old values and the new ones; the old values themselves aren't needed. News of keys that aren't there are new objects."""
    sums = news.groupBy(key).agg(F.count(value).alias("_n"), F.sum(value).alias("_s"))
    both = objects.join(sums, key, "full")
    old, more = F.coalesce(n, F.lit(0)), F.coalesce("_n", F.lit(0))
    total = F.coalesce(F.when(old > 0, F.col(mean) * old), F.lit(0.0)) + F.coalesce("_s", F.lit(0.0))
    return both.withColumn("_mean", total / F.when(old + more > 0, old + more)).withColumn(n, old + more).withColumn(mean, F.col("_mean")).drop("_n", "_s", "_mean")


def merged(first: DataFrame, second: DataFrame, key: str, n: str, values: list[str], radius_arcsec: float, position: tuple[str, str]) -> DataFrame:
    """Two catalogues as one: objects of the second that match one of the first are averaged into it by their numbers of measures, the others are added under their own keys. The position stays that of the first."""
    other = second.select(F.col(key).alias("_key"), F.col(position[0]).alias("_ra"), F.col(position[1]).alias("_dec"), F.col(n).alias("_n"), *[F.col(v).alias(f"_{v}") for v in values])
    pairs = match_once(other, first, "_key", key, radius_arcsec, ("_ra", "_dec"), position).drop("arcsec")
    mine = first.join(pairs, key, "left").join(other.drop("_ra", "_dec"), "_key", "left")
    more = F.coalesce("_n", F.lit(0))
    mean = lambda v: ((F.col(v) * F.col(n) + F.coalesce(F.col(f"_{v}"), F.lit(0.0)) * more) / (F.col(n) + more)).alias(v)
    kept = mine.select(key, *position, (F.col(n) + more).alias(n), *map(mean, values))
    added = second.join(pairs.select(F.col("_key").alias(key)), key, "left_anti").select(*kept.columns)
    return kept.unionByName(added)


def without(objects: DataFrame, condition: Column) -> DataFrame:
    """The objects for which the condition doesn't hold, or isn't known."""
    return objects.where(~F.coalesce(condition, F.lit(False)))
