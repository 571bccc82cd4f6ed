"""Joins by keys of which a few may have very many rows."""

from pyspark.sql import DataFrame, functions as F

#: Rows of a key in one task, and keys that are dealt to several tasks at most: with more rows, only larger keys are, so the list of them, which is broadcast, has a fixed bound.
ROWS, MOST = 1024, 8192


def join_counted(rows: DataFrame, values: DataFrame, keys: list[str], salt: list[str], how: str = "inner") -> DataFrame:
    """The rows with the columns of the one row that `values` has for a key; its column `rows` says how many rows the key has. A key with many is dealt to several tasks, by a hash of the columns in salt, and its value sent to each."""
    size = max(ROWS, (values.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]) // MOST)
    parts = F.ceil(F.col("rows") / size).cast("int")
    split = F.broadcast(values.where(F.col("rows") > size).select(*keys, parts.alias("_parts")))
    ours = rows.join(split, keys, "left").withColumn("_part", F.pmod(F.xxhash64(*salt), F.coalesce("_parts", F.lit(1)))).drop("_parts")
    theirs = values.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))).drop("rows")
    return ours.join(theirs, [*keys, "_part"], how).drop("_part")
