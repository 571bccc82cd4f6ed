"""Connected components of a graph that no task and no driver holds."""

from pyspark.sql import DataFrame, functions as F

from heliotab.llm.common import materialised


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (a, b) but the roots, which are the least nodes of their components.

    Large-star and small-star steps take turns until the edges don't change; each step is a grouped minimum, combined before the shuffle, and a join with it, which Spark can split where a node has many neighbours. Edges from a node to itself and repeated ones change nothing; no edges give no rows.
    """
    now = materialised(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if seen == mark or not seen["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = materialised(small.distinct())
