"""Connected components of a graph of any size."""

from pyspark.sql import DataFrame, functions as F

from heliotab.operators.store import written


def chains(points: DataFrame, key: str, x: str, reach: float) -> DataFrame:
    """(key, root): points whose numbers x differ by less than `reach` are linked, and so on from one to the next; root is the least key of a chain. Points in a cell of half the reach are all linked, so only cells, with their least and greatest numbers, are paired, each with the three above. Points without a number are alone."""
    cells = points.where(F.col(x).isNotNull() & ~F.isnan(x)).groupBy(F.floor(F.col(x) / (reach / 2)).alias("cell")).agg(F.min(x).alias("low"), F.max(x).alias("high"), F.min(key).alias("least"))
    cells = written(cells)
    above = cells.select(F.explode(F.array(*[F.col("cell") - i for i in (1, 2, 3)])).alias("cell"), F.col("cell").alias("b"), F.col("low").alias("_low"))
    roots = components(cells.join(above, "cell").where(F.col("_low") - F.col("high") < reach).select(F.col("cell").alias("a"), "b"))
    named = cells.join(roots.withColumnRenamed("node", "cell"), "cell", "left").withColumn("root", F.coalesce("root", "cell"))
    named = named.join(named.groupBy("root").agg(F.min("least").alias("_name")), "root").select("cell", "_name")
    own = F.when(~F.isnan(x), F.floor(F.col(x) / (reach / 2)))
    return points.withColumn("cell", own).join(named, "cell", "left").select(key, F.coalesce("_name", key).alias("root"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes of the edges (a, b), with the least node of each component as its root.

    Each round gives a node the least of its own label and those of its neighbours, then the label of its label; both are minima that are combined before the shuffle. Labels are written to the shared folder after each round, of which there are about as many as the logarithm of the longest path; labels are long columns that pack into small files, so they are merged and not broadcast. No edges give no rows.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")))
    while True:
        near = both.join(labels.hint("merge"), both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lower = labels.join(near.hint("merge"), "node").select("node", F.least("root", "near").alias("next"), "root")
        up = labels.select(F.col("node").alias("next"), F.col("root").alias("up"))
        new = written(lower.join(up.hint("merge"), "next").select("node", "root", F.least("next", "up").alias("new")))
        labels = new.select("node", F.col("new").alias("root"))
        if not new.where("new <> root").limit(1).count():
            return labels
