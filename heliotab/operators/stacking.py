"""Stacks of images with pixels rejected by their own variance, and masks that are confirmed and grown through the kernel that spread the light."""

from pyspark.sql import DataFrame, functions as F

from heliotab.operators.store import written


def deviant(df: DataFrame, by: list[str], image: str, clip: float, rounds: int) -> DataFrame:
    """(image, by, x, y) of the pixels (image, by, x, y, v, var) that deviate from the weighted mean of the other images by more than `clip` sigmas of both.

    A round gives up the worst image of each pixel (of equal ones the greatest name) and goes on with the pixels that lost one; pixels of fewer than three images lose none, for of two none is the odd one. Sums by place are combined before the shuffle, so a stack may be of any depth. Pixels with null or NaN values, or without a variance above zero, take no part.
    """
    place = [*by, "x", "y"]
    w = 1 / F.col("var")
    rows = df.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.col("var") > 0) & ~F.isnan("var")).select(image, *place, "v", "var")
    found = None
    for _ in range(rounds):
        sums = rows.groupBy(*place).agg(F.count("*").alias("_n"), F.sum(w).alias("_w"), F.sum(F.col("v") * w).alias("_s")).where("_n >= 3")
        others = F.col("_w") - w
        off = F.pow(F.col("v") - (F.col("_s") - F.col("v") * w) / others, F.lit(2.0)) / (F.col("var") + 1 / others)
        worst = rows.join(sums, place).groupBy(*place).agg(F.max(F.struct(off.alias("off"), F.col(image).alias("image"))).alias("_m"))
        bad = written(worst.where(F.col("_m.off") > clip * clip).select(F.col("_m.image").alias(image), *place))
        found = bad if found is None else found.unionByName(bad)
        if not bad.limit(1).count():
            break
        rows = written(rows.join(bad.select(*place), place, "left_semi").join(bad, [image, *place], "left_anti"))
    return found


def spread_mask(mask: DataFrame, by: list[str], kernel: dict[tuple[int, int], float], limit: float) -> DataFrame:
    """(by, x, y) of all places where the mask, sent on by kernel[(i, j)] to (x + i, y + j), is above `limit` times the kernel's sum. The work grows with the mask, not with the image."""
    total = float(sum(kernel.values()))
    parts = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k / total).alias("k")) for (i, j), k in kernel.items()])
    sent = mask.select(*by, "x", "y", F.explode(parts).alias("_p"))
    sums = sent.groupBy(*by, (F.col("x") + F.col("_p.i")).alias("x"), (F.col("y") + F.col("_p.j")).alias("y")).agg(F.sum("_p.k").alias("_k"))
    return sums.where(F.col("_k") > limit).drop("_k")


def rejected(df: DataFrame, by: list[str], image: str, clip: float, rounds: int, kernel: dict[tuple[int, int], float], threshold: float, poor: float) -> DataFrame:
    """(image, by, x, y) of the pixels that a stack leaves out. The images were spread by `kernel` before: deviant pixels are matched with it, and places where more than `threshold` of its weight is deviant were bad before the spread; all that more than `poor` of the kernel takes from these goes. Deviant pixels that no bad place explains stay."""
    keys = [image, *by]
    back = {(-i, -j): k for (i, j), k in kernel.items()}
    sources = spread_mask(deviant(df, by, image, clip, rounds), keys, back, threshold)
    return spread_mask(sources, keys, kernel, poor)


def stacked(df: DataFrame, by: list[str], image: str, mask: DataFrame) -> DataFrame:
    """(by, x, y, n, v, var): the mean weighted by variance of the pixels that the mask (image, by, x, y) leaves. Places without one have no row."""
    place = [*by, "x", "y"]
    good = F.col("v").isNotNull() & ~F.isnan("v") & (F.col("var") > 0) & ~F.isnan("var")
    left = df.where(good).join(mask, [image, *place], "left_anti")
    w = 1 / F.col("var")
    return left.groupBy(*place).agg(F.count("*").alias("n"), (F.sum(F.col("v") * w) / F.sum(w)).alias("v"), (1 / F.sum(w)).alias("var"))
