"""Images on the sky: which positions lie in which, and how deeply the sky is covered.

An image is a row with a centre (ra0, dec0), half sizes in degrees (half_x, half_y) on the plane that touches the sky there, and a position angle from north over east (angle).
"""

import math

from pyspark.sql import Column, DataFrame, functions as F

from heliotab.functions import sky
from heliotab.operators import joins


def inside(ra: Column, dec: Column) -> Column:
    """Whether a position lies in the image of the same row; borders count."""
    x, y = sky.tangent_plane(ra, dec, F.col("ra0"), F.col("dec0"))
    c, s = F.cos(F.radians("angle")), F.sin(F.radians("angle"))
    return F.coalesce((F.abs(x * c - y * s) <= F.col("half_x")) & (F.abs(x * s + y * c) <= F.col("half_y")), F.lit(False))


def containing(positions: DataFrame, images: DataFrame, ra: str, dec: str, largest: float, by: list[str] | None = None) -> DataFrame:
    """All pairs of a position and an image that holds it, with equal columns `by`. `largest`: the longest half diagonal of an image, in degrees. Images are sent to the cells around their centres, positions to their own, and both are merged; no pairs are made beyond a cell's reach. Counts both sides while the plan is built."""
    reach = math.radians(largest * 1.001)
    near = joins.sky_near(images, positions, reach, ("ra0", "dec0"), (ra, dec), by, joins.sky_tasks(images, positions, reach))
    return near.where(inside(F.col(ra), F.col(dec)))


#: Rows of a key that are listed together.
LISTED = 1024


def listed(rows: DataFrame, keys: list[str], salt: str) -> DataFrame:
    """(keys, rows): rows with equal keys as lists of some LISTED structs of the other columns, so that what belongs to a position is joined once and not shuffled again by each image that holds it. Rows of a key with more are dealt to several lists by a hash of the column `salt`; rows with a null key are left out."""
    rows = rows.dropna(subset=keys)
    crowds = F.broadcast(rows.groupBy(*keys).agg(F.ceil(F.count("*") / LISTED).alias("_parts")).where("_parts > 1"))
    part = F.pmod(F.xxhash64(salt), F.coalesce("_parts", F.lit(1)))
    other = [c for c in rows.columns if c not in keys]
    return rows.join(crowds, keys, "left").groupBy(*keys, part.alias("_part")).agg(F.collect_list(F.struct(*other)).alias("rows")).drop("_part")


def grid(images: DataFrame, step: float, largest: float) -> DataFrame:
    """(ra, dec, image columns) of the points of a grid of `step` degrees in both coordinates that lie in each image: the points around its centre, by a range of each image's own."""
    reach = largest * 1.001
    low, high = F.greatest(F.col("dec0") - reach, F.lit(-90.0)), F.least(F.col("dec0") + reach, F.lit(90.0))
    dec = F.explode(F.sequence(F.floor((low + 90) / step), F.floor((high + 90) / step)))
    rows = images.withColumn("_d", dec).withColumn("dec", F.col("_d") * step - 90 + step / 2).where("dec < 90")
    wide = F.when(F.greatest(F.abs(F.col("dec0")), F.abs(F.col("dec"))) + reach >= 90, F.lit(180.0)).otherwise(F.least(F.lit(180.0), reach / F.cos(F.radians(F.least(F.greatest(F.abs(F.col("dec0")), F.abs(F.col("dec"))) + reach, F.lit(89.999))))))
    n = round(360 / step)
    first = F.floor((F.col("ra0") - wide) / step)
    ra = F.explode(F.sequence(first, F.least(F.floor((F.col("ra0") + wide) / step), first + n - 1)))
    points = rows.withColumn("_r", ra).withColumn("ra", F.pmod(F.col("_r") * step + step / 2, F.lit(360.0)))
    return points.where(inside(F.col("ra"), F.col("dec"))).drop("_d", "_r")


def coverage(images: DataFrame, step: float, largest: float, value: str) -> DataFrame:
    """(ra, dec, n, low, high) for each grid point in an image: how many hold it, and the least and greatest of a column."""
    return grid(images, step, largest).groupBy("ra", "dec").agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
