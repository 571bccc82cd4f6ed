"""Detrending that is fitted: the shutter's travel from exposures of several times, and fringes from templates."""

from pyspark.sql import DataFrame, functions as F

from heliotab.operators import ranks
from heliotab.operators.group_fits import linear

#: Names of a pixel's place inside fits, whose own columns x and y would clash.
_PLACE = {"x": "_px", "y": "_py"}


def shutter_reference(df: DataFrame, by: list[str], time: str) -> DataFrame:
    """(by, reference): by how much the pixel that all values (by, x, y, time, v) are divided by is open longer than the nominal time.

    A value is scale * (t + offset) / (t + reference), hence v t = scale t + scale offset - reference v: linear in three unknowns of each pixel. The median over an image's pixels is taken; pixels with fewer than three different times, or whose values don't depend on time, have no say.
    """
    t, v = F.col(time).cast("double"), F.col("v")
    each = linear(df.withColumnsRenamed(_PLACE), [*by, *_PLACE.values()], [t, F.lit(1.0), v], v * t).where("c IS NOT NULL")
    return ranks.quantiles(each.select(*by, (-F.get("c", F.lit(2))).alias("v")), by, "v", {"reference": 0.5})


def shutter(df: DataFrame, by: list[str], time: str, reference: DataFrame, clip: float | None = None) -> DataFrame:
    """(by, x, y, scale, level, offset, n, chi) of each pixel, for known references (by, reference): a line of v (t + reference) over t, clipped if asked; level is the line's value at 0, and offset is level / scale. Pixels of a single time have a null scale, level and offset; where the scale is 0, the offset is null."""
    t = F.col(time).cast("double")
    rows = ranks.join_groups(df.select(*by, "x", "y", time, "v"), reference, by).withColumnsRenamed(_PLACE)
    out = linear(rows, [*by, *_PLACE.values()], [t, F.lit(1.0)], F.col("v") * (t + F.col("reference")), clip=clip)
    scale, level = F.get("c", F.lit(0)), F.get("c", F.lit(1))
    return out.select(*by, *[F.col(c).alias(p) for p, c in _PLACE.items()], scale.alias("scale"), level.alias("level"), F.when(scale != 0, level / scale).alias("offset"), "n", "chi")


def shutter_corrected(df: DataFrame, corrections: DataFrame, by: list[str], time: str) -> DataFrame:
    """The pixels as if each had been open for the nominal time; those without an offset stay."""
    t = F.col(time).cast("double")
    return df.join(corrections.select(*by, "x", "y", "offset"), [*by, "x", "y"], "left").withColumn("v", F.col("v") * F.coalesce(t / (t + F.col("offset")), F.lit(1.0))).drop("offset")


def fringes(df: DataFrame, by: list[str], templates: list[str], clip: float | None = 3.0) -> DataFrame:
    """(by, c, n, chi): the sky and how much of each template (columns of the pixels) an image holds, clipped. Sums are taken before the shuffle, so images may be of any size; templates that are one another's multiples give c null."""
    return linear(df, by, [F.lit(1.0), *[F.col(c) for c in templates]], F.col("v"), clip=clip)


def without_fringes(df: DataFrame, found: DataFrame, by: list[str], templates: list[str]) -> DataFrame:
    """The pixels without the fringes; the sky stays, and so do images without a fit and pixels without a template."""
    known = ranks.join_groups(df, found.select(*by, "c"), by, "left")
    light = sum((F.get("c", F.lit(i + 1)) * F.col(t) for i, t in enumerate(templates)), F.lit(0.0))
    return known.withColumn("v", F.col("v") - F.coalesce(light, F.lit(0.0))).drop("c")
