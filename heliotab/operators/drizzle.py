"""Images put onto another grid by the areas that pixels share with its cells."""

from pyspark.sql import Column, DataFrame, functions as F


def _under(u: Column) -> Column:
    """The integral from below 0 up to u of what lies between 0 and 1."""
    return F.when(u <= 0, 0.0).when(u <= 1, u * u / 2).otherwise(u - 0.5)


def _edge(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The signed area below an edge of a polygon and inside the unit square."""
    inside = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
    a, b = inside(x1), inside(x2)
    slope = (y2 - y1) / (x2 - x1)
    at = lambda x: y1 + slope * (x - x1)
    flat = inside((at(a) + at(b)) / 2) * (b - a)
    return F.when((a == b) | (x1 == x2), 0.0).when(F.abs(slope) * F.abs(b - a) < 1e-9, flat).otherwise((_under(at(b)) - _under(at(a))) / slope)


def shared_area(corners: list[tuple[Column, Column]], x: Column, y: Column) -> Column:
    """The area that a polygon, its corners in order, shares with the unit cell centred on (x, y): the sum over its edges, as a fold over an array, since four edges written out are too much for one generated method."""
    point = lambda c: (c[0] - x + 0.5, c[1] - y + 0.5)
    edges = [F.struct(*[v.alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), (*point(c), *point(d)))]) for c, d in zip(corners, corners[1:] + corners[:1])]
    return F.abs(F.aggregate(F.array(*edges), F.lit(0.0), lambda total, e: total + _edge(e.x1, e.y1, e.x2, e.y2)))


def drizzle(df: DataFrame, by: list[str], matrix: tuple[float, float, float, float], shift: tuple[float, float], *, fraction: float = 1.0, variance: str | None = None) -> DataFrame:
    """(by, x, y, v, weight, variance) on a grid on which the pixel (x, y, v) has its centre at matrix times (x, y) plus shift; matrix: xx, xy, yx, yy.

    A pixel, shrunk about its centre to `fraction` of its sides, gives each cell the part of its value that it shares with it: the values' sum stays, but for pixels without a value. weight is the area that a cell has got, of pixels of side `fraction`; variance the sum of the pixels' variances times the squared parts, null without such a column. NaN and nulls give nothing. Pixels meet only the cells of their bounding boxes, and are summed before the shuffle.
    """
    xx, xy, yx, yy = map(float, matrix)
    half, area = fraction / 2, abs(xx * yy - xy * yx) * fraction * fraction
    if not area:
        raise ValueError("the matrix has no inverse")
    own = df.where(F.col("v").isNotNull() & ~F.isnan("v")).select(*by, "v", (F.col(variance) if variance else F.lit(None)).cast("double").alias("_var"), (xx * F.col("x") + xy * F.col("y") + float(shift[0])).alias("_x"), (yx * F.col("x") + yy * F.col("y") + float(shift[1])).alias("_y"))
    rx, ry = (abs(xx) + abs(xy)) * half, (abs(yx) + abs(yy)) * half
    cells = own.withColumn("x", F.explode(F.sequence(F.floor(F.col("_x") - rx + 0.5), F.floor(F.col("_x") + rx + 0.5)))).withColumn("y", F.explode(F.sequence(F.floor(F.col("_y") - ry + 0.5), F.floor(F.col("_y") + ry + 0.5))))
    corners = [(F.col("_x") + (xx * i + xy * j) * half, F.col("_y") + (yx * i + yy * j) * half) for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
    part = cells.withColumn("_a", shared_area(corners, F.col("x"), F.col("y"))).where("_a > 1e-12")
    share = F.col("_a") / area
    return part.groupBy(*by, F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y")).agg(F.sum(F.col("v") * share).alias("v"), F.sum("_a").alias("weight"), F.sum(F.col("_var") * share * share).alias("variance"))
