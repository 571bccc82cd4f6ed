"""Astrometric calibration: maps of images and positions of objects that fit each other."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from heliotab.operators import sparse
from heliotab.operators.hot_keys import join_counted
from heliotab.operators.store import written


def terms(order: int) -> list[tuple[int, int]]:
    """The powers of x and y of a polynomial, by rising total power."""
    return [(n - j, j) for n in range(order + 1) for j in range(n + 1)]


def _power(x: str, n: int) -> Column:
    out = F.lit(1.0)
    for _ in range(n):
        out = out * F.col(x)
    return out


def mapped(coefficients: str, order: int) -> Column:
    """The value of a polynomial whose coefficients, in the order of terms(), are in an array column."""
    out = F.lit(0.0)
    for n, (i, j) in enumerate(terms(order)):
        out = out + F.get(coefficients, F.lit(n)) * _power("x", i) * _power("y", j)
    return out


def _sums(order: int) -> list[Column]:
    """What the normal equations of both axes need: weighted sums of monomials, and of these with the residuals dx and dy."""
    w = F.col("w")
    out = [F.sum(w * _power("x", i) * _power("y", j)).alias(f"s{i}_{j}") for i, j in terms(2 * order)]
    for axis in "xy":
        out += [F.sum(w * F.col(f"d{axis}") * _power("x", i) * _power("y", j)).alias(f"t{axis}{n}") for n, (i, j) in enumerate(terms(order))]
    return [*out, F.sum(w).alias("sw"), F.sum(w * (F.col("dx") ** 2 + F.col("dy") ** 2)).alias("sdd"), F.count("*").alias("n")]


def _improved(sums: DataFrame, key: str, order: int) -> DataFrame:
    """(key, ax, ay, n, s): coefficients better by the solution of each row's normal equations, solved as one stack a batch, and the scatter that is left. Where the rows don't determine all coefficients, the least change that fits is taken."""
    own = terms(order)

    def solve(batches):
        for batch in batches:
            get = lambda c: batch.column(c).to_numpy(zero_copy_only=False).astype(float)
            if not batch.num_rows:
                continue
            m = np.stack([np.stack([get(f"s{a[0] + b[0]}_{a[1] + b[1]}") for b in own], axis=-1) for a in own], axis=-2)
            inverse = np.linalg.pinv(m, rcond=1e-11, hermitian=True)
            left, columns = get("sdd"), {}
            for axis in "xy":
                t = np.stack([get(f"t{axis}{n}") for n in range(len(own))], axis=-1)
                change = np.einsum("nij,nj->ni", inverse, t)
                left = left - (change * t).sum(axis=-1)
                columns[axis] = np.stack(batch.column(f"a{axis}").to_numpy(zero_copy_only=False)) + change
            scatter = np.sqrt(np.maximum(left, 0) / get("sw"))
            arrays = [batch.column(key), *(pa.array(columns[a].tolist(), type=pa.list_(pa.float64())) for a in "xy"), batch.column("n"), pa.array(scatter)]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "ax", "ay", "n", "s"])

    kind = sums.schema[key].dataType.simpleString()
    return sums.mapInArrow(solve, f"{key} {kind}, ax array<double>, ay array<double>, n long, s double")


def calibrate(measures: DataFrame, reference: DataFrame, *, order: int = 1, clip: float = 3.0, passes: int = 10, tolerance: float = 1e-7) -> tuple[DataFrame, DataFrame]:
    """(maps, positions) of measures (image, object, x, y, w) on images whose places among each other are unknown, and of reference objects (object, x, y), whose positions stay.

    maps: (image, ax, ay, n, s): polynomials of an order from x and y on the image to positions, by terms(); the measures used, and the scatter that is left. positions: (object, px, py, n, fixed).

    Positions begin as the means of x and y. In turns each image's map is fitted to the positions of its objects, by weighted normal equations for the change of the last map, and each object gets the weighted mean of its mapped measures. Measures further than `clip` times the image's last scatter from their object are left out of the next fit and mean. It ends when no position changes by more than the tolerance, or after so many passes. An object whose measures are all left out keeps its place. Images of which no measure is in use keep their map. Rows with nulls or a weight of 0 are left out.

    Each turn is two joins by object and image and two sums, combined before the shuffle; images and objects of very many rows are dealt to several tasks. Only whether it has ended comes to the driver.
    """
    rows = measures.select("image", "object", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.col("w").cast("double").alias("w"))
    rows = written(rows.where("image IS NOT NULL AND object IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL AND w > 0"))
    fixed = reference.select("object", F.col("x").cast("double").alias("fx"), F.col("y").cast("double").alias("fy"))
    positions = rows.groupBy("object").agg(F.avg("x").alias("px"), F.avg("y").alias("py"), F.count("*").alias("rows")).join(fixed, "object", "left")
    positions = written(positions.select("object", F.coalesce("fx", "px").alias("px"), F.coalesce("fy", "py").alias("py"), "rows", F.col("fx").isNotNull().alias("fixed")))
    start = [[1.0 if t == own else 0.0 for t in terms(order)] for own in ((1, 0), (0, 1))] if order else [[0.0], [0.0]]
    maps = rows.groupBy("image").agg(F.count("*").alias("rows")).select("image", *[F.array(*map(F.lit, a)).alias(f"a{c}") for a, c in zip(start, "xy")], F.lit(None).cast("double").alias("s"), "rows")
    maps = written(maps.withColumn("n", F.col("rows")))
    shift = lambda c: mapped(f"a{c}", order) + (F.col(c) if not order else F.lit(0.0))  # noqa: E731  of order 0, the map adds to the place
    for _ in range(passes):
        near = F.col("s").isNull() | (F.hypot("dx", "dy") <= clip * F.col("s"))

        def residuals(maps, positions):
            both = join_counted(rows, maps.select("image", "ax", "ay", "s", "rows"), ["image"], ["object", "x", "y"])
            both = both.select("image", "object", "x", "y", "w", "s", shift("x").alias("mx"), shift("y").alias("my"))
            both = join_counted(both, positions.select("object", "px", "py", "rows"), ["object"], ["image", "x", "y"])
            return both.withColumn("dx", F.col("px") - F.col("mx")).withColumn("dy", F.col("py") - F.col("my"))

        sums = residuals(maps, positions).where(near).groupBy("image").agg(*_sums(order))
        new = _improved(sums.join(maps.select("image", "ax", "ay"), "image"), "image", order)
        kept = new.select("image", F.col("ax").alias("nx"), F.col("ay").alias("ny"), F.col("s").alias("ns"), F.col("n").alias("nn"))
        maps = written(maps.join(kept, "image", "left").select("image", F.coalesce("nx", "ax").alias("ax"), F.coalesce("ny", "ay").alias("ay"), F.coalesce("ns", "s").alias("s"), F.coalesce("nn", F.lit(0)).cast("long").alias("n"), "rows"))
        means = residuals(maps, positions).where(near).groupBy("object").agg((F.sum(F.col("w") * F.col("mx")) / F.sum("w")).alias("nx"), (F.sum(F.col("w") * F.col("my")) / F.sum("w")).alias("ny"), F.count("*").alias("n"))
        moved = positions.drop("n", "change").join(means, "object", "left")
        place = lambda c: F.when(~F.col("fixed"), F.col(f"n{c}")).otherwise(F.col(f"p{c}"))
        moved = moved.select("object", F.coalesce(place("x"), "px").alias("px"), F.coalesce(place("y"), "py").alias("py"), "rows", "fixed", F.coalesce("n", F.lit(0)).alias("n"), F.when(~F.col("fixed"), F.hypot(F.col("nx") - F.col("px"), F.col("ny") - F.col("py"))).alias("change"))
        positions = written(moved)
        if not positions.where(F.col("change") > tolerance).limit(1).count():
            break
    return maps.select("image", "ax", "ay", "n", "s"), positions.select("object", "px", "py", "n", "fixed")


def offset_equations(measures: DataFrame, reference: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matrix, sides) of the shifts of all images and the positions of all objects that fit measures (image, object, x, y, w) best, both at once: rows 2 * image are shifts, rows 2 * object + 1 positions (ids are longs from 0 on); sides 0 and 1 are the axes. Objects of the reference (object, x, y) are known and go to the sides."""
    rows = measures.where("w > 0").join(reference.select("object", F.col("x").alias("fx"), F.col("y").alias("fy")), "object", "left").withColumn("known", F.col("fx").isNotNull())
    i, o = F.col("image").cast("long") * 2, F.col("object").cast("long") * 2 + 1
    part = lambda r, c, v: F.struct(r.alias("row"), c.alias("col"), v.alias("value"))
    cells = F.when(F.col("known"), F.array(part(i, i, F.col("w")))).otherwise(F.array(part(i, i, F.col("w")), part(o, o, F.col("w")), part(i, o, -F.col("w")), part(o, i, -F.col("w"))))
    matrix = rows.select(F.explode(cells).alias("c")).select("c.*").groupBy("row", "col").agg(F.sum("value").alias("value"))
    sides = []
    for k, c in enumerate("xy"):
        own = lambda r, v: F.struct(F.lit(k).alias("k"), r.alias("row"), v.alias("value"))  # noqa: E731, B023
        sides.append(F.when(F.col("known"), F.array(own(i, F.col("w") * (F.col(f"f{c}") - F.col(c))))).otherwise(F.array(own(i, -F.col("w") * F.col(c)), own(o, F.col("w") * F.col(c)))))
    return matrix, rows.select(F.explode(F.concat(*sides)).alias("c")).select("c.*").groupBy("k", "row").agg(F.sum("value").alias("value"))


def joint_offsets(measures: DataFrame, reference: DataFrame, **options) -> DataFrame:
    """(row, dx, dy) of offset_equations(), by conjugate gradients: the shifts of images and positions of objects at once, which turns reach slowly where images hang together by few objects. Every image must hang together with a reference object."""
    solved = sparse.conjugate_gradients(*offset_equations(measures, reference), **options)
    return solved.groupBy("row").agg(*[F.max(F.when(F.col("k") == k, F.col("value"))).alias(n) for k, n in enumerate(("dx", "dy"))])
