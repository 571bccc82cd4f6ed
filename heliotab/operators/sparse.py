"""Sparse symmetric linear systems held as tables."""

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from heliotab.operators.store import written


def mirrored(upper: DataFrame) -> DataFrame:
    """The whole of a symmetric matrix (row, col, value) of which one half, with the diagonal, is given."""
    return upper.unionByName(upper.where("row <> col").select(F.col("col").alias("row"), F.col("row").alias("col"), "value"))


def product(matrix: DataFrame, vectors: DataFrame) -> DataFrame:
    """(k, row, value): the matrix (row, col, value) times each vector (k, row, value). One join and one sum, combined before the shuffle."""
    right = vectors.select("k", F.col("row").alias("col"), F.col("value").alias("_v"))
    return matrix.join(right, "col").groupBy("k", "row").agg(F.sum(F.col("value") * F.col("_v")).alias("value"))


def _of(values: dict, k: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), k)


def conjugate_gradients(matrix: DataFrame, sides: DataFrame, *, tolerance: float = 1e-10, passes: int = 1000) -> DataFrame:
    """(k, row, value): the solutions of matrix times x = side for each right side (k, row, value), by conjugate gradients, scaled by the diagonal.

    The matrix (row, col, value) must be symmetric and positive definite, with its whole diagonal; equal places are summed. Each step is a join of the matrix with the directions, a sum and a table written to the shared folder; of each side only two sums come to the driver, so there may be some hundred sides. It ends when the scaled residual of each side has fallen to `tolerance` of the first one, or after so many passes. Rows that a side doesn't name are 0 there.
    """
    matrix = written(matrix.groupBy("row", "col").agg(F.sum("value").alias("value")))
    diagonal = matrix.where("row = col").select("row", F.col("value").alias("d"))
    numbers = [r["k"] for r in sides.select("k").distinct().collect()]
    if not numbers:
        return sides.select("k", "row", F.col("value").cast("double").alias("value"))
    b = sides.groupBy("k", "row").agg(F.sum("value").alias("b"))
    state = diagonal.withColumn("k", F.explode(F.array(*map(F.lit, numbers)))).join(b, ["k", "row"], "left").select("k", "row", "d", F.lit(0.0).alias("x"), F.coalesce("b", F.lit(0.0)).alias("r"))
    state = written(state.withColumn("p", F.col("r") / F.col("d")))
    rz = {r["k"]: r["s"] for r in state.groupBy("k").agg(F.sum(F.col("r") * F.col("r") / F.col("d")).alias("s")).collect()}
    first = dict(rz)
    for _ in range(passes):
        if not any(rz[k] > tolerance**2 * first[k] for k in rz):
            break
        ap = product(matrix, state.select("k", "row", F.col("p").alias("value"))).withColumnRenamed("value", "ap")
        state = written(state.join(ap, ["k", "row"], "left").withColumn("ap", F.coalesce("ap", F.lit(0.0))))
        pap = {r["k"]: r["s"] for r in state.groupBy("k").agg(F.sum(F.col("p") * F.col("ap")).alias("s")).collect()}
        ended = {k: rz[k] <= tolerance**2 * first[k] or not pap[k] for k in rz}  # such a side stays as it is
        alpha = {k: 0.0 if ended[k] else rz[k] / pap[k] for k in rz}
        left = F.col("r") - _of(alpha, F.col("k")) * F.col("ap")
        new = {r["k"]: r["s"] for r in state.groupBy("k").agg(F.sum(left * left / F.col("d")).alias("s")).collect()}
        beta = {k: 0.0 if ended[k] else new[k] / rz[k] for k in rz}
        a, c = _of(alpha, F.col("k")), _of(beta, F.col("k"))
        state = state.select("k", "row", "d", (F.col("x") + a * F.col("p")).alias("x"), left.alias("r"), (left / F.col("d") + c * F.col("p")).alias("p"))
        rz = new
    return state.select("k", "row", F.col("x").alias("value"))


def bordered(matrix: DataFrame, border: DataFrame, corner: list[list[float]], side: DataFrame, lower: list[float], **options) -> tuple[DataFrame, list[float]]:
    """(x, y) of [A B; B' D] (x, y) = (f, g): a sparse block A (row, col, value) with a few dense columns B (k from 0 on, row, value) and a small corner D. x is a table (row, value), y a list.

    A is solved for f and for all columns of B at once; what is left is a system of the corner's size on the driver.
    """
    m = len(lower)
    sides = side.select(F.lit(m).alias("k"), "row", "value").unionByName(border.select(F.col("k").cast("int").alias("k"), "row", "value"))
    solved = written(conjugate_gradients(matrix, sides, **options))
    dots = solved.join(border.select(F.col("k").alias("j"), "row", F.col("value").alias("_b")), "row").groupBy("k", "j").agg(F.sum(F.col("value") * F.col("_b")).alias("s")).collect()
    schur, right = np.array(corner, dtype=float).reshape(m, m), np.array(lower, dtype=float)
    for r in dots:
        if r["k"] == m:
            right[r["j"]] -= r["s"]
        else:
            schur[r["j"], r["k"]] -= r["s"]
    y = np.linalg.solve(schur, right).tolist() if m else []
    weight = _of({m: 1.0} | {k: -v for k, v in enumerate(y)}, F.col("k"))
    return solved.groupBy("row").agg(F.sum(F.col("value") * weight).alias("value")), y
