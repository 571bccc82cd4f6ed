"""Fits whose sums come from one aggregation; only those come to the driver."""

from functools import reduce
from itertools import product
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def chebyshev_terms(x: Column, low: float, high: float, order: int) -> list[Column]:
    """T_0 to T_order of x, scaled so that low and high fall on -1 and 1."""
    u = (2 * x - (low + high)) / (high - low)
    terms = [F.lit(1.0), u]
    for _ in range(order - 1):
        terms.append(2 * u * terms[-1] - terms[-2])
    return terms[: order + 1]


def powers_2d(x: Column, y: Column, order: int) -> list[Column]:
    """x^i * y^j with i + j up to the order, by j, then by i."""
    return [F.pow(x, F.lit(float(i))) * F.pow(y, F.lit(float(j))) for j in range(order + 1) for i in range(order + 1 - j)]


def powers_nd(x: list[Column], order: int) -> list[Column]:
    """Products of powers of all coordinates, with exponents that sum to the order at most."""
    return [reduce(mul, [F.pow(c, F.lit(float(k))) for c, k in zip(x, e)]) for e in product(range(order + 1), repeat=len(x)) if sum(e) <= order]


def linear_fit(df: DataFrame, terms: list[Column], y: Column) -> list[float]:
    """Least-squares coefficients of the terms. Rows with a null or NaN don't count."""
    n = len(terms)
    rows = df.select(*[t.cast("double").alias(f"t{i}") for i, t in enumerate(terms)], y.cast("double").alias("y"))
    all_ = sum((F.col(c) for c in rows.columns), F.lit(0.0))
    rows = rows.where(all_.isNotNull() & ~F.isnan(all_))
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    got = rows.agg(*[F.sum(F.col(f"t{i}") * F.col(f"t{j}")) for i, j in pairs], *[F.sum(F.col(f"t{i}") * F.col("y")) for i in range(n)]).first()
    matrix = np.zeros((n, n))
    for (i, j), v in zip(pairs, got):
        matrix[i, j] = matrix[j, i] = v
    return np.linalg.solve(matrix, np.array(got[len(pairs) :], dtype=float)).tolist()


def applied(terms: list[Column], coefficients: list[float]) -> Column:
    """The fitted value."""
    return sum((t * c for t, c in zip(terms, coefficients)), F.lit(0.0))


def projection_sql(rows: str, terms: list[str]) -> str:
    """DuckDB SQL of the same fit, by projection on orthogonal terms: the rows, which have y, with `fitted`. For tests and oracles."""
    out = [f"WITH b0 AS MATERIALIZED (SELECT *, {', '.join(f'CAST({t} AS DOUBLE) AS t{k}' for k, t in enumerate(terms))} FROM ({rows}))"]
    for k in range(len(terms)):
        less = "".join(f" - q{j} * (SELECT sum(t{k} * q{j}) / sum(q{j} * q{j}) FROM b{k})" for j in range(k))
        out.append(f"b{k + 1} AS MATERIALIZED (SELECT *, t{k}{less} AS q{k} FROM b{k})")
    n = len(terms)
    fitted = " + ".join(f"q{k} * (SELECT sum(y * q{k}) / sum(q{k} * q{k}) FROM b{n})" for k in range(n))
    return ", ".join(out) + f" SELECT *, {fitted} AS fitted FROM b{n}"


def interpolate(points: DataFrame, nodes: DataFrame, by: list[str], x: str, y: str, out: str, extrapolate: bool = True) -> DataFrame:
    """The points with `out`: linear between the nodes (by, x, y) around them; outside, on the line through the two outermost nodes (a single node's value everywhere), or null without `extrapolate`. The nodes' x differ within a key; a key without nodes has null. Both sides are merged in one window of each key; no pairs are made."""
    names = points.columns
    own = Window.partitionBy(*by).orderBy(x)
    node = F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    nodes = nodes.select(*by, x, node.alias("_own")).select(*by, x, F.struct("_own", F.lag("_own").over(own).alias("before"), F.lead("_own").over(own).alias("after")).alias("_node"))
    both = points.withColumn("_node", F.lit(None).cast(nodes.schema["_node"].dataType)).unionByName(nodes, allowMissingColumns=True)
    before = F.last("_node", ignorenulls=True).over(own.rangeBetween(Window.unboundedPreceding, 0))
    after = F.first("_node", ignorenulls=True).over(own.rangeBetween(0, Window.unboundedFollowing))
    found = both.select("*", before.alias("_left"), after.alias("_right")).where("_node IS NULL")
    a, b, v = F.col("_a"), F.col("_b"), F.col(x).cast("double")
    if extrapolate:  # left of all nodes, the first two; right of all, the last two
        ends = F.coalesce("_left._own", "_right._own").alias("_a"), F.when(F.col("_left").isNull(), F.coalesce("_right.after", "_right._own")).when(F.col("_right").isNull(), F.coalesce("_left.before", "_left._own")).otherwise(F.col("_right._own")).alias("_b")
    else:
        ends = F.col("_left._own").alias("_a"), F.col("_right._own").alias("_b")
    value = F.when(a["x"] == b["x"], a["y"]).otherwise(a["y"] + (v - a["x"]) * (b["y"] - a["y"]) / F.when(a["x"] != b["x"], b["x"] - a["x"]))
    return found.select("*", *ends).select(*names, value.alias(out))


def _bends(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The second derivatives at the nodes of the natural cubic spline, by elimination along the three diagonals."""
    n = len(x)
    out = np.zeros(n)
    if n < 3:
        return out
    h, slope = np.diff(x), np.diff(y) / np.diff(x)
    upper, right = np.zeros(n - 2), np.zeros(n - 2)
    for i in range(n - 2):
        under = h[i] * upper[i - 1] if i else 0.0
        pivot = 2 * (h[i] + h[i + 1]) - under
        upper[i] = h[i + 1] / pivot
        right[i] = (6 * (slope[i + 1] - slope[i]) - (h[i] * right[i - 1] if i else 0.0)) / pivot
    for i in range(n - 3, -1, -1):
        out[i + 1] = right[i] - upper[i] * out[i + 2]
    return out


def spline(points: DataFrame, nodes: DataFrame, by: list[str], x: str, y: str, out: str) -> DataFrame:
    """The points with `out`: the natural cubic spline through the nodes (by, x, y), null outside. The nodes' x differ within a key. A key's nodes are fitted in one task; points are merged with them in one window of each key, as in interpolate()."""
    names = [f"b{i}" for i in range(len(by))]
    own = nodes.select(*[F.col(c).alias(b) for c, b in zip(by, names)], F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by("x")
        bends = _bends(table.column("x").to_numpy(), table.column("y").to_numpy())
        return table.append_column("m", pa.array(bends))

    bent = own.groupBy(*names).applyInArrow(fitted, StructType([*own.schema, StructField("m", DoubleType())]))
    w = Window.partitionBy(*by).orderBy(x)
    both = points.withColumn("_node", F.lit(None).cast("struct<x:double,y:double,m:double>")).unionByName(bent.select(*[F.col(b).alias(c) for c, b in zip(by, names)], F.col("x").cast(points.schema[x].dataType).alias(x), F.struct("x", "y", "m").alias("_node")), allowMissingColumns=True)
    before = F.last("_node", ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    after = F.first("_node", ignorenulls=True).over(w.rangeBetween(0, Window.unboundedFollowing))
    found = both.select("*", before.alias("_a"), after.alias("_b")).where("_node IS NULL")
    a, b, v = F.col("_a"), F.col("_b"), F.col(x).cast("double")
    h = F.when(b["x"] != a["x"], b["x"] - a["x"])
    left, right = (b["x"] - v) / h, (v - a["x"]) / h
    value = left * a["y"] + right * b["y"] + ((left * left * left - left) * a["m"] + (right * right * right - right) * b["m"]) * h * h / 6
    return found.select(*points.columns, F.when(a["x"] == b["x"], a["y"]).otherwise(value).alias(out))
