"""Small dense matrices as columns: arrays of doubles, row after row, one matrix a row of the table. numpy works on them in batches; each is checked to have n * n numbers."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


def _mapped(df: DataFrame, schema: str, f: Callable[[pd.Series], list]) -> DataFrame:
    added = StructType.fromDDL(schema)
    kept = [c for c in df.columns if c not in added.names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            made = [f(r) for r in frame.to_dict("records")]
            yield frame[kept].assign(**{name: [m[i] for m in made] for i, name in enumerate(added.names)})

    return df.select(*df.columns).mapInPandas(run, StructType([*(df.schema[c] for c in kept), *added]))


def _square(values, n: int) -> np.ndarray | None:
    """The matrix; None for null, for a null or NaN inside, or for another size."""
    if values is None or len(values) != n * n:
        return None
    a = np.array(values, dtype=float)
    return a.reshape(n, n) if np.isfinite(a).all() else None


def inverse(df: DataFrame, matrix: str, n: int) -> DataFrame:
    """The table with `determinant` and `inverse` (null for singular ones) of a column of matrices."""

    def one(row):
        a = _square(row[matrix], n)
        if a is None:
            return None, None
        whole = np.linalg.matrix_rank(a) == n
        return float(np.linalg.det(a)), np.linalg.inv(a).ravel().tolist() if whole else None

    return _mapped(df, "determinant double, inverse array<double>", one)


def solved(df: DataFrame, matrix: str, side: str, n: int) -> DataFrame:
    """The table with `solution` of matrix * solution = side; null for singular ones."""

    def one(row):
        a, b = _square(row[matrix], n), row[side]
        if a is None or b is None or len(b) != n or np.linalg.matrix_rank(a) < n:
            return (None,)
        return (np.linalg.solve(a, np.array(b, dtype=float)).tolist(),)

    return _mapped(df, "solution array<double>", one)


def singular_values(df: DataFrame, matrix: str, n: int) -> DataFrame:
    """The table with `u`, `w` (falling) and `vt`, whose product is the matrix."""

    def one(row):
        a = _square(row[matrix], n)
        if a is None:
            return None, None, None
        u, w, vt = np.linalg.svd(a)
        return u.ravel().tolist(), w.tolist(), vt.ravel().tolist()

    return _mapped(df, "u array<double>, w array<double>, vt array<double>", one)
