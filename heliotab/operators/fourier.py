"""Fourier transforms of long series in two steps, so that no task holds more than about the square root of a series."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def factors(n: int) -> tuple[int, int]:
    """The two factors of n that are nearest to each other."""
    a = next(k for k in range(math.isqrt(n), 0, -1) if n % k == 0)
    return a, n // a


def fft(df: DataFrame, by: list[str], ordinal: str, real: str, imaginary: str | None, n: int, inverse: bool = False) -> DataFrame:
    """(by, k, re, im) for the series of n values of each group, by the ordinals 0 to n - 1; values that are missing count as 0, and each ordinal is there once at most.

    With n = a * b, the values whose ordinals agree modulo a are transformed by themselves (b values), turned by their phases, and those of equal frequency modulo b transformed again (a values). With a prime n, one of the two is the whole series.
    """
    a, b = factors(n)
    sign = 1 if inverse else -1
    names, many = [f"g{i}" for i in range(len(by))], len(by)
    own = df.select(*[F.col(c).alias(x) for c, x in zip(by, names)], F.col(ordinal).cast("bigint").alias("at"), F.col(real).cast("double").alias("re"), (F.col(imaginary).cast("double") if imaginary else F.lit(0.0)).alias("im"))

    def transformed(table: pa.Table, place: np.ndarray, size: int) -> np.ndarray:
        values = np.zeros(size, dtype=complex)
        values[place] = table.column("re").to_numpy() + 1j * table.column("im").to_numpy()
        return np.fft.ifft(values) * size if inverse else np.fft.fft(values)

    def made(table: pa.Table, at: np.ndarray, values: np.ndarray) -> pa.Table:
        columns = [pa.chunked_array([pa.array([table.column(i)[0].as_py()] * len(at), type=table.schema.field(i).type)]) for i in range(many)]
        return pa.Table.from_arrays([*columns, pa.array(at), pa.array(values.real.copy()), pa.array(values.imag.copy())], names=[*names, "at", "re", "im"])

    def inner(table: pa.Table) -> pa.Table:
        at = table.column("at").to_numpy()
        r, k = int(at[0] % a), np.arange(b)
        turned = transformed(table, at // a, b) * np.exp(sign * 2j * np.pi * r * k / n)
        return made(table, k * a + r, turned)

    def outer(table: pa.Table) -> pa.Table:
        at = table.column("at").to_numpy()
        k = int(at[0] // a)
        return made(table, k + b * np.arange(a), transformed(table, at % a, a))

    schema = own.schema
    half = own.groupBy(*names, F.col("at") % a).applyInArrow(inner, schema)
    whole = half.groupBy(*names, F.floor(F.col("at") / a)).applyInArrow(outer, schema)
    scale = 1 / n if inverse else 1.0
    return whole.select(*[F.col(x).alias(c) for c, x in zip(by, names)], F.col("at").alias("k"), (F.col("re") * scale).alias("re"), (F.col("im") * scale).alias("im"))
