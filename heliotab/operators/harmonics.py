"""Spherical harmonics of scalars and of vectors on the sky: terms as columns, fits by normal equations, and their values."""

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from heliotab.functions import sem


def degrees_and_orders(degree: int, least: int = 0) -> list[tuple[int, int]]:
    """(l, m) by rising l, m from -l to l; negative m stand for sines."""
    return [(n, m) for n in range(least, degree + 1) for m in range(-n, n + 1)]


def _legendre(degree: int, s: Column, c: Column) -> dict[tuple[int, int], Column]:
    """Normalised associated Legendre functions of the sine s of the latitude, c its cosine: the sums over the sphere of the squared terms are 1, without the factor (-1)^m. The recursion by degree runs over the coefficients of polynomials in s, which Horner's rule then evaluates, so that expressions grow with the degree alone."""
    q: dict[tuple[int, int], np.ndarray] = {(0, 0): np.array([math.sqrt(1 / (4 * math.pi))])}
    for m in range(1, degree + 1):
        q[m, m] = q[m - 1, m - 1] * math.sqrt((2 * m + 1) / (2 * m) * (2 if m == 1 else 1))
    for m in range(degree):
        q[m + 1, m] = np.append(0, q[m, m]) * math.sqrt(2 * m + 3)
        for n in range(m + 2, degree + 1):
            a = math.sqrt((4 * n * n - 1) / (n * n - m * m))
            b = math.sqrt(((n - 1) ** 2 - m * m) / (4 * (n - 1) ** 2 - 1))
            q[n, m] = np.append(0, q[n - 1, m]) * a
            q[n, m][: len(q[n - 2, m])] -= q[n - 2, m] * a * b
    return {k: _polynomial(x.tolist(), s) * F.pow(c, F.lit(float(k[1]))) for k, x in q.items()}


def _polynomial(coefficients: list[float], x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = out * x + c
    return out


def terms(degree: int, ra: Column, dec: Column) -> dict[tuple[int, int], Column]:
    """Real, orthonormal harmonics of degrees; angles in degrees."""
    lon, lat = F.radians(ra), F.radians(dec)
    p = _legendre(degree, F.sin(lat), F.cos(lat))
    return {(n, m): p[n, abs(m)] * (F.lit(1.0) if m == 0 else F.cos(lon * m) if m > 0 else F.sin(lon * -m)) for n, m in degrees_and_orders(degree)}


def vector_terms(degree: int, ra: Column, dec: Column) -> dict[tuple[str, int, int], tuple[Column, Column]]:
    """Orthonormal vector harmonics from degree 1 on, as parts along right ascension and declination: `s`, the gradients of the scalar ones, and `t`, the gradients turned by a right angle. Not for the poles themselves."""
    lon, lat = F.radians(ra), F.radians(dec)
    s, c = F.sin(lat), F.cos(lat)
    p, out = _legendre(degree, s, c), {}
    for n, m in degrees_and_orders(degree, 1):
        k, size = abs(m), 1 / math.sqrt(n * (n + 1))
        below = p[n - 1, k] * math.sqrt((n * n - k * k) * (2 * n + 1) / (2 * n - 1)) if n > k else F.lit(0.0)
        slope = (below - p[n, k] * s * n) / c  # by latitude
        wave = F.lit(1.0) if m == 0 else F.cos(lon * m) if m > 0 else F.sin(lon * k)
        turned = F.lit(0.0) if m == 0 else F.sin(lon * m) * -m if m > 0 else F.cos(lon * k) * k
        east, north = p[n, k] * turned / c * size, slope * wave * size
        out["s", n, m], out["t", n, m] = (east, north), (-north, east)
    return out


def _solved(sums: list[float], n: int) -> list[float]:
    """The coefficients of n terms from the upper half of the products' sums and the sums with the values; the least ones, where the rows don't determine all."""
    upper = np.zeros((n, n))
    upper[np.triu_indices(n)] = sums[: n * (n + 1) // 2]
    whole = upper + np.triu(upper, 1).T
    return (np.linalg.pinv(whole, rcond=1e-12, hermitian=True) @ np.array(sums[n * (n + 1) // 2 :])).tolist()


def _sums(rows: DataFrame, parts: list[list[Column]], values: list[Column], w: Column) -> list[float]:
    """Sums of products of terms, and of terms and values, over rows and their parts: one aggregation, of which one row comes to the driver. Terms are computed once a row."""
    n = len(parts[0])
    named = rows.select(w.alias("w"), *[v.alias(f"v{k}") for k, v in enumerate(values)], *[t.alias(f"t{k}_{i}") for k, own in enumerate(parts) for i, t in enumerate(own)])
    over = range(len(parts))
    add = lambda cs: sum(cs[1:], cs[0])
    pairs = [F.sum(F.col("w") * add([F.col(f"t{k}_{i}") * F.col(f"t{k}_{j}") for k in over])) for i in range(n) for j in range(i, n)]
    sides = [F.sum(F.col("w") * add([F.col(f"t{k}_{i}") * F.col(f"v{k}") for k in over])) for i in range(n)]
    return [x or 0.0 for x in named.agg(*pairs, *sides).first()]


def fit(df: DataFrame, degree: int, ra: str, dec: str, value: str, weight: Column | None = None) -> dict[tuple[int, int], float]:
    """Coefficients of harmonics up to a degree that fit a column best. Rows that aren't finite are left out. A job runs while this is called: sums of (degree + 1)^4 / 2 products, combined before the shuffle."""
    own = terms(degree, F.col(ra), F.col(dec))
    rows = df.where(sem.is_finite(F.col(ra).cast("double")) & sem.is_finite(F.col(dec).cast("double")) & sem.is_finite(F.col(value).cast("double")))
    return dict(zip(own, _solved(_sums(rows, [list(own.values())], [F.col(value)], F.lit(1.0) if weight is None else weight), len(own))))


def apply(coefficients: dict[tuple[int, int], float], ra: Column, dec: Column) -> Column:
    """The value of a sum of harmonics."""
    own = terms(max((n for n, _ in coefficients), default=0), ra, dec)
    out = F.lit(0.0)
    for k, c in coefficients.items():
        out = out + own[k] * c
    return out


def fit_vectors(df: DataFrame, degree: int, ra: str, dec: str, east: str, north: str, weight: Column | None = None) -> dict[tuple[str, int, int], float]:
    """Coefficients of vector harmonics that fit two columns, the parts along right ascension (with the cosine of the declination) and declination: `t` of degree 1 are rotations, `s` of degree 1 a flow from pole to pole. Rows at the poles and those that aren't finite are left out."""
    own = vector_terms(degree, F.col(ra), F.col(dec))
    rows = df.where((F.abs(dec) < 90) & sem.is_finite(F.col(ra).cast("double")) & sem.is_finite(F.col(east).cast("double")) & sem.is_finite(F.col(north).cast("double")))
    return dict(zip(own, _solved(_sums(rows, [[v[k] for v in own.values()] for k in (0, 1)], [F.col(east), F.col(north)], F.lit(1.0) if weight is None else weight), len(own))))


def apply_vectors(coefficients: dict[tuple[str, int, int], float], ra: Column, dec: Column) -> tuple[Column, Column]:
    own = vector_terms(max((k[1] for k in coefficients), default=1), ra, dec)
    out = [F.lit(0.0), F.lit(0.0)]
    for k, c in coefficients.items():
        out = [o + t * c for o, t in zip(out, own[k])]
    return out[0], out[1]
