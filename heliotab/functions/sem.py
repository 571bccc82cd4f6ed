"""Arithmetic and comparison as IEEE numbers have them, where Spark's SQL rules differ.

Booleans are 0 and 1, and any other number, NaN too, counts as true.
"""

import math

from pyspark.sql import Column, functions as F

NAN, INF = float("nan"), float("inf")


def fdiv(a: Column, b: Column) -> Column:
    """Float division: by 0 it gives an infinity of the dividend's sign, and NaN for 0 or NaN by 0."""
    a, b = a.cast("double"), b.cast("double")
    at_zero = F.when(F.isnan(a) | (a == 0), F.lit(NAN)).when(a > 0, F.lit(INF)).otherwise(F.lit(-INF))
    return F.when(b == 0, at_zero).otherwise(a / F.when(b != 0, b))


def idiv(a: Column, b: Column) -> Column:
    """Integer division toward zero, exact in all 64 bits; null by 0, and where the least long is divided by -1."""
    a, b = a.cast("bigint"), b.cast("bigint")
    return F.when(b == -1, F.try_subtract(F.lit(0).cast("bigint"), a)).otherwise(F.call_function("div", a, F.when((b != 0) & (b != -1), b)))


def trunc(x: Column) -> Column:
    """Toward zero, as bigint; null for what isn't finite."""
    return F.when(~F.isnan(x) & (F.abs(x) < INF), x.cast("bigint"))


def log10(x: Column) -> Column:
    return F.when(x > 0, F.log10(x)).when(x == 0, F.lit(-INF)).when(x.isNotNull(), F.lit(NAN))


def ln(x: Column) -> Column:
    return F.when(x > 0, F.log(x)).when(x == 0, F.lit(-INF)).when(x.isNotNull(), F.lit(NAN))


def ten(x: Column) -> Column:
    return F.pow(F.lit(10.0), x)


def dsin(x: Column) -> Column:
    return F.sin(F.radians(x))


def dcos(x: Column) -> Column:
    return F.cos(F.radians(x))


def dtan(x: Column) -> Column:
    return F.tan(F.radians(x))


def dasin(x: Column) -> Column:
    return F.degrees(F.asin(x))


def dacos(x: Column) -> Column:
    return F.degrees(F.acos(x))


def datan(x: Column) -> Column:
    return F.degrees(F.atan(x))


def datan2(y: Column, x: Column) -> Column:
    return F.degrees(F.atan2(y, x))


def _numbers(a: Column, b: Column) -> Column:
    return ~F.isnan(a.cast("double")) & ~F.isnan(b.cast("double"))


def lt(a: Column, b: Column) -> Column:
    return (a < b) & _numbers(a, b)


def le(a: Column, b: Column) -> Column:
    return (a <= b) & _numbers(a, b)


def gt(a: Column, b: Column) -> Column:
    return (a > b) & _numbers(a, b)


def ge(a: Column, b: Column) -> Column:
    return (a >= b) & _numbers(a, b)


def eq(a: Column, b: Column) -> Column:
    return (a == b) & _numbers(a, b)


def ne(a: Column, b: Column) -> Column:
    return (a != b) | ~_numbers(a, b)


def true(x: Column) -> Column:
    return x.cast("double") != 0


def flag(condition: Column) -> Column:
    return condition.cast("int")


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < INF)


def near(a: Column, b: Column, tolerance: float = 1e-6) -> Column:
    """Equality of floats up to a tolerance."""
    return F.abs(a - b) < tolerance


def maximum(a: Column, b: Column) -> Column:
    """The greater of two; NaN if one is, null if one is null."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def minimum(a: Column, b: Column) -> Column:
    """The lesser of two; NaN if one is, null if one is null."""
    return F.when(F.isnan(a.cast("double")), a).when(F.isnan(b.cast("double")), b).when(a.isNotNull() & b.isNotNull(), F.least(a, b))


#: Coefficients of the approximation of the gamma function by Lanczos (g = 7, 9 terms); fixed values.
_LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)


def lgamma(x: Column) -> Column:
    """The logarithm of the absolute value of the gamma function, to about 14 digits: Lanczos' sum from 1/2 on, reflected below. Infinite at 0 and the negative integers and at both infinities."""

    def upper(z: Column) -> Column:
        z = z - 1
        terms = F.lit(_LANCZOS[0])
        for k, c in enumerate(_LANCZOS[1:], 1):
            terms = terms + c / (z + k)
        t = z + 7.5
        return math.log(2 * math.pi) / 2 + (z + 0.5) * F.log(t) - t + F.log(terms)

    x = x.cast("double")
    reflected = math.log(math.pi) - F.log(F.abs(F.sin(math.pi * (x - F.rint(x))))) - upper(1 - x)
    pole = (x <= 0) & (x == F.floor(x)) | (F.abs(x) == INF)
    return F.when(F.isnan(x), F.lit(NAN)).when(pole, F.lit(INF)).when(x >= 0.5, upper(x)).otherwise(reflected)


def erf(x: Column) -> Column:
    """The error function to about 15 digits: its series below 2 in absolute value, a continued fraction of the complement from there on."""
    x = x.cast("double")
    a = F.least(F.abs(x), F.lit(30.0))
    near = F.least(a, F.lit(2.0))
    square, series = near * near, F.lit(0.0)
    for n in range(33, -1, -1):  # sum of (2 x^2)^n / (1 * 3 * ... * (2n + 1)), whose terms are all positive
        series = (1 + series) * (2 * square / (2 * n + 1)) if n else 1 + series
    far = F.greatest(a, F.lit(2.0))
    fraction = far
    for n in range(60, 0, -1):
        fraction = far + (n / 2) / fraction
    small = 2 / math.sqrt(math.pi) * near * F.exp(-square) * series
    large = 1 - F.exp(-far * far) / (math.sqrt(math.pi) * fraction)
    return F.when(F.isnan(x), F.lit(NAN)).when(x.isNotNull(), F.signum(x) * F.when(a < 2, small).otherwise(large))
