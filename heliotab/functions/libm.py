"""The C library's sine, arc and power, by Arrow: the JVM's differ from them in the last bit now and then, which decides which of two places is nearer, or how a value at a border is rounded."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


@F.arrow_udf(DoubleType())
def _arc(lat1: pa.Array, lat2: pa.Array, dlat: pa.Array, dlon: pa.Array) -> pa.Array:
    square = lambda x: pc.power(pc.sin(pc.divide(x, 2.0)), 2.0)
    a = pc.add(square(dlat), pc.multiply(pc.multiply(pc.cos(lat1), pc.cos(lat2)), square(dlon)))
    return pc.multiply(2.0, pc.asin(pc.sqrt(pc.if_else(pc.greater(a, 1.0), 1.0, a))))


def arc(lat1: Column, lat2: Column, dlat: Column, dlon: Column) -> Column:
    """Great-circle distance by the haversine formula, from latitudes and differences; all in radians."""
    return _arc(lat1, lat2, dlat, dlon)


def separation_arcsec(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """As sky.separation_arcsec. Right ascensions may be decimals: their difference is then exact."""
    return F.degrees(arc(F.radians(dec1), F.radians(dec2), F.radians(dec2 - dec1), F.radians((ra2 - ra1).cast("double")))) * 3600


@F.arrow_udf(StructType([StructField("alt", DoubleType()), StructField("az", DoubleType())]))
def _horizon(h: pa.Array, d: pa.Array, p: pa.Array) -> pa.Array:
    sd, cd, sp, cp, ch = pc.sin(d), pc.cos(d), pc.sin(p), pc.cos(p), pc.cos(h)
    up = pc.add(pc.multiply(sd, sp), pc.multiply(pc.multiply(cd, cp), ch))
    east = pc.multiply(pc.negate(cd), pc.sin(h))
    north = pc.subtract(pc.multiply(sd, cp), pc.multiply(pc.multiply(cd, sp), ch))
    up = pc.if_else(pc.greater(up, 1.0), 1.0, pc.if_else(pc.less(up, -1.0), -1.0, up))
    return pa.StructArray.from_arrays([pc.asin(up), pc.atan2(east, north)], names=["alt", "az"])


def altitude_azimuth(hour_angle: Column, dec: Column, latitude: float) -> tuple[Column, Column]:
    """Altitude, and azimuth from north over east (0 to 360), of an hour angle in degrees."""
    found = _horizon(F.radians(hour_angle), F.radians(dec), F.radians(F.lit(latitude)))
    return F.degrees(found["alt"]), F.pmod(F.degrees(found["az"]) + 360, F.lit(360.0))


def rounded(x: Column, digits: int) -> Column:
    """To so many digits, halves away from zero, as C rounds: of the product, and not of the shortest decimal of the number."""
    whole = F.floor(F.abs(x) * 10.0**digits)
    up = F.when(F.abs(x) * 10.0**digits - whole >= 0.5, whole + 1).otherwise(whole).cast("double") / 10.0**digits
    return F.when(F.isnan(x), x).otherwise(F.when(x < 0, -up).otherwise(up))
