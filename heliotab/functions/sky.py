"""Angles and positions on the sky, in degrees unless said otherwise."""

import math

from pyspark.sql import Column, functions as F

#: The north pole of the Galaxy (right ascension, declination) and the galactic longitude of the celestial pole, J2000; fixed values.
GALACTIC_POLE_RA, GALACTIC_POLE_DEC, GALACTIC_NODE = 192.85948, 27.12825, 122.93192


def separation_arcsec(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    a = F.pow(F.sin(F.radians(dec2 - dec1) / 2), 2) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.pow(F.sin(F.radians(ra2 - ra1) / 2), 2)
    return F.degrees(2 * F.asin(F.sqrt(F.least(F.lit(1.0), a)))) * 3600


def unit_vector(ra: Column, dec: Column) -> tuple[Column, Column, Column]:
    return F.cos(F.radians(dec)) * F.cos(F.radians(ra)), F.cos(F.radians(dec)) * F.sin(F.radians(ra)), F.sin(F.radians(dec))


def galactic(ra: Column, dec: Column) -> tuple[Column, Column]:
    """Galactic longitude (0 to 360) and latitude."""
    d, a = F.radians(dec), F.radians(ra - GALACTIC_POLE_RA)
    pole = F.radians(F.lit(GALACTIC_POLE_DEC))
    b = F.asin(F.sin(d) * F.sin(pole) + F.cos(d) * F.cos(pole) * F.cos(a))
    turn = F.atan2(F.cos(d) * F.sin(a), F.sin(d) * F.cos(pole) - F.cos(d) * F.sin(pole) * F.cos(a))
    return F.pmod(F.lit(GALACTIC_NODE) - F.degrees(turn), F.lit(360.0)), F.degrees(b)


def tangent_plane(ra: Column, dec: Column, ra0: Column | float, dec0: Column | float) -> tuple[Column, Column]:
    """Gnomonic projection about (ra0, dec0): standard coordinates in degrees; null on the far hemisphere."""
    ra0, dec0 = (x if isinstance(x, Column) else F.lit(x) for x in (ra0, dec0))
    d, a, d0 = F.radians(dec), F.radians(ra - ra0), F.radians(dec0)
    depth = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    over = F.when(depth > 0, depth)
    return F.degrees(F.cos(d) * F.sin(a) / over), F.degrees((F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a)) / over)


def to_sexagesimal(x: Column) -> Column:
    """Degrees as [-]DD:MM:SS.ss, with as many digits of degrees as there are."""
    c = F.round(F.abs(x) * 360000).cast("bigint")
    whole = lambda by: F.floor(c / by)
    return F.format_string("%s%02d:%02d:%02d.%02d", F.when(x < 0, "-").otherwise(""), whole(360000), whole(6000) % 60, whole(100) % 60, c % 100)


def from_sexagesimal(s: Column) -> Column:
    """[-]DD:MM:SS.s as degrees; null for other text."""
    part = lambda k: F.regexp_extract(s, r"^\s*-?(\d+):(\d+):(\d+(?:\.\d*)?)\s*$", k).try_cast("double")
    return (part(1) + part(2) / 60 + part(3) / 3600) * F.when(F.ltrim(s).startswith("-"), -1.0).otherwise(1.0)


#: The obliquity of the ecliptic at J2000, in degrees; a fixed value.
OBLIQUITY = 23.4392911
#: Arcseconds of Newcomb's precession angles for t centuries since J2000: coefficients of t, t^2 and t^3 of zeta, z and theta (IAU 1976); fixed values.
PRECESSION = {"zeta": (2306.2181, 0.30188, 0.017998), "z": (2306.2181, 1.09468, 0.018203), "theta": (2004.3109, -0.42665, -0.041833)}
#: Modified Julian date of the Unix epoch; Julian date of modified date 0 and of the Unix epoch; days of a Julian century; Julian date of J2000; fixed values.
MJD_UNIX, JD_MJD, JD_UNIX, CENTURY, J2000 = 40587.0, 2400000.5, 2440587.5, 36525.0, 2451545.0


def _turned(lon: Column, lat: Column, tilt: float) -> tuple[Column, Column]:
    """Longitude (0 to 360) and latitude after a turn by `tilt` degrees about the x axis."""
    a, d, e = F.radians(lon), F.radians(lat), math.radians(tilt)
    up = F.sin(d) * math.cos(e) - F.cos(d) * F.sin(a) * math.sin(e)
    return F.pmod(F.degrees(F.atan2(F.sin(a) * F.cos(d) * math.cos(e) + F.sin(d) * math.sin(e), F.cos(a) * F.cos(d))), F.lit(360.0)), F.degrees(F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), up))))


def ecliptic(ra: Column, dec: Column) -> tuple[Column, Column]:
    return _turned(ra, dec, OBLIQUITY)


def from_ecliptic(lon: Column, lat: Column) -> tuple[Column, Column]:
    return _turned(lon, lat, -OBLIQUITY)


def from_galactic(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Right ascension (0 to 360) and declination."""
    b, a = F.radians(lat), F.radians(GALACTIC_NODE - lon)
    pole = math.radians(GALACTIC_POLE_DEC)
    d = F.asin(F.sin(b) * math.sin(pole) + F.cos(b) * math.cos(pole) * F.cos(a))
    turn = F.atan2(F.cos(b) * F.sin(a), F.sin(b) * math.cos(pole) - F.cos(b) * math.sin(pole) * F.cos(a))
    return F.pmod(F.degrees(turn) + GALACTIC_POLE_RA, F.lit(360.0)), F.degrees(d)


def precessed(ra: Column, dec: Column, years: float) -> tuple[Column, Column]:
    """Positions of the equinox of J2000 at that of so many years later."""
    t = years / 100
    zeta, z, theta = (math.radians(sum(c * t**k for k, c in enumerate(PRECESSION[x], 1)) / 3600) for x in ("zeta", "z", "theta"))
    a, d = F.radians(ra) + zeta, F.radians(dec)
    x = math.cos(theta) * F.cos(d) * F.cos(a) - math.sin(theta) * F.sin(d)
    y = math.sin(theta) * F.cos(d) * F.cos(a) + math.cos(theta) * F.sin(d)
    return F.pmod(F.degrees(F.atan2(F.cos(d) * F.sin(a), x) + z), F.lit(360.0)), F.degrees(F.asin(y))


def mjd(ts: Column) -> Column:
    """The modified Julian date of an instant."""
    return F.unix_micros(ts.cast("timestamp")) / 86_400e6 + MJD_UNIX


def from_mjd(day: Column) -> Column:
    """The instant of a modified Julian date, to a microsecond."""
    return F.timestamp_micros(F.round((day - MJD_UNIX) * 86_400e6).cast("bigint"))


def julian_date(ts: Column) -> Column:
    """The Julian date of an instant, rounded once: through the modified date it would be rounded twice, to 40 microseconds each."""
    return F.unix_micros(ts.cast("timestamp")) / 86_400e6 + JD_UNIX


def sidereal_hours(day: Column, longitude: float) -> Column:
    """Mean sidereal time, in hours, of a Julian date at a longitude in degrees east."""
    d = day - J2000
    return F.pmod((280.46061837 + 360.98564736629 * d + longitude) / 15, F.lit(24.0))


def altitude_azimuth(hour_angle: Column, dec: Column, latitude: float) -> tuple[Column, Column]:
    """Altitude, and azimuth from north over east, of an hour angle in degrees."""
    h, d, p = F.radians(hour_angle), F.radians(dec), math.radians(latitude)
    up = F.sin(d) * math.sin(p) + F.cos(d) * math.cos(p) * F.cos(h)
    return F.degrees(F.asin(up)), F.pmod(F.degrees(F.atan2(-F.cos(d) * F.sin(h), F.sin(d) * math.cos(p) - F.cos(d) * math.sin(p) * F.cos(h))), F.lit(360.0))


def plane_sky(x: Column, y: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    """The position of standard coordinates, in degrees, about (ra0, dec0): the inverse of tangent_plane."""
    x, y, d0 = F.radians(x), F.radians(y), F.radians(dec0)
    under = F.cos(d0) - y * F.sin(d0)
    return F.pmod(ra0 + F.degrees(F.atan2(x, under)), F.lit(360.0)), F.degrees(F.atan2(F.sin(d0) + y * F.cos(d0), F.hypot(x, under)))


def fields_of(ra: Column, dec: Column, degrees: float) -> Column:
    """The name of the tile of so many degrees a side that holds a position."""
    return F.format_string("r%03d.d%+03d", (F.floor(F.pmod(ra, F.lit(360.0)) / degrees) * degrees).cast("int"), (F.floor((dec + 90) / degrees) * degrees - 90).cast("int"))


def sun_vector(day: Column) -> tuple[Column, Column, Column]:
    """The Sun's place as seen from the Earth, in astronomical units along the equatorial axes, to about 0.01 degrees, at a Julian date."""
    n = day - J2000
    g = F.radians(357.528 + 0.9856003 * n)
    lon = F.radians(280.460 + 0.9856474 * n + 1.915 * F.sin(g) + 0.020 * F.sin(2 * g))
    r = 1.00014 - 0.01671 * F.cos(g) - 0.00014 * F.cos(2 * g)
    tilt = math.radians(OBLIQUITY)
    return r * F.cos(lon), r * F.sin(lon) * math.cos(tilt), r * F.sin(lon) * math.sin(tilt)


def parallax_factors(ra: Column, dec: Column, day: Column) -> tuple[Column, Column]:
    """How far a star of unit parallax stands from its mean place along right ascension (on the sky) and declination."""
    x, y, z = sun_vector(day)
    a, d = F.radians(ra), F.radians(dec)
    return y * F.cos(a) - x * F.sin(a), z * F.cos(d) - x * F.cos(a) * F.sin(d) - y * F.sin(a) * F.sin(d)


def rotated(x: Column, y: Column, z: Column, axis: str, degrees: float) -> tuple[Column, Column, Column]:
    """A vector turned about one of the axes, against the clock as seen from its end."""
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    if axis == "x":
        return x, c * y - s * z, s * y + c * z
    if axis == "y":
        return c * x + s * z, y, c * z - s * x
    return c * x - s * y, s * x + c * y, z
