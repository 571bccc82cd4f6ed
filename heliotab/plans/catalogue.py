"""All queries of this engine over the test tables, with the SQL that must give the same rows."""

from heliotab.plans import astrometry, differences, expressions, fields, fits_and_upkeep, fits_files, images_and_fits, numerics, pixels, reduction, relational, sky_and_series, sky_objects, streams, vectors  # noqa: F401  they register their queries
from heliotab.plans.registry import ORACLES, QUERIES


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict:
    return ORACLES
