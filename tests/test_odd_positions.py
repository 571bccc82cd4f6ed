"""Positions with nulls and such as aren't numbers: the queries on the sky give their SQL's rows."""

import duckdb
import pytest

from heliotab.plans import catalogue

NAN = float("nan")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Stars and listed positions without a declination, with one that isn't a number, and without a key; lists near and far from stars, two of them in the polar tiles of the right ascensions of stars without a declination."""
    folder = str(tmp_path_factory.mktemp("odd"))
    stars = [(10, 1, 12.0), (12, 1, None), (14, 1, NAN), (None, 1, 5.0), (3610, 1, 12.0), (20, 2, -0.0), (21, 2, 90.0)]
    listed = [(10, 1, 12.1), (12, 1, None), (14, 1, NAN), (None, 1, 5.0), (500, 1, 85.0), (3612, 1, 85.0), (3614, 1, -85.0), (16, 2, None), (3610, 1, 12.1)]
    spark.createDataFrame(stars, "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame(listed, "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(1, 10), (2, None)], "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    return folder


def _same(spark, name, folder):
    con = duckdb.connect()
    for t in ("customer", "supplier", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    theirs = con.sql(catalogue.oracle_sql()[name])
    ours = catalogue.queries()[name](spark, folder).select(*theirs.columns).collect()
    return sorted(repr(tuple(r)) for r in ours), sorted(map(repr, theirs.fetchall()))


@pytest.mark.parametrize("name", ["sky_nearest", "sky_nearest_measures"])
def test_nearest(name, spark, odd):
    ours, theirs = _same(spark, name, odd)
    assert ours == theirs and ours


def test_merged(spark, odd):
    ours, theirs = _same(spark, "merge_catalogues", odd)
    assert ours == theirs and ours
