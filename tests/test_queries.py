"""Every query of the catalogue runs, and gives DuckDB's rows where it has SQL."""

import os

import pytest

from heliotab.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    return sorted(tuple(repr(float(v)) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(name, spark, duck):
    df = catalogue.queries()[name](spark, SF)
    columns = sorted(df.columns)
    ours = plain(df.select(*columns).collect())
    if name in catalogue.oracle_sql():
        theirs = duck.sql(catalogue.oracle_sql()[name])
        assert sorted(theirs.columns) == columns
        places = [theirs.columns.index(c) for c in columns]
        assert ours == plain(tuple(r[i] for i in places) for r in theirs.fetchall())


def test_polynomial_residuals_are_orthogonal(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    r = catalogue.queries()["polyfit2"](spark, SF).agg({"residual": "avg"}).first()[0]
    assert abs(r) < 1e-6 * lines.agg({"l_extendedprice": "avg"}).first()[0]
