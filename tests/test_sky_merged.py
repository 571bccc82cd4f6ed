"""Positions that are sent to cells of the sky are merged and not broadcast, and what belongs to a star is joined once: the rows are the SQL's."""

import datetime
import random

import duckdb
import pytest

from heliotab.operators import footprints, joins
from heliotab.plans import catalogue


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Stars and images all over the sky, one star with very many orders; orders without a star or a date."""
    r = random.Random(8)
    path = str(tmp_path_factory.mktemp("sky"))
    spark.createDataFrame([(i, r.randrange(-99999, 999999) / 100) for i in range(1500)], "c_custkey long, c_acctbal double").write.parquet(f"{path}/customer.parquet")
    spark.createDataFrame([(i, r.randrange(-99999, 999999) / 100, i % 25) for i in range(120)], "s_suppkey long, s_acctbal double, s_nationkey int").write.parquet(f"{path}/supplier.parquet")
    con = duckdb.connect()
    held = con.sql(f"WITH customer AS (SELECT * FROM '{path}/customer.parquet/*.parquet'), supplier AS (SELECT * FROM '{path}/supplier.parquet/*.parquet') SELECT id FROM ({catalogue.oracle_sql()['stars_in_images']}) GROUP BY id ORDER BY count(*) DESC, id LIMIT 1").fetchall()[0][0]
    day = lambda: datetime.datetime(1995, 1, 1) + datetime.timedelta(days=r.randrange(2000))
    orders = [(i, held if i % 3 == 0 else r.randrange(1500), float(i), day()) for i in range(2000)] + [(5000, None, 1.0, day()), (5001, held, 1.0, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{path}/orders.parquet")
    return path


@pytest.mark.parametrize("name", ["sky_radius", "stars_in_images", "image_measures"])
def test_rows_are_the_sqls_and_none_broadcast(name, spark, folder, monkeypatch):
    monkeypatch.setattr(joins, "CROWD", 3)
    monkeypatch.setattr(footprints, "LISTED", 40, raising=False)
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in ("customer", "supplier", "orders"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    theirs = con.sql(catalogue.oracle_sql()[name])
    ours = catalogue.queries()[name](spark, folder).select(*theirs.columns)
    plan = ours._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and not any("BroadcastHashJoin" in line and "Inner" in line for line in plan.splitlines())
    assert "Exchange" not in plan.split("SortMergeJoin")[0]  # pairs stay where they are made
    assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall()) and ours.count() > 0


def test_tasks_grow_with_pairs(spark, monkeypatch):
    rows = spark.range(4000)
    assert joins.sky_tasks(rows, rows, 0.1) == 2 * spark.sparkContext.defaultParallelism
    monkeypatch.setattr(joins, "_PAIRS", 1000)
    assert joins.sky_tasks(rows, rows, 0.1) == 320
