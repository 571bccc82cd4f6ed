"""Queries on derived positions give their SQL's rows where these lie on borders, where stars are equally near, and where values are level."""

import datetime

import duckdb
import pytest

from heliotab.plans import catalogue


def _rows(spark, name, folder, tables):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    theirs = con.sql(catalogue.oracle_sql()[name])
    ours = catalogue.queries()[name](spark, folder).select(*theirs.columns).collect()
    plain = lambda rows: sorted(tuple(repr(float(v)) if v is not None and not isinstance(v, bool) and not isinstance(v, str) else str(v) for v in r) for r in rows)
    return plain(ours), plain(theirs.fetchall())


@pytest.fixture(scope="module")
def borders(spark, tmp_path_factory):
    """Stars at whole right ascensions (5400: 180 degrees; 46600: 20 degrees), and pairs of one declination as far to either side of a listed position (1458, and 775)."""
    folder = str(tmp_path_factory.mktemp("borders"))
    stars = [(k, f"c{k}", 1, 12.0, "A") for k in (5400, 23400, 27000, 46600, 50200, 2400, 6000)] + [(k, f"c{k}", 3, 46.0, "A") for k in (7006, 22762)] + [(k, f"c{k}", 5, 20.0, "A") for k in (5053, 12549)]
    spark.createDataFrame(stars, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(1458, "s", 3, 46.5), (775, "s", 5, 20.3)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(1, 7006), (2, 22762)], "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.mark.parametrize("name", ["delete_region", "sky_horizon", "region_of_tiles", "sky_plane_histogram", "haversine_group", "match_once", "merge_catalogues", "sky_nearest", "sky_nearest_measures", "sky_radius"])
def test_borders_and_ties(name, spark, borders):
    ours, theirs = _rows(spark, name, borders, ("customer", "supplier", "orders"))
    assert ours == theirs and (ours or name == "region_of_tiles")


def test_julian_dates_are_rounded_once(spark, tmp_path):
    import os

    con = duckdb.connect()
    if not os.path.exists("/root/testdata/sf0.1/events.parquet"):
        pytest.skip("needs the test tables")
    ts = con.sql("SELECT epoch_us(ts) FROM '/root/testdata/sf0.1/events.parquet' WHERE event_id = 51565").fetchall()[0][0]
    rows = [(51565, 1, datetime.datetime(1970, 1, 1) + datetime.timedelta(microseconds=ts))]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    ours, theirs = _rows(spark, "sky_times", str(tmp_path), ("events",))
    assert ours == theirs


def test_level_values_are_no_peaks(spark, tmp_path):
    rows = [(i, 1, datetime.datetime(2024, 1, 1, 0, i), float(v)) for i, v in enumerate([41, 50, 50, 42, 60, 41])]
    spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, value double").write.parquet(f"{tmp_path}/events.parquet")
    ours, theirs = _rows(spark, "peaks", str(tmp_path), ("events",))
    assert ours == theirs and len(ours) == 1


def test_what_is_just_at_the_tolerance_stands(spark, tmp_path):
    """Detection 59826 is 0.05 from 56123, which moves, at another time: both stand, by the SQL's decimals."""
    rows = [(i,) for i in (*range(56120, 56128), 59826, 71192, *range(79960, 79968))]
    spark.createDataFrame(rows, "event_id long").write.parquet(f"{tmp_path}/events.parquet")
    ours, theirs = _rows(spark, "moving_triples", str(tmp_path), ("events",))
    assert ours == theirs and len(ours) > 0


@pytest.fixture(scope="module")
def last_bits(spark, tmp_path_factory):
    """Where the JVM's functions differ from the C library's in the last bit: a star at right ascension 180 whose altitude lies at the border of its sixth digit; pairs of stars that are equally near to a position by the one and not by the other, the greater number the nearer one."""
    folder = str(tmp_path_factory.mktemp("last_bits"))
    key = lambda tenths, above=0: (tenths * pow(377, -1, 3600)) % 3600 + 3600 * above
    stars = [(key(1800), "a", 1, 37.7990825, "A"), (key(35, 2), "b", 2, 64.92999999999999, "A"), (key(7), "c", 2, 64.92999999999999, "A"), (key(36), "d", 3, 81.705, "A"), (key(3580, 1), "e", 3, 81.705, "A")]
    listed = [(key(21), "s", 2, 65.83), (key(6), "t", 3, 83.37)]
    spark.createDataFrame(stars, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame(listed, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(k, s[0]) for k, s in enumerate(stars)], "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    return folder


@pytest.mark.parametrize("name", ["sky_horizon", "haversine_group", "match_once", "merge_catalogues", "sky_nearest", "sky_nearest_measures"])
def test_last_bits(name, spark, last_bits):
    ours, theirs = _rows(spark, name, last_bits, ("customer", "supplier", "orders"))
    assert ours == theirs and ours


def test_hour_angles_are_exact(spark, tmp_path):
    """A star 0.2 degrees off the meridian whose azimuth lies at the border of its sixth digit: 180.2 - 180 in doubles is 0.19999999999998863."""
    star = (1802 * pow(377, -1, 3600)) % 3600
    spark.createDataFrame([(star, 20.75000000050935)], "c_custkey long, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, 0.0)], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    ours, theirs = _rows(spark, "sky_horizon", str(tmp_path), ("customer",))
    assert ours == theirs and ours


@pytest.mark.parametrize("name", ["match_once", "merge_catalogues", "sky_nearest"])
def test_equally_near_stars_of_copies(name, spark, tmp_path):
    """Pairs of stars, of six copies of the tables with shifted keys, that are equally near to a listed position: the least number wins."""
    stars = [(22770, 2503.74), (55170, 5473.74), (68919, 516.43), (77389, 9066.43), (30553, 6733.61), (32501, 6823.61)]
    spark.createDataFrame(stars, "c_custkey long, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1848, 8983.84), (328, -876.23), (3701, 343.66)], "s_suppkey long, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    ours, theirs = _rows(spark, name, str(tmp_path), ("customer", "supplier"))
    assert ours == theirs and ours
