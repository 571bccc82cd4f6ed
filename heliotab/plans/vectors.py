"""Expressions, binning, distinct values, statistics and fits over columns."""

from pyspark.sql import functions as F

from heliotab.functions import sem
from heliotab.operators import bins, fits, series, stats
from heliotab.plans.registry import query, same, table


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(sin(radians(l_quantity)), 9) AS s, round(degrees(atan2(l_tax, l_discount + 1)), 9) AS a, round(log10(l_extendedprice), 9) AS lg, round(ln(l_quantity), 9) AS n, round(power(10, l_discount), 9) AS t FROM lineitem""")
def expr_trig(spark, d):
    c = F.col
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(sem.dsin(c("l_quantity")), 9).alias("s"), F.round(sem.datan2(c("l_tax"), c("l_discount") + 1), 9).alias("a"),
        F.round(sem.log10(c("l_extendedprice")), 9).alias("lg"), F.round(sem.ln(c("l_quantity")), 9).alias("n"), F.round(sem.ten(c("l_discount")), 9).alias("t"),
    )


@query("""SELECT p_partkey, CAST(trunc(p_retailprice) AS BIGINT) AS whole, CAST(floor(p_retailprice / 7) AS BIGINT) AS f, CAST(ceil(p_retailprice / 7) AS BIGINT) AS c, round(sqrt(p_retailprice), 9) AS r, abs(p_size - 25) AS a, CAST(p_size // 7 AS BIGINT) AS q, p_size % 7 AS m FROM part""")
def expr_math(spark, d):
    p, z = F.col("p_retailprice"), F.col("p_size")
    return table(spark, d, "part").select("p_partkey", sem.trunc(p).alias("whole"), F.floor(p / 7).alias("f"), F.ceil(p / 7).alias("c"), F.round(F.sqrt(p), 9).alias("r"), F.abs(z - 25).alias("a"), sem.idiv(z, F.lit(7)).alias("q"), (z % 7).alias("m"))


@query("""SELECT p_partkey, CAST((p_size > 10 AND NOT (p_size >= 40)) OR p_size = 1 AS INT) AS f, CASE WHEN p_size <> 0 THEN 1 ELSE 0 END AS t, p_size & 12 AS a, p_size | 3 AS o, xor(p_size, 5) AS x FROM part""")
def expr_logic(spark, d):
    z = F.col("p_size")
    return table(spark, d, "part").select("p_partkey", sem.flag((sem.gt(z, F.lit(10)) & ~sem.ge(z, F.lit(40))) | sem.eq(z, F.lit(1))).alias("f"), sem.flag(sem.true(z)).alias("t"), z.bitwiseAND(12).alias("a"), z.bitwiseOR(3).alias("o"), z.bitwiseXOR(5).alias("x"))


same("select_ifelse", "SELECT o_orderkey, CASE WHEN o_totalprice > 150000 THEN o_totalprice ELSE -o_totalprice END AS v FROM {orders}", ("orders",))


@query("""SELECT CAST(range AS BIGINT) AS ordinal, CAST(-5 + 0.25 * range AS DOUBLE) AS v FROM range(0, 60)""")
def create_sequence(spark, d):
    start, end, delta = -5.0, 10.0, 0.25
    return spark.range(int((end - start) / delta)).select(F.col("id").alias("ordinal"), (F.lit(start) + F.col("id") * delta).alias("v"))


@query("""SELECT row_number() OVER (ORDER BY part, k) - 1 AS ordinal, k FROM (SELECT 0 AS part, s_suppkey AS k FROM supplier UNION ALL SELECT 1, n_nationkey FROM nation)""")
def concat_vectors(spark, d):
    first = table(spark, d, "supplier").select(F.lit(0).alias("part"), F.col("s_suppkey").alias("k"))
    second = table(spark, d, "nation").select(F.lit(1).alias("part"), F.col("n_nationkey").cast("bigint").alias("k"))
    return series.numbered(first.unionByName(second), ["part", "k"], "ordinal").select("ordinal", "k")


@query("""SELECT o_orderkey, coalesce(c_acctbal, -4096) AS v FROM orders LEFT JOIN customer ON c_custkey = o_custkey * 2""")
def reindex(spark, d):
    values = table(spark, d, "customer").select(F.col("c_custkey").alias("i"), F.col("c_acctbal").alias("v"))
    return table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("i")).join(values, "i", "left").select("o_orderkey", F.coalesce("v", F.lit(-4096.0)).alias("v"))


_CLAMP = "CAST(least(greatest(trunc((l_extendedprice - 0) / 5000), 0), 9) AS INT)"


@query(f"""SELECT CAST(range AS INT) AS bin, range * 5000.0::DOUBLE AS x_low, coalesce(n, 0) AS n FROM range(0, 10) LEFT JOIN (SELECT {_CLAMP} AS b, count(*) AS n FROM lineitem GROUP BY b) ON b = range""")
def hist_clamp(spark, d):
    return bins.histogram(table(spark, d, "lineitem"), "l_extendedprice", 0, 50000, 5000)


@query("""SELECT CAST(least(greatest(trunc((l_quantity - 1) / 10), 0), 4) AS INT) AS b0, CAST(least(greatest(trunc(l_discount / 0.025), 0), 3) AS INT) AS b1, count(*) AS n FROM lineitem GROUP BY b0, b1""")
def hist2d(spark, d):
    return bins.histogram_nd(table(spark, d, "lineitem"), [("l_quantity", 1, 51, 10), ("l_discount", 0, 0.1, 0.025)])


@query("""SELECT CAST(least(greatest(trunc((l_quantity - 1) / 10), 0), 4) AS INT) AS b0, CAST(least(greatest(trunc(l_tax / 0.02), 0), 3) AS INT) AS b1, CAST(least(greatest(trunc(l_extendedprice / 20000), 0), 4) AS INT) AS b2, count(*) AS n FROM lineitem GROUP BY b0, b1, b2""")
def hist3d(spark, d):
    return bins.histogram_nd(table(spark, d, "lineitem"), [("l_quantity", 1, 51, 10), ("l_tax", 0, 0.08, 0.02), ("l_extendedprice", 0, 100000, 20000)])


@query("""SELECT CAST(range AS INT) AS bin, round(coalesce(v, 0), 2) AS value FROM range(0, 12) LEFT JOIN (SELECT CAST(least(greatest(trunc(l_quantity / 5), 0), 11) AS INT) AS b, sum(l_extendedprice) AS v FROM lineitem GROUP BY b) ON b = range""")
def accum_sum(spark, d):
    return bins.accumulate(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 0, 60, 5).withColumn("value", F.round("value", 2))


@query("""SELECT CAST(range AS INT) AS bin, CASE WHEN v IS NULL THEN 'NaN'::DOUBLE ELSE round(v, 4) END AS value FROM range(0, 12) LEFT JOIN (SELECT CAST(least(greatest(trunc(l_quantity / 5), 0), 11) AS INT) AS b, avg(l_extendedprice) AS v FROM lineitem GROUP BY b) ON b = range""")
def accum_mean(spark, d):
    return bins.accumulate(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 0, 60, 5, mean=True).withColumn("value", F.round("value", 4))


@query("""SELECT CAST(trunc(l_quantity) AS INT) AS q, round(avg(l_extendedprice), 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY trunc(l_quantity) ORDER BY l_extendedprice) - 1 AS k, count(*) OVER (PARTITION BY trunc(l_quantity)) AS n FROM lineitem) WHERE k >= floor(n * 0.25) AND k < ceil(n * 0.75) GROUP BY q""")
def medacc(spark, d):
    rows = table(spark, d, "lineitem").select(sem.trunc(F.col("l_quantity")).cast("int").alias("q"), "l_extendedprice")
    return bins.inner_mean(rows, ["q"], "l_extendedprice").select("q", F.round("value", 4).alias("value"))


@query("""SELECT CAST(b.i AS INT) AS bin, count(*) AS n, round(avg(l_extendedprice), 4) AS mean, round(median(l_extendedprice), 4) AS median FROM (SELECT range AS i, 1 + 10 * range AS a, 11 + 10 * range AS z FROM range(0, 5)) b JOIN lineitem ON l_quantity BETWEEN a AND z GROUP BY b.i""")
def vgroup(spark, d):
    out = bins.grouped_by_edges(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", [1, 11, 21, 31, 41, 51])
    return out.select("bin", "n", F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"))


@query("""SELECT CAST(floor(l_quantity / 10) AS INT) AS ix, CAST(floor(l_discount / 0.02) AS INT) AS iy, round(avg(l_extendedprice), 4) AS value, count(*) AS n FROM lineitem WHERE l_quantity >= 0 AND l_quantity < 40 AND l_discount >= 0 AND l_discount < 0.08 GROUP BY ix, iy""")
def gridify(spark, d):
    out = bins.gridify(table(spark, d, "lineitem"), "l_quantity", "l_discount", "l_extendedprice", (0, 40, 10), (0, 0.08, 0.02))
    return out.withColumn("value", F.round("value", 4))


def unique_counts(df, value: str):
    """(v, n): the distinct finite values in order, with their counts."""
    v = F.col(value)
    return df.where(sem.is_finite(v)).groupBy(v.alias("v")).agg(F.count("*").alias("n")).orderBy("v")


@query("SELECT l_extendedprice AS v, count(*) AS n FROM lineitem WHERE isfinite(l_extendedprice) GROUP BY l_extendedprice ORDER BY v")
def uniq_counts(spark, d):
    return unique_counts(table(spark, d, "lineitem"), "l_extendedprice")


same("uniqpair_counts", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM {lineitem} GROUP BY l_orderkey, l_linenumber", ("lineitem",))
same("uniqpair_repeated", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM {lineitem} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1", ("lineitem",))
same("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM {lineitem}", ("lineitem",))
same("cast_vectors", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS d, CAST(p_partkey AS INT) AS i, CAST(p_size AS STRING) AS s FROM {part}", ("part",), "SELECT p_partkey, CAST(p_size AS DOUBLE) AS d, CAST(p_partkey AS INT) AS i, CAST(p_size AS VARCHAR) AS s FROM part")


@query("""WITH s AS (SELECT l_returnflag AS f, count(*) AS n, round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS sigma, min(l_extendedprice) AS low, max(l_extendedprice) AS high, round(median(l_extendedprice), 4) AS median, round(kurtosis_pop(l_extendedprice), 6) AS kurtosis FROM lineitem GROUP BY l_returnflag),
  b AS (SELECT f, CAST(least(floor((l_extendedprice - low) / ((high - low) / 1000)), 999) AS INT) AS bin, count(*) AS m FROM lineitem JOIN s ON l_returnflag = f GROUP BY ALL),
  m AS (SELECT f, bin FROM b QUALIFY row_number() OVER (PARTITION BY f ORDER BY m DESC, bin) = 1)
  SELECT f AS l_returnflag, n, total, mean, sigma, low, high, median, kurtosis, round(low + bin * (high - low) / 1000, 6) AS mode FROM s JOIN m USING (f)""")
def vstats(spark, d):
    out = stats.summary(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice")
    return out.select("l_returnflag", "n", F.round("total", 2).alias("total"), F.round("mean", 4).alias("mean"), F.round("sigma", 4).alias("sigma"), "low", "high", F.round("median", 4).alias("median"), F.round("kurtosis", 6).alias("kurtosis"), F.round("mode", 6).alias("mode"))


@query("""WITH p1 AS (SELECT event_type, avg(value) m, stddev_samp(value) s FROM events GROUP BY event_type),
  p2 AS (SELECT e.event_type, avg(value) m, stddev_samp(value) s FROM events e JOIN p1 USING (event_type) WHERE abs(value - m) <= 2 * s GROUP BY e.event_type),
  p3 AS (SELECT e.event_type, count(*) n, avg(value) m, stddev_samp(value) s FROM events e JOIN p2 USING (event_type) WHERE abs(value - m) <= 2 * s GROUP BY e.event_type)
  SELECT event_type, n, round(m, 6) AS mean, round(s, 6) AS sigma FROM p3""")
def vstats_clip(spark, d):
    out = stats.clipped(table(spark, d, "events"), ["event_type"], "value", 2.0, 3)
    return out.select("event_type", "n", F.round("mean", 6).alias("mean"), F.round("sigma", 6).alias("sigma"))


@query("""SELECT l_returnflag, round(sum(l_extendedprice / (l_quantity * l_quantity)) / sum(1 / (l_quantity * l_quantity)), 4) AS value, round(1 / sum(1 / (l_quantity * l_quantity)), 9) AS variance FROM lineitem GROUP BY l_returnflag""")
def wtmean(spark, d):
    out = stats.weighted_mean(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity")
    return out.select("l_returnflag", F.round("value", 4).alias("value"), F.round("variance", 9).alias("variance"))


#: A pass: groups that have ended keep their value.
_PASS = "SELECT f, CASE WHEN d THEN m ELSE x END AS m, d OR abs(x - m) < 1e-4 * abs(x) AS d FROM (SELECT r.f, any_value(m) AS m, any_value(d) AS d, sum(v / (1 + power((v - m) / s, 2)) / (s * s)) / sum(1 / (1 + power((v - m) / s, 2)) / (s * s)) AS x FROM r JOIN {0} USING (f) GROUP BY r.f)"


@query(
    "WITH r AS (SELECT l_returnflag AS f, l_extendedprice AS v, l_quantity * 500 AS s FROM lineitem), p0 AS (SELECT f, sum(v / (s * s)) / sum(1 / (s * s)) AS m, FALSE AS d FROM r GROUP BY f), "
    + ", ".join(f"p{k} AS MATERIALIZED ({_PASS.format(f'p{k - 1}')})" for k in range(1, 11))
    + " SELECT f AS l_returnflag, round(m, 3) AS value FROM p10"
)
def virls(spark, d):
    rows = table(spark, d, "lineitem").select("l_returnflag", "l_extendedprice", (F.col("l_quantity") * 500).alias("s"))
    return stats.irls(rows, ["l_returnflag"], "l_extendedprice", "s").withColumn("value", F.round("value", 3))


@query("""SELECT l_suppkey, round(avg(v), 4) AS value FROM (SELECT l_suppkey, l_extendedprice AS v, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) - 1 AS k, count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem) WHERE n > 1 AND k >= CASE WHEN n <= 3 THEN 0 ELSE floor(n * 0.25 + 0.5) END AND k < CASE WHEN n <= 3 THEN n ELSE floor(n * 0.75 + 0.25) END GROUP BY l_suppkey""")
def liststats_inner(spark, d):
    return bins.list_mean(table(spark, d, "lineitem"), ["l_suppkey"], "l_extendedprice").select("l_suppkey", F.round("value", 4).alias("value"))


@query("""SELECT round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""")
def linfit(spark, d):
    a, b = stats.polynomial_fit(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", 1)
    return spark.createDataFrame([(round(b, 5), round(a, 4))], "slope double, intercept double")


@query("SELECT l_orderkey, l_linenumber, round(y - fitted, 4) AS residual FROM (" + fits.projection_sql("SELECT *, l_extendedprice AS y FROM lineitem", ["1.0::DOUBLE", "l_quantity", "l_quantity * l_quantity"]) + ")")
def polyfit2(spark, d):
    lines = table(spark, d, "lineitem")
    c = stats.polynomial_fit(lines, "l_quantity", "l_extendedprice", 2)
    return lines.select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") - stats.apply_polynomial(F.col("l_quantity"), c), 4).alias("residual"))
