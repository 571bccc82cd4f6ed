"""The functions of the expression language, of strings, and the idioms of SQL templates, each over a whole table."""

from pyspark.sql import functions as F

from heliotab.functions import sem, strings
from heliotab.operators import sampling
from heliotab.plans.registry import query, same, table

_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _lines(spark, d, **columns):
    return table(spark, d, "lineitem").select(*_LINE.split(", "), *[c.alias(k) for k, c in columns.items()])


@query("SELECT p_partkey, round(p_retailprice / 7) AS r, round_even(p_size / 2.0::DOUBLE, 0) AS e, floor(-p_retailprice / 7) AS f, ceil(-p_retailprice / 7) AS c, CAST(trunc(-p_retailprice / 7) AS BIGINT) AS i FROM part")
def expr_rounding(spark, d):
    p = F.col("p_retailprice")
    return table(spark, d, "part").select("p_partkey", F.round(p / 7).alias("r"), F.rint(F.col("p_size") / 2).alias("e"), F.floor(-p / 7).cast("double").alias("f"), F.ceil(-p / 7).cast("double").alias("c"), sem.trunc(-p / 7).alias("i"))


@query(f"SELECT {_LINE}, round(exp(l_discount), 9) AS e, round(sinh(l_discount), 9) AS sh, round(cosh(l_tax), 9) AS ch, round(asinh(l_quantity), 9) AS ash, round(acosh(l_quantity), 9) AS ach FROM lineitem")
def expr_exponential(spark, d):
    c = F.col
    return _lines(spark, d, e=F.round(F.exp(c("l_discount")), 9), sh=F.round(F.sinh(c("l_discount")), 9), ch=F.round(F.cosh(c("l_tax")), 9), ash=F.round(F.asinh(c("l_quantity")), 9), ach=F.round(F.acosh(c("l_quantity")), 9))


@query(f"SELECT {_LINE}, round(sin(l_quantity), 9) AS s, round(cos(l_quantity), 9) AS c, round(tan(l_discount), 9) AS t, round(asin(l_discount), 9) AS a, round(acos(l_discount), 9) AS o, round(atan(l_quantity), 9) AS n, round(atan2(l_tax, l_discount + 1), 9) AS n2 FROM lineitem")
def expr_radians(spark, d):
    c = F.col
    return _lines(spark, d, s=F.round(F.sin("l_quantity"), 9), c=F.round(F.cos("l_quantity"), 9), t=F.round(F.tan("l_discount"), 9), a=F.round(F.asin("l_discount"), 9), o=F.round(F.acos("l_discount"), 9), n=F.round(F.atan("l_quantity"), 9), n2=F.round(F.atan2(c("l_tax"), c("l_discount") + 1), 9))


@query(f"SELECT {_LINE}, round(cos(radians(l_quantity)), 9) AS c, round(tan(radians(l_quantity)), 9) AS t, round(degrees(asin(l_discount)), 9) AS a, round(degrees(acos(l_discount)), 9) AS o, round(degrees(atan(l_quantity)), 9) AS n FROM lineitem")
def expr_degrees(spark, d):
    c = F.col
    return _lines(spark, d, c=F.round(sem.dcos(c("l_quantity")), 9), t=F.round(sem.dtan(c("l_quantity")), 9), a=F.round(sem.dasin(c("l_discount")), 9), o=F.round(sem.dacos(c("l_discount")), 9), n=F.round(sem.datan(c("l_quantity")), 9))


@query("SELECT p_partkey, power(2.0, power(2, p_size % 3)) AS p, greatest(p_size, p_partkey % 40) AS hi, least(p_size, p_partkey % 40) AS lo, -p_size AS neg, 0 AS zero, p_size % 7 AS m FROM part")
def expr_power(spark, d):
    """2 ^ 2 ^ n, grouped from the right; the greater and the lesser of two, under both of their names; negation, zero and remainder."""
    z, k = F.col("p_size"), F.col("p_partkey") % 40
    return table(spark, d, "part").select("p_partkey", F.pow(F.lit(2.0), F.pow(F.lit(2), z % 3)).alias("p"), sem.maximum(z, k).alias("hi"), sem.minimum(z, k).alias("lo"), (-z).alias("neg"), F.lit(0).alias("zero"), (z % 7).alias("m"))


_ODD = "CASE p_partkey % 5 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN '-inf'::DOUBLE WHEN 3 THEN p_retailprice END"


@query(f"SELECT p_partkey, CASE WHEN isnan(x) THEN 1 WHEN x IS NOT NULL THEN 0 END AS nan_, CASE WHEN isinf(x) THEN 1 WHEN x IS NOT NULL THEN 0 END AS inf_, CASE WHEN x IS NULL THEN NULL WHEN isnan(x) THEN 0 WHEN x < 1500 THEN 1 ELSE 0 END AS lt, CASE WHEN x IS NULL THEN NULL WHEN isnan(x) THEN 0 WHEN x <= 1500 THEN 1 ELSE 0 END AS le, CASE WHEN x IS NULL THEN NULL WHEN isnan(x) OR x <> 1500 THEN 1 ELSE 0 END AS ne, CASE WHEN x IS NULL THEN NULL WHEN isnan(x) THEN 'NaN'::DOUBLE ELSE greatest(x, 1500) END AS hi FROM (SELECT p_partkey, {_ODD} AS x FROM part)")
def expr_nonfinite(spark, d):
    """Tests and comparisons of NaN, infinities and nulls."""
    k, x, level = F.col("p_partkey") % 5, F.col("x"), F.lit(1500.0)
    odd = F.when(k == 0, F.lit(sem.NAN)).when(k == 1, F.lit(sem.INF)).when(k == 2, F.lit(-sem.INF)).when(k == 3, F.col("p_retailprice"))
    known = lambda c: F.when(x.isNotNull(), c.cast("int"))
    rows = table(spark, d, "part").select("p_partkey", odd.alias("x"))
    return rows.select("p_partkey", known(F.isnan(x)).alias("nan_"), known(F.abs(x) == sem.INF).alias("inf_"), known(sem.lt(x, level)).alias("lt"), known(sem.le(x, level)).alias("le"), known(sem.ne(x, level)).alias("ne"), sem.maximum(x, level).alias("hi"))


@query("SELECT c_custkey, k, CASE WHEN k = 0 THEN (CASE WHEN c_acctbal > 0 THEN 'inf'::DOUBLE WHEN c_acctbal < 0 THEN '-inf'::DOUBLE WHEN c_acctbal = 0 THEN 'NaN'::DOUBLE END) ELSE round(c_acctbal / k, 6) END AS q, CASE WHEN k = 0 THEN 'NaN'::DOUBLE ELSE 0 END AS z, CASE WHEN k <> 0 THEN CAST(c_custkey // k AS BIGINT) END AS i FROM (SELECT *, CAST(c_custkey % 4 AS BIGINT) AS k FROM customer)")
def expr_division(spark, d):
    """Division of floats by numbers among which 0 is: infinities of the dividend's sign, and NaN for 0 by 0; of integers, toward zero."""
    k, b = F.col("c_custkey") % 4, F.col("c_acctbal")
    q = sem.fdiv(b, k)
    return table(spark, d, "customer").select("c_custkey", k.alias("k"), F.when(sem.is_finite(q), F.round(q, 6)).otherwise(q).alias("q"), sem.fdiv(F.lit(0.0), k).alias("z"), sem.idiv(F.col("c_custkey"), k).alias("i"))


@query(f"SELECT {_LINE}, round(lgamma(l_quantity + l_discount), 8) AS lgamma FROM lineitem")
def expr_lgamma(spark, d):
    return _lines(spark, d, lgamma=F.round(sem.lgamma(F.col("l_quantity") + F.col("l_discount")), 8))


@query(f"WITH x AS (SELECT *, l_quantity * 0.08 - 1.997 + l_discount AS x FROM lineitem) SELECT {_LINE}, round(2 / sqrt(pi()) * list_sum(list_transform(range(0, 80), lambda n: power(-1, n) * power(x, 2 * n + 1) / (gamma(n + 1) * (2 * n + 1)))), 8) AS erf FROM x")
def expr_erf(spark, d):
    """The error function from -2 to 2.1; its oracle is the power series."""
    return _lines(spark, d, erf=F.round(sem.erf(F.col("l_quantity") * 0.08 - 1.997 + F.col("l_discount")), 8))


@query(r"""SELECT p_partkey, s, CAST(regexp_full_match(s, '\s*[-+]?[0-9]+\s*') AS INT) AS is_int, CAST(regexp_full_match(s, '\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*') AS INT) AS is_num,
  CAST(regexp_full_match(s, '\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*') AND NOT regexp_full_match(s, '\s*[-+]?[0-9]+\s*') AS INT) AS is_flt, CAST(NOT regexp_full_match(s, '\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*') AS INT) AS is_word
  FROM (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN CAST(p_size AS VARCHAR) WHEN 2 THEN '-' || p_size || '.5' WHEN 3 THEN p_size || 'e-2' ELSE ' ' || p_size || 'x' END AS s FROM part)""")
def expr_types(spark, d):
    """Which words are integers, floats or numbers at all."""
    k, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    s = F.when(k == 0, F.col("p_name")).when(k == 1, size).when(k == 2, F.concat(F.lit("-"), size, F.lit(".5"))).when(k == 3, F.concat(size, F.lit("e-2"))).otherwise(F.concat(F.lit(" "), size, F.lit("x")))
    flag = lambda c, name: c.cast("int").alias(name)
    word = F.col("s")
    return table(spark, d, "part").select("p_partkey", s.alias("s")).select("p_partkey", "s", flag(strings.is_int(word), "is_int"), flag(strings.is_number(word), "is_num"), flag(strings.is_number(word) & ~strings.is_int(word), "is_flt"), flag(~strings.is_number(word), "is_word"))


_UNIFORM = "CAST('0x' || substr(md5(CAST({0} AS VARCHAR) || ':' || {1}), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE"


@query(f"SELECT o_orderkey, round(u, 9) AS d, CAST(floor(u * 2147483648) AS BIGINT) AS l, CAST(floor(u * 4294967296) - 2147483648 AS BIGINT) AS m, round(5 + 2 * sqrt(-2 * ln(1 - u)) * cos(2 * pi() * v), 6) AS g FROM (SELECT o_orderkey, {_UNIFORM.format('o_orderkey', 7)} AS u, {_UNIFORM.format('o_orderkey', 8)} AS v FROM orders)")
def random_numbers(spark, d):
    """Uniform numbers from 0 to 1, of 31 bits and of 32 signed bits, and Gaussian ones: by a hash of key and seed, so they are the same in every run and at any partitioning."""
    u, key = sampling.uniform, F.col("o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", F.round(u(key, 7), 9).alias("d"), F.floor(u(key, 7) * (1 << 31)).alias("l"), (F.floor(u(key, 7) * (1 << 32)) - (1 << 31)).alias("m"), F.round(sampling.gaussian(key, 7, 5.0, 2.0), 6).alias("g"))


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE {_UNIFORM.format('l_orderkey', 3)} < 0.1")
def sample_rows(spark, d):
    """A tenth of the orders' lines, by a hash of the order."""
    return _lines(spark, d).where(sampling.uniform(F.col("l_orderkey"), 3) < 0.1)


@query(f"SELECT c_mktsegment, r AS replica, CAST(sum(w) AS BIGINT) AS weight, round(sum(w * c_acctbal), 2) AS total FROM (SELECT c_mktsegment, c_acctbal, r, CASE WHEN u < 0.36787944117144233 THEN 0 WHEN u < 0.7357588823428847 THEN 1 WHEN u < 0.9196986029286058 THEN 2 WHEN u < 0.9810118431238462 THEN 3 ELSE 4 END AS w FROM (SELECT *, {_UNIFORM.format('c_custkey', 'r')} AS u FROM customer, (SELECT unnest(range(20)) AS r))) GROUP BY ALL")
def bootstrap_means(spark, d):
    """Twenty bootstrap means of each segment; rows count in each replica with a weight drawn by a hash."""
    out = sampling.bootstrap(table(spark, d, "customer"), ["c_mktsegment"], F.col("c_custkey"), F.col("c_acctbal"), 20)
    return out.select("c_mktsegment", "replica", "weight", F.round("total", 2).alias("total"))


@query("""SELECT page_id, regexp_extract(url, '[^/]*$') AS base, regexp_replace(url, '/[^/]*$', '') AS dir, CAST(strpos(url, '.') - 1 AS INT) AS chr, split_part(url, '/', 1) AS head, substr(url, length(split_part(url, '/', 1)) + 2) AS tail,
  replace(url, 'http', 'ftp') AS sub, CAST(regexp_matches(url, '^https?://[a-z.]+/') AS INT) AS matches, printf('%05d:%s', page_id, substr(url, 1, 8)) AS text, CAST('0x' || substr(md5(url), 1, 8) AS BIGINT) % 1000 AS hash, CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 AS int_hash FROM pages""")
def string_verbs(spark, d):
    """Base and directory names, the place of a character, popping, substitution, matching, formatting and hashes of words."""
    url = F.col("url")
    return table(spark, d, "pages").select(
        "page_id", strings.basename(url).alias("base"), strings.dirname(url).alias("dir"), strings.find(url, ".").alias("chr"), strings.pop(url, "/")[0].alias("head"), strings.pop(url, "/")[1].alias("tail"),
        F.replace(url, F.lit("http"), F.lit("ftp")).alias("sub"), F.rlike(url, F.lit("^https?://[a-z.]+/")).cast("int").alias("matches"), F.format_string("%05d:%s", "page_id", F.substring(url, 1, 8)).alias("text"),
        strings.word_hash(url, 1000).alias("hash"), strings.word_hash(F.col("page_id").cast("string"), 1000).alias("int_hash"),
    )


same("sql_text", "SELECT c_custkey, concat(c_name, '/', c_mktsegment) AS joined, concat_ws('-', c_name, NULL, CAST(c_nationkey AS STRING)) AS ws, trim(concat('  ', c_mktsegment, ' ')) AS t, hex(c_nationkey) AS h, substring(c_name, 3, 5) AS s, replace(c_name, '#', '_') AS r FROM {customer} WHERE c_mktsegment LIKE 'B%'", ("customer",), "SELECT c_custkey, concat(c_name, '/', c_mktsegment) AS joined, concat_ws('-', c_name, NULL, CAST(c_nationkey AS VARCHAR)) AS ws, trim(concat('  ', c_mktsegment, ' ')) AS t, CASE WHEN c_nationkey = 0 THEN '0' ELSE ltrim(hex(c_nationkey), '0') END AS h, substring(c_name, 3, 5) AS s, replace(c_name, '#', '_') AS r FROM customer WHERE c_mktsegment LIKE 'B%'")
same("sql_truncate", "SELECT o_orderkey, sign(o_totalprice - 150000) * floor(abs(o_totalprice - 150000) * 10) / 10 AS cut, CAST(o_totalprice AS DECIMAL(15, 2)) AS money, CAST(o_orderkey AS STRING) AS word FROM {orders}", ("orders",), "SELECT o_orderkey, sign(o_totalprice - 150000) * floor(abs(o_totalprice - 150000) * 10) / 10 AS cut, CAST(o_totalprice AS DECIMAL(15, 2)) AS money, CAST(o_orderkey AS VARCHAR) AS word FROM orders")
same("sql_times", "SELECT event_id, unix_timestamp(CAST(ts AS TIMESTAMP)) % 86400 AS sec, date_format(ts, 'yyyy-MM-dd') AS day, CAST(ts AS TIMESTAMP) < now() AS past FROM {events}", ("events",), "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) % 86400 AS sec, strftime(ts, '%Y-%m-%d') AS day, ts < now() AS past FROM events")
same("sql_cte", "WITH late AS (SELECT l_orderkey, max(l_shipdate) AS shipped FROM {lineitem} GROUP BY l_orderkey), slow AS (SELECT o_orderkey, datediff(DAY, o_orderdate, shipped) AS days FROM {orders} JOIN late ON l_orderkey = o_orderkey) SELECT days, count(*) AS n FROM slow WHERE days > 0 GROUP BY days", ("lineitem", "orders"), "WITH late AS (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY l_orderkey), slow AS (SELECT o_orderkey, date_sub('day', o_orderdate, shipped) AS days FROM orders JOIN late ON l_orderkey = o_orderkey) SELECT days, count(*) AS n FROM slow WHERE days > 0 GROUP BY days")
same("sql_advance", "SELECT o_custkey AS run, count(*) AS parts, count_if(o_orderstatus = 'F') AS done, CASE WHEN count(*) = count_if(o_orderstatus = 'F') THEN 'full' WHEN count_if(o_orderstatus = 'F') = 0 THEN 'new' ELSE 'run' END AS state FROM {orders} GROUP BY o_custkey", ("orders",), "SELECT o_custkey AS run, count(*) AS parts, CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS done, CASE WHEN count(*) = count_if(o_orderstatus = 'F') THEN 'full' WHEN count_if(o_orderstatus = 'F') = 0 THEN 'new' ELSE 'run' END AS state FROM orders GROUP BY o_custkey")
