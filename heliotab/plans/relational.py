"""Extract-where, joins of keys, and the idioms of workflow tables."""

from pyspark.sql import Window, functions as F

from heliotab.functions import libm
from heliotab.operators import joins
from heliotab.plans.registry import query, same, table

same("extract_where", "SELECT l_orderkey, l_extendedprice * (1 - l_discount) AS revenue FROM {lineitem} WHERE l_quantity > 30 AND l_discount >= 0.05", ("lineitem",))
same("extract_region", "SELECT c_custkey, c_name, c_acctbal FROM {customer} WHERE c_acctbal BETWEEN 0 AND 2500 AND c_nationkey IN (1, 2, 3)", ("customer",))
same("list_limited", "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 25", ("orders",))
same("join_inner", "SELECT o_orderkey, c_name, o_totalprice FROM {orders} JOIN {customer} ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'", ("orders", "customer"))
same("join_left", "SELECT c_custkey, count(o_orderkey) AS n_orders FROM {customer} LEFT JOIN {orders} ON o_custkey = c_custkey GROUP BY c_custkey", ("customer", "orders"))
same("join_right", "SELECT c_custkey, o_orderkey FROM {orders} RIGHT JOIN {customer} ON o_custkey = c_custkey AND o_totalprice > 300000", ("customer", "orders"))
@query("SELECT s_nationkey, c_nationkey, s_suppkey, c_custkey FROM (SELECT * FROM supplier WHERE s_acctbal > 0) s FULL JOIN (SELECT * FROM customer WHERE c_acctbal > 9500) c ON s_nationkey = c_nationkey")
def join_full(spark, d):
    suppliers = table(spark, d, "supplier").where("s_acctbal > 0").select("s_nationkey", "s_suppkey")
    customers = table(spark, d, "customer").where("c_acctbal > 9500").select("c_nationkey", "c_custkey")
    return joins.full_of_few_keys(suppliers, customers, "s_nationkey", "c_nationkey", ["s_suppkey"]).select("s_nationkey", "c_nationkey", "s_suppkey", "c_custkey")


same("join_anti", "SELECT c_custkey FROM {customer} c LEFT JOIN {orders} o ON o_custkey = c_custkey WHERE o_orderkey IS NULL", ("customer", "orders"), "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
same("join_semi", "SELECT s_suppkey, s_name FROM {supplier} WHERE s_suppkey IN (SELECT l_suppkey FROM {lineitem} WHERE l_quantity >= 49)", ("supplier", "lineitem"))
same("join_self_pairs", "SELECT a.l_orderkey, a.l_linenumber AS line_a, b.l_linenumber AS line_b, count(*) AS n FROM {lineitem} a JOIN {lineitem} b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber WHERE a.l_returnflag = 'R' AND b.l_returnflag = 'A' GROUP BY a.l_orderkey, a.l_linenumber, b.l_linenumber", ("lineitem",))
same("cross_dimension", "SELECT r_name, n_name FROM {region} CROSS JOIN {nation} WHERE r_regionkey <> n_regionkey", ("region", "nation"))
same("completeness_having", "SELECT o_orderkey, count(*) AS lines FROM {orders} JOIN {lineitem} ON o_orderkey = l_orderkey GROUP BY o_orderkey HAVING count(*) = sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)", ("orders", "lineitem"))
same("completeness_left", "SELECT o_orderkey, CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 0) AS BIGINT) AS faults FROM {orders} LEFT JOIN {lineitem} ON o_orderkey = l_orderkey GROUP BY o_orderkey HAVING count(o_orderkey) = count(l_orderkey) AND coalesce(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END), 0) = 0", ("orders", "lineitem"))
same("max_subquery", "SELECT o.o_custkey, o.o_orderkey FROM {orders} o JOIN (SELECT o_custkey, max(o_orderkey) AS k FROM {orders} GROUP BY o_custkey) m ON o.o_custkey = m.o_custkey AND o.o_orderkey = m.k", ("orders",))
same("scalar_subquery", "SELECT l_orderkey, l_linenumber, l_extendedprice FROM {lineitem} WHERE l_extendedprice > (SELECT 1.95 * avg(l_extendedprice) FROM {lineitem})", ("lineitem",))
same("correlated_lookup", "SELECT s_suppkey, (SELECT n_name FROM {nation} WHERE n_nationkey = s_nationkey) AS nation FROM {supplier}", ("supplier", "nation"))
same("derived_table", "SELECT seg, count(*) AS n, round(avg(total), 2) AS mean_total FROM (SELECT c_mktsegment AS seg, c_custkey, sum(o_totalprice) AS total FROM {customer} JOIN {orders} ON c_custkey = o_custkey GROUP BY c_mktsegment, c_custkey) t GROUP BY seg", ("customer", "orders"))
same("union_distinct", "SELECT s_nationkey AS nation FROM {supplier} WHERE s_acctbal > 5000 UNION SELECT c_nationkey FROM {customer} WHERE c_acctbal < 0", ("supplier", "customer"))
same("union_all", "SELECT 'supplier' AS kind, count(*) AS n FROM {supplier} UNION ALL SELECT 'customer', count(*) FROM {customer}", ("supplier", "customer"))
same("intersect_keys", "SELECT s_nationkey AS k FROM {supplier} INTERSECT SELECT c_nationkey FROM {customer}", ("supplier", "customer"))
same("except_keys", "SELECT c_custkey AS k FROM {customer} EXCEPT SELECT o_custkey FROM {orders}", ("customer", "orders"))
same("case_locate", "SELECT p_partkey, CASE WHEN p_size > 40 THEN 'large' WHEN p_size > 20 THEN 'middle' ELSE 'small' END AS kind, position('#' IN p_brand) AS place, length(p_type) AS n FROM {part}", ("part",), "SELECT p_partkey, CASE WHEN p_size > 40 THEN 'large' WHEN p_size > 20 THEN 'middle' ELSE 'small' END AS kind, CAST(position('#' IN p_brand) AS INT) AS place, CAST(length(p_type) AS INT) AS n FROM part")
same("substring_index", "SELECT page_id, substring_index(substring_index(url, '/', 3), '/', -1) AS host FROM {pages}", ("pages",), "SELECT page_id, split_part(url, '/', 3) AS host FROM pages")
same("group_concat", "SELECT n_regionkey, array_join(sort_array(collect_list(n_name)), ',') AS names FROM {nation} GROUP BY n_regionkey", ("nation",), "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")
same("conditional_sums", "SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS n_full, sum(if(o_totalprice > 100000, 1, 0)) AS n_large, count(DISTINCT o_orderpriority) AS n_priorities FROM {orders} GROUP BY o_custkey", ("orders",), "SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_full, CAST(sum(CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END) AS BIGINT) AS n_large, count(DISTINCT o_orderpriority) AS n_priorities FROM orders GROUP BY o_custkey")
same("null_handling", "SELECT c_custkey, coalesce(o_orderstatus, 'none') AS status, ifnull(o_totalprice, -1.0) AS total FROM {customer} LEFT JOIN {orders} ON c_custkey = o_custkey AND o_totalprice > 400000", ("customer", "orders"))
same("time_difference", "SELECT l_orderkey, l_linenumber, l_quantity, l_partkey, datediff(DAY, o_orderdate, l_shipdate) AS days FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey WHERE l_quantity > 45", ("lineitem", "orders"), "SELECT l_orderkey, l_linenumber, l_quantity, l_partkey, date_sub('day', o_orderdate, l_shipdate) AS days FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity > 45")
same("rollup_flags", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM {lineitem} GROUP BY ROLLUP (l_returnflag, l_linestatus)", ("lineitem",))
same("cube_flags", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)", ("lineitem",))
same("grouping_sets", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders} GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())", ("orders",))
same("ranking_windows", "SELECT c_nationkey, c_custkey, rank() OVER w AS place, dense_rank() OVER w AS dense_place, ntile(4) OVER w AS quarter FROM {customer} WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)", ("customer",), "SELECT c_nationkey, c_custkey, CAST(rank() OVER w AS INT) AS place, CAST(dense_rank() OVER w AS INT) AS dense_place, CAST(ntile(4) OVER w AS INT) AS quarter FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)")
same("json_props", "SELECT event_type, CAST(sum(CAST(get_json_object(props, '$.k') AS INT)) AS BIGINT) AS total, count(DISTINCT get_json_object(props, '$.k')) AS kinds FROM {events} GROUP BY event_type", ("events",), "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS INT)) AS BIGINT) AS total, count(DISTINCT json_extract_string(props, '$.k')) AS kinds FROM events GROUP BY event_type")
same("pivot_status", "SELECT o_orderpriority, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS f, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS o, count(CASE WHEN o_orderstatus = 'P' THEN 1 END) AS p FROM {orders} GROUP BY o_orderpriority", ("orders",))
same("update_rewrite", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_totalprice < 1000 THEN 'cleaned' ELSE o_orderstatus END AS state FROM {orders}", ("orders",))
same("update_join_rewrite", "SELECT o_orderkey, CASE WHEN f.k IS NOT NULL THEN 'failed' ELSE o_orderstatus END AS state FROM {orders} LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM {lineitem} WHERE l_returnflag = 'R' AND l_quantity > 49) f ON o_orderkey = f.k", ("orders", "lineitem"))
same("delete_rewrite", "SELECT o_orderkey FROM {orders} WHERE NOT (o_orderstatus = 'P' OR o_totalprice < 500)", ("orders",))
same("delete_join_rewrite", "SELECT o_orderkey FROM {orders} WHERE NOT EXISTS (SELECT 1 FROM {lineitem} WHERE l_discount = 0.1 AND l_orderkey = o_orderkey)", ("orders", "lineitem"), "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_discount = 0.1 AND l_orderkey IS NOT NULL)")
same("insert_select", "SELECT o_orderkey AS k, o_orderstatus AS state FROM {orders} WHERE o_orderstatus = 'F' UNION ALL SELECT -1 - c_custkey, 'new' FROM {customer} WHERE c_acctbal < -900", ("orders", "customer"))
_PLACES = "SELECT s_suppkey, c_custkey, 2 * asin(sqrt(power(sin((cb - sb) / 2), 2) + cos(sb) * cos(cb) * power(sin((cl - sl) / 2), 2))) AS dist FROM (SELECT s_suppkey, s_nationkey, radians((s_suppkey * 37.7) % 360) AS sl, radians(s_acctbal % 90) AS sb FROM supplier) s JOIN (SELECT c_custkey, c_nationkey, radians((c_custkey * 37.7) % 360) AS cl, radians(c_acctbal % 90) AS cb FROM customer) c ON s_nationkey = c_nationkey"
@query(f"SELECT s_suppkey, CAST(split_part(string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY dist, c_custkey), ',', 1) AS BIGINT) AS partner, round(degrees(min(dist)), 8) AS degrees FROM ({_PLACES}) GROUP BY s_suppkey")
def haversine_group(spark, d):
    """The nearest partner of the same group by great-circle distance, by cells of growing size."""
    suppliers = table(spark, d, "supplier").selectExpr("s_suppkey", "s_nationkey AS nation", "(s_suppkey * 377) % 3600 / 10D AS sl", "s_acctbal % 90 AS sb")
    customers = table(spark, d, "customer").selectExpr("c_custkey AS partner", "c_nationkey AS nation", "(c_custkey * 377) % 3600 / 10D AS cl", "c_acctbal % 90 AS cb")
    out = joins.nearest_of_group(suppliers, customers, "nation", "s_suppkey", ("sl", "sb"), ("cl", "cb"), "partner")
    return out.select("s_suppkey", "partner", libm.rounded(F.degrees("radians"), 8).alias("degrees"))


@query("""SELECT o_orderkey, coalesce(l_partkey, -1) AS first_part FROM orders LEFT JOIN (
            SELECT l_orderkey, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1) ON o_orderkey = l_orderkey""")
def join_outer_first(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.struct("l_linenumber", "l_partkey").alias("k"), F.col("l_partkey").alias("first_part"))
    return joins.first_match(table(spark, d, "orders").select("o_orderkey"), lines, "o_orderkey", "k", "first_part")


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 2""")
def top_k_per_group(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, d, "orders").withColumn("k", F.row_number().over(w)).where("k <= 2").select("o_orderkey", "o_custkey", "o_totalprice")


@query("""SELECT l_orderkey, min(CASE WHEN l_returnflag = 'N' AND l_discount < 0.02 THEN 11 WHEN l_returnflag = 'N' THEN 12 WHEN l_returnflag = 'A' THEN 13 ELSE 14 END) AS best_rank FROM lineitem GROUP BY l_orderkey""")
def rank_quality(spark, d):
    n, a = F.col("l_returnflag") == "N", F.col("l_returnflag") == "A"
    rank = F.when(n & (F.col("l_discount") < 0.02), 11).when(n, 12).when(a, 13).otherwise(14)
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min(rank).alias("best_rank"))


@query("""SELECT coalesce(n.k, o.k) AS k, coalesce(n.state, o.state) AS state FROM (SELECT o_orderkey AS k, o_orderstatus AS state FROM orders) o
          FULL JOIN (SELECT o_orderkey * 3 AS k, 'new' AS state FROM orders WHERE o_orderkey % 7 = 0) n ON n.k = o.k""")
def upsert(spark, d):
    old = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("state"))
    new = table(spark, d, "orders").where("o_orderkey % 7 = 0").select((F.col("o_orderkey") * 3).alias("k"), F.lit("new").alias("state"))
    return old.join(new.select("k"), "k", "left_anti").unionByName(new)


@query("""SELECT l_suppkey, n_parts, spread FROM (SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts, max(l_quantity) - min(l_quantity) AS spread FROM lineitem GROUP BY l_suppkey) WHERE n_parts > 10""")
def staged_table(spark, d):
    staged = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.countDistinct("l_partkey").alias("n_parts"), (F.max("l_quantity") - F.min("l_quantity")).alias("spread"))
    return staged.where("n_parts > 10")


@query("""SELECT DISTINCT split_part(url, '/', 3) AS host, split_part(url, '/', 4) AS entry, count(*) OVER (PARTITION BY split_part(url, '/', 3), split_part(url, '/', 4)) AS n FROM pages""")
def namespace_find(spark, d):
    parts = F.split("url", "/")
    return table(spark, d, "pages").groupBy(parts[2].alias("host"), F.coalesce(F.get(parts, 3), F.lit("")).alias("entry")).agg(F.count("*").alias("n"))
