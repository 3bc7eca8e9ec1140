"""E: joins, F: aggregations, G: per-key rows, sort/limit, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from starling.operators import aggregates as A
from starling.operators import joins as J
from starling.operators import windows as W
from starling.operators.load import insert_or_ignore
from starling.plans.bindings.common import (
    DIRTY_CUSTOMER_SQL, DIRTY_LINEITEM_SQL, DIRTY_ORDERS_SQL, LINE_TIEBREAK, bind, dirty_customer, dirty_lineitem,
    dirty_orders, table,
)

# ------------------------------------------------------------------ E: joins


@bind("join_inner_multikey", """WITH s AS (SELECT l_orderkey, l_suppkey, sum(l_quantity) AS supp_qty FROM lineitem
  GROUP BY l_orderkey, l_suppkey)
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_partkey, s.supp_qty FROM lineitem l
  JOIN s ON l.l_orderkey = s.l_orderkey AND l.l_suppkey = s.l_suppkey""")
def q_join_inner_multikey(spark, sf):
    li = table(spark, sf, "lineitem")
    s = li.groupBy("l_orderkey", "l_suppkey").agg(F.sum("l_quantity").alias("supp_qty"))
    return J.join_inner_multikey(li.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"), s,
                                 ["l_orderkey", "l_suppkey"])


@bind("star_join_sample", """SELECT o.o_orderkey, o.o_orderdate, o.o_totalprice, c.c_custkey, c.c_name,
  c.c_mktsegment, n.n_name, r.r_name, o.o_orderstatus FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  ORDER BY o.o_orderkey LIMIT 5""")
def q_star_join_sample(spark, sf):
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    j = (o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
         .join(r, n["n_regionkey"] == r["r_regionkey"]))
    cols = ["o_orderkey", "o_orderdate", "o_totalprice", "c_custkey", "c_name", "c_mktsegment", "n_name", "r_name",
            "o_orderstatus"]
    return W.sample_limit(j.select(*cols), 5, ["o_orderkey"])


@bind("star_join_left", """SELECT o.o_orderkey, o.o_orderdate, c.c_name, c.c_mktsegment, n.n_name, r.r_name
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey WHERE c.c_mktsegment = 'BUILDING'
  ORDER BY o.o_orderdate DESC, o.o_orderkey DESC""")
def q_star_join_left(spark, sf):
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    j = (o.join(c, o["o_custkey"] == c["c_custkey"], "left").join(n, c["c_nationkey"] == n["n_nationkey"], "left")
         .join(r, n["n_regionkey"] == r["r_regionkey"], "left")
         .where(F.col("c_mktsegment") == "BUILDING"))          # filter on a left-joined column: Catalyst -> inner
    return j.select("o_orderkey", "o_orderdate", "c_name", "c_mktsegment", "n_name", "r_name") \
            .orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc())


@bind("join_inner_group", """SELECT c.c_mktsegment, count(*) AS orders,
  round(sum(o.o_totalprice), 2) AS revenue FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY c.c_mktsegment""")
def q_join_inner_group(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return (o.join(c, o["o_custkey"] == c["c_custkey"]).groupBy("c_mktsegment")
            .agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue")))


@bind("anti_join_left_null", f"""SELECT d.* FROM {DIRTY_ORDERS_SQL} d LEFT JOIN customer c ON d.o_custkey = c.c_custkey
  WHERE d.o_custkey IS NOT NULL AND c.c_custkey IS NULL""")
def q_anti_join_left_null(spark, sf):
    d = dirty_orders(spark, sf)
    return J.anti_join(d.where(F.col("o_custkey").isNotNull()), table(spark, sf, "customer"),
                       [("o_custkey", "c_custkey")])


@bind("anti_join_not_in", f"""WITH c AS (SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey END AS k
  FROM customer)
SELECT d.* FROM {DIRTY_ORDERS_SQL} d WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.k = d.o_custkey)""")
def q_anti_join_not_in(spark, sf):
    # parent keys contain NULLs: SQL NOT IN would return nothing; the anti-join does not
    c = table(spark, sf, "customer").select(
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")).alias("k"))
    return J.anti_join(dirty_orders(spark, sf), c, [("o_custkey", "k")])


@bind("lookup_left", f"""SELECT d.l_orderkey, d.l_linenumber, d.l_suppkey, s.s_name FROM
  (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 10 = 0 THEN l_suppkey + 100000 ELSE l_suppkey END AS l_suppkey
   FROM lineitem) d LEFT JOIN supplier s ON d.l_suppkey = s.s_suppkey""")
def q_lookup_left(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_partkey") % 10 == 0, F.col("l_suppkey") + 100000).otherwise(F.col("l_suppkey")).alias("l_suppkey"))
    return J.lookup_left(li, table(spark, sf, "supplier"), "l_suppkey", "s_suppkey", "s_name")


@bind("join_null_safe", f"""WITH d AS {DIRTY_CUSTOMER_SQL},
g AS (SELECT c_nationkey, count(*) AS nation_customers FROM d GROUP BY c_nationkey)
SELECT d.c_custkey, d.c_nationkey, g.nation_customers FROM d JOIN g ON d.c_nationkey IS NOT DISTINCT FROM g.c_nationkey""")
def q_join_null_safe(spark, sf):
    d = dirty_customer(spark, sf)
    g = d.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("nation_customers"))
    return J.join_null_safe(d.select("c_custkey", "c_nationkey"), g, ["c_nationkey"])


@bind("join_one_to_many", """SELECT o.o_orderkey, o.o_orderdate, l.l_linenumber, l.l_partkey, l.l_quantity
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
def q_join_one_to_many(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey",
                                             "l_quantity")
    return J.join_one_to_many(o, li, "o_orderkey")


@bind("semi_in_set", """SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c
  WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment = 'BUILDING')""")
def q_semi_in_set(spark, sf):
    # rows whose key is NOT among the known (BUILDING) customers: the negated membership test
    known = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return J.anti_join(table(spark, sf, "orders"), known, [("o_custkey", "c_custkey")])


# ------------------------------------------------------------------ F: aggregations

@bind("count_rows", "SELECT count(*) AS row_count FROM lineitem")
def q_count_rows(spark, sf):
    return A.count_rows(table(spark, sf, "lineitem"))


@bind("count_distinct", "SELECT count(DISTINCT o_custkey) AS distinct_count FROM orders")
def q_count_distinct(spark, sf):
    return A.count_distinct(table(spark, sf, "orders"), ["o_custkey"])


@bind("success_rate", """SELECT CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS successes,
  count(*) AS total, coalesce(round(100.0 * sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)
  / nullif(count(*), 0), 1), 0.0) AS success_rate FROM orders""")
def q_success_rate(spark, sf):
    return A.success_rate(table(spark, sf, "orders"), "o_orderstatus", "F")


@bind("monthly_distinct", """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(DISTINCT o_custkey) AS cnt
  FROM orders GROUP BY 1 ORDER BY 1 LIMIT 6""")
def q_monthly_distinct(spark, sf):
    return A.monthly_distinct(table(spark, sf, "orders"), "o_orderdate", "o_custkey", 6)


@bind("count_by_dim_attribute", f"""SELECT coalesce(nullif(c.c_mktsegment, ''), 'Unknown') AS label, count(*) AS value
  FROM orders o JOIN {DIRTY_CUSTOMER_SQL} c ON o.o_custkey = c.c_custkey GROUP BY c.c_mktsegment""")
def q_count_by_dim_attribute(spark, sf):
    return A.count_by_dim_attribute(table(spark, sf, "orders"), dirty_customer(spark, sf), "o_custkey",
                                    "c_custkey", "c_mktsegment")


@bind("value_counts", "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY l_returnflag")
def q_value_counts(spark, sf):
    return A.value_counts(table(spark, sf, "lineitem"), "l_returnflag")


# Account-balance buckets of the histogram binding (label, low incl., high excl.).
BALANCE_BUCKETS = [("<0", None, 0), ("0-2499", 0, 2500), ("2500-4999", 2500, 5000), ("5000-9999", 5000, 10000),
                   ("10000+", 10000, None)]


@bind("bucket_histogram", f"""WITH b AS (SELECT * FROM (VALUES ('<0', 0), ('0-2499', 1), ('2500-4999', 2),
  ('5000-9999', 3), ('10000+', 4)) t(label, bucket_order)),
c AS (SELECT CASE WHEN c_acctbal < 0 THEN '<0' WHEN c_acctbal < 2500 THEN '0-2499' WHEN c_acctbal < 5000
  THEN '2500-4999' WHEN c_acctbal < 10000 THEN '5000-9999' ELSE '10000+' END AS label, count(*) AS n
  FROM {DIRTY_CUSTOMER_SQL} WHERE c_acctbal IS NOT NULL GROUP BY 1)
SELECT b.label, coalesce(c.n, 0) AS value, CAST(b.bucket_order AS INTEGER) AS bucket_order
  FROM b LEFT JOIN c ON b.label = c.label""")
def q_bucket_histogram(spark, sf):
    return A.bucket_histogram(dirty_customer(spark, sf), "c_acctbal", BALANCE_BUCKETS)


@bind("null_profile", " UNION ALL ".join(
    f"SELECT 'customer' AS table_name, '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count "
    f"FROM {DIRTY_CUSTOMER_SQL}" for c in ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]))
def q_null_profile(spark, sf):
    return A.null_profile(dirty_customer(spark, sf), "customer")


@bind("duplicate_count", """SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM
  (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F'))) AS BIGINT) AS duplicate_rows
  FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F')""")
def q_duplicate_count(spark, sf):
    o = table(spark, sf, "orders")
    return A.duplicate_count(o.unionByName(o.where(F.col("o_orderstatus") == "F")))


@bind("mean_impute", f"""WITH d AS {DIRTY_LINEITEM_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(l_quantity, (SELECT avg(l_quantity) FROM d)) AS l_quantity FROM d""")
def q_mean_impute(spark, sf):
    d = dirty_lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return A.mean_impute(d, ["l_quantity"])


@bind("quantile_stats", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.01) AS p01, "
    f"quantile_cont({c}, 0.99) AS p99 FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_discount")))
def q_quantile_stats(spark, sf):
    return A.quantile_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@bind("keep_min_per_key", """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""")
def q_keep_min_per_key(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("__rowid", F.struct("l_linenumber", "l_partkey", "l_suppkey",
                                                                          *LINE_TIEBREAK))
    return A.keep_min_per_key(li, ["l_orderkey"], "__rowid").drop("__rowid")


@bind("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL")
def q_distinct_values(spark, sf):
    return A.distinct_values(table(spark, sf, "orders"), "o_orderpriority")


@bind("batch_count_summary", """WITH t AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) < 1997),
b AS (SELECT * FROM orders WHERE year(o_orderdate) >= 1997),
f AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
SELECT 'first_order_since_1997' AS table_name, (SELECT count(*) FROM b) AS processed,
  (SELECT count(*) FROM f WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_custkey = f.o_custkey)) AS inserted""")
def q_batch_count_summary(spark, sf):
    o = table(spark, sf, "orders")
    y = F.year("o_orderdate")
    batch = o.where(y >= 1997)
    target = W.first_per_key(o.where(y < 1997), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    new = insert_or_ignore(target, batch, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    counts = (batch.select(F.lit(1).alias("__p"), F.lit(0).alias("__i"))
              .unionByName(new.select(F.lit(0).alias("__p"), F.lit(1).alias("__i"))))
    return counts.agg(F.lit("first_order_since_1997").alias("table_name"),
                      F.sum("__p").cast("long").alias("processed"), F.sum("__i").cast("long").alias("inserted"))


# ------------------------------------------------------------------ G: per-key rows, sort, limit, union

@bind("latest_per_key", """SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def q_latest_per_key(spark, sf):
    return W.latest_per_key(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@bind("first_per_key", """SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
  ORDER BY o_orderdate, o_orderkey) = 1""")
def q_first_per_key(spark, sf):
    return W.first_per_key(table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@bind("sort_limit", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
  ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10""")
def q_sort_limit(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return W.sort_limit(li, [("l_extendedprice", False), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], 10)


@bind("sample_limit", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def q_sample_limit(spark, sf):
    return W.sample_limit(table(spark, sf, "customer"), 5, ["c_custkey"])


@bind("sort_distinct", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS ship_date FROM lineitem ORDER BY 1")
def q_sort_distinct(spark, sf):
    li = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("ship_date"))
    return W.sort_distinct(li, ["ship_date"])


@bind("union_by_name", """SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
  NULL AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_nationkey, NULL, c_mktsegment FROM customer""")
def q_union_by_name(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("name"),
                                            F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("party_key"),
                                            F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"))
    return W.union_by_name([s, c])
