"""B: projections, cleaning, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from starling.operators import clean as C
from starling.plans.bindings.common import (
    DIRTY_CUSTOMER_SQL, DIRTY_EVENTS_SQL, DIRTY_LINEITEM_SQL, DIRTY_ORDERS_SQL, bind, dirty_customer,
    dirty_events, dirty_lineitem, dirty_orders, table,
)

CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@bind("normalize_columns", "SELECT * FROM customer")
def q_normalize_columns(spark, sf):
    c = table(spark, sf, "customer")
    messy = c.toDF(" C_CustKey", "C_Name ", "c_NationKey", " C_AcctBal ", "C_MktSegment")
    return C.normalize_columns(messy)


@bind("rename_aliases", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment AS segment FROM customer")
def q_rename_aliases(spark, sf):
    c = table(spark, sf, "customer")
    # both the old and the new name present: the new column is kept, its gaps filled
    two = c.withColumn("patient_name", F.col("c_name")).withColumn(
        "c_name", F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")))
    return C.rename_aliases(two, {"patient_name": "c_name", "c_mktsegment": "segment"})


@bind("ensure_columns", "SELECT *, 'Unknown' AS status, 0 AS visits, CAST(NULL AS DOUBLE) AS score FROM customer")
def q_ensure_columns(spark, sf):
    return C.ensure_columns(table(spark, sf, "customer"),
                            {"status": ("Unknown", "string"), "visits": (0, "int"), "score": (None, "double"),
                             "c_name": ("never used", "string")})


@bind("require_columns", "SELECT * FROM customer")
def q_require_columns(spark, sf):
    return C.require_columns(table(spark, sf, "customer"), ["c_custkey", "c_name"])


@bind("drop_exact_duplicates", "SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL "
                               "SELECT * FROM orders WHERE o_orderstatus = 'F')")
def q_drop_exact_duplicates(spark, sf):
    o = table(spark, sf, "orders")
    return C.drop_exact_duplicates(o.unionByName(o.where(F.col("o_orderstatus") == "F")))


def _all_null_customers(spark, sf):
    c = table(spark, sf, "customer")
    keep = F.col("c_custkey") % 10 != 0
    return c.select(*[F.when(keep, F.col(x)).alias(x) for x in CUSTOMER_COLS])


@bind("drop_all_null_rows", "SELECT * FROM customer WHERE c_custkey % 10 <> 0")
def q_drop_all_null_rows(spark, sf):
    # every 10th customer row is entirely NULL
    return C.drop_all_null_rows(_all_null_customers(spark, sf))


@bind("drop_any_null_rows", f"SELECT * FROM {DIRTY_ORDERS_SQL} WHERE o_custkey IS NOT NULL")
def q_drop_any_null_rows(spark, sf):
    return C.drop_any_null_rows(dirty_orders(spark, sf))


@bind("trim_strings", "SELECT * FROM customer")
def q_trim_strings(spark, sf):
    c = table(spark, sf, "customer")
    padded = c.withColumn("c_name", F.concat(F.lit("  "), "c_name", F.lit(" "))) \
              .withColumn("c_mktsegment", F.concat("c_mktsegment", F.lit("\t ")))
    return C.trim_strings(padded)


@bind("coerce_numeric", """SELECT c_custkey, c_name, c_nationkey,
  CASE WHEN c_custkey % 9 IN (0, 1) THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""")
def q_coerce_numeric(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey") % 9
    text = c.withColumn("c_acctbal", F.when(k == 0, F.lit("n/a")).when(k == 1, F.lit(" "))
                        .otherwise(F.col("c_acctbal").cast("string")))
    return C.coerce_numeric(text, ["c_acctbal"], "double")


@bind("parse_date_coerce", """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 9 IN (0, 1) THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate
  FROM orders""")
def q_parse_date_coerce(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey") % 9
    text = o.withColumn("o_orderdate", F.when(k == 0, F.lit("31/02/1999")).when(k == 1, F.lit(""))
                        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    return C.parse_date_coerce(text, ["o_orderdate"])


@bind("fill_numeric_median", f"""WITH d AS {DIRTY_LINEITEM_SQL}
SELECT l_orderkey, l_linenumber,
  coalesce(l_extendedprice, (SELECT median(l_extendedprice) FROM d)) AS l_extendedprice,
  coalesce(l_discount, (SELECT median(l_discount) FROM d)) AS l_discount,
  coalesce(l_quantity, (SELECT median(l_quantity) FROM d)) AS l_quantity FROM d""")
def q_fill_numeric_median(spark, sf):
    d = dirty_lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount",
                                         "l_quantity")
    return C.fill_numeric_median(d, ["l_extendedprice", "l_discount", "l_quantity"])


@bind("winsorize", """WITH q AS (SELECT quantile_cont(l_extendedprice, 0.01) AS e1,
  quantile_cont(l_extendedprice, 0.99) AS e99, quantile_cont(l_quantity, 0.01) AS q1,
  quantile_cont(l_quantity, 0.99) AS q99 FROM lineitem)
SELECT l_orderkey, l_linenumber, least(greatest(l_extendedprice, e1), e99) AS l_extendedprice,
  least(greatest(l_quantity, q1), q99) AS l_quantity FROM lineitem, q""")
def q_winsorize(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return C.winsorize(li, ["l_extendedprice", "l_quantity"], 0.01, 0.99)


@bind("fill_string_default", f"""SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  coalesce(c_mktsegment, 'Unknown') AS c_mktsegment FROM {DIRTY_CUSTOMER_SQL}""")
def q_fill_string_default(spark, sf):
    return C.fill_string_default(dirty_customer(spark, sf), exclude=["c_name"])


# The waiting-days rule of the reference (High 90, Medium 45, Low 30, else 30),
# bound here to order priorities.
WAITING_DAYS = {"1-URGENT": 90, "2-HIGH": 45, "5-LOW": 30}


@bind("map_values", """SELECT o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 90
  WHEN '2-HIGH' THEN 45 WHEN '5-LOW' THEN 30 ELSE 30 END AS waiting_days FROM orders""")
def q_map_values(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return C.map_values(o, "o_orderpriority", WAITING_DAYS, 30, out_col="waiting_days")


@bind("safe_ratio", """SELECT l_orderkey, l_linenumber,
  coalesce(l_discount / nullif(l_tax, 0), 0.0) AS discount_per_tax FROM lineitem""")
def q_safe_ratio(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return C.safe_ratio(li, "l_discount", "l_tax", "discount_per_tax").drop("l_discount", "l_tax")


@bind("fill_from_column", f"""SELECT l_orderkey, l_linenumber,
  CAST(coalesce(l_quantity, l_linenumber) AS INTEGER) AS l_quantity FROM {DIRTY_LINEITEM_SQL}""")
def q_fill_from_column(spark, sf):
    d = dirty_lineitem(spark, sf).select("l_orderkey", "l_linenumber", "l_quantity")
    return C.fill_from_column(d, "l_quantity", "l_linenumber", "int")


@bind("filter_predicates", """SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'
  AND c_nationkey IN (1, 3, 5, 7, 11) AND c_name IS NOT NULL""")
def q_filter_predicates(spark, sf):
    return C.filter_predicates(table(spark, sf, "customer"), equals={"c_mktsegment": "BUILDING"},
                               not_null=["c_name"], isin={"c_nationkey": [1, 3, 5, 7, 11]})


@bind("search_rows_text", """SELECT * FROM part
  WHERE contains(lower(concat_ws(' ', p_name, p_brand, p_type)), 'red')""")
def q_search_rows_text(spark, sf):
    return C.search_rows_text(table(spark, sf, "part"), "RED", ["p_name", "p_brand", "p_type"])


@bind("filter_status_contains", "SELECT * FROM orders WHERE contains(lower(o_orderpriority), 'urgent')")
def q_filter_status_contains(spark, sf):
    return C.filter_status_contains(table(spark, sf, "orders"), "o_orderpriority", "Urgent")


@bind("null_label", f"""SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  coalesce(nullif(c_mktsegment, ''), 'Unknown') AS c_mktsegment FROM {DIRTY_CUSTOMER_SQL}""")
def q_null_label(spark, sf):
    return C.null_label(dirty_customer(spark, sf), "c_mktsegment")


@bind("split_valid_rejected", f"""SELECT *, CASE WHEN value IS NULL THEN 'null_value' ELSE 'null_props' END
  AS reject_reason FROM {DIRTY_EVENTS_SQL} WHERE value IS NULL OR props IS NULL""")
def q_split_valid_rejected(spark, sf):
    _, rejected = C.split_valid_rejected(dirty_events(spark, sf), {"null_value": F.col("value").isNotNull(),
                                                                   "null_props": F.col("props").isNotNull()})
    return rejected
