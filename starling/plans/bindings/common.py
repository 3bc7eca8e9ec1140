"""Registry of bound queries + table readers + deterministic dirt.

The driver's tables are clean, but most data-quality operators only do something on
dirty input.  Dirt is injected by pure expressions of each row's own key, written once
for Spark and once as SQL text, so both sides see identical input.  Every row of the
table is still processed: the expressions change values, they never filter rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def bind(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ dirt: orders
# o_custkey: NULL for every 13th order key, an unknown customer for every 17th.
def dirty_orders(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    return o.withColumn("o_custkey", F.when(k % 13 == 0, F.lit(None).cast("long"))
                        .when(k % 17 == 0, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey")))


DIRTY_ORDERS_SQL = """(SELECT o_orderkey,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN o_custkey + 1000000 ELSE o_custkey END
    AS o_custkey,
  o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders)"""


# ------------------------------------------------------------------ dirt: customer
# c_name NULL every 6th key, c_acctbal NULL every 7th, c_mktsegment NULL every 8th and
# blank for keys = 1 mod 8, c_nationkey NULL every 9th.
def dirty_customer(spark, sf) -> DataFrame:
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    return c.select(
        "c_custkey",
        F.when(k % 6 != 0, F.col("c_name")).alias("c_name"),
        F.when(k % 9 != 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(k % 7 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(k % 8 == 0, F.lit(None).cast("string")).when(k % 8 == 1, F.lit("")).otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"))


DIRTY_CUSTOMER_SQL = """(SELECT c_custkey,
  CASE WHEN c_custkey % 6 <> 0 THEN c_name END AS c_name,
  CASE WHEN c_custkey % 9 <> 0 THEN c_nationkey END AS c_nationkey,
  CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 8 = 0 THEN NULL WHEN c_custkey % 8 = 1 THEN '' ELSE c_mktsegment END AS c_mktsegment
  FROM customer)"""


# ------------------------------------------------------------------ dirt: lineitem
# with h = l_orderkey + l_linenumber: l_extendedprice NULL when h % 7 = 0, l_discount NULL
# when h % 11 = 0, l_quantity NULL when h % 5 = 0, l_orderkey unknown when h % 19 = 0.
def dirty_lineitem(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    h = F.col("l_orderkey") + F.col("l_linenumber")
    return li.select(
        F.when(h % 19 == 0, F.col("l_orderkey") + 1000000000).otherwise(F.col("l_orderkey")).alias("l_orderkey"),
        "l_partkey", "l_suppkey", "l_linenumber",
        F.when(h % 5 != 0, F.col("l_quantity")).alias("l_quantity"),
        F.when(h % 7 != 0, F.col("l_extendedprice")).alias("l_extendedprice"),
        F.when(h % 11 != 0, F.col("l_discount")).alias("l_discount"),
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


DIRTY_LINEITEM_SQL = """(SELECT
  CASE WHEN (l_orderkey + l_linenumber) % 19 = 0 THEN l_orderkey + 1000000000 ELSE l_orderkey END AS l_orderkey,
  l_partkey, l_suppkey, l_linenumber,
  CASE WHEN (l_orderkey + l_linenumber) % 5 <> 0 THEN l_quantity END AS l_quantity,
  CASE WHEN (l_orderkey + l_linenumber) % 7 <> 0 THEN l_extendedprice END AS l_extendedprice,
  CASE WHEN (l_orderkey + l_linenumber) % 11 <> 0 THEN l_discount END AS l_discount,
  l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem)"""


# ------------------------------------------------------------------ dirt: events
# value NULL every 7th event id, props NULL every 11th.
def dirty_events(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.col("event_id")
    return e.select("event_id", "ts", "user_id", "event_type",
                    F.when(k % 7 != 0, F.col("value")).alias("value"),
                    F.when(k % 11 != 0, F.col("props")).alias("props"))


DIRTY_EVENTS_SQL = """(SELECT event_id, ts, user_id, event_type,
  CASE WHEN event_id % 7 <> 0 THEN value END AS value,
  CASE WHEN event_id % 11 <> 0 THEN props END AS props FROM events)"""


# A total order of line items (no two rows tie unless identical): "first line" picks and
# line numbering are deterministic at every scale.
LINE_TIEBREAK = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_TIEBREAK_SQL = "l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
              "embeddings", "pages", "benchmark", "labels", "conversations"]

# Column lists of the driver tables (for SQL generated per column).
TABLE_COLUMNS = {
    "region": ["r_regionkey", "r_name"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "embeddings": ["vec_id", "embedding", "label"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "conversations": ["conv_id", "turn", "role", "text"],
}


def all_tables(spark, sf) -> dict[str, DataFrame]:
    return {t: table(spark, sf, t) for t in ALL_TABLES}
