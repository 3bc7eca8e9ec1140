"""C: keys, D: warehouse load (and G01, the distributed row number)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.operators import keys as K
from starling.operators import load as L
from starling.operators.windows import first_per_key, latest_per_key, row_number_all
from starling.plans.bindings.common import LINE_TIEBREAK, bind, table
from starling.plans.daily import run_daily_load
from starling.plans.warehouse import run_full_etl
from starling.session import work_dir
from starling.sources.files import write_csv
from starling.sources.store import TableStore

STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


def _nk_sql(*cols: str) -> str:
    texts = [f"nullif({STRIP.format(f'CAST({c} AS VARCHAR)')}, '')" for c in cols]
    return "concat_ws('|', " + ", ".join(f"coalesce(length({t}) || ':' || {t}, '')" for t in texts) + ")"


def _slug_sql(c: str) -> str:
    return f"coalesce(replace(lower({STRIP.format(f'CAST({c} AS VARCHAR)')}), ' ', '_'), 'unknown')"


# ------------------------------------------------------------------ C: keys

@bind("dense_surrogate_key", """SELECT row_number() OVER (ORDER BY p_brand NULLS FIRST, p_type NULLS FIRST,
  p_size NULLS FIRST) AS sk, p_brand, p_type, p_size FROM (SELECT DISTINCT p_brand, p_type, p_size FROM part)""")
def q_dense_surrogate_key(spark, sf):
    return K.dense_surrogate_key(table(spark, sf, "part"), ["p_brand", "p_type", "p_size"], "sk")


@bind("row_number_all", """SELECT l_orderkey, l_linenumber,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS rn FROM lineitem""")
def q_row_number_all(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return row_number_all(li, ["l_orderkey", "l_linenumber"], "rn")


@bind("composite_text_key", f"""SELECT p_partkey, concat('prot', '_t', {_slug_sql('p_type')}, '_d', {_slug_sql('p_size')},
  '_b', {_slug_sql('p_brand')}) AS protocol_id FROM part""")
def q_composite_text_key(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_type", "p_size", "p_brand")
    return K.composite_text_key(p, "protocol_id", "prot", [("t", "p_type"), ("d", "p_size"), ("b", "p_brand")]) \
        .select("p_partkey", "protocol_id")


@bind("positional_id", """SELECT c_custkey, concat('f_', CAST(row_number() OVER (ORDER BY c_custkey) - 1 AS VARCHAR))
  AS female_id FROM customer""")
def q_positional_id(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey")
    return K.positional_id(c, ["c_custkey"], "f", "female_id", offset=0)


@bind("fill_missing_ids", f"""WITH d AS (SELECT c_custkey, c_nationkey,
  CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN ' ' ELSE c_name END AS c_name FROM customer)
SELECT c_custkey, c_nationkey, CASE WHEN nullif({STRIP.format('c_name')}, '') IS NULL
  THEN concat('cust_', substr(sha256({_nk_sql('c_custkey', 'c_nationkey')}), 1, 32)) ELSE c_name END AS c_name FROM d""")
def q_fill_missing_ids(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey") % 4
    d = c.select("c_custkey", "c_nationkey", F.when(k == 0, F.lit(None).cast("string")).when(k == 1, F.lit(" "))
                 .otherwise(F.col("c_name")).alias("c_name"))
    return K.fill_missing_ids(d, "c_name", "cust", ["c_custkey", "c_nationkey"])


@bind("natural_key_text", f"SELECT p_partkey, {_nk_sql('p_brand', 'p_type', 'p_size')} AS natural_key FROM part")
def q_natural_key_text(spark, sf):
    p = table(spark, sf, "part")
    return K.natural_key(p, "natural_key", ["p_brand", "p_type", "p_size"]).select("p_partkey", "natural_key")


def _halves(df, first):
    """Rows where ``first`` holds, and all others (those where it is NULL too)."""
    return df.where(first), df.where(~F.coalesce(first, F.lit(False)))


def _two_batches(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("o_year"))
    return _halves(o, F.col("o_year") < 1998)


_INCR_SQL = """WITH o AS (SELECT o_orderkey, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders),
k1 AS (SELECT DISTINCT o_orderpriority, o_year FROM o WHERE o_year < 1998),
d1 AS (SELECT row_number() OVER (ORDER BY o_orderpriority NULLS FIRST, o_year NULLS FIRST) AS key_id,
  o_orderpriority, o_year FROM k1),
k2 AS (SELECT DISTINCT o_orderpriority, o_year FROM o WHERE (o_year < 1998) IS NOT TRUE),
n2 AS (SELECT * FROM k2 WHERE NOT EXISTS (SELECT 1 FROM d1 WHERE d1.o_orderpriority IS NOT DISTINCT FROM
  k2.o_orderpriority AND d1.o_year IS NOT DISTINCT FROM k2.o_year)),
d2 AS (SELECT coalesce((SELECT max(key_id) FROM d1), 0) + row_number() OVER (ORDER BY o_orderpriority NULLS FIRST,
  o_year NULLS FIRST) AS key_id, o_orderpriority, o_year FROM n2),
dim AS (SELECT * FROM d1 UNION ALL SELECT * FROM d2)"""


@bind("assign_incremental_keys", _INCR_SQL + " SELECT * FROM dim")
def q_assign_incremental_keys(spark, sf):
    b1, b2 = _two_batches(spark, sf)
    nk = ["o_orderpriority", "o_year"]
    _, dim1 = K.assign_incremental_keys(b1, None, nk, "key_id")
    _, new2 = K.assign_incremental_keys(b2, dim1, nk, "key_id")
    return dim1.unionByName(new2)


@bind("resolve_dimension_ids", _INCR_SQL + """ SELECT o.o_orderkey, dim.key_id FROM o JOIN dim
  ON o.o_orderpriority IS NOT DISTINCT FROM dim.o_orderpriority AND o.o_year IS NOT DISTINCT FROM dim.o_year
  WHERE (o.o_year < 1998) IS NOT TRUE""")
def q_resolve_dimension_ids(spark, sf):
    b1, b2 = _two_batches(spark, sf)
    nk = ["o_orderpriority", "o_year"]
    _, dim1 = K.assign_incremental_keys(b1, None, nk, "key_id")
    mapped, _ = K.assign_incremental_keys(b2, dim1, nk, "key_id")
    return mapped.select("o_orderkey", "key_id")


# ------------------------------------------------------------------ D: loads

@bind("build_dimension", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def q_build_dimension(spark, sf):
    return L.build_dimension(table(spark, sf, "customer"), ["c_nationkey", "c_mktsegment"])


@bind("load_dimension_mode", """WITH o AS (SELECT *, year(o_orderdate) AS y FROM orders),
c1 AS (SELECT o_orderpriority, o_orderstatus, min(o_orderkey) AS first_order FROM o WHERE y < 1997 GROUP BY 1, 2),
t1 AS (SELECT * FROM c1 QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY first_order) = 1),
c2 AS (SELECT o_orderpriority, o_orderstatus, min(o_orderkey) AS first_order FROM o WHERE (y < 1997) IS NOT TRUE GROUP BY 1, 2),
f2 AS (SELECT * FROM c2 QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY first_order) = 1)
SELECT * FROM t1 UNION ALL SELECT * FROM f2 WHERE NOT EXISTS
  (SELECT 1 FROM t1 WHERE t1.o_orderpriority = f2.o_orderpriority)""")
def q_load_dimension_mode(spark, sf):
    o = table(spark, sf, "orders")

    def cand(df):
        return df.groupBy("o_orderpriority", "o_orderstatus").agg(F.min("o_orderkey").alias("first_order"))
    store = TableStore(spark)
    y = F.year("o_orderdate")
    early, late = _halves(o, y < 1997)
    L.load_dimension_mode(store, "dim_priority", cand(early), ["o_orderpriority"], ["first_order"], refresh=True)
    return L.load_dimension_mode(store, "dim_priority", cand(late), ["o_orderpriority"], ["first_order"], refresh=False)


_DIM_TIME_SQL = """SELECT row_number() OVER (ORDER BY d) AS time_id, strftime(d, '%Y-%m-%d') AS full_date,
  CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year, CAST(weekofyear(d) AS INTEGER) AS week
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL)"""


def _dim_time(spark, sf):
    return L.build_dim_time(table(spark, sf, "orders"), "o_orderdate")


@bind("build_dim_time", _DIM_TIME_SQL)
def q_build_dim_time(spark, sf):
    return _dim_time(spark, sf)


@bind("date_to_time_key", f"""WITH t AS ({_DIM_TIME_SQL})
SELECT l.l_orderkey, l.l_linenumber, t.time_id AS ship_time_id FROM lineitem l
  LEFT JOIN t ON strftime(l.l_shipdate, '%Y-%m-%d') = t.full_date""")
def q_date_to_time_key(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return L.date_to_time_key(li, "l_shipdate", _dim_time(spark, sf), "ship_time_id").drop("l_shipdate")


FACT_CYCLE_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("cycle_start_time_id", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("good_embryos", T.IntegerType())])


def _raw_lines(spark, sf):
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")


_FIRST_LINE_SQL = f"""WITH t AS ({_DIM_TIME_SQL}),
r AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1)"""


@bind("build_fact_cycle", _FIRST_LINE_SQL + """ SELECT r.o_orderkey, r.o_custkey, t.time_id AS cycle_start_time_id,
  r.l_partkey, r.l_quantity, 0 AS good_embryos FROM r LEFT JOIN t ON strftime(r.o_orderdate, '%Y-%m-%d') = t.full_date""")
def q_build_fact_cycle(spark, sf):
    raw = L.date_to_time_key(_raw_lines(spark, sf), "o_orderdate", _dim_time(spark, sf), "cycle_start_time_id")
    return L.build_fact(raw, "o_orderkey", LINE_ORDER, FACT_CYCLE_SCHEMA.fieldNames(), FACT_CYCLE_SCHEMA,
                        defaults={"good_embryos": 0})


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", *LINE_TIEBREAK]   # (orderkey, linenumber) has ties
FACT_TRANSFER_COLS = ["o_orderkey", "transfer_time_fk", "embryos_transferred", "live_birth"]


@bind("build_fact_transfer", _FIRST_LINE_SQL + """ SELECT r.o_orderkey, t.time_id AS transfer_time_fk,
  CAST(r.l_quantity AS INTEGER) AS embryos_transferred, CASE WHEN r.o_orderstatus = 'F' THEN 1 ELSE 0 END AS live_birth
  FROM r LEFT JOIN t ON strftime(r.l_shipdate, '%Y-%m-%d') = t.full_date""")
def q_build_fact_transfer(spark, sf):
    raw = _raw_lines(spark, sf)
    if any(c not in raw.columns for c in ("o_orderkey", "l_shipdate", "l_quantity")):
        return None   # the reference skips the transfer fact when its inputs are absent
    raw = L.date_to_time_key(raw, "l_shipdate", _dim_time(spark, sf), "transfer_time_fk")
    raw = raw.withColumn("embryos_transferred", F.col("l_quantity").cast("int")) \
             .withColumn("live_birth", F.when(F.col("o_orderstatus") == "F", 1).otherwise(0))
    return L.build_fact(raw, "o_orderkey", LINE_ORDER, FACT_TRANSFER_COLS)


@bind("build_bridge", """WITH f AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS transfer_sk FROM orders)
SELECT DISTINCT f.transfer_sk, l.l_partkey FROM lineitem l JOIN f ON l.l_orderkey = f.o_orderkey""")
def q_build_bridge(spark, sf):
    facts = row_number_all(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], "transfer_sk")
    raw = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return L.build_bridge(raw, facts, "o_orderkey", "transfer_sk", "l_partkey")


@bind("insert_or_ignore", """WITH t AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) < 1997),
b AS (SELECT * FROM orders WHERE (year(o_orderdate) < 1997) IS NOT TRUE
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_custkey = b.o_custkey)""")
def q_insert_or_ignore(spark, sf):
    o = table(spark, sf, "orders")
    y = F.year("o_orderdate")
    early, late = _halves(o, y < 1997)
    target = first_per_key(early, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return L.insert_or_ignore(target, late, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@bind("insert_or_ignore_multi")
def q_insert_or_ignore_multi(spark, sf):
    # two unique keys, (customer, priority) and (order date, status); greedy by order key
    o = table(spark, sf, "orders")
    return L.insert_or_ignore_multi(None, o, [["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderstatus"]],
                                    "o_orderkey")


@bind("insert_or_ignore_chain", """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn FROM orders)
SELECT o_orderkey, CAST(rn AS BIGINT) AS rn FROM r WHERE rn % 6 IN (0, 2, 4)""")
def q_insert_or_ignore_chain(spark, sf):
    """Two unique keys in chains of six rows: each row shares its first key with one neighbour and its
    second with the other.  A row that was refused takes no key, so every other row stays."""
    r = row_number_all(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], "rn").withColumn("rn", F.col("rn") - 1)
    chain, place = F.floor(F.col("rn") / 6), F.col("rn") % 6
    keyed = r.withColumn("chain", chain).withColumn("ka", F.floor(place / 2)).withColumn("kb", F.floor((place + 1) / 2))
    return L.insert_or_ignore_multi(None, keyed, [["chain", "ka"], ["chain", "kb"]], "rn").select("o_orderkey", "rn")


@bind("upsert_last_wins", """WITH o AS (SELECT * FROM orders),
t AS (SELECT * FROM o WHERE year(o_orderdate) < 1998
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
b AS (SELECT * FROM o WHERE (year(o_orderdate) < 1998) IS NOT TRUE
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_custkey = t.o_custkey) UNION ALL SELECT * FROM b""")
def q_upsert_last_wins(spark, sf):
    o = table(spark, sf, "orders")
    y = F.year("o_orderdate")
    early, late = _halves(o, y < 1998)
    target = latest_per_key(early, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return L.upsert_last_wins(target, late, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@bind("fact_by_natural_keys", """WITH a AS (SELECT row_number() OVER (ORDER BY o_orderpriority NULLS FIRST,
  o_orderstatus NULLS FIRST) AS outcome_key, * FROM (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders)),
b AS (SELECT row_number() OVER (ORDER BY p_brand NULLS FIRST, p_type NULLS FIRST, p_size NULLS FIRST) AS embryo_key, *
  FROM (SELECT DISTINCT p_brand, p_type, p_size FROM part))
SELECT l.l_orderkey, l.l_linenumber, a.outcome_key, b.embryo_key FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  JOIN a ON o.o_orderpriority IS NOT DISTINCT FROM a.o_orderpriority AND o.o_orderstatus IS NOT DISTINCT FROM a.o_orderstatus
  JOIN b ON p.p_brand IS NOT DISTINCT FROM b.p_brand AND p.p_type IS NOT DISTINCT FROM b.p_type
   AND p.p_size IS NOT DISTINCT FROM b.p_size""")
def q_fact_by_natural_keys(spark, sf):
    o, p = table(spark, sf, "orders"), table(spark, sf, "part")
    outcome = K.dense_surrogate_key(o, ["o_orderpriority", "o_orderstatus"], "outcome_key")
    embryo = K.dense_surrogate_key(p, ["p_brand", "p_type", "p_size"], "embryo_key")
    raw = (table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
           .join(o.select("o_orderkey", "o_orderpriority", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
           .join(p.select("p_partkey", "p_brand", "p_type", "p_size"), F.col("l_partkey") == F.col("p_partkey")))
    out = L.fact_by_natural_keys(raw, [(outcome, ["o_orderpriority", "o_orderstatus"], "outcome_key"),
                                       (embryo, ["p_brand", "p_type", "p_size"], "embryo_key")])
    return out.select("l_orderkey", "l_linenumber", "outcome_key", "embryo_key")


# ------------------------------------------------------------------ D11: the whole load

def clinic_raw(spark, sf):
    """The raw wide case table of the clinic preset, one row per line item: case = order,
    patient = customer, partner = nation, doctor = (segment, priority), outcome =
    (priority, status), embryo = part attributes, cycle date = order date."""
    li, o, c = table(spark, sf, "lineitem"), table(spark, sf, "orders"), table(spark, sf, "customer")
    n, p = table(spark, sf, "nation"), table(spark, sf, "part")
    # orders take their customer before lines take their order: the attributes of a case are shuffled once a case
    cases = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey")).join(cases, F.col("l_orderkey") == F.col("o_orderkey"))
    st = F.col("o_orderstatus")
    return j.select(
        F.col("o_orderkey").cast("string").alias("case_id"), F.col("c_custkey").cast("string").alias("female_id"),
        (F.col("c_nationkey") + 20).alias("female_age"), F.col("c_acctbal").alias("female_bmi"),
        F.col("n_nationkey").cast("string").alias("male_id"), (F.col("n_regionkey") + 30).alias("male_age"),
        F.col("n_name").alias("male_factor"), F.col("c_mktsegment").alias("protocol_type"),
        F.col("c_mktsegment").alias("doctor_name"), F.col("o_orderpriority").alias("doctor_recommendation"),
        F.col("o_orderpriority").alias("risk_level"), st.alias("response_type"),
        F.col("p_type").alias("fresh_et_stage"), F.col("p_brand").alias("grading"),
        F.col("p_size").cast("double").alias("class_a_rate"), F.col("o_orderdate").alias("et_date"),
        F.col("l_quantity").cast("int").alias("retrieved_oocytes"), F.col("l_linenumber").alias("blastocyst_d5"),
        F.col("l_tax").alias("fertilization_rate"), F.col("l_extendedprice").alias("e2_on_trigger"),
        F.col("l_quantity").cast("int").alias("embryos_transferred"), st.alias("pregnancy_test_result"),
        F.when(st != "O", 1).otherwise(0).alias("clinical_pregnancy"),
        F.when(st == "F", 1).otherwise(0).alias("live_birth"),
        F.col("l_discount").alias("success_probability_score"),
        (F.col("o_orderkey") * 8 + F.col("l_linenumber")).alias("row_ord"))


def load_clinic_star(spark, sf) -> TableStore:
    store = TableStore(spark)
    run_full_etl(clinic_raw(spark, sf), store, refresh=True, order_by=["row_ord"])
    return store


_RAW_SQL = """WITH r AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey)"""

STAR_COUNTS_SQL = _RAW_SQL + """
SELECT 'dim_female' AS table_name, count(DISTINCT c_custkey) AS row_count FROM r
UNION ALL SELECT 'dim_male', count(DISTINCT n_nationkey) FROM r
UNION ALL SELECT 'dim_protocol', count(DISTINCT c_mktsegment) FROM r
UNION ALL SELECT 'dim_doctor', count(*) FROM (SELECT DISTINCT c_mktsegment, o_orderpriority FROM r)
UNION ALL SELECT 'dim_outcome', count(*) FROM (SELECT DISTINCT o_orderpriority, o_orderstatus FROM r)
UNION ALL SELECT 'dim_embryo', count(*) FROM (SELECT DISTINCT p_type, p_brand, p_size FROM r)
UNION ALL SELECT 'dim_time', count(DISTINCT CAST(o_orderdate AS DATE)) FROM r
UNION ALL SELECT 'fact_ivf_cycle', count(DISTINCT o_orderkey) FROM r
UNION ALL SELECT 'fact_transfer', count(DISTINCT o_orderkey) FROM r
UNION ALL SELECT 'fact_transfer_embryo', count(*) FROM (SELECT DISTINCT o_orderkey, p_type, p_brand, p_size FROM r)"""


LOAD_ORDER = ["row_ord", "e2_on_trigger", "retrieved_oocytes", "fertilization_rate", "success_probability_score",
              "fresh_et_stage", "grading", "class_a_rate"]


def case_rows(store: TableStore) -> DataFrame:
    """Every loaded cycle with its dimensions' attributes, transfer and number of embryos: a key
    that leads nowhere shows as NULLs."""
    cyc, tr = store.read("fact_ivf_cycle"), store.read("fact_transfer")
    members = store.read("fact_transfer_embryo").join(store.read("dim_embryo").select("embryo_id"), "embryo_id")
    n = members.groupBy("transfer_sk").agg(F.count(F.lit(1)).alias("embryos"))
    transfers = tr.select("case_id", "transfer_sk", "embryos_transferred", "live_birth").join(n, "transfer_sk", "left")
    return (cyc.join(store.read("dim_female").select("female_id", "female_age"), "female_id", "left")
            .join(store.read("dim_male").select("male_id", "male_age"), "male_id", "left")
            .join(store.read("dim_protocol").select("protocol_id", "protocol_type"), "protocol_id", "left")
            .join(store.read("dim_doctor"), "doctor_id", "left")
            .join(store.read("dim_outcome").select("outcome_id", "risk_level", "response_type"), "outcome_id", "left")
            .join(store.read("dim_time").select(F.col("time_id").alias("cycle_start_time_id"), "full_date"),
                  "cycle_start_time_id", "left")
            .join(transfers, "case_id", "left")
            .select("case_id", "cycle_sk", "transfer_sk", "female_id", "female_age", "male_id", "male_age", "protocol_type",
                    "doctor_name", "doctor_recommendation", "risk_level", "response_type", "full_date",
                    "retrieved_oocytes", "blastocyst_d5", "fertilization_rate", "e2_on_trigger", "gv_count",
                    "embryos_transferred", "live_birth", "embryos"))


def partly_named(raw):
    """A third of the cases bring a protocol id of their own, for the same protocols."""
    return raw.withColumn("protocol_id", F.when(F.col("case_id").cast("long") % 3 == 0, F.concat(F.lit("P-"), "protocol_type")))


def case_rows_sql(first_batch: str) -> str:
    return _RAW_SQL + f""",
f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_extendedprice,
  CAST(l_quantity AS INTEGER), l_tax, l_discount, p_type, p_brand, p_size) = 1),
e AS (SELECT o_orderkey, count(*) AS embryos FROM (SELECT DISTINCT o_orderkey, p_type, p_brand, p_size FROM r) GROUP BY 1),
k AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN {first_batch} THEN 0 ELSE 1 END, o_orderkey) AS sk FROM f)
SELECT CAST(o_orderkey AS VARCHAR) AS case_id, sk AS cycle_sk, sk AS transfer_sk, CAST(c_custkey AS VARCHAR) AS female_id,
  CAST(c_nationkey + 20 AS INTEGER) AS female_age, CAST(n_nationkey AS VARCHAR) AS male_id,
  CAST(n_regionkey + 30 AS INTEGER) AS male_age, c_mktsegment AS protocol_type, c_mktsegment AS doctor_name,
  o_orderpriority AS doctor_recommendation, o_orderpriority AS risk_level, o_orderstatus AS response_type,
  strftime(o_orderdate, '%Y-%m-%d') AS full_date, CAST(l_quantity AS INTEGER) AS retrieved_oocytes,
  CAST(l_linenumber AS INTEGER) AS blastocyst_d5, l_tax AS fertilization_rate, l_extendedprice AS e2_on_trigger,
  0 AS gv_count, CAST(l_quantity AS INTEGER) AS embryos_transferred,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS live_birth, embryos
FROM k JOIN e USING (o_orderkey)"""


@bind("run_pipeline", case_rows_sql("TRUE"))
def q_run_pipeline(spark, sf):
    store = TableStore(spark)
    run_full_etl(partly_named(clinic_raw(spark, sf)), store, refresh=True, order_by=LOAD_ORDER)
    return case_rows(store)


@bind("run_pipeline_incremental", case_rows_sql("year(o_orderdate) < 1997"))
def q_run_pipeline_incremental(spark, sf):
    """Two batches, the second of which brings known and new protocols under other ids."""
    store = TableStore(spark)
    early, late = _halves(partly_named(clinic_raw(spark, sf)), F.year("et_date") < 1997)
    run_full_etl(early, store, refresh=True, order_by=LOAD_ORDER)
    run_full_etl(late, store, refresh=False, order_by=LOAD_ORDER)
    return case_rows(store)


# ------------------------------------------------------------------ the daily file load

@bind("run_daily_etl", """SELECT CAST(o_orderkey AS VARCHAR) AS case_id, o_orderpriority AS risk_level,
  o_orderstatus AS response_type, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS doctor_recommendation,
  CAST(c_nationkey + 20 AS DOUBLE) AS female_age, CASE WHEN o_orderkey % 7 <> 0 THEN
  o_totalprice * CASE WHEN year(o_orderdate) >= 1996 THEN 2 ELSE 1 END END AS e2_on_trigger
FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_run_daily_etl(spark, sf):
    """Two days of files that overlap (their headers differ, numbers may be unreadable): the
    second day's rows win; every case comes back through its dimension ids."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    blank = F.lit(None).cast("string")

    def rows(df, factor):
        measure = F.when(k % 7 == 0, F.lit(" n/a ")).otherwise((price * factor).cast("string"))
        return df.select(
            k.alias("case_id"), F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")).alias("risk_level"),
            F.col("o_orderstatus").alias("response_type"), blank.alias("suggested_waiting_period_days"),
            blank.alias("failure_reason"), F.when(k % 5 != 0, F.col("o_orderpriority")).alias("doctor_recommendation"),
            (F.col("c_nationkey") + 20).alias("female_age"), F.col("c_acctbal").alias("female_bmi"),
            blank.alias("amh_level"), blank.alias("fsh_level"), blank.alias("afc"), measure.alias("e2_on_trigger"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("saved_at"))

    early = F.coalesce(F.year("o_orderdate") < 1997, F.lit(False))
    late = ~F.coalesce(F.year("o_orderdate") < 1996, F.lit(False))
    store, days = TableStore(spark), [work_dir(spark, "day-1"), work_dir(spark, "day-2")]
    write_csv(rows(o.where(early), 1), days[0])
    second = rows(o.where(late), 2)
    write_csv(second.select(*reversed(second.columns)), days[1])
    for folder in days:
        run_daily_load(spark, folder, store, ["saved_at"])
    return (store.read("fact_ivf_cycle")
            .join(store.read("dim_outcome"), "outcome_id").join(store.read("dim_female"), "female_id")
            .select("case_id", "risk_level", "response_type", "doctor_recommendation", "female_age", "e2_on_trigger"))
