"""H: validation and repair, I: dashboard reports over a star built from the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starling.operators import quality as Q
from starling.operators.aggregates import table_counts
from starling.operators.keys import dense_surrogate_key, row_index
from starling.operators.load import build_dim_time, date_to_time_key
from starling.plans import reports as R
from starling.plans.bindings.common import (
    ALL_TABLES, DIRTY_LINEITEM_SQL, DIRTY_ORDERS_SQL, LINE_TIEBREAK, bind, dirty_lineitem, dirty_orders, table, all_tables,
)
from starling.plans.bindings.keys_load import STAR_COUNTS_SQL, _DIM_TIME_SQL, load_clinic_star
from starling.plans.bindings.sources import _null_sheet_sql
from starling.plans.warehouse import run_repairs

# ------------------------------------------------------------------ H: validation

_DUP_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST((SELECT count(*) FROM {t}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t}))"
    f" AS BIGINT) AS duplicate_rows" for t in ALL_TABLES)


@bind("check_duplicates", _DUP_SQL)
def q_check_duplicates(spark, sf):
    return Q.check_duplicates(all_tables(spark, sf))


@bind("check_nulls", _null_sheet_sql())
def q_check_nulls(spark, sf):
    return Q.check_nulls(all_tables(spark, sf))


@bind("table_inventory", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES))
def q_table_inventory(spark, sf):
    return Q.table_inventory(all_tables(spark, sf))


REQUIRED = {"orders": ["o_orderkey", "o_custkey"], "lineitem": ["l_orderkey", "l_quantity", "l_extendedprice"]}

_REQ_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
    f"count(*) - count({c}) > 0 AS failed FROM {src}"
    for t, src in (("orders", DIRTY_ORDERS_SQL), ("lineitem", DIRTY_LINEITEM_SQL)) for c in REQUIRED[t])


def _dirty_tables(spark, sf):
    return {"orders": dirty_orders(spark, sf), "lineitem": dirty_lineitem(spark, sf),
            "customer": table(spark, sf, "customer"), "part": table(spark, sf, "part"),
            "supplier": table(spark, sf, "supplier"), "nation": table(spark, sf, "nation")}


@bind("check_required_nulls", _REQ_SQL)
def q_check_required_nulls(spark, sf):
    return Q.check_required_nulls(_dirty_tables(spark, sf), REQUIRED)


FK_CHECKS = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
             ("lineitem", "l_partkey", "part", "p_partkey"), ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
             ("customer", "c_nationkey", "nation", "n_nationkey")]


def _fk_sql(child_src, fk, parent, pk, name):
    return (f"SELECT '{name}' AS check_name, count(*) AS invalid_count FROM {child_src} ch LEFT JOIN {parent} p "
            f"ON ch.{fk} = p.{pk} WHERE ch.{fk} IS NOT NULL AND p.{pk} IS NULL")


_SRC = {"orders": DIRTY_ORDERS_SQL, "lineitem": DIRTY_LINEITEM_SQL, "customer": "customer"}
_FK_SQL = " UNION ALL ".join(_fk_sql(_SRC[c], fk, p, pk, f"{c}.{fk} -> {p}.{pk}") for c, fk, p, pk in FK_CHECKS)


@bind("check_foreign_keys", _FK_SQL)
def q_check_foreign_keys(spark, sf):
    return Q.check_foreign_keys(_dirty_tables(spark, sf), FK_CHECKS)


@bind("validation_status", f"""WITH f AS ({_FK_SQL}), r AS ({_REQ_SQL}),
d AS (SELECT CAST((SELECT count(*) FROM orders) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS BIGINT) AS n)
SELECT CAST(CASE WHEN greatest((SELECT max(invalid_count) FROM f), (SELECT max(null_count) FROM r),
  (SELECT n FROM d)) > 0 THEN -1 ELSE 1 END AS INTEGER) AS status""")
def q_validation_status(spark, sf):
    t = _dirty_tables(spark, sf)
    dups = Q.check_duplicates({"orders": table(spark, sf, "orders")})
    return Q.validation_status(dups, Q.check_required_nulls(t, REQUIRED), Q.check_foreign_keys(t, FK_CHECKS))


# ------------------------------------------------------------------ H: repairs

@bind("repair_required_nulls", f"SELECT * FROM {DIRTY_ORDERS_SQL} WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL")
def q_repair_required_nulls(spark, sf):
    return Q.repair_required_nulls(dirty_orders(spark, sf), REQUIRED["orders"])


@bind("repair_duplicates", "SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)")
def q_repair_duplicates(spark, sf):
    o = table(spark, sf, "orders")
    return Q.repair_duplicates(o.unionByName(o))


@bind("repair_orphan_fk_to_null", f"""SELECT d.o_orderkey, CASE WHEN c.c_custkey IS NULL THEN NULL ELSE d.o_custkey END
  AS o_custkey, d.o_orderstatus, d.o_totalprice, d.o_orderdate, d.o_orderpriority
  FROM {DIRTY_ORDERS_SQL} d LEFT JOIN customer c ON d.o_custkey = c.c_custkey""")
def q_repair_orphan_fk_to_null(spark, sf):
    return Q.repair_orphan_fk_to_null(dirty_orders(spark, sf), "o_custkey", table(spark, sf, "customer"), "c_custkey")


@bind("repair_delete_orphans", f"""SELECT * FROM {DIRTY_LINEITEM_SQL} d WHERE d.l_orderkey IS NULL
  OR EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = d.l_orderkey)""")
def q_repair_delete_orphans(spark, sf):
    return Q.repair_delete_orphans(dirty_lineitem(spark, sf), "l_orderkey", table(spark, sf, "orders"), "o_orderkey")


@bind("repair_fk_to_min", f"""SELECT d.o_orderkey, CASE WHEN d.o_custkey IS NOT NULL AND c.c_custkey IS NULL
  THEN (SELECT min(c_custkey) FROM customer) ELSE d.o_custkey END AS o_custkey, d.o_orderstatus, d.o_totalprice,
  d.o_orderdate, d.o_orderpriority FROM {DIRTY_ORDERS_SQL} d LEFT JOIN customer c ON d.o_custkey = c.c_custkey""")
def q_repair_fk_to_min(spark, sf):
    return Q.repair_fk_to_min(dirty_orders(spark, sf), "o_custkey", table(spark, sf, "customer"), "c_custkey")


@bind("repair_placeholder_parents", f"""SELECT * FROM customer UNION ALL
SELECT DISTINCT d.o_custkey AS c_custkey, 'placeholder' AS c_name, CAST(NULL AS INTEGER) AS c_nationkey,
  CAST(NULL AS DOUBLE) AS c_acctbal, 'Unknown' AS c_mktsegment FROM {DIRTY_ORDERS_SQL} d
  WHERE d.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = d.o_custkey)""")
def q_repair_placeholder_parents(spark, sf):
    return Q.repair_placeholder_parents(table(spark, sf, "customer"), dirty_orders(spark, sf), "o_custkey",
                                        "c_custkey", {"c_name": "placeholder", "c_mktsegment": "Unknown"})


@bind("run_repairs", STAR_COUNTS_SQL)
def q_run_repairs(spark, sf):
    store = load_clinic_star(spark, sf)
    # damage the loaded star the way the repair log shows: a duplicated transfer row and
    # bridge rows pointing to an embryo that does not exist
    ft = store.read("fact_transfer")
    store.append("fact_transfer", ft.where(F.col("transfer_sk") % 97 == 0))
    be = store.read("fact_transfer_embryo")
    store.append("fact_transfer_embryo", be.where(F.col("transfer_sk") % 50 == 0)
                 .withColumn("embryo_id", F.lit("emb_missing")))
    status = run_repairs(store)
    if status.first()["status"] != 1:
        raise RuntimeError("repair pass left validation failures")
    return table_counts({n: store.read(n) for n in store.registry.names()})


# ------------------------------------------------------------------ I: reports over a TPC-H star

class TpchStar:
    """A star in the clinic layout built from the test tables: case = order, patient =
    customer, partner = nation, doctor = (segment, priority), outcome = (status,
    priority), transfer = line item.  Tables are built on first use, so a report only
    pays for the tables it reads."""

    def __init__(self, spark, sf):
        self.spark, self.sf, self._built = spark, sf, {}

    def __getitem__(self, name):
        if name not in self._built:
            self._built[name] = getattr(self, "_" + name)()
        return self._built[name]

    def _t(self, name):
        return table(self.spark, self.sf, name)

    @staticmethod
    def _outcome_id():
        return F.concat(F.col("o_orderstatus"), F.lit("|"), F.col("o_orderpriority"))

    def _oc(self):
        o, c = self._t("orders"), self._t("customer")
        return o.join(c, o["o_custkey"] == c["c_custkey"])

    def _dim_time(self):
        return build_dim_time(self._t("orders"), "o_orderdate")

    def _doctor(self):
        return dense_surrogate_key(self["oc"], ["c_mktsegment", "o_orderpriority"], "doctor_id")

    def _dim_doctor(self):
        return self["doctor"].select("doctor_id", F.col("c_mktsegment").alias("doctor_name"),
                                     F.col("o_orderpriority").alias("doctor_recommendation"))

    def _dim_outcome(self):
        return self._t("orders").select(
            self._outcome_id().alias("outcome_id"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("risk_level"),
            F.col("o_orderstatus").alias("response_type")).distinct()

    def _dim_female(self):
        return self._t("customer").select(F.col("c_custkey").cast("string").alias("female_id"),
                                          (F.col("c_nationkey") + 20).alias("female_age"),
                                          F.col("c_acctbal").alias("female_bmi"))

    def _dim_male(self):
        return self._t("nation").select(F.col("n_nationkey").cast("string").alias("male_id"),
                                        (F.col("n_regionkey") + 30).alias("male_age"),
                                        F.col("n_name").alias("male_factor"))

    def _dim_protocol(self):
        return self._t("customer").select(F.col("c_mktsegment").alias("protocol_id"),
                                          F.col("c_mktsegment").alias("protocol_type")).distinct()

    def _fact_ivf_cycle(self):
        cyc = self["oc"].join(self["doctor"], ["c_mktsegment", "o_orderpriority"], "left")
        cyc = date_to_time_key(cyc, "o_orderdate", self["dim_time"], "cycle_start_time_id")
        return cyc.select(F.col("o_orderkey").alias("cycle_sk"), F.col("o_orderkey").cast("string").alias("case_id"),
                          F.col("o_custkey").cast("string").alias("female_id"),
                          F.col("c_nationkey").cast("string").alias("male_id"), "doctor_id",
                          self._outcome_id().alias("outcome_id"), "cycle_start_time_id",
                          F.month("o_orderdate").alias("retrieved_oocytes"),
                          F.dayofmonth("o_orderdate").alias("blastocyst_d5"))

    def _transfer_lines(self):
        li, o = self._t("lineitem"), self._t("orders")
        lines = li.join(o.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
                        li["l_orderkey"] == o["o_orderkey"])
        return lines.withColumn("live_birth", F.when(F.col("l_linestatus") == "F", 1).otherwise(0))

    def _fact_transfer(self):
        lines = row_index(self["transfer_lines"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *LINE_TIEBREAK],
                          "transfer_sk")
        lines = date_to_time_key(lines, "l_shipdate", self["dim_time"], "transfer_time_fk")
        return lines.select("transfer_sk", F.col("l_orderkey").cast("string").alias("case_id"), "transfer_time_fk",
                            F.col("l_quantity").cast("int").alias("embryos_transferred"),
                            F.col("l_returnflag").alias("pregnancy_test_result"),
                            "live_birth", self._outcome_id().alias("outcome_id"))


def tpch_star(spark, sf) -> TpchStar:
    return TpchStar(spark, sf)


STAR_SQL = f"""WITH dim_time AS ({_DIM_TIME_SQL}),
dim_female AS (SELECT CAST(c_custkey AS VARCHAR) AS female_id, c_nationkey + 20 AS female_age, c_acctbal AS female_bmi
  FROM customer),
dim_male AS (SELECT CAST(n_nationkey AS VARCHAR) AS male_id, n_regionkey + 30 AS male_age, n_name AS male_factor
  FROM nation),
oc AS (SELECT o.*, c.c_mktsegment, c.c_nationkey FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
dim_doctor AS (SELECT row_number() OVER (ORDER BY c_mktsegment NULLS FIRST, o_orderpriority NULLS FIRST) AS doctor_id,
  c_mktsegment AS doctor_name, o_orderpriority AS doctor_recommendation
  FROM (SELECT DISTINCT c_mktsegment, o_orderpriority FROM oc)),
dim_outcome AS (SELECT DISTINCT o_orderstatus || '|' || o_orderpriority AS outcome_id,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS risk_level, o_orderstatus AS response_type FROM orders),
dim_protocol AS (SELECT DISTINCT c_mktsegment AS protocol_id, c_mktsegment AS protocol_type FROM customer),
fact_ivf_cycle AS (SELECT oc.o_orderkey AS cycle_sk, CAST(oc.o_orderkey AS VARCHAR) AS case_id,
  CAST(oc.o_custkey AS VARCHAR) AS female_id, CAST(oc.c_nationkey AS VARCHAR) AS male_id, d.doctor_id,
  oc.o_orderstatus || '|' || oc.o_orderpriority AS outcome_id, t.time_id AS cycle_start_time_id,
  CAST(month(oc.o_orderdate) AS INTEGER) AS retrieved_oocytes, CAST(day(oc.o_orderdate) AS INTEGER) AS blastocyst_d5
  FROM oc LEFT JOIN dim_doctor d ON oc.c_mktsegment = d.doctor_name AND oc.o_orderpriority = d.doctor_recommendation
  LEFT JOIN dim_time t ON strftime(oc.o_orderdate, '%Y-%m-%d') = t.full_date),
fact_transfer AS (SELECT row_number() OVER (ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
  l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus, l.l_shipdate)
  AS transfer_sk, CAST(l.l_orderkey AS VARCHAR) AS case_id, t.time_id AS transfer_time_fk,
  CAST(l.l_quantity AS INTEGER) AS embryos_transferred, l.l_returnflag AS pregnancy_test_result,
  CASE WHEN l.l_linestatus = 'F' THEN 1 ELSE 0 END AS live_birth, o.o_orderstatus || '|' || o.o_orderpriority AS outcome_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN dim_time t ON strftime(l.l_shipdate, '%Y-%m-%d') = t.full_date)"""


@bind("dashboard_kpis", STAR_SQL + """,
k AS (SELECT (SELECT count(DISTINCT female_id) FROM fact_ivf_cycle) AS total_patients,
  (SELECT count(*) FROM fact_ivf_cycle) AS active_cycles,
  (SELECT CAST(coalesce(sum(CASE WHEN live_birth = 1 THEN 1 ELSE 0 END), 0) AS BIGINT) FROM fact_transfer) AS live_births,
  (SELECT count(*) FROM fact_transfer) AS total_transfers)
SELECT *, coalesce(round(100.0 * live_births / nullif(total_transfers, 0), 1), 0.0) AS success_rate FROM k""")
def q_dashboard_kpis(spark, sf):
    s = tpch_star(spark, sf)
    return R.dashboard_kpis(s["fact_ivf_cycle"], s["transfer_lines"])  # no ids: nothing here reads them


@bind("dashboard_monthly", STAR_SQL + """ SELECT substr(t.full_date, 1, 7) AS month, count(DISTINCT f.female_id) AS cnt
  FROM fact_ivf_cycle f JOIN dim_time t ON f.cycle_start_time_id = t.time_id GROUP BY 1 ORDER BY 1 LIMIT 6""")
def q_dashboard_monthly(spark, sf):
    s = tpch_star(spark, sf)
    return R.dashboard_monthly(s["fact_ivf_cycle"], s["dim_time"])


@bind("dashboard_outcomes", STAR_SQL + """ SELECT coalesce(nullif(o.risk_level, ''), 'Unknown') AS label,
  count(*) AS value FROM fact_ivf_cycle f JOIN dim_outcome o ON f.outcome_id = o.outcome_id GROUP BY o.risk_level""")
def q_dashboard_outcomes(spark, sf):
    s = tpch_star(spark, sf)
    return R.dashboard_outcomes(s["fact_ivf_cycle"], s["dim_outcome"])


@bind("dashboard_age", STAR_SQL + """, b AS (SELECT * FROM (VALUES ('<30', 0), ('30–34', 1), ('35–39', 2),
  ('40–44', 3), ('45+', 4)) t(label, bucket_order)),
c AS (SELECT CASE WHEN female_age < 30 THEN '<30' WHEN female_age < 35 THEN '30–34' WHEN female_age < 40 THEN '35–39'
  WHEN female_age < 45 THEN '40–44' ELSE '45+' END AS label, count(*) AS n FROM dim_female
  WHERE female_age IS NOT NULL GROUP BY 1)
SELECT b.label, coalesce(c.n, 0) AS value, CAST(b.bucket_order AS INTEGER) AS bucket_order
  FROM b LEFT JOIN c ON b.label = c.label""")
def q_dashboard_age(spark, sf):
    return R.dashboard_age(tpch_star(spark, sf)["dim_female"])


@bind("patients_list", STAR_SQL + """ SELECT female_id AS patient_id, '-' AS last_visit, 'Unknown' AS status,
  '-' AS next_appointment FROM dim_female ORDER BY female_id LIMIT 5""")
def q_patients_list(spark, sf):
    return R.patients_list(tpch_star(spark, sf)["dim_female"])


_PROFILE_SQL = STAR_SQL + """,
latest AS (SELECT * FROM fact_ivf_cycle WHERE female_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY female_id ORDER BY cycle_sk DESC) = 1),
lt AS (SELECT * FROM fact_transfer WHERE case_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY transfer_sk DESC) = 1)
SELECT l.female_id, l.cycle_sk, l.case_id, f.female_age, f.female_bmi, m.male_id, m.male_age, m.male_factor,
  d.doctor_recommendation, o.risk_level, o.response_type, t.full_date AS cycle_date, l.retrieved_oocytes,
  l.blastocyst_d5, lt.transfer_sk, t2.full_date AS transfer_date, lt.embryos_transferred, lt.pregnancy_test_result,
  lt.live_birth AS transfer_live_birth, o2.response_type AS transfer_outcome
FROM latest l JOIN dim_female f ON l.female_id = f.female_id LEFT JOIN dim_male m ON l.male_id = m.male_id
  LEFT JOIN dim_doctor d ON l.doctor_id = d.doctor_id LEFT JOIN dim_outcome o ON l.outcome_id = o.outcome_id
  LEFT JOIN dim_time t ON l.cycle_start_time_id = t.time_id LEFT JOIN lt ON l.case_id = lt.case_id
  LEFT JOIN dim_time t2 ON lt.transfer_time_fk = t2.time_id LEFT JOIN dim_outcome o2 ON lt.outcome_id = o2.outcome_id"""


@bind("patient_profile", _PROFILE_SQL)
def q_patient_profile(spark, sf):
    s = tpch_star(spark, sf)
    return R.patient_profile(s["fact_ivf_cycle"], s["fact_transfer"], s["dim_female"], s["dim_male"],
                             s["dim_doctor"], s["dim_outcome"], s["dim_time"])


@bind("patient_profile_nested", f"""SELECT female_id, case_id AS basic_case_id, female_age AS basic_female_age, male_id AS basic_male_id,
  doctor_recommendation AS basic_doctor_recommendation, risk_level AS basic_risk_level, cycle_date AS cycle_date, retrieved_oocytes AS cycle_retrieved,
  blastocyst_d5 AS cycle_blast_d5, risk_level AS cycle_status, transfer_sk IS NOT NULL AS has_transfer, transfer_date,
  pregnancy_test_result AS transfer_preg_test, transfer_live_birth, transfer_outcome FROM ({_PROFILE_SQL})""")
def q_patient_profile_nested(spark, sf):
    """The nested row (basic, latest_cycle, transfer or NULL) of every patient, read field by field."""
    s = tpch_star(spark, sf)
    nested = R.patient_profile(s["fact_ivf_cycle"], s["fact_transfer"], s["dim_female"], s["dim_male"],
                               s["dim_doctor"], s["dim_outcome"], s["dim_time"], nested=True)
    basic = [F.col(f"basic.{c}").alias(f"basic_{c}") for c in ("case_id", "female_age", "male_id", "doctor_recommendation", "risk_level")]
    cycle = [F.col(f"latest_cycle.{c}").alias(f"cycle_{c}") for c in ("date", "retrieved", "blast_d5", "status")]
    transfer = [F.col(f"transfer.{c}").alias(f"transfer_{c}") for c in ("date", "preg_test", "live_birth", "outcome")]
    return nested.select("female_id", *basic, *cycle, F.col("transfer").isNotNull().alias("has_transfer"), *transfer)


@bind("warehouse_summary", STAR_SQL + """ SELECT 'total_female' AS metric, CAST(NULL AS VARCHAR) AS label,
  count(*) AS value FROM dim_female
UNION ALL SELECT 'total_male', NULL, count(*) FROM dim_male
UNION ALL SELECT 'protocol_distribution', protocol_type, count(*) FROM dim_protocol GROUP BY protocol_type
UNION ALL SELECT 'outcome_counts', outcome_id, count(*) FROM fact_transfer GROUP BY outcome_id""")
def q_warehouse_summary(spark, sf):
    s = tpch_star(spark, sf)
    return R.warehouse_summary(s["dim_female"], s["dim_male"], s["dim_protocol"], s["fact_transfer"])
