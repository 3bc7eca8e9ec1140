"""Work by batches: replayed streams, month-scoped upserts, the clean stage, the landing job, refused
values, mergeable statistics, incremental validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from starling.operators import load as L
from starling.operators import sketches as S
from starling.plans import reports as R
from starling.plans.bindings.common import (
    DIRTY_LINEITEM_SQL, DIRTY_ORDERS_SQL, TABLE_COLUMNS, bind, dirty_lineitem, dirty_orders, table,
)
from starling.plans.bindings.keys_load import LOAD_ORDER, _RAW_SQL, case_rows, case_rows_sql, clinic_raw, partly_named
from starling.plans.bindings.quality_reports import FK_CHECKS, REQUIRED
from starling.plans.bindings.sources import EVENTS_TYPED
from starling.plans.bindings.stream import ARRIVAL_KEYS
from starling.plans.incremental_checks import IncrementalChecks, check_name
from starling.plans.landing_job import LEDGER, run_landing_job
from starling.plans.warehouse import REJECTED, run_full_etl, run_repairs
from starling.registry import clinic_registry
from starling.session import work_dir
from starling.sources.store import TableStore
from starling.streaming.landing_stream import stream_incremental_load, stream_landing_ingest

# ------------------------------------------------------------------ K02: replays, keys that are missing, truncated records

@bind("stream_load_replayed", """SELECT event_id, user_id, event_type, value, props,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS saved_at FROM events WHERE event_id % 13 <> 0 AND event_id % 17 <> 0""")
def q_stream_load_replayed(spark, sf):
    """Events with missing keys and cut-off records, loaded by a stream, then delivered again to a
    stream that knows nothing of the first."""
    return _replayed(spark, sf).read("events_loaded")


@bind("stream_load_rejects", """SELECT CASE WHEN event_id % 17 = 0 THEN 'corrupt_record' ELSE 'null_event_id' END AS reject_reason,
  count(*) AS n FROM events WHERE event_id % 17 = 0 OR event_id % 13 = 0 GROUP BY 1""")
def q_stream_load_rejects(spark, sf):
    """What the same two streams set aside, each record once."""
    rejected = _replayed(spark, sf).read("events_loaded_rejected")
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def _replayed(spark, sf) -> TableStore:
    landing, store = damaged_json(spark, sf), TableStore(spark)
    for checkpoint in ("first", "second"):
        stream_incremental_load(spark, landing, EVENTS_TYPED, store, "events_loaded", ["event_id"], ["saved_at"],
                                work_dir(spark, f"replay-{checkpoint}"), partitioned=False)
    return store


def damaged_json(spark, sf) -> str:
    """Events as JSON lines: every 13th without its id, every 17th record cut off after its time of saving."""
    landing = work_dir(spark, "damaged-landing")
    e, k = table(spark, sf, "events"), F.col("event_id")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = F.to_json(F.struct(stamp.alias("saved_at"), F.when(k % 13 != 0, k).alias("event_id"), "user_id", "event_type", "value", "props"))
    cut = F.concat(F.lit('{"note":"'), k.cast("string"), F.lit('","event_id":'))
    line = F.when(k % 17 == 0, cut).otherwise(fields)
    # the text writer names its files .txt; the JSON writer keeps a lone text column as an object, so the
    # lines go out as CSV without quotes under the .json suffix the landing zone expects
    (e.select(line.alias("value")).write.option("extension", "json").option("quote", "").option("escapeQuotes", False)
     .option("sep", "\u0001").csv(landing))
    return landing


# ------------------------------------------------------------------ K01: resubmissions

@bind("stream_resubmissions", """SELECT event_id, user_id, event_type, value, props,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS saved_at FROM events""")
def q_stream_resubmissions(spark, sf):
    """Every event submitted twice, the second time between two runs of the stream: keyed state in the
    checkpoint tells the second from the first."""
    landing, staging, checkpoint = (work_dir(spark, n) for n in ("landing", "staging", "ckpt"))
    e = table(spark, sf, "events")
    rows = e.select("event_id", "user_id", "event_type", "value", "props", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("saved_at"))
    for _ in range(2):
        rows.write.mode("append").json(landing)
        out = stream_landing_ingest(spark, landing, EVENTS_TYPED, staging, checkpoint, partitioned=False, once_per=["event_id"], within="3650 days")
    return out.drop("source_file", "batch_id")


# ------------------------------------------------------------------ D10 by month

@bind("upsert_partitions", """WITH t AS (SELECT * FROM orders WHERE year(o_orderdate) < 1998
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
b AS (SELECT * FROM orders WHERE (year(o_orderdate) < 1998) IS NOT TRUE
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT *, strftime(o_orderdate, '%Y-%m') AS order_month FROM (
  SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_custkey = t.o_custkey) UNION ALL SELECT * FROM b)""")
def q_upsert_partitions(spark, sf):
    """The last order of every customer, stored by month: the second batch moves customers to new months."""
    o = table(spark, sf, "orders").withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    early = F.coalesce(F.year("o_orderdate") < 1998, F.lit(False))
    store, order = TableStore(spark), ["o_orderdate", "o_orderkey"]
    for batch in (o.where(early), o.where(~early)):
        L.upsert_partitions(store, "last_orders", batch, ["o_custkey"], order, "order_month")
    return store.read("last_orders")


# ------------------------------------------------------------------ D11: clean stage, refused values
# text as it comes from a form: padded names, some blank; a bmi missing for every 9th customer; prices with a
# unit in every 11th order, which no cast reads

def form_raw(spark, sf):
    raw = partly_named(clinic_raw(spark, sf))
    case, female = F.col("case_id").cast("long"), F.col("female_id").cast("long")
    return raw.withColumns({
        "protocol_type": F.when(case % 10 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), "protocol_type", F.lit(" "))),
        "female_bmi": F.when(female % 9 != 0, F.col("female_bmi")),
        "e2_on_trigger": F.when(case % 11 == 0, F.concat(F.col("e2_on_trigger").cast("string"), F.lit(" pg/mL"))).otherwise(F.col("e2_on_trigger").cast("string")),
        "good_embryos": F.col("blastocyst_d5"), "risk_level": F.element_at(F.array(F.lit("High"), F.lit("Medium"), F.lit("Low"), F.lit("?")), (case % 4 + 1).cast("int"))})


_FORM_SQL = _RAW_SQL + """,
q AS (SELECT DISTINCT o_orderkey, l_linenumber, c_custkey, o_orderdate, o_orderstatus, o_orderpriority, p_type, p_brand, p_size, n_name,
  CASE WHEN o_orderkey % 10 <> 0 THEN c_mktsegment END AS protocol_type, c_mktsegment AS doctor,
  CAST(c_nationkey + 20 AS DOUBLE) AS female_age, CAST(CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS DOUBLE) AS female_bmi,
  CAST(CASE WHEN o_orderkey % 11 <> 0 THEN l_extendedprice END AS DOUBLE) AS e2_on_trigger,
  CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS transferred, CAST(l_linenumber AS DOUBLE) AS good,
  CAST(l_tax AS DOUBLE) AS fertilization_rate, l_discount,
  ['High', 'Medium', 'Low', '?'][CAST(o_orderkey % 4 AS INTEGER) + 1] AS risk_level FROM r),
f1 AS (SELECT * REPLACE (coalesce(female_bmi, (SELECT quantile_cont(female_bmi, 0.5) FROM q)) AS female_bmi,
  coalesce(e2_on_trigger, (SELECT quantile_cont(e2_on_trigger, 0.5) FROM q)) AS e2_on_trigger) FROM q),
s AS (SELECT """ + ", ".join(f"quantile_cont({c}, 0.01) AS {c}_lo, quantile_cont({c}, 0.99) AS {c}_hi"
                             for c in ("female_age", "female_bmi", "e2_on_trigger", "transferred", "good", "fertilization_rate")) + """ FROM f1),
c AS (SELECT f1.* REPLACE (""" + ", ".join(
    f"{'round(' * w}least(greatest({c}, {c}_lo), {c}_hi){')' * w} AS {c}" for c, w in
    (("female_age", 1), ("female_bmi", 0), ("e2_on_trigger", 0), ("transferred", 1), ("good", 1), ("fertilization_rate", 0))) + """) FROM f1, s)"""


@bind("run_clean_etl", _FORM_SQL + """,
p AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, p_type, p_brand, p_size, transferred, fertilization_rate, l_discount) AS rn FROM c)
SELECT CAST(o_orderkey AS VARCHAR) AS case_id, CAST(female_age AS INTEGER) AS female_age, female_bmi,
  coalesce(protocol_type, 'Unknown') AS protocol_type, risk_level,
  CAST(CASE risk_level WHEN 'High' THEN 90 WHEN 'Medium' THEN 45 ELSE 30 END AS INTEGER) AS suggested_waiting_period_days,
  e2_on_trigger, fertilization_rate, CAST(good AS INTEGER) AS good_embryos, CAST(transferred AS INTEGER) AS embryos_transferred,
  embryos, best_rate
FROM p JOIN (SELECT o_orderkey, count(*) AS embryos, max(rate) AS best_rate FROM (SELECT DISTINCT o_orderkey, p_type, p_brand,
  coalesce(good / nullif(transferred, 0), 0.0) AS rate FROM c) GROUP BY 1) USING (o_orderkey) WHERE rn = 1""")
def q_run_clean_etl(spark, sf):
    """The load with its clean stage: statistics of the whole raw table, missing values filled, outliers
    clipped, text trimmed or 'Unknown', waiting days by risk."""
    store = TableStore(spark)
    run_full_etl(form_raw(spark, sf), store, refresh=True, order_by=CLEAN_ORDER, clean=True)
    fc, ft = store.read("fact_ivf_cycle"), store.read("fact_transfer")
    members = (store.read("fact_transfer_embryo").join(store.read("dim_embryo"), "embryo_id").groupBy("transfer_sk")
               .agg(F.count(F.lit(1)).alias("embryos"), F.max("class_a_rate").alias("best_rate")))
    return (fc.join(store.read("dim_female").select("female_id", "female_age", "female_bmi"), "female_id")
            .join(store.read("dim_protocol").select("protocol_id", "protocol_type"), "protocol_id")
            .join(store.read("dim_outcome").select("outcome_id", "risk_level", "suggested_waiting_period_days"), "outcome_id")
            .join(ft.select("case_id", "transfer_sk", "embryos_transferred").join(members, "transfer_sk"), "case_id")
            .select("case_id", "female_age", "female_bmi", "protocol_type", "risk_level", "suggested_waiting_period_days",
                    "e2_on_trigger", "fertilization_rate", "good_embryos", "embryos_transferred", "embryos", "best_rate"))


CLEAN_ORDER = ["row_ord", "fresh_et_stage", "grading", "class_a_rate", "retrieved_oocytes", "fertilization_rate", "success_probability_score"]


@bind("clean_statistics", _FORM_SQL + """, m AS (SELECT quantile_cont(female_bmi, 0.5) AS bmi, quantile_cont(e2_on_trigger, 0.5) AS e2,
  quantile_cont(fertilization_rate, 0.5) AS rate, count(*) AS n, count(*) - count(female_bmi) AS no_bmi, count(*) - count(e2_on_trigger) AS no_e2 FROM q)
SELECT 'female_bmi' AS column_name, n, no_bmi AS missing, bmi AS median, female_bmi_lo AS low, female_bmi_hi AS high FROM m, s
UNION ALL SELECT 'e2_on_trigger', n, no_e2, e2, e2_on_trigger_lo, e2_on_trigger_hi FROM m, s
UNION ALL SELECT 'fertilization_rate', n, 0, rate, fertilization_rate_lo, fertilization_rate_hi FROM m, s""")
def q_clean_statistics(spark, sf):
    """The statistics that the clean stage stores with the run (three of the columns)."""
    store = TableStore(spark)
    run_full_etl(form_raw(spark, sf), store, refresh=True, order_by=CLEAN_ORDER, clean=True)
    return store.read("clean_statistics").where(F.col("column_name").isin("female_bmi", "e2_on_trigger", "fertilization_rate"))


@bind("refused_values", _RAW_SQL + """ SELECT CAST(o_orderkey AS VARCHAR) AS case_id, 'e2_on_trigger' AS column_name, count(*) AS n
FROM (SELECT DISTINCT o_orderkey, l_linenumber, l_extendedprice, l_quantity, l_tax, l_discount, p_type, p_brand, p_size, c_custkey FROM r) WHERE o_orderkey % 11 = 0 GROUP BY 1""")
def q_refused_values(spark, sf):
    """The values that the load's casts refused, from its reject table."""
    store = TableStore(spark)
    run_full_etl(form_raw(spark, sf), store, refresh=True, order_by=CLEAN_ORDER)
    rejected = store.read(REJECTED).where("reject_reason = 'refused_values'")
    each = rejected.select(F.get_json_object("record", "$.case_id").alias("case_id"), F.inline("refused"))
    return each.groupBy("case_id", "column_name").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ A10, I02: facts stored by month

@bind("dashboard_monthly_range", _RAW_SQL + """ SELECT strftime(o_orderdate, '%Y-%m') AS month, count(DISTINCT c_custkey) AS cnt
FROM r WHERE year(o_orderdate) = 1996 AND quarter(o_orderdate) = 2 GROUP BY 1""")
def q_dashboard_monthly_range(spark, sf):
    """Monthly patients of one quarter over a star whose facts are stored by month."""
    store = TableStore(spark)
    run_full_etl(clinic_raw(spark, sf), store, refresh=True, order_by=["row_ord"], registry=clinic_registry(partitioned=True))
    return R.dashboard_monthly(store.read("fact_ivf_cycle"), store.read("dim_time"), limit=None, days="year = 1996 AND quarter = 2")


# ------------------------------------------------------------------ A04, A05, D11: landing to star

def _landing_runs(spark, sf) -> TableStore:
    raw = partly_named(clinic_raw(spark, sf)).withColumn("et_date", F.date_format("et_date", "yyyy-MM-dd"))
    landing, store, early = work_dir(spark, "job-landing"), TableStore(spark), F.coalesce(F.col("et_date") < "1997", F.lit(False))
    for run, rows in (("day-1", raw.where(early)), ("day-2", raw.where(~early).withColumn("ward", F.lit("B"))), ("day-3", None)):
        if rows is not None:
            rows.write.mode("append").option("compression", "gzip").json(landing)
        run_landing_job(spark, landing, store, raw.schema, LOAD_ORDER, run)
    return store


@bind("run_landing_job", f"SELECT * EXCLUDE ({', '.join(ARRIVAL_KEYS)}) FROM ({case_rows_sql('TRUE')})")
def q_run_landing_job(spark, sf):
    """Two days of JSON files through staging into the star, and a third run that finds nothing new."""
    return case_rows(_landing_runs(spark, sf)).drop(*ARRIVAL_KEYS)


@bind("landing_ledger", _RAW_SQL + """ SELECT CASE WHEN year(o_orderdate) < 1997 THEN 'day-1' ELSE 'day-2' END AS run, count(*) AS staged,
  0 AS corrupt, CASE WHEN year(o_orderdate) < 1997 THEN '' ELSE 'ward' END AS undeclared FROM r GROUP BY 1, 4""")
def q_landing_ledger(spark, sf):
    """What the same runs noted of their files, summed by run."""
    ledger = _landing_runs(spark, sf).read(LEDGER)
    return ledger.groupBy("run").agg(F.sum("staged").alias("staged"), F.sum("corrupt").cast("int").alias("corrupt"),
                                     F.max(F.array_join("undeclared", ",")).alias("undeclared"))


# ------------------------------------------------------------------ H10: repaired rows

@bind("run_repairs_rows", f"""SELECT * REPLACE (CASE WHEN CAST(case_id AS BIGINT) % 89 = 0 THEN NULL ELSE full_date END AS full_date)
FROM (SELECT * EXCLUDE ({', '.join(ARRIVAL_KEYS)}) FROM ({case_rows_sql('TRUE')}))""")
def q_run_repairs_rows(spark, sf):
    """Every case of a star that was damaged in four ways and repaired: only the dates whose calendar row
    is gone stay lost."""
    store = TableStore(spark)
    run_full_etl(partly_named(clinic_raw(spark, sf)), store, refresh=True, order_by=LOAD_ORDER)
    ft, be, fc = (store.read(t) for t in ("fact_transfer", "fact_transfer_embryo", "fact_ivf_cycle"))
    store.append("fact_transfer", ft.where("transfer_sk % 7 = 0"))
    store.append("fact_transfer", ft.where("transfer_sk % 5 = 0").withColumn("case_id", F.lit(None).cast("string"))
                 .withColumn("transfer_sk", -F.col("transfer_sk")))
    store.append("fact_transfer_embryo", be.where("transfer_sk % 3 = 0").withColumn("embryo_id", F.lit("emb_missing")))
    store.replace("fact_ivf_cycle", fc.withColumn("cycle_start_time_id", F.when(F.col("case_id").cast("long") % 89 == 0, F.lit(-1).cast("long"))
                                                  .otherwise(F.col("cycle_start_time_id"))))
    if run_repairs(store).first()["status"] != 1:
        raise RuntimeError("repair pass left validation failures")
    return case_rows(store).drop(*ARRIVAL_KEYS)


# ------------------------------------------------------------------ mergeable statistics

@bind("monthly_distinct_sketch", """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(DISTINCT o_custkey) AS cnt
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1""")
def q_monthly_distinct_sketch(spark, sf):
    """Customers per month from sketches stored by three batches, one of them delivered twice; exact while
    a month has no more than 4,096 of them, as here."""
    o = table(spark, sf, "orders").where("o_orderdate IS NOT NULL").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    store = TableStore(spark)
    for i in (0, 1, 2, 2):
        S.add_distinct_batch(store, "month_sketches", o.where(F.col("o_orderkey") % 3 == i), ["month"], "o_custkey", i)
    return S.merged_distinct(store.read("month_sketches"), ["month"])


SKETCHED = ("l_extendedprice", "l_quantity", "l_discount")


@bind("merged_quantiles", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, TRUE AS median_close, TRUE AS low_close, TRUE AS high_close FROM {DIRTY_LINEITEM_SQL}" for c in SKETCHED))
def q_merged_quantiles(spark, sf):
    """Quantiles from the sketches of four batches, each held against the exact rank of the estimate: within one per
    cent of the rows."""
    li = dirty_lineitem(spark, sf)
    parts = [S.quantile_sketches(li.where(F.pmod(F.xxhash64("l_partkey", "l_suppkey"), F.lit(4)) == i), SKETCHED) for i in range(4)]
    store = TableStore(spark)
    for part in parts:
        store.append("line_sketches", part)
    probs, names = (0.5, 0.01, 0.99), ("median", "low", "high")
    found = {r["column_name"]: r for r in S.merged_quantiles(store.read("line_sketches"), probs, names).collect()}
    each = []
    for c in SKETCHED:
        n = F.count(c)
        close = [((F.count_if(F.col(c) < found[c][a]) / n - p <= 0.01) & (p - F.count_if(F.col(c) <= found[c][a]) / n <= 0.01)).alias(f"{a}_close")
                 for p, a in zip(probs, names, strict=True)]
        each.append(li.agg(n.alias("n"), *close).select(F.lit(c).alias("column_name"), "n", *[f"{a}_close" for a in names]))
    return each[0].unionByName(each[1]).unionByName(each[2])


# ------------------------------------------------------------------ H01-H05 by batches

_CHECKED = {"orders": f"(SELECT * FROM {DIRTY_ORDERS_SQL} UNION ALL SELECT * FROM {DIRTY_ORDERS_SQL} WHERE o_orderkey % 19 = 0)",
            "lineitem": DIRTY_LINEITEM_SQL, "customer": "customer", "part": "part", "supplier": "supplier", "nation": "nation"}


def _checks_sql() -> str:
    parts = []
    for t, src in _CHECKED.items():
        parts.append(f"SELECT 'rows' AS sheet, '{t}' AS name, NULL AS column_name, count(*) AS n FROM {src}")
        parts.append(f"SELECT 'duplicates', '{t}', NULL, (SELECT count(*) FROM {src}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {src}))")
        parts += [f"SELECT 'nulls', '{t}', '{c}', count(*) - count({c}) FROM {src}" for c in TABLE_COLUMNS[t]]
    for check in FK_CHECKS:
        child, fk, parent, pk = check
        parts.append(f"SELECT 'fk_checks', '{check_name(check)}', NULL, count(*) FROM {_CHECKED[child]} ch WHERE ch.{fk} IS NOT NULL "
                     f"AND NOT EXISTS (SELECT 1 FROM {_CHECKED[parent]} p WHERE p.{pk} = ch.{fk})")
    return " UNION ALL ".join(parts)


@bind("incremental_checks", _checks_sql())
def q_incremental_checks(spark, sf):
    """Three batches with damage in each, the children often before their parents, orders delivered twice, and the
    third batch checked a second time."""
    checks = IncrementalChecks(TableStore(spark), FK_CHECKS, REQUIRED)
    o, li = dirty_orders(spark, sf), dirty_lineitem(spark, sf)
    small = {t: table(spark, sf, t) for t in ("customer", "part", "supplier", "nation")}
    third = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))
    for i in (0, 1, 2, 2):
        batch = {"orders": o.where(third == i), "lineitem": li.where(F.col("l_linenumber") % 3 == i)}
        if i == 1:
            batch |= {t: small[t] for t in ("customer", "part")}
        if i == 2:
            again = o.where(F.col("o_orderkey") % 19 == 0)
            batch |= {t: small[t] for t in ("supplier", "nation")} | {"orders": batch["orders"].unionByName(again)}
        checks.add(batch, i)
    return checks.totals()
