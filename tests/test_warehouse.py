"""A 4-row raw table through the whole load, with the hand-derived
expectations (load, idempotence, validation, dashboard)."""

from pyspark.sql import functions as F

from starling.plans import reports
from starling.plans.warehouse import run_full_etl, run_validation
from starling.sources.store import TableStore
from tests.fixtures import raw_rows, raw_schema


def _load(spark, root):
    raw = spark.createDataFrame(raw_rows(), raw_schema())
    store = TableStore(spark, root)
    summary = run_full_etl(raw, store, refresh=True)
    return raw, store, summary


def test_load_counts_and_idempotence(spark, tmp_root):
    raw, store, summary = _load(spark, tmp_root)
    counts = {n: store.read(n).count() for n in store.registry.names()}
    assert counts["fact_ivf_cycle"] == 3
    assert counts["fact_transfer"] == 3
    assert counts["fact_transfer_embryo"] == 3
    assert counts["dim_doctor"] == 3
    assert counts["dim_time"] == 2
    assert counts["dim_female"] == 3
    # load the same input again (incremental): no table grows
    run_full_etl(raw, store, refresh=False)
    again = {n: store.read(n).count() for n in store.registry.names()}
    assert again == counts


def test_dim_time_and_fact_keys(spark, tmp_root):
    _, store, _ = _load(spark, tmp_root)
    t = {r["full_date"]: r.asDict() for r in store.read("dim_time").collect()}
    assert t["2022-11-15"]["week"] == 46 and t["2022-11-15"]["quarter"] == 4
    assert t["2022-11-15"]["month_name"] == "November" and t["2022-11-15"]["time_id"] == 1
    assert t["2023-03-07"]["week"] == 10 and t["2023-03-07"]["day"] == 7 and t["2023-03-07"]["time_id"] == 2
    f = {r["case_id"]: r for r in store.read("fact_ivf_cycle").collect()}
    assert f["CASE_TEST_003"]["cycle_start_time_id"] is None
    assert f["CASE_TEST_001"]["m2_count"] == 4
    docs = {(r["doctor_name"], r["doctor_recommendation"]) for r in store.read("dim_doctor").collect()}
    assert docs == {("Unknown", "Good response"), ("Unknown", "Monitor closely"), ("Unknown", None)}
    assert all(r["doctor_id"] is not None for r in store.read("fact_transfer").collect())


def test_validation_and_dashboard(spark, tmp_root):
    _, store, _ = _load(spark, tmp_root)
    v = run_validation(store)
    assert v["status"].first()["status"] == 1
    fc, ft = store.read("fact_ivf_cycle"), store.read("fact_transfer")
    k = reports.dashboard_kpis(fc, ft).first()
    assert (k["total_patients"], k["active_cycles"], k["live_births"], k["total_transfers"], k["success_rate"]) == \
        (3, 3, 0, 3, 0.0)
    m = [tuple(r) for r in reports.dashboard_monthly(fc, store.read("dim_time")).collect()]
    assert m == [("2022-11", 1), ("2023-03", 1)]
    o = {r["label"]: r["value"] for r in reports.dashboard_outcomes(fc, store.read("dim_outcome")).collect()}
    assert o == {"High": 1, "Medium": 1, "Unknown": 1}
    a = [(r["label"], r["value"]) for r in reports.dashboard_age(store.read("dim_female")).orderBy("bucket_order").collect()]
    assert a == [("<30", 1), ("30–34", 2), ("35–39", 0), ("40–44", 0), ("45+", 0)]
    p = reports.patient_profile(fc, ft, store.read("dim_female"), store.read("dim_male"), store.read("dim_doctor"),
                                store.read("dim_outcome"), store.read("dim_time"))
    assert p.count() == 3
    assert p.where(F.col("case_id") == "CASE_TEST_002").first()["risk_level"] == "Medium"


def test_repair_pass_on_dirty_star(spark, tmp_root):
    from starling.plans.warehouse import run_repairs
    _, store, _ = _load(spark, tmp_root)
    ft = store.read("fact_transfer")
    one = ft.orderBy("transfer_sk").limit(1)
    store.append("fact_transfer", one)                                          # duplicate row
    store.append("fact_transfer", one.withColumn("transfer_sk", F.lit(900).cast("long"))
                 .withColumn("case_id", F.lit(None).cast("string")))            # NULL required case_id
    cyc = store.read("fact_ivf_cycle")
    store.replace("fact_ivf_cycle", cyc.withColumn(                             # orphan time key
        "cycle_start_time_id", F.when(F.col("case_id") == "CASE_TEST_002", F.lit(77).cast("long"))
        .otherwise(F.col("cycle_start_time_id"))))
    sk = ft.agg(F.min("transfer_sk")).first()[0]
    extra = spark.createDataFrame([(999, "emb_x"), (sk, "emb_missing"), (sk, None)],
                                  "transfer_sk bigint, embryo_id string")
    store.append("fact_transfer_embryo", extra)
    assert run_validation(store)["status"].first()["status"] == -1
    assert run_repairs(store).first()["status"] == 1
    assert store.read("fact_transfer").count() == 3
    assert store.read("fact_ivf_cycle").where("case_id = 'CASE_TEST_002'").first()["cycle_start_time_id"] is None
    bridge = {(r["transfer_sk"], r["embryo_id"]) for r in store.read("fact_transfer_embryo").collect()}
    assert (999, "emb_x") not in bridge and (sk, "emb_missing") not in bridge and (sk, None) in bridge
    assert len(bridge) == 4


def _store(spark, root, rows, schema, **kw):
    store = TableStore(spark, root)
    run_full_etl(spark.createDataFrame(rows, schema), store, refresh=True, **kw)
    return store


def test_absent_measures_are_zero_and_transfers_are_not_invented(spark, tmp_root):
    store = _store(spark, tmp_root, [("c1", "2024-01-02", 3), ("c2", "2024-01-03", None)],
                   "case_id string, et_date string, gv_count int")
    got = {r["case_id"]: r for r in store.read("fact_ivf_cycle").collect()}
    assert (got["c1"]["gv_count"], got["c1"]["good_embryos"], got["c1"]["e2_on_trigger"]) == (3, 0, 0)
    assert got["c2"]["gv_count"] is None  # present but missing in the row
    assert store.read("fact_transfer").count() == 0 and store.read("fact_transfer_embryo").count() == 0


def test_one_natural_key_has_one_id_in_facts_of_all_batches(spark, tmp_root):
    schema = ("case_id string, et_date string, embryos_transferred int, embryo_id string, grading string, "
              "fresh_et_stage string, class_a_rate double")
    store = _store(spark, tmp_root, [("c1", "2024-01-02", 1, "E1", "AA", "B", 0.5), ("c2", "2024-01-02", 1, None, "AA", "B", 0.5)], schema)
    run_full_etl(spark.createDataFrame([("c3", "2024-01-02", 1, None, "AA", "B", 0.5), ("c4", "2024-01-02", 2, "E9", "AA", "B", 0.5)], schema),
                 store, refresh=False)
    assert [r["embryo_id"] for r in store.read("dim_embryo").collect()] == ["E1"]
    bridge = store.read("fact_transfer_embryo").collect()
    assert len(bridge) == 4 and {r["embryo_id"] for r in bridge} == {"E1"}
    assert run_validation(store)["status"].first()["status"] == 1


def test_natural_keys_do_not_run_together(spark, tmp_root):
    schema = "case_id string, et_date string, embryos_transferred int, grading string, fresh_et_stage string"
    store = _store(spark, tmp_root, [("c1", None, 1, "c", "a|b"), ("c2", None, 1, "b|c", "a"), ("c3", None, 1, None, "<null>"),
                                     ("c4", None, 1, None, None)], schema)
    assert store.read("dim_embryo").count() == 4


def test_rows_without_a_case_are_set_aside_once(spark, tmp_root):
    rows, schema = [("c1", "2024-01-02", 1), (None, "2024-01-03", 2), (" ", "2024-01-03", 2)], "case_id string, et_date string, embryos_transferred int"
    store = _store(spark, tmp_root, rows, schema)
    before = {n: store.read(n).count() for n in [*store.registry.names(), "rejected_raw"]}
    assert before["fact_ivf_cycle"] == before["fact_transfer"] == 1 and before["rejected_raw"] == 1
    run_full_etl(spark.createDataFrame(rows, schema), store, refresh=False)
    assert {n: store.read(n).count() for n in before} == before
