"""Work by batches: what a repeated, broken or interrupted load leaves behind."""

import contextlib
import io
import json
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.operators import sketches as S
from starling.operators.aggregates import clean_statistics
from starling.operators.clean import apply_clean_statistics
from starling.operators.load import insert_or_ignore, upsert_partitions
from starling.operators.quality import validate
from starling.plans import reports
from starling.plans.daily import FACT, REJECTED_DAILY, run_daily_load
from starling.plans.incremental_checks import IncrementalChecks
from starling.plans.landing_job import LEDGER, STAGING, run_landing_job
from starling.plans.warehouse import REJECTED, run_full_etl
from starling.registry import clinic_registry
from starling.session import written
from starling.sources.landing import staging_refresh
from starling.sources.store import TableStore
from starling.streaming.landing_stream import stream_incremental_load, stream_landing_ingest, stream_star_load

CASES = T.StructType([T.StructField("case_id", T.StringType()), T.StructField("female_age", T.IntegerType()), T.StructField("saved_at", T.StringType())])


def put(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


# ------------------------------------------------------------------ staging, daily load

def test_restaging_a_day_without_valid_files_leaves_no_rows(spark, tmp_root):
    landing, staging = tmp_root + "/landing", tmp_root + "/staging"
    for i in range(3):
        put(landing, f"{i}_20240101.json", {"case_id": f"c{i}"})
        put(landing, f"{i}_20240102.json", {"case_id": f"d{i}"})
    assert staging_refresh(spark, landing, staging, "20240101").count() == 3
    assert staging_refresh(spark, landing, staging, "20240102").count() == 3
    for i in range(3):
        put(landing, f"{i}_20240101.json", '{"case_id": "c')
    assert staging_refresh(spark, landing, staging, "20240101").count() == 0
    assert spark.read.parquet(staging).count() == 3
    assert spark.read.parquet(staging + "_quarantine").count() == 3


def daily(folder, name, *rows):
    put(folder, name, "case_id,risk_level,response_type,suggested_waiting_period_days,failure_reason,doctor_recommendation,e2_on_trigger,saved_at", *rows)


def test_daily_load_twice_changes_nothing_and_writes_only_touched_months(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    daily(tmp_root + "/d1", "a.csv", "c1,High,F,,,x,10,2024-01-05", "c2,Low,F,,,x,20,2024-02-05", ",Low,F,,,x,99,2024-02-06", "c3,Low,F,,,x,30,not a date")
    done = run_daily_load(spark, tmp_root + "/d1", store, ["saved_at"])
    assert done.fact_rows == 3 and done.months == ("2024-01", "2024-02", None)
    first = sorted(map(tuple, store.read(FACT).select("case_id", "e2_on_trigger", "case_month").collect()), key=str)
    run_daily_load(spark, tmp_root + "/d1", store, ["saved_at"])
    assert sorted(map(tuple, store.read(FACT).select("case_id", "e2_on_trigger", "case_month").collect()), key=str) == first
    assert store.read(REJECTED_DAILY).count() == 1 and store.read("dim_outcome").count() == 2
    january = [f for f in store.folders(FACT) if "case_month=2024-01" in f]
    daily(tmp_root + "/d2", "a.csv", "c2,Low,F,,,x,21,2024-03-01", "c4,Low,F,,,x,40,2024-03-02")
    assert run_daily_load(spark, tmp_root + "/d2", store, ["saved_at"]).months == ("2024-02", "2024-03")
    assert [f for f in store.folders(FACT) if "case_month=2024-01" in f] == january
    got = {r["case_id"]: (r["e2_on_trigger"], r["case_month"]) for r in store.read(FACT).collect()}
    assert store.read(FACT).count() == 4 and got["c2"] == (21.0, "2024-03") and got["c3"] == (30.0, None)


def test_upsert_partitions_of_nothing(spark, tmp_root):
    store, schema = TableStore(spark, tmp_root + "/wh"), "k long, v long, month string"
    upsert_partitions(store, "t", spark.createDataFrame([(1, 1, "a")], schema), ["k"], ["v"], "month")
    before = store.folders("t")
    assert upsert_partitions(store, "t", spark.createDataFrame([], schema), ["k"], ["v"], "month") == []
    assert store.folders("t") == before
    assert upsert_partitions(store, "t", spark.createDataFrame([(1, 5, "b"), (1, 4, "c")], schema), ["k"], ["v"], "month") in (["a", "b"], ["b", "a"])
    assert [tuple(r) for r in store.read("t").collect()] == [(1, 5, "b")]


# ------------------------------------------------------------------ streams

def test_streams_of_an_empty_landing_folder(spark, tmp_root):
    os.makedirs(tmp_root + "/landing")
    out = stream_landing_ingest(spark, tmp_root + "/landing", CASES, tmp_root + "/staging", tmp_root + "/c1", partitioned=False)
    assert out.count() == 0 and out.columns == [*CASES.fieldNames(), "source_file", "batch_id"]
    out = stream_incremental_load(spark, tmp_root + "/landing", CASES, TableStore(spark, tmp_root + "/wh"), "t", ["case_id"], ["saved_at"],
                                  tmp_root + "/c2", partitioned=False)
    assert out.count() == 0 and out.columns == CASES.fieldNames()


def load_cases(spark, tmp_root, store, checkpoint):
    return stream_incremental_load(spark, tmp_root + "/landing", CASES, store, "cases", ["case_id"], ["saved_at"], tmp_root + checkpoint, partitioned=False)


def test_a_replayed_batch_adds_nothing(spark, tmp_root):
    put(tmp_root + "/landing", "a.json", {"case_id": "c1", "female_age": 30}, {"female_age": 31}, '{"case_id": "c2", "fema')
    store = TableStore(spark, tmp_root + "/wh")
    for checkpoint in ("/one", "/two"):  # the second delivers the same file to a stream that knows nothing of it
        assert [r["case_id"] for r in load_cases(spark, tmp_root, store, checkpoint).collect()] == ["c1"]
        assert sorted(r["reject_reason"] for r in store.read("cases_rejected").collect()) == ["corrupt_record", "null_case_id"]
    folders = store.folders("cases")
    for name in ("0", ".0.crc"):  # the stream's own note of the batch is lost: it runs the batch again
        if os.path.exists(f"{tmp_root}/one/commits/{name}"):
            os.remove(f"{tmp_root}/one/commits/{name}")
    again = TableStore(spark, tmp_root + "/wh")
    load_cases(spark, tmp_root, again, "/one")
    assert again.folders("cases") == folders


def test_a_batch_killed_before_its_commit_is_loaded_once(spark, tmp_root, monkeypatch):
    put(tmp_root + "/landing", "a.json", {"case_id": "c1", "female_age": 30}, {"case_id": "c2"}, {"female_age": 31})
    store = TableStore(spark, tmp_root + "/wh")
    with monkeypatch.context() as m, pytest.raises(Exception):
        m.setattr(store, "mark_batch", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        load_cases(spark, tmp_root, store, "/ckpt")
    assert TableStore(spark, tmp_root + "/wh").read("cases").count() == 0
    fresh = TableStore(spark, tmp_root + "/wh")
    assert load_cases(spark, tmp_root, fresh, "/ckpt").count() == 2 and fresh.read("cases_rejected").count() == 1


def test_star_load_sets_corrupt_records_aside(spark, tmp_root):
    put(tmp_root + "/landing", "a.json", {"case_id": "c1", "et_date": "2024-01-02"}, {"et_date": "2024-01-03"}, '{"case_id": "c2", "et_d')
    store = TableStore(spark, tmp_root + "/wh")
    typed = T.StructType.fromDDL("case_id string, et_date string")
    for checkpoint in ("/one", "/two"):
        stream_star_load(spark, tmp_root + "/landing", typed, store, ["et_date"], tmp_root + checkpoint, partitioned=False)
        assert store.read("fact_ivf_cycle").count() == 1
        assert sorted(r["reject_reason"] for r in store.read(REJECTED).collect()) == ["corrupt_record", "null_case_id"]


def test_resubmissions_enter_staging_once_over_restarts(spark, tmp_root):
    def ingest():
        return sorted((r["case_id"] or "", r["female_age"] or 0) for r in stream_landing_ingest(
            spark, tmp_root + "/landing", CASES, tmp_root + "/staging", tmp_root + "/ckpt", partitioned=False, once_per=["case_id"], within="12 seconds").collect())

    put(tmp_root + "/landing", "a.json", {"case_id": "c1", "female_age": 1, "saved_at": "2024-01-01T10:00:00"}, {"female_age": 7})
    assert ingest() == [("", 7), ("c1", 1)]
    put(tmp_root + "/landing", "b.json", {"case_id": "c1", "female_age": 2, "saved_at": "2030-01-01T10:20:00"},
        {"case_id": "c2", "female_age": 3, "saved_at": "1999-01-01T10:10:00"}, {"female_age": 8}, '{"case_id": "c3"', '{"case_id": "c4"')
    assert ingest() == [("", 7), ("", 8), ("c1", 1), ("c2", 3)]
    assert spark.read.parquet(tmp_root + "/staging_quarantine").count() == 2
    time.sleep(26)  # the first c1 leaves the state
    put(tmp_root + "/landing", "c.json", {"case_id": "c9", "female_age": 4})
    assert ("c9", 4) in ingest()
    put(tmp_root + "/landing", "d.json", {"case_id": "c1", "female_age": 5}, {"case_id": "c9", "female_age": 6})
    assert ingest() == [("", 7), ("", 8), ("c1", 1), ("c1", 5), ("c2", 3), ("c9", 4)]


# ------------------------------------------------------------------ plans of small batches

def test_a_small_batch_does_not_shuffle_the_target(spark, tmp_root):
    spark.range(200_000).withColumn("v", F.col("id") * 2).write.parquet(tmp_root + "/target")
    target = spark.read.parquet(tmp_root + "/target")
    batch = written(spark.createDataFrame([(5, 0), (7, 0), (900_000, 0)], "id long, v long"), "batch")
    new = insert_or_ignore(target, batch, ["id"], ["v"], cut_target=True)
    assert [r["id"] for r in new.collect()] == [900_000]
    text = plan(insert_or_ignore(target, batch, ["id"], ["v"], unique_batch=True, cut_target=True)).split("\n\n\n")[0]
    steps = text[:text.index("(1) ")] if "(1) " in text else text
    # nothing lies between the target's scan and the broadcast semi join
    scan = next(i for i, line in enumerate(steps.splitlines()) if "BroadcastHashJoin LeftSemi" in line)
    below = steps.splitlines()[scan + 1:]
    target_side = below[:next(i for i, line in enumerate(below) if "BroadcastExchange" in line)]
    assert any("Scan parquet" in x for x in target_side) and not any("Exchange" in x for x in target_side)


def raw_cases(spark, rows):
    return spark.createDataFrame(rows, "case_id string, et_date string, female_age string, embryos_transferred int, good_embryos int, grading string")


def test_a_batch_without_news_writes_nothing(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    rows = [("c1", "2024-01-02", "30", 2, 1, "AA"), ("c2", "2024-02-02", "31", 2, 1, "AB")]
    run_full_etl(raw_cases(spark, rows), store, refresh=True)
    before = {n: store.folders(n) for n in store.registry.names()}
    run_full_etl(raw_cases(spark, rows), store, refresh=False)
    assert {n: store.folders(n) for n in store.registry.names()} == before
    run_full_etl(raw_cases(spark, [("c3", "2024-01-02", "30", 2, 1, "AA")]), store, refresh=False)
    after = {n: store.folders(n) for n in store.registry.names()}
    assert all(after[n][:len(before[n])] == before[n] for n in before)
    assert after["dim_embryo"] == before["dim_embryo"] and len(after["dim_female"]) == len(before["dim_female"]) + 1


def test_reports_prune_months_at_run_time(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    rows = [(f"c{i}", f"2024-{i % 12 + 1:02d}-03", "30", 1, 1, "AA") for i in range(60)]
    run_full_etl(raw_cases(spark, rows), store, refresh=True, registry=clinic_registry(partitioned=True))
    assert store.partition_of("fact_ivf_cycle") == "cycle_month" and store.partition_of("fact_transfer") == "transfer_month"
    df = reports.dashboard_monthly(store.read("fact_ivf_cycle"), store.read("dim_time"), limit=None, days="quarter = 2")
    assert sorted(map(tuple, df.collect())) == [("2024-04", 5), ("2024-05", 5), ("2024-06", 5)]
    assert "dynamicpruning" in plan(df).lower()
    again = run_full_etl(raw_cases(spark, rows), store, refresh=False, registry=clinic_registry(partitioned=True))
    assert all(r["inserted"] == 0 for r in again.collect())


# ------------------------------------------------------------------ clean stage, refused values

@pytest.mark.parametrize("share", [0.0, 0.3, 0.97])
def test_clean_statistics_against_numpy(spark, share):
    rng = random.Random(int(share * 100))
    values = [None if rng.random() < share else rng.choice([rng.gauss(0, 10), 3.0]) for _ in range(700)]
    rows = [(v, None if i % 3 else i, float("nan") if i % 2 else 1.0, None) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double").repartition(5)
    got = {r["column_name"]: r for r in clean_statistics(df, ["a", "b", "c", "d"]).collect()}
    for c, raw in (("a", values), ("b", [r[1] for r in rows]), ("c", [None if np.isnan(r[2]) else r[2] for r in rows])):
        own = [v for v in raw if v is not None]
        median = float(np.median(own))
        filled = [median if v is None else v for v in raw]
        want = (700, 700 - len(own), median, *np.quantile(filled, [0.01, 0.99]))
        assert tuple(got[c])[1:3] == want[:2] and np.allclose(tuple(got[c])[3:], want[2:], rtol=1e-12, atol=1e-12)
    assert tuple(got["d"]) == ("d", 700, 700, None, None, None)
    cleaned = apply_clean_statistics(df, clean_statistics(df, ["a", "b", "d"]))
    assert cleaned.where("a IS NULL OR b IS NULL").count() == 0 and dict(cleaned.dtypes)["b"] == "int" and cleaned.where("d IS NULL").count() == 700


def test_clean_stage_reuses_its_statistics(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    rows = [(f"c{i}", "2024-01-02", str(20 + i % 10), 2, 1, " AA ") for i in range(40)] + [("x", "2024-01-02", None, 2, 1, None)]
    run_full_etl(raw_cases(spark, rows), store, refresh=True, clean=True)
    stats = [tuple(r) for r in store.read("clean_statistics").orderBy("column_name").collect()]
    assert {r["grading"] for r in store.read("dim_embryo").collect()} == {"AA", "Unknown"}
    assert {r["class_a_rate"] for r in store.read("dim_embryo").collect()} == {0.5}
    run_full_etl(raw_cases(spark, [("y", "2024-01-02", "99", 0, 1, "AA"), ("z", "2024-01-02", None, 0, 1, "AA")]), store, refresh=False, clean=True)
    assert [tuple(r) for r in store.read("clean_statistics").orderBy("column_name").collect()] == stats
    ages = {r["case_id"]: r["female_age"] for r in store.read("fact_ivf_cycle").join(store.read("dim_female"), "female_id").collect()}
    assert (ages["x"], ages["y"], ages["z"]) == (25, 29, 25)  # clipped to the first load's 99 %, filled with its median


def test_clean_stage_on_sketches(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    for batch in range(3):
        rows = [(f"c{batch}-{i}", "2024-01-02", str(20 + i % 10) if i % 4 else None, 2, 1, "AA") for i in range(40)]
        run_full_etl(raw_cases(spark, rows), store, refresh=batch == 0, clean="sketch")
    row, = store.read("clean_statistics").where("column_name = 'female_age'").collect()
    assert (row["n"], row["missing"]) == (120, 30) and 24 <= row["median"] <= 26 and (row["low"], row["high"]) in {(20.0, 29.0), (21.0, 29.0)}


def test_refused_values_are_kept_with_their_text(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    rows = [("c1", "2024-01-02", "thirty", 2, 1, "AA"), ("c2", "some day", "31", 2, 1, "AA"), ("c3", None, " ", 2, 1, "AA"), (None, "2024-01-02", "x", 2, 1, "AA")]
    for refresh in (True, False):
        run_full_etl(raw_cases(spark, rows), store, refresh=refresh)
        got = {(json.loads(r["record"]).get("case_id"), r["reject_reason"]): [tuple(x) for x in r["refused"] or ()] for r in store.read(REJECTED).collect()}
        assert got == {("c1", "refused_values"): [("female_age", "thirty")], ("c2", "refused_values"): [("et_date", "some day")],
                       (None, "null_case_id"): [("female_age", "x")]}
        assert store.read("fact_ivf_cycle").count() == 3 and store.read(REJECTED).count() == 3


# ------------------------------------------------------------------ landing job

def test_landing_job_takes_a_file_once_and_a_changed_one_again(spark, tmp_root):
    landing, store = tmp_root + "/landing", TableStore(spark, tmp_root + "/wh")
    typed = T.StructType.fromDDL("case_id string, et_date string, female_age int, female_id string")
    put(landing, "a.json", {"case_id": "c1", "patient_id": "p1", "ward": "B", "et_date": "2024-01-02"}, {"et_date": "2024-01-03"}, '{"case_id": "c', "[1", "7")
    put(landing, "b.json", {"case_id": "c2", "female_age": "31"})
    put(landing, "empty.json", "", " ", "")
    put(landing, "nothing.json")
    put(landing, "notes.txt", "no data")

    def run(name):
        rows = run_landing_job(spark, landing, store, typed, ["et_date"], name).collect()
        return {os.path.basename(r["file"]): (r["staged"], r["corrupt"], r["undeclared"]) for r in rows}

    assert run("r1") == {"a.json": (2, 3, ["ward"]), "b.json": (1, 0, []), "empty.json": (0, 0, [])}
    assert run("r2") == {}
    assert sorted(r["case_id"] for r in store.read("fact_ivf_cycle").collect()) == ["c1", "c2"]
    assert {r["reject_reason"] for r in store.read(REJECTED).collect()} == {"corrupt_record", "null_case_id"} and store.read(REJECTED).count() == 4
    time.sleep(1.1)
    put(landing, "b.json", {"case_id": "c2", "female_age": "40"}, {"case_id": "c5"})
    assert run("r3") == {"b.json": (2, 0, [])}
    assert sorted(r["case_id"] for r in store.read("fact_ivf_cycle").collect()) == ["c1", "c2", "c5"]
    assert store.read(LEDGER).count() == 4 and store.read(STAGING).count() == 2
    assert {r["female_id"] for r in store.read("fact_ivf_cycle").where("case_id = 'c1'").collect()} == {"p1"}


def test_landing_job_of_forms_with_many_lines(spark, tmp_root):
    landing, store = tmp_root + "/landing", TableStore(spark, tmp_root + "/wh")
    put(landing, "a.json", json.dumps({"case_id": "c1", "et_date": "2024-01-02"}, indent=2))
    put(landing, "b.json", json.dumps([{"case_id": "c2"}, {"case_id": "c3"}], indent=2))
    typed = T.StructType.fromDDL("case_id string, et_date string")
    rows = run_landing_job(spark, landing, store, typed, ["et_date"], "r1", multiline=True).collect()
    assert sorted(r["staged"] for r in rows) == [1, 2] and store.read("fact_ivf_cycle").count() == 3


# ------------------------------------------------------------------ validation by batches, sketches

CHECKS = [("child", "fk", "parent", "pk"), ("parent", "up", "parent", "pk")]


def test_checks_by_batches_equal_the_whole_validation(spark, tmp_root):
    rng, batches = random.Random(4), []
    for i in range(3):
        child = [(rng.choice([None, *range(12)]), rng.choice([None, "x", "y"])) for _ in range(60)]
        parent = [(k if rng.random() < 0.9 else None, rng.choice([None, 1, 2, 50])) for k in rng.sample(range(4 * i, 4 * i + 6), 4)]
        batches.append({"child": spark.createDataFrame(child, "fk long, v string")} | ({"parent": spark.createDataFrame(parent, "pk long, up long")} if i else {}))
    checks = IncrementalChecks(TableStore(spark, tmp_root + "/wh"), CHECKS, {"child": ["v"], "parent": ["pk"]})
    assert checks.sheets()["status"].first()["status"] == 1
    for i, b in enumerate(batches):
        checks.add(b, i)
    checks.add(batches[2], 2)  # a batch checked again counts once
    whole = {"child": batches[0]["child"].union(batches[1]["child"]).union(batches[2]["child"]), "parent": batches[1]["parent"].union(batches[2]["parent"])}
    want, got = validate(whole, {"child": ["v"], "parent": ["pk"]}, CHECKS), checks.sheets()
    for name in ("tables", "nulls", "duplicates", "fk_checks", "required", "status"):
        assert sorted(map(str, got[name].select(*want[name].columns).collect())) == sorted(map(str, want[name].collect())), name


def test_distinct_sketches_merge_within_their_error(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    df = spark.range(60_000).select((F.col("id") % 3).cast("string").alias("month"), (F.col("id") % 15_000).alias("who"))
    for i, part in enumerate((df.where("who < 9000"), df.where("who >= 6000"), df.where("who < 100"))):
        S.add_distinct_batch(store, "sk", part, ["month"], "who", i)
    folders = store.folders("sk")
    S.add_distinct_batch(store, "sk", df, ["month"], "who", 1)
    assert store.folders("sk") == folders
    for r in S.merged_distinct(store.read("sk"), ["month"]).collect():
        assert abs(r["cnt"] - 5000) < 5000 * 5 / 2 ** (S.LG_ENTRIES / 2)  # five standard errors


def test_quantile_sketches_merge_within_their_rank_error(spark):
    df = spark.range(40_000).select((F.col("id") * F.col("id")).cast("double").alias("x"), F.when(F.col("id") % 2 == 0, F.lit(1.0)).alias("y"), F.lit(None).cast("double").alias("z"))
    parts = [S.quantile_sketches(df.where(F.pmod(F.xxhash64("x"), F.lit(5)) == i), ["x", "y", "z"]) for i in range(5)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    got = {r["column_name"]: r for r in S.merged_quantiles(merged, (0.01, 0.5, 0.99), ("a", "b", "c")).collect()}
    for p, a in ((0.01, "a"), (0.5, "b"), (0.99, "c")):
        assert abs(got["x"][a] ** 0.5 / 40_000 - p) < 0.01
    assert (got["y"]["b"], got["y"]["n"], got["z"]["b"], got["z"]["n"]) == (1.0, 20_000, None, 0)
