"""What the loads leave behind and shuffle: working tables, whole rows, compressed submissions."""

from __future__ import annotations

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from starling.operators.clean import drop_exact_duplicates
from starling.operators.keys import row_index
from starling.operators.load import record_rejects
from starling.operators.windows import first_per_key
from starling.plans.incremental_checks import ROWS, IncrementalChecks
from starling.plans.landing_job import run_landing_job
from starling.plans.warehouse import run_full_etl
from starling.session import ensure_checkpoint_dir, local_path
from starling.sources.store import TableStore


def working_files(spark) -> set[str]:
    root = os.path.join(local_path(ensure_checkpoint_dir(spark)), "starling-work")
    return {d for d in (os.listdir(root) if os.path.isdir(root) else []) if not d.startswith("warehouse")}


def cases(spark, ids):
    rows = [(str(i), f"f{i % 3}", "m1", "IVF", "day5", "A", "2024-01-0%d" % (1 + i % 9), float(i), 1) for i in ids]
    return spark.createDataFrame(rows, "case_id string, female_id string, male_id string, protocol_type string, fresh_et_stage string, "
                                 "grading string, et_date string, e2_on_trigger double, embryos_transferred int")


@pytest.mark.parametrize("clean", [False, True])
def test_a_load_leaves_no_working_tables(spark, tmp_path, clean):
    store, before = TableStore(spark, str(tmp_path)), working_files(spark)
    raw = cases(spark, [1, 2, 2, 3])
    for batch in (raw, raw.unionByName(cases(spark, [4, 5]))):
        run_full_etl(batch, store, refresh=False, order_by=["case_id"], clean=clean)
    assert working_files(spark) == before
    cyc, tr = ({r["case_id"]: r[k] for r in store.read(t).collect()} for t, k in (("fact_ivf_cycle", "cycle_sk"), ("fact_transfer", "transfer_sk")))
    assert cyc == tr == {"1": 1, "2": 2, "3": 3, "4": 4, "5": 5}
    assert store.read("fact_transfer_embryo").count() == 5
    cycles = store.read("fact_ivf_cycle")
    for t, k in (("dim_outcome", "outcome_id"), ("dim_protocol", "protocol_id"), ("dim_female", "female_id"), ("dim_doctor", "doctor_id")):
        assert cycles.join(store.read(t), k).count() == 5


def test_rows_without_an_equal_are_not_shuffled(spark, tmp_path):
    nan, null = float("nan"), None
    rows = [(1, nan, "a"), (1, nan, "a"), (2, 0.0, null), (2, -0.0, null), (3, null, null), (4, 1.0, "b")]
    spark.createDataFrame(rows, "k int, x double, s string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = sorted(str(tuple(r)) for r in drop_exact_duplicates(df, reread=True).collect())
    assert len(got) == 4 and sorted(r[0] for r in drop_exact_duplicates(df).collect()) == [1, 2, 3, 4]
    assert drop_exact_duplicates(df.where("k > 2"), reread=True).count() == 2
    assert "Exchange" not in drop_exact_duplicates(df.where("k > 2"), reread=True)._jdf.queryExecution().toString()


def test_numbered_rows_are_stored_compressed_and_order_columns_travel_once(spark):
    df = spark.range(20).select((F.col("id") * 7 % 20).alias("v"), F.lit(None).cast("string").alias("s"))
    assert [r["n"] for r in row_index(df, ["v"], "n").orderBy("v").collect()] == list(range(1, 21))
    assert "FileScan parquet" in row_index(df, ["v"], "n")._jdf.queryExecution().toString()
    assert [r["n"] for r in row_index(df.withColumn("z", F.lit(None)), ["v"], "n").orderBy("v").collect()] == list(range(1, 21))
    plan = first_per_key(df.withColumn("k", F.col("v") % 3), ["k"], ["v"])
    assert sorted((r["k"], r["v"]) for r in plan.collect()) == [(0, 0), (1, 1), (2, 2)]
    assert "struct(__o0, v#" in plan._jdf.queryExecution().toString() and ", v, v#" not in plan._jdf.queryExecution().toString()


def test_each_distinct_reject_is_kept_once(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    assert record_rejects(store, "r", rows, F.lit("x")) == 2
    assert record_rejects(store, "r", rows.unionByName(rows), F.lit("x")) == 0
    assert record_rejects(store, "r", rows.unionByName(rows), F.lit("y")) == 2
    assert store.read("r").count() == 4


def test_compressed_submissions_are_taken(spark, tmp_path):
    landing, store = tmp_path / "landing", TableStore(spark, str(tmp_path / "star"))
    landing.mkdir()
    record = cases(spark, [1]).first().asDict()
    for name, opener, case in (("a.json", open, "1"), ("b.json.gz", gzip.open, "2")):
        with opener(landing / name, "wt") as f:
            f.write(json.dumps(record | {"case_id": case}) + "\n")
    before = working_files(spark)
    taken = run_landing_job(spark, str(landing), store, cases(spark, []).schema, ["case_id"], "day-1")
    assert sorted(r["staged"] for r in taken.collect()) == [1, 1]
    assert sorted(r["case_id"] for r in store.read("fact_ivf_cycle").collect()) == ["1", "2"]
    assert {d.rsplit("-", 1)[0] for d in working_files(spark) - before} == {"ledger-rows"}


def test_checked_batches_leave_no_working_tables(spark, tmp_path):
    store, before = TableStore(spark, str(tmp_path)), working_files(spark)
    checks = IncrementalChecks(store, [("c", "p", "d", "p")], {})
    d = spark.createDataFrame([(1,), (2,)], "p int")
    checks.add({"c": spark.createDataFrame([(1, 1), (2, 3), (2, 3)], "k int, p int")}, 0)
    checks.add({"d": d, "c": spark.createDataFrame([(2, 3)], "k int, p int")}, 1)
    n = {(r["sheet"], r["name"]): r["n"] for r in checks.totals().where("sheet <> 'nulls'").collect()}
    assert n == {("rows", "c"): 4, ("duplicates", "c"): 2, ("rows", "d"): 2, ("duplicates", "d"): 0, ("fk_checks", "c.p -> d.p"): 3}
    assert store.read(ROWS).count() == 4 and working_files(spark) == before
