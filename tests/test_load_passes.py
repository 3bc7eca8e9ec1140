"""What the passes of a load read: ids and typed values computed once, code that is compiled."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from starling.plans import landing_job, warehouse
from starling.session import COMPILED, METHOD_LIMIT, compiled_methods
from starling.sources.store import TableStore
from starling.streaming.landing_stream import stream_star_load

SCHEMA = ("case_id string, female_id string, female_age int, male_id string, protocol_type string, risk_level string, response_type string, "
          "fresh_et_stage string, grading string, et_date string, e2_on_trigger double, embryos_transferred int, good_embryos int")


def rows(spark, cases):
    """(case, female, age): one raw row each."""
    return spark.createDataFrame([(c, f, age, "m1", "IVF", "High", "good", "day5", "A", "2024-01-0%d" % (1 + i % 9), float(i), 2, 1)
                                  for i, (c, f, age) in enumerate(cases)], SCHEMA)


def seen(monkeypatch, module, spark) -> dict:
    """What ``module`` writes to the work folder by name: columns, and the method limit then."""
    found, real = {}, module.written

    def spy(df, name):
        found[name] = (df.columns, spark.conf.get(METHOD_LIMIT))
        return real(df, name)
    monkeypatch.setattr(module, "written", spy)
    return found


def test_ids_are_computed_once_and_the_rows_by_compiled_code(spark, tmp_path, monkeypatch):
    default, found = spark.conf.get(METHOD_LIMIT), seen(monkeypatch, warehouse, spark)
    for clean, name in ((False, "typed-rows"), (True, "cleaned-rows")):
        warehouse.run_full_etl(rows(spark, [("1", "f1", 30), ("2", "f2", 31)]), TableStore(spark, str(tmp_path / name)), clean=clean)
        columns, limit = found[name]
        assert {"female_id", "male_id", "protocol_id", "outcome_id", "embryo_id"} <= set(columns) and limit == COMPILED
    assert spark.conf.get(METHOD_LIMIT) == default


def test_a_method_limit_of_the_user_stays(spark):
    default = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, "20000")
    try:
        with compiled_methods(spark):
            assert spark.conf.get(METHOD_LIMIT) == "20000"
        assert spark.conf.get(METHOD_LIMIT) == "20000"
    finally:
        spark.conf.unset(METHOD_LIMIT)
    with compiled_methods(spark), compiled_methods(spark):
        assert spark.conf.get(METHOD_LIMIT) == COMPILED
    assert spark.conf.get(METHOD_LIMIT) == default


def test_the_first_row_of_a_key_is_looked_up_only_where_it_has_several(spark, tmp_path):
    distinct = rows(spark, [("1", "f1", 30), ("2", "f2", 31)]).select("female_id", "female_age")
    assert warehouse._first_rows(None, distinct, ["female_id"]) is distinct
    store = TableStore(spark, str(tmp_path))
    first = rows(spark, [("2", "f1", 40), ("1", "f1", 50), ("3", "f2", None), ("4", "f2", 20)])
    summary = {r["table_name"]: (r["processed"], r["inserted"]) for r in warehouse.run_full_etl(first, store, order_by=["case_id"]).collect()}
    assert summary["dim_female"] == (4, 2) and summary["dim_male"] == (1, 1)
    again = warehouse.run_full_etl(rows(spark, [("0", "f1", 60), ("5", "f3", 70), ("6", "f3", 71)]), store, refresh=False, order_by=["case_id"])
    assert {r["table_name"]: (r["processed"], r["inserted"]) for r in again.collect()}["dim_female"] == (3, 1)
    assert {r["female_id"]: r["female_age"] for r in store.read("dim_female").collect()} == {"f1": 50, "f2": None, "f3": 70}


def test_derived_ids_are_looked_up_only_where_the_dimension_has_others(spark, tmp_path, monkeypatch):
    asked, real = [], warehouse.resolve_hashed_ids
    monkeypatch.setattr(warehouse, "resolve_hashed_ids", lambda df, store, reg, dims: asked.extend(dims) or real(df, store, reg, dims))
    store = TableStore(spark, str(tmp_path))
    warehouse.run_full_etl(rows(spark, [("1", "f1", 30)]), store, refresh=False)
    warehouse.run_full_etl(rows(spark, [("2", "f1", 30)]), store, refresh=False)
    assert not asked and store.read("fact_transfer_embryo").join(store.read("dim_embryo"), "embryo_id").count() == 2
    held = store.read("dim_embryo").withColumn("embryo_id", F.lit("E-1"))
    store.replace("dim_embryo", held)
    warehouse.run_full_etl(rows(spark, [("3", "f1", 30)]), store, refresh=False)
    assert asked == ["dim_embryo"]
    new = store.read("fact_transfer").where("case_id = '3'").join(store.read("fact_transfer_embryo"), "transfer_sk")
    assert [r["embryo_id"] for r in new.collect()] == ["E-1"] and store.read("dim_embryo").count() == 1


def test_records_are_typed_as_they_are_parsed(spark, tmp_path):
    landing, schema = tmp_path / "landing", rows(spark, []).schema
    landing.mkdir()
    good = {"case_id": " 1 ", "female_id": "f1", "female_age": "30", "e2_on_trigger": 1.5, "ward": "B"}
    (landing / "a.json").write_text("\n".join([json.dumps(good), "17", '{"case_id":', json.dumps([good | {"case_id": 2}, good | {"case_id": ""}])]) + "\n")
    store = TableStore(spark, str(tmp_path / "star"))
    records = landing_job._records(spark, str(landing), landing_job.new_files(spark, str(landing), store), schema, False)
    assert {f.name: f.dataType for f in schema}.items() <= {f.name: f.dataType for f in records.schema}.items()
    taken = landing_job.run_landing_job(spark, str(landing), store, schema, ["case_id"], "day-1").first()
    assert (taken["staged"], taken["corrupt"], taken["undeclared"]) == (3, 2, ["ward"])
    staged = {r["case_id"]: (r["female_age"], r["e2_on_trigger"], r["source_file"]) for r in store.read(landing_job.STAGING).collect()}
    assert staged == {c: (30, 1.5, "a.json") for c in ("1", "2", None)} and store.read(landing_job.STAGING).columns == [*schema.fieldNames(), "source_file"]


def test_a_stream_is_loaded_by_compiled_code(spark, tmp_path, monkeypatch):
    from starling.streaming import landing_stream
    found = {}
    monkeypatch.setattr(landing_stream, "written", lambda df, name, real=landing_stream.written: (
        found.update({name: df.sparkSession.conf.get(METHOD_LIMIT)}) or real(df, name)))
    rows(spark, [("1", "f1", 30), ("2", "f2", 31)]).write.json(str(tmp_path / "landing"))
    store = stream_star_load(spark, str(tmp_path / "landing"), rows(spark, []).schema, TableStore(spark, str(tmp_path / "star")), ["case_id"],
                             str(tmp_path / "ckpt"), partitioned=False)
    assert found == {"micro-batch": COMPILED} and store.read("fact_ivf_cycle").count() == 2
