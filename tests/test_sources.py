"""Versioned store, landing-zone naming rules, streaming = batch."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.registry import clinic_registry
from starling.sources.landing import landing_counts, read_json_landing, staging_refresh, landing_schema, staging_schema, type_landing
from starling.sources.store import TableStore
from starling.streaming.landing_stream import stream_landing_ingest


def test_store_replace_from_itself_and_append(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    df = spark.range(10).withColumnRenamed("id", "x")
    store.replace("t", df)
    store.replace("t", store.read("t").where("x % 2 = 0"))       # read and rewrite the same table
    assert sorted(r["x"] for r in store.read("t").collect()) == [0, 2, 4, 6, 8]
    store.append("t", spark.range(100, 102).withColumnRenamed("id", "x"))
    assert store.read("t").count() == 7
    # a new store object on the same root sees the same current versions
    assert TableStore(spark, tmp_root + "/wh").read("t").count() == 7


def test_create_star_tables(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    reg = clinic_registry()
    assert sorted(store.create_all(reg, refresh=True)) == sorted(reg.names())
    assert store.create_all(reg, refresh=False) == []
    for spec in reg:
        t = store.read(spec.name)
        assert t.count() == 0 and t.schema == spec.schema


def _write(folder, name, obj):
    with open(os.path.join(folder, name), "w") as f:
        json.dump(obj, f, indent=4)


def test_landing_file_name_dates_and_typing(spark, tmp_root):
    landing = tmp_root + "/landing"
    os.makedirs(landing)
    # ISO date in the name: the 8-character slice is '2025-11-', never the run date
    _write(landing, "0912_2025-11-27T09-35-26.909941.json", {"patient_id": "0912", "female_age": "31"})
    # template with typed numbers and an unknown key; the name slice is '2025'
    _write(landing, "1234_2025.json", {"female_id": "1234", "female_age": 30, "outcome_id": "x"})
    # a form submission of the run date: blanks become NULL, patient_id -> female_id
    _write(landing, "134_20251127101948.json", {"patient_id": "134", "case_id": "C-134", "female_age": "33",
                                                "female_bmi": " 24.5 ", "afc": "", "male_factor": ""})
    _write(landing, "notes.txt", {"ignored": True})
    typed = staging_schema()
    raw = read_json_landing(spark, landing, landing_schema(typed), "20251127")
    rows = type_landing(raw, typed).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["female_id"], r["case_id"], r["female_age"], r["female_bmi"], r["afc"], r["male_factor"]) == \
        ("134", "C-134", 33, 24.5, None, None)
    staged = staging_refresh(spark, landing, tmp_root + "/staging", "20251127")
    assert staged.count() == 1 and staged.first()["load_date"] == "20251127"
    staged = staging_refresh(spark, landing, tmp_root + "/staging", "20251127")   # re-run: same day replaced
    assert spark.read.parquet(tmp_root + "/staging").count() == 1


def test_stream_ingest_equals_batch(spark, tmp_root):
    landing = tmp_root + "/landing"
    os.makedirs(landing)
    for i in range(6):
        _write(landing, f"{i}_20240101.json", {"case_id": f"c{i}", "female_age": str(20 + i),
                                               "female_id": None if i == 3 else f"f{i}"})
    typed = T.StructType([T.StructField("case_id", T.StringType()), T.StructField("female_id", T.StringType()),
                          T.StructField("female_age", T.IntegerType())])
    out = stream_landing_ingest(spark, landing, typed, tmp_root + "/staging", tmp_root + "/ckpt",
                                required=["female_id"], quarantine=tmp_root + "/quarantine", multiline=True,
                                partitioned=False)
    batch = type_landing(read_json_landing(spark, landing, landing_schema(typed, ()), None), typed, {})
    want = sorted((r["case_id"], r["female_age"]) for r in batch.where(F.col("female_id").isNotNull()).collect())
    assert sorted((r["case_id"], r["female_age"]) for r in out.collect()) == want
    assert spark.read.parquet(tmp_root + "/quarantine").count() == 1
    # running again processes nothing new (checkpointed file source)
    again = stream_landing_ingest(spark, landing, typed, tmp_root + "/staging", tmp_root + "/ckpt",
                                  required=["female_id"], multiline=True, partitioned=False)
    assert again.count() == len(want)


def test_corrupt_records_and_undeclared_keys_are_kept_and_counted(spark, tmp_root):
    landing = tmp_root + "/landing"
    os.makedirs(landing)
    _write(landing, "1_20240101.json", {"case_id": "c1", "female_id": "f1", "outcome_id": "x"})
    _write(landing, "2_20240101.json", {"case_id": "c2", "female_id": "f2", "outcome_id": "y", "note": {"a": 1}})
    with open(landing + "/3_20240101.json", "w") as f:
        f.write('{"case_id": "c3", "female_id": "f')
    raw = read_json_landing(spark, landing, landing_schema(staging_schema()), "20240101")
    assert [r["source_file"] for r in raw.where("_corrupt_record IS NOT NULL").collect()] == ["3_20240101.json"]
    staged = staging_refresh(spark, landing, tmp_root + "/staging", "20240101")
    assert sorted(r["case_id"] for r in staged.collect()) == ["c1", "c2"]
    counts = landing_counts(spark, landing, landing_schema(staging_schema()), "20240101").collect()
    assert {(r["problem"], r["key"]): r["n"] for r in counts} == {
        ("corrupt_record", None): 1, ("undeclared_key", "outcome_id"): 2, ("undeclared_key", "note"): 1}
    typed = T.StructType([T.StructField("case_id", T.StringType()), T.StructField("female_id", T.StringType())])
    out = stream_landing_ingest(spark, landing, typed, tmp_root + "/stream", tmp_root + "/ckpt", multiline=True, partitioned=False)
    assert sorted(r["case_id"] for r in out.collect()) == ["c1", "c2"]
    for kept in ("/staging_quarantine", "/stream_quarantine"):
        row, = spark.read.parquet(tmp_root + kept).collect()
        assert (row["source_file"], row["reject_reason"]) == ("3_20240101.json", "corrupt_record")
        assert row["_corrupt_record"].startswith('{"case_id": "c3"')


def test_stream_incremental_load_is_idempotent(spark, tmp_root):
    from starling.streaming.landing_stream import stream_incremental_load
    landing = tmp_root + "/landing"
    os.makedirs(landing)
    for i in range(8):
        # case c1 arrives twice: first submission wins, later copies are ignored
        _write(landing, f"{i}_20240101.json", {"case_id": f"c{i % 5}", "female_age": str(20 + i)})
    typed = T.StructType([T.StructField("case_id", T.StringType()), T.StructField("female_age", T.IntegerType())])
    store = TableStore(spark, tmp_root + "/wh")
    out = stream_incremental_load(spark, landing, typed, store, "cases", ["case_id"], ["female_age"],
                                  tmp_root + "/ckpt", max_files_per_trigger=2, multiline=True, partitioned=False)
    assert out.count() == 5 and out.select("case_id").distinct().count() == 5
    # a new file for a known case and one for a new case: only the new case is added
    _write(landing, "9_20240102.json", {"case_id": "c2", "female_age": "99"})
    _write(landing, "10_20240102.json", {"case_id": "c7", "female_age": "40"})
    out = stream_incremental_load(spark, landing, typed, store, "cases", ["case_id"], ["female_age"],
                                  tmp_root + "/ckpt", max_files_per_trigger=2, multiline=True, partitioned=False)
    assert sorted(r["case_id"] for r in out.collect()) == ["c0", "c1", "c2", "c3", "c4", "c7"]
    assert out.where("case_id = 'c2'").first()["female_age"] != 99


def test_read_files_glob_mixes_csv_and_parquet(spark, tmp_root):
    import pytest
    from starling.sources.files import NoInputFilesError, read_files_glob
    folder = tmp_root + "/in"
    os.makedirs(folder)
    with open(os.path.join(folder, "part1.csv"), "w") as f:
        f.write(" a , b \n1,x\n2,y\n")                       # header names padded with spaces
    with open(os.path.join(folder, "notes.txt"), "w") as f:
        f.write("not data\n")
    spark.createDataFrame([("3", "z")], "a string, c string").write.parquet(folder + "/part2.parquet")
    out = read_files_glob(spark, folder + "/*")
    assert sorted(out.columns) == ["a", "b", "c"]
    assert sorted((r["a"], r["b"], r["c"]) for r in out.collect()) == [("1", "x", None), ("2", "y", None),
                                                                        ("3", None, "z")]
    with pytest.raises(NoInputFilesError):
        read_files_glob(spark, tmp_root + "/nothing-here/*")


def test_read_files_glob_goes_by_each_files_header(spark, tmp_root):
    import os
    import pytest
    from starling.sources.files import NoInputFilesError, read_files_glob
    with open(os.path.join(tmp_root, "a.csv"), "w") as f:
        f.write("case_id,female_age\n1,30\n")
    with open(os.path.join(tmp_root, "b c.csv"), "w") as f:
        f.write("\nfemale_age, case_id ,extra\n41,2,x\n")
    got = {r["case_id"]: (r["female_age"], r["extra"]) for r in read_files_glob(spark, tmp_root).collect()}
    assert got == {"1": ("30", None), "2": ("41", "x")}
    typed = read_files_glob(spark, tmp_root, csv_schema=T.StructType.fromDDL("female_age int, case_id long"))
    assert dict(typed.dtypes) == {"case_id": "bigint", "female_age": "int", "extra": "string"}
    with pytest.raises(NoInputFilesError):
        read_files_glob(spark, [tmp_root, os.path.join(tmp_root, "missing.parquet")])


def test_unreadable_files_are_reported_beside_the_good_ones(spark, tmp_root):
    from starling.sources.files import NoInputFilesError, files_report, read_files_glob
    folder = os.path.join(tmp_root, "with space")
    spark.range(3).write.parquet(os.path.join(folder, "good"))
    spark.range(0).write.parquet(os.path.join(folder, "none"))
    os.makedirs(os.path.join(folder, "other"))
    good = next(f for f in os.listdir(os.path.join(folder, "good")) if f.endswith(".parquet"))
    with open(os.path.join(folder, "good", good), "rb") as f:
        whole = f.read()
    for name, content in (("cut.parquet", whole[:len(whole) // 2]), ("a.csv", b"id\n7\n8\n"), ("b.csv", b""), ("c.txt", b"x")):
        with open(os.path.join(folder, "other", name), "wb") as f:
            f.write(content)
    paths = os.path.join(folder, "*")
    rows = files_report(spark, paths).collect()
    by_name = {r["file"].rsplit("/", 1)[1]: (r["format"], r["status"], r["rows"]) for r in rows if "/other/" in r["file"]}
    assert by_name == {"cut.parquet": ("parquet", "unreadable", 0), "a.csv": ("csv", "loaded", 2), "b.csv": ("csv", "empty", 0),
                       "c.txt": (None, "skipped", 0)}
    assert [r["error"] is not None for r in rows].count(True) == 1
    assert sum(r["rows"] for r in rows if "/good/" in r["file"]) == 3
    assert all(r["status"] == "loaded" and r["rows"] == 0 for r in rows if "/none/" in r["file"])
    assert sorted(str(r["id"]) for r in read_files_glob(spark, paths, bad_files="skip").collect()) == ["0", "1", "2", "7", "8"]
    with pytest.raises(Exception):
        read_files_glob(spark, paths).collect()
    with pytest.raises(NoInputFilesError):
        read_files_glob(spark, os.path.join(folder, "other", "cut.parquet"), bad_files="skip")
    with pytest.raises(NoInputFilesError):
        files_report(spark, os.path.join(folder, "nothing-here"))
