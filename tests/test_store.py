"""Commits of the table store: snapshots, appends, transactions, partitions, the batch ledger."""

import pytest
from pyspark.sql import functions as F

from starling.sources.store import TableStore


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def months(spark, rows):
    return spark.createDataFrame(rows, "id long, month string")


def test_append_is_published_and_readers_keep_what_they_opened(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    store.replace("t", spark.range(3))
    opened = store.read("t")
    other = TableStore(spark, tmp_root + "/wh")
    assert ids(other.read("t")) == [0, 1, 2]
    store.append("t", spark.range(10, 12))
    assert ids(opened) == [0, 1, 2] and ids(other.read("t")) == [0, 1, 2]
    other.refresh_log()
    assert ids(other.read("t")) == ids(store.read("t")) == [0, 1, 2, 10, 11]
    store.compact("t")
    assert len(store.folders("t")) == 1 and ids(store.read("t")) == [0, 1, 2, 10, 11]


def test_a_failed_write_publishes_nothing(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    store.replace("t", spark.range(3))
    broken = spark.range(5).withColumn("id", F.expr("if(id = 4, raise_error('stop'), id)"))
    with pytest.raises(Exception, match="stop"):
        store.append("t", broken)
    assert ids(store.read("t")) == ids(TableStore(spark, tmp_root + "/wh").read("t")) == [0, 1, 2]


def test_a_transaction_publishes_all_or_nothing(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    store.replace("a", spark.range(2))
    with pytest.raises(RuntimeError), store.transaction():
        store.append("a", spark.range(5, 6))
        store.replace("b", spark.range(1))
        store.mark_batch("s", 0)
        assert ids(store.read("a")) == [0, 1, 5] and store.exists("b")
        raise RuntimeError
    assert ids(store.read("a")) == [0, 1] and not store.exists("b") and not store.has_batch("s", 0)
    with store.transaction():
        store.append("a", spark.range(5, 6))
        store.mark_batch("s", 3)
        assert ids(TableStore(spark, tmp_root + "/wh").read("a")) == [0, 1]
    again = TableStore(spark, tmp_root + "/wh")
    assert ids(again.read("a")) == [0, 1, 5]
    assert again.has_batch("s", 3) and again.has_batch("s", 2) and not again.has_batch("s", 4) and not again.has_batch("r", 0)


def test_partitions_are_replaced_alone(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    store.replace("f", months(spark, [(1, "2024-01"), (2, "2024-02"), (3, None), (4, "2024-02")]), partition_by="month")
    before = set(store.folders("f"))
    assert dict(store.read("f").dtypes)["month"] == "string"
    store.replace_partitions("f", months(spark, [(20, "2024-02"), (30, None)]), "month", ["2024-02", None, "2024-03"])
    assert {(r["id"], r["month"]) for r in store.read("f").collect()} == {(1, "2024-01"), (20, "2024-02"), (30, None)}
    kept = before & set(store.folders("f"))
    assert len(kept) == 1 and "month=2024-01" in kept.pop()
    store.append("f", months(spark, [(5, "2024-01")]))
    store.replace_partitions("f", months(spark, []), "month", ["2024-02"])
    assert {(r["id"], r["month"]) for r in TableStore(spark, tmp_root + "/wh").read("f").collect()} == {(1, "2024-01"), (5, "2024-01"), (30, None)}
    with pytest.raises(ValueError):
        store.replace_partitions("f", months(spark, [(9, "2024-09")]), "month", ["2024-01"])
    with pytest.raises(ValueError):
        store.replace_partitions("f", months(spark, []), "month", ["a/b"])
    store.compact("f")
    assert ids(store.read("f")) == [1, 5, 30]
    plan = store.read("f").where("month = '2024-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_empty_tables(spark, tmp_root):
    store = TableStore(spark, tmp_root + "/wh")
    store.replace("f", months(spark, []), partition_by="month")
    assert store.exists("f") and store.read("f").count() == 0
    store.append("f", months(spark, [(1, "2024-01")]), partition_by="month")
    assert store.partition_of("f") == "month" and ids(store.read("f")) == [1]
    with pytest.raises(KeyError):
        store.read("nothing")
