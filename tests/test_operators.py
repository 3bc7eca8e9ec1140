"""Operator invariants against plain-Python / numpy brute force on small inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starling.operators import aggregates as A
from starling.operators import clean as C
from starling.operators import keys as K
from starling.operators import load as L
from starling.operators import quality as Q
from starling.operators import windows as W
from tests.conftest import SF_SMALL


def test_row_index_equals_global_row_number(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey",
                                                                   "l_linenumber")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    got = K.row_index(li, order, "rn", start=1, num_partitions=7)
    want = li.withColumn("rn", F.row_number().over(Window.orderBy(*order)).cast("long"))
    # duplicate rows exist, so compare the multisets of (order key..., rn)
    assert sorted(tuple(r) for r in got.select(*order, "rn").collect()) == \
        sorted(tuple(r) for r in want.select(*order, "rn").collect())
    ids = sorted(r["rn"] for r in got.select("rn").collect())
    assert ids == list(range(1, len(ids) + 1))


def test_exact_percentiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = [float(x) for x in rng.normal(100, 30, 997)] + [None] * 13
    ints = [int(x) for x in rng.integers(0, 50, 1010)]
    df = spark.createDataFrame(list(zip(vals, ints)), "x double, y long")
    got = A.exact_percentiles(df, ["x", "y"], [0.0, 0.01, 0.5, 0.99, 1.0])
    xs = np.array([v for v in vals if v is not None])
    assert got["x"] == pytest.approx(list(np.quantile(xs, [0.0, 0.01, 0.5, 0.99, 1.0])), rel=1e-12)
    assert got["y"] == pytest.approx(list(np.quantile(np.array(ints), [0.0, 0.01, 0.5, 0.99, 1.0])), rel=1e-12)


def _greedy(rows, key_sets):
    taken = [set() for _ in key_sets]
    kept = []
    for r in sorted(rows, key=lambda r: r["ord"]):
        ks = [tuple(r[k] for k in s) for s in key_sets]
        if any(None not in k and k in taken[i] for i, k in enumerate(ks)):
            continue
        kept.append(r["ord"])
        for i, k in enumerate(ks):
            if None not in k:
                taken[i].add(k)
    return sorted(kept)


def test_insert_or_ignore_multi_reference_fixture(spark):
    # rows in order (p1,n1), (p2,n1), (p2,n2): greedy keeps rows 1 and 3
    df = spark.createDataFrame([(1, "p1", "n1"), (2, "p2", "n1"), (3, "p2", "n2")], "ord long, pk string, nk string")
    out = L.insert_or_ignore_multi(None, df, [["pk"], ["nk"]], "ord")
    assert sorted(r["ord"] for r in out.collect()) == [1, 3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_insert_or_ignore_multi_equals_sequential_greedy(spark, seed):
    rnd = random.Random(seed)
    rows = [{"ord": i, "a": rnd.randint(0, 40), "b": rnd.choice([None] + list(range(30)))} for i in range(300)]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(r["ord"], r["a"], r["b"]) for r in rows], "ord long, a long, b long")
    got = sorted(r["ord"] for r in L.insert_or_ignore_multi(None, df, [["a"], ["b"]], "ord").collect())
    assert got == _greedy(rows, [["a"], ["b"]])


def test_insert_or_ignore_multi_on_orders_equals_greedy(spark):
    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority",
                                                                "o_orderdate", "o_orderstatus")
    keys = [["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderstatus"]]
    got = sorted(r["o_orderkey"] for r in L.insert_or_ignore_multi(None, o, keys, "o_orderkey").collect())
    rows = [dict(r.asDict(), ord=r["o_orderkey"]) for r in o.collect()]
    assert got == _greedy(rows, keys)


def test_insert_or_ignore_null_keys_never_conflict(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v long")
    batch = spark.createDataFrame([("a", 2), ("b", 3), ("b", 4), (None, 5), (None, 6)], "k string, v long")
    out = {(r["k"], r["v"]) for r in L.insert_or_ignore(target, batch, ["k"], ["v"]).collect()}
    assert out == {("b", 3), (None, 5), (None, 6)}


def test_upsert_last_wins(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    batch = spark.createDataFrame([("b", 5), ("b", 7), ("c", 1)], "k string, v long")
    out = {(r["k"], r["v"]) for r in L.upsert_last_wins(target, batch, ["k"], ["v"]).collect()}
    assert out == {("a", 1), ("b", 7), ("c", 1)}


def test_first_and_latest_per_key_with_hot_key(spark):
    # one key holds most rows: min/max(struct) is combined map-side, result as brute force
    rows = [(0 if i % 3 else i % 7, i, f"x{i}") for i in range(2000)]
    df = spark.createDataFrame(rows, "k long, o long, s string").repartition(8)
    first = {r["k"]: r["o"] for r in W.first_per_key(df, ["k"], ["o"]).collect()}
    last = {r["k"]: r["o"] for r in W.latest_per_key(df, ["k"], ["o"]).collect()}
    want_first, want_last = {}, {}
    for k, o, _ in rows:
        want_first[k] = min(want_first.get(k, o), o)
        want_last[k] = max(want_last.get(k, o), o)
    assert first == want_first and last == want_last


def test_assign_incremental_keys_null_safe(spark):
    b1 = spark.createDataFrame([("x", "r1"), ("x", None), ("y", "r2")], "name string, rec string")
    mapped1, dim1 = K.assign_incremental_keys(b1, None, ["name", "rec"], "id")
    assert sorted((r["id"], r["name"], r["rec"]) for r in dim1.collect()) == \
        [(1, "x", None), (2, "x", "r1"), (3, "y", "r2")]
    b2 = spark.createDataFrame([("x", None), ("z", "r9")], "name string, rec string")
    mapped2, new2 = K.assign_incremental_keys(b2, dim1, ["name", "rec"], "id")
    assert [tuple(r) for r in new2.select("id", "name", "rec").collect()] == [(4, "z", "r9")]
    assert {(r["name"], r["id"]) for r in mapped2.collect()} == {("x", 1), ("z", 4)}


def test_fill_missing_ids_deterministic(spark):
    df = spark.createDataFrame([("1", None), ("2", " "), ("3", "keep")], "case_id string, fid string")
    a = {r["case_id"]: r["fid"] for r in K.fill_missing_ids(df, "fid", "f", ["case_id"]).collect()}
    b = {r["case_id"]: r["fid"] for r in K.fill_missing_ids(df, "fid", "f", ["case_id"]).collect()}
    assert a == b and a["3"] == "keep" and a["1"].startswith("f_") and len(a["1"]) == 34


def test_cleaning_helpers(spark):
    df = spark.createDataFrame([(" 12.7 ", "2023-03-07", "\tx "), ("n/a", "bad", None), ("", None, "")],
                               "n string, d string, s string")
    out = C.coerce_numeric(df, ["n"], "int")
    assert [r["n"] for r in out.collect()] == [12, None, None]
    out = C.parse_date_coerce(df, ["d"])
    assert [r["d"] for r in out.collect()] == ["2023-03-07", None, None]
    assert [r["s"] for r in C.trim_strings(df).collect()] == ["x", None, ""]
    m = C.map_values(spark.createDataFrame([("High",), ("Medium",), (None,), ("Odd",)], "risk string"),
                     "risk", {"High": 90, "Medium": 45, "Low": 30}, 30, out_col="days")
    assert [r["days"] for r in m.collect()] == [90, 45, 30, 30]


def test_quality_checks_and_repairs(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 99), (4, 99)], "id long, fk long")
    parent = spark.createDataFrame([(10,), (11,), (None,)], "pk long")
    assert Q.fk_orphan_count(child, "fk", parent, "pk").first()[0] == 2
    assert A.duplicate_count(child).first()[0] == 1
    nulled = {(r["id"], r["fk"]) for r in Q.repair_orphan_fk_to_null(child, "fk", parent, "pk").collect()}
    assert nulled == {(1, 10), (2, 11), (3, None), (4, None)}
    kept = sorted(r["id"] for r in Q.repair_delete_orphans(child, "fk", parent, "pk").collect())
    assert kept == [1, 2, 3]
    assert Q.repair_fk_to_min(child, "fk", parent, "pk").where("id = 4").first()["fk"] == 10
    placeholders = Q.repair_placeholder_parents(parent, child, "fk", "pk")
    assert sorted(r["pk"] for r in placeholders.where("pk is not null").collect()) == [10, 11, 99]
    desc = Q.schema_describe(child, "child").collect()
    assert [(r["cid"], r["column_name"], r["data_type"]) for r in desc] == [(0, "id", "bigint"), (1, "fk", "bigint")]


def test_exact_percentiles_with_hot_value(spark):
    # one value holds a third of all rows: it is counted once, never shuffled as raw rows
    rng = np.random.default_rng(11)
    vals = [0.0] * 700 + [float(x) for x in rng.uniform(-5, 5, 1400)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(8)
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    assert A.exact_percentiles(df, ["x"], probs)["x"] == pytest.approx(list(np.quantile(np.array(vals), probs)),
                                                                         rel=1e-12, abs=1e-12)


def test_row_index_with_hot_order_key(spark):
    # 1/3 of the rows share one order value: ids stay dense 1..n and respect the order
    rows = [(0 if i % 3 == 0 else i, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, payload long")
    out = sorted((r["rn"], r["k"]) for r in K.row_index(df, ["k"], "rn", num_partitions=6).collect())
    assert [r for r, _ in out] == list(range(1, 3001))
    assert [k for _, k in out] == sorted(k for k, _ in rows)


def test_values_that_used_to_be_lost(spark):
    from starling.functions.exprs import natural_key_text, try_date, try_integer
    from starling.operators.aggregates import mean_impute
    from starling.operators.clean import fill_numeric_median
    row = spark.createDataFrame([("9007199254740993", "12.7", "x")], "a string, b string, c string").select(
        try_integer("a", "bigint").alias("a"), try_integer("b").alias("b"), try_integer("c").alias("c")).first()
    assert tuple(row) == (9007199254740993, 12, None)
    texts = ["2025-11-27T09:35:26.909941", "2025-11-27 09:35:26.5", "2025-11-27T23:59:59Z", "20251127", "2025/11/27",
             "11/27/2025", " 2025-11-27 ", "27.11.2025", "20251399", "", None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
           .orderBy("i").select(try_date("t").cast("string")).collect()]
    assert got == ["2025-11-27"] * 7 + [None] * 4
    keys = [("a|b", "c"), ("a", "b|c"), (None, "c"), ("<null>", "c"), ("", "c"), ("0:", "c")]
    made = [r[0] for r in spark.createDataFrame(keys, "a string, b string").select(natural_key_text("a", "b")).collect()]
    assert len(set(made)) == 5 and made[2] == made[4]  # NULL and blank are one value
    whole = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    assert [r[0] for r in mean_impute(whole, ["v"]).collect()] == [1.0, 2.0, 1.5]
    assert [r[0] for r in fill_numeric_median(whole, ["v"]).collect()] == [1.0, 2.0, 1.5]
    nan = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")
    assert [r[0] for r in fill_numeric_median(nan, ["v"]).collect()] == [1.0, 2.0, 3.0]


def test_null_keys_keep_every_copy(spark):
    from starling.operators.windows import first_per_key
    rows = [(1, "b"), (1, "a"), (None, "x"), (None, "x"), (None, "y")]
    got = first_per_key(spark.createDataFrame(rows, "k int, v string").repartition(3), ["k"], ["v"], null_keys_distinct=True)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, "a"), (None, "x"), (None, "x"), (None, "y")]))
