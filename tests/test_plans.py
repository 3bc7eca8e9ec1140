"""Plan-shape guards for the scale properties (read from the public ``explain()`` text)."""

import contextlib
import io

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filters_reach_the_parquet_scan(spark):
    plan = _plan(E.queries()["filter_predicates"](spark, SF_SMALL))
    assert "PushedFilters" in plan and "EqualTo(c_mktsegment,BUILDING)" in plan


def test_projection_prunes_scan_columns(spark):
    plan = _plan(E.queries()["build_dimension"](spark, SF_SMALL))
    schema_lines = [l for l in plan.splitlines() if "ReadSchema" in l]
    assert schema_lines and all("c_name" not in l and "c_acctbal" not in l for l in schema_lines)


def test_dashboard_dimension_lookups_are_broadcast(spark):
    df = E.queries()["dashboard_monthly"](spark, SF_SMALL)
    df.collect()  # no hint: the size measured at run time decides
    plan = _plan(df).split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_first_per_key_is_an_aggregate_not_a_window(spark):
    # a hot key is reduced map-side by partial aggregation; a window would move it whole
    plan = _plan(E.queries()["first_per_key"](spark, SF_SMALL))
    assert "Window" not in plan and "partial_min" in plan


def _scans(df) -> int:
    return _plan(df).split("\n\n\n")[0].count("Scan parquet")


def test_null_keys_and_duplicates_read_their_input_once(spark):
    assert _scans(E.queries()["insert_or_ignore"](spark, SF_SMALL)) <= 2
    assert _scans(E.queries()["drop_exact_duplicates"](spark, SF_SMALL)) <= 2
    assert _scans(E.queries()["upsert_last_wins"](spark, SF_SMALL)) <= 3
