"""Plan assertions: native expressions only (no Python evaluation), filters
pushed into the scan, no cartesian products."""

import pytest

import __spark_entry__ as E

KEYS = ["fingerprint_localize", "aggregate_parity", "rowcount_parity", "merge_apply", "fk_orphan",
        "call_driver_regex", "repeat_contact_window", "first_contact_resolution", "client_executive_summary",
        "scd2_build", "decimal_roundtrip", "epoch_conversion", "cross_join", "program_margin", "left_join_true", "shrinkage_analysis",
        "approx_distinct", "multi_count_distinct", "lag_gap", "version_sort", "nearest_rank_pct", "upsert_split", "name_set_diff"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_python_and_no_cartesian(spark, sf0001, key):
    p = _plan(E.queries()[key](spark, sf0001))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "FlatMapGroupsInPandas", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{key}: {bad}"


@pytest.mark.parametrize("key", ["approx_distinct", "multi_count_distinct", "shrinkage_analysis"])
def test_no_row_is_expanded_per_counted_column(spark, sf0001, key):
    assert "Expand" not in _plan(E.queries()[key](spark, sf0001))


def test_rows_are_hashed_after_the_bucket_join(spark, sf0001):
    """Localisation: below the semi-join on bad buckets only the key is hashed, the row hash stands above it."""
    p = _plan(E.queries()["fingerprint_localize"](spark, sf0001))
    per_key = p[:p.index("LeftSemi")]
    assert "md5(concat_ws" in per_key.replace("md5(cast(concat_ws", "md5(concat_ws")


def test_scans_per_view(spark, sf0001):
    for key, table, most in (("agent_scorecard", "lineitem", 2), ("attrition_risk", "orders", 2)):
        p = _plan(E.queries()[key](spark, sf0001))
        assert p.count(f"{table}.parquet") <= most, key


def test_filter_pushed_to_scan(spark, sf0001):
    p = _plan(E.queries()["elt_project_filter"](spark, sf0001))
    assert "PushedFilters" in p
    p = _plan(E.queries()["first_contact_resolution"](spark, sf0001))
    assert "EqualTo(o_orderstatus,F)" in p


def test_column_pruning(spark, sf0001):
    p = _plan(E.queries()["rowcount_parity"](spark, sf0001))
    assert "ReadSchema: struct<>" in p or "ReadSchema: struct<o_orderstatus" in p
