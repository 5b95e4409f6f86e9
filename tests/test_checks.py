"""Encoding, SCD-2, merge, foreign-key, transform and schema checks on the
small fixtures: golden must pass, twins must fail for the stated reason."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from paritylake.operators import encoding as E
from paritylake.operators import fk as FK
from paritylake.operators import merge as M
from paritylake.operators import scd2 as S
from paritylake.operators import transform as TR
from paritylake.operators.schema import ColumnSpec, logical_type, nested_signature, schema_conformance


def test_epoch_lying_column_and_wrong_unit(spark):
    ms = [(1, 1704067200123), (2, 1719792000000), (3, None)]
    src = spark.createDataFrame(ms, "id long, issued_sec long")
    tgt = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 0)), (2, dt.datetime(2024, 7, 1)), (3, None)],
                                "id long, issued_ts timestamp")
    ok = {r["class"]: r["n"] for r in E.epoch_conversion(src, tgt, "id", "issued_sec", "issued_ts", "millis",
                                                         (2000, 2030))[1].collect()}
    assert ok == {"matched": 2, "null_ok": 1}
    bad = {r["class"] for r in E.epoch_conversion(src, tgt, "id", "issued_sec", "issued_ts", "seconds",
                                                  (2000, 2030))[1].collect()}
    assert "not_nulled" in bad                         # read as seconds: years near 56000


def test_epoch_quarantine_edge_rows(spark):
    df = spark.createDataFrame([(1, 1704067200000), (2, 10 ** 17), (3, -86400000)], "id long, raw long")
    clean, audit = E.epoch_quarantine(df, "raw", "millis", "id", "ods_epoch_edge", out_col="ts")
    assert [r["ts"] is None for r in clean.orderBy("id").collect()] == [False, True, True]
    assert sorted((r["row_id"], r["reason"]) for r in audit.collect()) == [
        (2, "after_sane_range"), (3, "before_sane_range")]


def test_epoch_audit_coverage(spark):
    src = spark.createDataFrame([(1, 1704067200000), (2, 10 ** 17)], "id long, raw long")
    clean, audit = E.epoch_quarantine(src, "raw", "millis", "id", "edge", out_col="ts")
    classes = E.epoch_classes(src, clean, "id", "raw", "ts", "millis", (2000, 2030))
    assert E.audit_coverage(classes, audit, "edge", "raw").first()["status"] == "PASS"
    assert E.audit_coverage(classes, audit.limit(0), "edge", "raw").first()["status"] == "FAIL"


def test_decimal_roundtrip(spark):
    s = spark.createDataFrame([(1, Decimal("1.50")), (2, Decimal("2.00")), (3, Decimal("3.00"))], "k long, a decimal(12,2)")
    t = spark.createDataFrame([(1, Decimal("1.5000")), (2, Decimal("2.0100"))], "k long, a decimal(12,4)")
    bad, _ = E.decimal_roundtrip(s, t, "k", ["a"])
    assert sorted(r["k"] for r in bad.collect()) == [2, 3]


def _scd(spark, rows):
    return spark.createDataFrame(rows, "k long, eff_from timestamp, eff_to timestamp, is_current boolean, "
                                       "name string, row_hash string")


def _h(k, name):
    import hashlib
    return hashlib.md5(f"{k}|{name}".encode()).hexdigest()


T0, T1, T2, END = (dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1),
                   dt.datetime(9999, 12, 31))


def test_scd2_golden_and_twin(spark):
    good = _scd(spark, [(1, T0, T1, False, "a", _h(1, "a")), (1, T1, END, True, "b", _h(1, "b")),
                        (2, T0, END, True, "c", _h(2, "c"))])
    v, c = S.scd2_continuity(good, "k", hash_col="row_hash", hash_cols=["k", "name"])
    assert v.count() == 0
    bad = _scd(spark, [(1, T0, T2, True, "a", _h(1, "a")), (1, T1, END, True, "b", _h(1, "b")),
                       (2, T0, END, True, "c", "0" * 32)])
    rules = {r["rule"] for r in S.scd2_continuity(bad, "k", hash_col="row_hash", hash_cols=["k", "name"])[0].collect()}
    assert rules == {"gap_or_overlap", "current_not_terminal", "current_count", "hash_mismatch"}


def test_scd2_build_collapses_equal_neighbours(spark):
    ch = spark.createDataFrame([(1, T0, 1, "a"), (1, T1, 2, "a"), (1, T2, 3, "b")],
                               "k long, ts timestamp, id long, attr string")
    v = S.scd2_build(ch, "k", "ts", ["attr"], tie="id").orderBy("eff_from").collect()
    assert [(r["attr"], r["eff_to"], r["is_current"]) for r in v] == [("a", T2, False), ("b", END, True)]


MT = "invoice_id long, contact_id long, amount decimal(12,2)"


def test_merge_fold_and_idempotency(spark):
    t = spark.createDataFrame([(i, 10 + i, Decimal(i)) for i in range(1, 6)], MT)
    d = spark.createDataFrame([(2, 12, Decimal("20.00"), "U", 1), (9, 19, Decimal("9.00"), "I", 2),
                               (3, 13, Decimal("3.00"), "D", 3)], MT + ", op string, change_ms long")
    out = M.merge_apply(t, M.delta_latest(d, ["invoice_id"], ["change_ms"]), ["invoice_id"])
    assert out.count() == 5
    assert {r["invoice_id"]: r["_action"] for r in out.collect()}[9] == "insert"
    ok = {r["target"]: r["status"] for r in M.merge_idempotency(t, d, ["invoice_id"]).collect()}
    assert set(ok.values()) == {"PASS"}
    twin = M.merge_idempotency(t, d, ["invoice_id"], merge_fn=lambda a, b: M.append_merge(a, b, ["invoice_id"]))
    assert {r["status"] for r in twin.collect()} == {"FAIL"}


def test_fk_orphan_rate_and_cap(spark):
    child = spark.createDataFrame([(i, i % 4) for i in range(7)] + [(7, 99)], "id long, contact long")
    parent = spark.createDataFrame([(0,), (1,), (2,), (3,), (3,)], "contact long")
    r = FK.fk_orphan("fact->dim", child, parent, child, parent, "contact", "contact").first()
    assert (r["src_orphans"], r["src_rate_pct"], r["status"]) == (1, 12.5, "PASS")
    capped = FK.fk_orphan("fact->dim", child, parent, child, parent, "contact", "contact", max_rate=0.0)
    assert capped.first()["status"] == "FAIL"


def test_expect_rows_and_properties(spark):
    exp = spark.createDataFrame([(1, "I"), (2, "U")], "id long, op string")
    act = spark.createDataFrame([(1, "I", 5), (2, "U", 6)], "id long, op string, extra long")
    miss, unexp = TR.expect_rows(act, exp)
    assert miss.count() == 0 and unexp.count() == 0
    buggy = act.unionByName(spark.createDataFrame([(3, "D", 7)], "id long, op string, extra long"))
    assert TR.expect_rows(buggy, exp)[1].count() == 1
    props = {r["target"]: r["status"] for r in TR.assert_properties(
        spark.createDataFrame([(1, None), (1, None)], "a long, b long"), "t", rowcount=2, unique=["a", "b"],
        no_nulls=["b"]).collect()}
    assert props == {"t:rowcount": "PASS", "t:unique(a,b)": "FAIL", "t:no_nulls(b)": "FAIL"}


def test_transform_diff_compares_both_column_sets(spark):
    a = spark.sql("SELECT 'F' AS s, 1 AS n")
    b = spark.sql("SELECT 'F' AS S, 1 AS N, 'x' AS extra")
    assert TR.transform_diff(a, b).count() == 2


def test_schema_types_and_twin(spark):
    assert logical_type("decimal(12,2)") == ("NUMERIC", 2)
    assert logical_type("INT") == ("INT64", None)
    assert nested_signature("array<struct<Name:string,level:bigint>>") == "ARRAY<STRUCT<name:STRING,level:INT64>>"
    df = spark.createDataFrame([(1, Decimal("1.50"), None)], "id long, amt decimal(12,2), note string")
    specs = [ColumnSpec("id", "int64", False), ColumnSpec("amt", "numeric(12,1)", False),
             ColumnSpec("note", "string", False), ColumnSpec("missing", "string")]
    got = {r["target"]: r["status"] for r in schema_conformance(spark, df, "t", specs).collect()}
    assert got["t.id:type"] == "PASS"
    assert got["t.amt:type"] == "FAIL"                # declared scale 1, table scale 2
    assert got["t.amt:scale_on_data"] == "PASS"       # 1.50 uses one decimal place
    assert got["t.note:not_null_on_data"] == "FAIL"
    assert got["t.missing:exists"] == "FAIL"


def test_perf_conditions(spark):
    from paritylake.operators.reporting import perf_assert, perf_compare
    stats = spark.createDataFrame([("a", "t", 10.0, 20.0, 30.0, 1.0), ("b", "t", 5.0, 6.0, 7.0, 2.0)],
                                  "query_id string, metric string, p50 double, p95 double, max double, min double")
    pairs = spark.createDataFrame([(op, "a", "b", "t", op, 0.5) for op in ("<=", "<", ">=", ">", "!=", "report")],
                                  "name string, a string, b string, metric string, op string, k double")
    got = {r["target"]: r["status"] for r in perf_compare(stats, pairs).collect()}
    assert got == {"compare:<=": "PASS", "compare:<": "FAIL", "compare:>=": "PASS", "compare:>": "FAIL", "compare:!=": "ERROR", "compare:report": "PASS"}
    thr = spark.createDataFrame([("a", "t", 10.0, s) for s in ("p50", "p95", "max", "min", "p42")], "query_id string, metric string, threshold double, stat string")
    got = {r["target"]: r["status"] for r in perf_assert(stats, thr).collect()}
    assert got == {"assert:a:t:p50": "PASS", "assert:a:t": "FAIL", "assert:a:t:max": "FAIL", "assert:a:t:min": "PASS", "assert:a:t:p42": "ERROR"}


def test_aggregates_compare_by_type_class(spark):
    from paritylake.operators.parity import aggregate_parity
    a = spark.createDataFrame([("1.0", 1)], "s string, n long")
    b = spark.createDataFrame([("1", 1.0)], "s string, n double")
    got = {r["target"]: r["status"] for r in aggregate_parity(a, b, [("s", "max", 1), ("n", "max", 0), ("n", "sum", 0)]).collect()}
    assert got == {"table.s.max": "FAIL", "table.n.max": "PASS", "table.n.sum": "PASS"}


def test_repeated_target_keys(spark):
    from paritylake.operators import encoding as E
    import datetime as dt
    t = dt.datetime(2020, 1, 1)
    ms = 1577836800000
    src = spark.createDataFrame([(1, ms), (2, ms), (None, ms)], "k long, e long")
    tgt = spark.createDataFrame([(1, t), (1, t), (2, t), (2, t + dt.timedelta(days=1)), (None, t)], "k long, ts timestamp")
    got = {r["k"]: r["class"] for r in E.epoch_classes(src, tgt, "k", "e", "ts", "millis", (1990, 2030)).collect()}
    assert got == {1: "matched", 2: "target_conflict", None: "matched"}
    s, d = src.selectExpr("k", "cast(1.5 as decimal(10,2)) v"), spark.createDataFrame([(1, 1.5), (2, 1.5), (2, 2.5)], "k long, v double")
    bad, _ = E.decimal_roundtrip(s, d, "k", ["v"])
    assert {(r["k"], r["tgt_rows"]) for r in bad.collect()} == {(2, 2), (None, 0)}


def test_hierarchy_walks_to_the_leaves_and_leaves_cycles_out(spark):
    from paritylake.operators.hierarchy import walk
    rows = [(0, None, "r")] + [(i, i - 1, f"n{i}") for i in range(1, 12)] + [(50, 51, "c"), (51, 50, "d")]
    got = {r["id"]: (r["root"], r["depth"], r["path"]) for r in walk(spark.createDataFrame(rows, "id long, up long, name string"), "id", "up", "name").collect()}
    assert len(got) == 12 and got[11][:2] == (0, 11) and got[2][2] == "r > n1 > n2"
    assert walk(spark.createDataFrame(rows, "id long, up long, name string"), "id", "up", "name", 3).count() == 4


def test_profile_of_extreme_values(spark):
    from paritylake.operators.schema import column_profile
    df = spark.createDataFrame([(1e300, [1.0, None]), (0.1234567, [2.0]), (None, None)], "x double, v array<double>")
    got = {r["col"]: r for r in column_profile(df).collect()}
    assert got["x"]["max_scale"] == 7 and got["v"]["inner_nulls"] == 1


def test_a_long_chain_takes_few_rounds_and_cycles_and_orphans_are_named(spark):
    from paritylake.operators.hierarchy import climbed, unreached, walk
    chain = spark.range(10_000).selectExpr("id AS k", "CASE WHEN id > 0 THEN id - 1 END AS up", "cast(id AS string) AS name")
    _, rounds = climbed(chain, "k", "up")
    assert rounds <= 15
    got = walk(chain, "k", "up", "name", with_path=False).agg(F.min("root"), F.max("root"), F.max("depth"), F.count("*")).first()
    assert tuple(got) == (0, 0, 9_999, 10_000)
    rows = [(1, None, "a"), (2, 1, "b"), (3, 2, "c"), (10, 12, "x"), (11, 10, "y"), (12, 11, "z"), (13, 12, "w"), (20, 99, "o"), (21, 20, "p"), (22, 21, "q"), (30, 30, "s")]
    df = spark.createDataFrame(rows, "k long, up long, name string")
    assert {(r["k"], r["reason"]) for r in unreached(df, "k", "up").collect()} == {
        (10, "cycle"), (11, "cycle"), (12, "cycle"), (13, "cycle"), (20, "orphan"), (21, "below an orphan"), (22, "below an orphan"), (30, "cycle")}
    assert {(r["k"], r["depth"], r["path"]) for r in walk(df, "k", "up", "name").collect()} == {(1, 0, "a"), (2, 1, "a > b"), (3, 2, "a > b > c")}
    assert unreached(df.where("k < 4"), "k", "up").collect() == [] == walk(df.limit(0), "k", "up", "name").collect()


def test_the_signoff_report_stores_its_checks_in_one_job(spark, sf0001):
    from paritylake import session
    from paritylake.plans.registry import QUERIES
    handed_out = len(session._WRITTEN)
    got = {r["pattern"]: (r["status"], r["checks"]) for r in QUERIES["signoff_report"](spark, sf0001).collect()}
    stored = [p for p in session._WRITTEN[handed_out:] if "signoff_checks" in p]
    assert len(stored) == 1
    assert len(spark.read.parquet(stored[0]).inputFiles()) == 1
    assert got["fingerprint_parity"] == ("FAIL", 7) and got["merge_idempotency"] == ("FAIL", 4) and got["schema_conformance"][0] == "GAP"


def test_the_signoff_report_runs_every_required_pattern_and_names_uncovered_flows(spark, monkeypatch):
    from paritylake.plans import registry
    rows = lambda ddl, *r: lambda s, sf: s.createDataFrame(list(r), ddl)
    checks = "pattern string, target string, status string, measurement boolean"
    fakes = {p: rows(checks, (p, "a", "PASS", False), (p, "b", "FAIL", False)) for p in (
        "fingerprint_parity", "merge_idempotency", "egress_parity", "schema_conformance", "aggregate_parity")}
    fakes |= {p: rows("relation string, status string", ("a", "PASS")) for p in ("rowcount_parity", "fk_orphan")}
    # a query that Spark refuses; checks that fail or err, one that only measures
    fakes["transform_unit"] = lambda s, sf: s.table("a_table_that_is_not_there")
    fakes["query_parity"] = rows(checks, ("query_parity", "a", "FAIL", False), ("query_parity", "b", "ERROR", False))
    fakes["bulk_load"] = rows(checks, ("bulk_load", "a", "PASS", True))
    fakes["query_performance"] = rows(checks, ("query_performance", "a", "PASS", False), ("query_performance", "b", "PASS", True))
    # violations
    fakes["epoch_conversion"] = rows("unit string, class string, n long", ("millis", "matched", 5), ("millis", "null_ok", 1), ("seconds", "lying", 2))
    fakes["decimal_roundtrip"] = rows("o_orderkey long, column string", (1, "amount"), (2, "amount"), (1, "digits_25"))
    fakes["scd2_continuity"] = rows("variant string, rule string, violations long", ("broken", "gap_or_overlap", 3))
    fakes["transform_diff"] = rows("variant string, copies long")
    for p, fn in fakes.items():
        monkeypatch.setitem(registry.QUERIES, p, fn)
    got = sorted(tuple(r) for r in registry.QUERIES["signoff_report"](spark, "no folder").collect())
    want = [(p, "FAIL", 2, 1, 1, 0) for p in ("fingerprint_parity", "merge_idempotency", "egress_parity", "schema_conformance",
                                              "aggregate_parity", "epoch_conversion", "scd2_continuity")]
    want += [(p, "PASS", 1, 1, 0, 0) for p in ("rowcount_parity", "fk_orphan", "query_performance")]
    want += [("transform_unit", "ERROR", 1, 0, 0, 1), ("query_parity", "ERROR", 2, 0, 1, 1), ("decimal_roundtrip", "FAIL", 4, 2, 2, 0), ("transform_diff", "PASS", 2, 2, 0, 0)]
    want += [(p, "GAP", 0, 0, 0, 0) for p in ("transform_unit", "query_parity", "bulk_load", "Consumer Migration: query_parity", "Extract-Load: bulk_load")]
    assert got == sorted(want)
