"""Incremental ingest with a ledger; levelled change files; two-sided windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from paritylake.session import scratch_dir
from paritylake.streaming import compaction as C, ingest as S, ledger as L, paritywindow as PW

SCHEMA = "k long, at long, v string"


def run(spark, sink, n, rows, **kw):
    r = L.incremental_ingest(spark, spark.createDataFrame(rows, SCHEMA), sink, "at", n, "k", **kw).first()
    return {c: r[c] for c in ("appended", "late", "changed", "gone", "no_key", "no_check_value", "ledger_rows_read")}


def aside(spark, sink, n):
    return sorted((str(r["k"]), r["reason"]) for r in spark.read.parquet(f"{sink}/_aside/run={n}").collect())


def test_every_row_ends_in_the_data_or_in_a_named_count(spark):
    sink, far = scratch_dir(spark, "sink"), 10 * 4096
    first = [(1, 5, "a"), (2, 5, "b"), (3, far, "c"), (5, far, "e")]
    assert run(spark, sink, 1, first) == {"appended": 4, "late": 0, "changed": 0, "gone": 0, "no_key": 0, "no_check_value": 0, "ledger_rows_read": 0}
    # a tie above the watermark's key, one below it, a change at the watermark, an older change, no key, no check value, a moved and a lost row
    second = [(1, 5, "A"), (3, far, "c"), (4, far, "late tie"), (5, far, "E"), (6, far, "new tie"), (2, far + 9, "moved"), (None, far + 1, "x"), (7, None, "y")]
    want = {"appended": 2, "late": 1, "changed": 2, "gone": 0, "no_key": 1, "no_check_value": 1}
    for _ in range(2):  # a retry replaces its run
        got = run(spark, sink, 2, second)
        assert {c: got[c] for c in want} == want
    assert aside(spark, sink, 2) == [("1", "changed"), ("4", "late"), ("5", "changed"), ("7", "no_check_value"), ("None", "no_key")]
    assert sorted(r["k"] for r in L.sink_rows(spark, sink, spark.createDataFrame([], SCHEMA).schema).collect()) == [1, 2, 2, 3, 5, 6]
    # told once: the ledger knows them by now, and nothing of it is read
    assert run(spark, sink, 3, second[:6])["ledger_rows_read"] == 0
    got = run(spark, sink, 4, second[1:6])
    assert (got["gone"], got["late"], got["changed"]) == (1, 0, 0) and 0 < got["ledger_rows_read"] <= 2  # one slice of the ledger


def test_rows_read_of_the_ledger_do_not_grow_with_the_sink(spark):
    sink, rows = scratch_dir(spark, "sink"), []
    for n in range(1, 5):
        rows += [(1000 * n + i, 4096 * n + i, "v") for i in range(30)]
        got = run(spark, sink, n, rows)
        assert (got["appended"], got["ledger_rows_read"]) == (30, 0)
    feed = [(4029, 4096 * 4 + 29, "v"), (9, 4096 * 4 + 3, "late"), (5000, 4096 * 5, "v")]
    got = run(spark, sink, 5, feed, complete=False)
    assert (got["appended"], got["late"], got["changed"], got["gone"]) == (1, 1, 0, 0) and got["ledger_rows_read"] == 30


def test_an_unfinished_run_counts_for_nothing(spark):
    sink = scratch_dir(spark, "sink")
    run(spark, sink, 1, [(1, 5, "a")])
    spark.createDataFrame([("0", 99, 0, 0)], "_slice string, n long, s1 long, s2 long").selectExpr(
        "_slice", "n", "cast(s1 as decimal(38,0)) s1", "cast(s2 as decimal(38,0)) s2").write.parquet(f"{sink}/_slices/run=2")
    assert run(spark, sink, 3, [(1, 5, "a"), (2, 6, "b")])["appended"] == 1


def test_levels_stay_few_and_replays_change_nothing(spark):
    base = scratch_dir(spark, "runs")
    schema = spark.createDataFrame([], "k long, n long").schema
    latest = lambda df: df.groupBy("k").agg(F.max("n").alias("n"))
    for b in range(17):
        batch = spark.createDataFrame([(b % 5, b), (100 + b, b)], schema)
        C.add_batch(spark, base, b, batch, schema, latest)
        if b in (3, 16):
            C.add_batch(spark, base, b, batch, schema, latest)
    runs = C.live_runs(spark, base)
    assert sorted(r["level"] for r in runs) == [0, 2]
    got = {r["k"]: r["n"] for r in latest(C.read_runs(spark, base, schema)).collect()}
    assert got == {**{100 + b: b for b in range(17)}, 0: 15, 1: 16, 2: 12, 3: 13, 4: 14}


def test_a_call_that_dies_before_the_swap_leaves_the_old_snapshot(spark, monkeypatch):
    base = scratch_dir(spark, "runs")
    schema = spark.createDataFrame([], "k long").schema
    C.add_batch(spark, base, 0, spark.createDataFrame([(1,)], schema), schema, lambda df: df.distinct())
    swap = C.Manifest.swap
    monkeypatch.setattr(C.Manifest, "swap", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError):
        C.add_batch(spark, base, 1, spark.createDataFrame([(2,)], schema), schema, lambda df: df.distinct())
    monkeypatch.setattr(C.Manifest, "swap", swap)
    assert [r["k"] for r in C.read_runs(spark, base, schema).collect()] == [1]
    C.add_batch(spark, base, 1, spark.createDataFrame([(2,)], schema), schema, lambda df: df.distinct())
    assert sorted(r["k"] for r in C.read_runs(spark, base, schema).collect()) == [1, 2]
    with pytest.raises(RuntimeError):  # another writer was first
        C.Manifest(spark, base).swap(2, {})


def test_changes_without_a_key_are_reported(spark):
    schema = spark.createDataFrame([], "k long, v string, op string, at long, day int").schema
    landing, base = scratch_dir(spark, "l"), scratch_dir(spark, "b")
    S.land_files(spark.createDataFrame([(1, "x", "U", 5, 1), (None, "z", "I", 9, 1), (None, "y", "I", 8, 1)], schema), landing, "day")
    initial = spark.createDataFrame([(1, "a")], "k long, v string")
    assert [tuple(r) for r in S.stream_merge(spark, landing, schema, initial, ["k"], "at", base).collect()] == [(1, "x")]
    r = S.refused_changes(spark, base, schema, ["k"], ["k", "v"], "at").first()
    assert (r["status"], r["actual"]) == ("ERROR", "2")


def test_windows_close_once_whatever_the_restarts(spark):
    schema = spark.createDataFrame([], "id long, ts timestamp").schema
    lands = {s: scratch_dir(spark, s) for s in ("src", "tgt")}
    sink = scratch_dir(spark, "w")
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    call = lambda: PW.stream_parity_windows(spark, lands, schema, "ts", ["id"], sink, "1 hour")

    def land(side, rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(lands[side])

    land("src", [(1, at(1)), (2, at(1, 5)), (3, at(2))])
    land("tgt", [(1, at(1)), (2, at(1, 5))])
    verdicts, late = call()
    assert verdicts.count() == 0  # the watermark, an hour behind, has not passed the first day's end
    land("tgt", [(3, at(2)), (4, at(3, 2))])
    for _ in range(2):
        verdicts, late = call()
        assert sorted((r["window_start"].day, r["src_n"], r["tgt_n"], r["status"]) for r in verdicts.collect()) == [(1, 2, 2, "PASS"), (2, 1, 1, "PASS")]
    land("src", [(9, at(1, 7)), (4, at(3, 2)), (5, at(4, 3))])
    verdicts, late = call()
    assert sorted((r["window_start"].day, r["status"]) for r in verdicts.collect()) == [(1, "PASS"), (2, "PASS"), (3, "PASS")]
    assert [(r["id"], r["_side"]) for r in late.collect()] == [(9, "src")]
