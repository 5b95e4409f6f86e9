"""Incremental ingest and the order-independent streaming merge."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from paritylake.operators import merge as M
from paritylake.plans import derived as D
from paritylake.session import scratch_dir
from paritylake.streaming import ingest as S


def test_incremental_runs_equal_full_set(spark, sf0001):
    r = {x["run"]: x for x in E.queries()["incremental_ingest"](spark, sf0001).collect()}
    total = spark.read.parquet(f"{sf0001}/events.parquet").count()
    assert r["1"]["appended"] + r["2"]["appended"] == total == r["final"]["appended"]
    assert r["3"]["appended"] == 0 and r["2"]["late"] > 0 and r["2"]["no_check_value"] > 0
    assert r["final"]["status"] == "PASS"


def test_stream_merge_equals_batch_merge(spark, sf0001):
    o = spark.read.parquet(f"{sf0001}/orders.parquet")
    s = E.queries()["stream_merge"](spark, sf0001)
    latest = M.delta_latest(D.orders_delta(o), ["o_orderkey"], ["change_ms"])
    b = M.merge_apply(D.orders_target_snapshot(o), latest, ["o_orderkey"]).drop("_action").withColumn("amount", F.col("amount").cast("string"))
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_stream_merge_goes_on_with_new_files(spark):
    initial = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    schema = "k long, v string, op string, at long, day int"
    landing, base = scratch_dir(spark, "t_landing"), scratch_dir(spark, "t_base")
    merge = lambda: {tuple(r) for r in S.stream_merge(spark, landing, spark.createDataFrame([], schema).schema, initial, ["k"], "at", base).collect()}
    S.land_files(spark.createDataFrame([(1, "x", "U", 5, 1), (3, "n", "I", 5, 1), (None, "z", "I", 9, 1)], schema), landing, "day")
    assert merge() == {(1, "x"), (2, "b"), (3, "n")} == merge()
    # an older change arrives late: it does not undo the newer one
    spark.createDataFrame([(1, "old", "U", 4, 2), (2, None, "D", 6, 2)], schema).write.mode("append").partitionBy("day").parquet(landing)
    assert merge() == {(1, "x"), (3, "n")} == merge()


def test_merge_refuses_null_and_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "t")], "k long, v string")
    delta = spark.createDataFrame([(1, "p", "U"), (1, "q", "U"), (None, "z", "I"), (2, "n", "I"), (3, None, None)], "k long, v string, op string")
    assert {tuple(r) for r in M.merge_apply(target, delta, ["k"]).collect()} == {(1, "a", "keep"), (None, "t", "keep"), (2, "n", "insert")}
    assert {(r["target"], r["status"], r["actual"]) for r in M.merge_refusals(delta, ["k"]).collect()} == {
        ("delta:null_keys", "ERROR", "1"), ("delta:repeated_keys", "ERROR", "2")}
