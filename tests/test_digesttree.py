"""Digest trees: depth, descent, stored sides, edge keys."""

import pytest
from pyspark.sql import functions as F

from paritylake.operators import digesttree as T
from paritylake.session import scratch_dir

COLS = ["k", "v"]


def table(spark, n, changed=()):
    v = F.when(F.col("id").isin(*changed), F.lit("other")).otherwise(F.concat(F.lit("v"), F.col("id"))) if changed else F.concat(F.lit("v"), F.col("id"))
    return spark.range(n).select(F.col("id").alias("k"), v.alias("v"))


def test_depth_follows_the_rows():
    assert [T.depth_for(n) for n in (0, 1, 1024, 1025, 16_384, 16_385, 10**6, 10**11)] == [1, 1, 1, 2, 2, 3, 4, 8]
    assert all(10**p / 16 ** T.depth_for(10**p) <= T.LEAF_ROWS for p in range(1, 12))


def test_ten_differing_keys_leave_all_else_unread(spark):
    n, changed = 60_000, list(range(5, 60_000, 6_000))
    a = T.store_tree(table(spark, n), COLS, "k", scratch_dir(spark, "a"))
    b = T.store_tree(table(spark, n, changed), COLS, "k", scratch_dir(spark, "b"), shape=a.shape)
    leaves, seen = T.differing_nodes(a, b)
    assert len(leaves) <= 10 and len(seen) == a.shape.depth + 1
    assert all(met <= 16 * max(1, bad_above) for (met, _), bad_above in zip(seen[1:], [x[1] for x in seen]))  # only children of differing nodes
    assert a.keys(leaves).agg(F.sum("n")).first()[0] < n / 100
    got = T.localize_trees(a, b)
    assert sorted((r["k"], r["kind"]) for r in got.collect()) == [(k, "changed") for k in changed]


def test_a_stored_side_is_not_scanned_again(spark, tmp_path):
    src_path, tgt_path = scratch_dir(spark, "src"), scratch_dir(spark, "tgt")
    table(spark, 5_000).write.parquet(src_path)
    table(spark, 5_000, [7]).where("k <> 9").write.parquet(tgt_path)
    stored = T.store_tree(spark.read.parquet(src_path), COLS, "k", scratch_dir(spark, "tree"))
    opened = T.open_tree(spark, stored.path)
    assert opened == stored
    got = T.localize_against(opened, spark.read.parquet(tgt_path))
    plan = got._jdf.queryExecution().toString()
    assert src_path not in plan and tgt_path not in plan  # digests of both sides by now, and only those
    assert "node" in plan and sorted((r["k"], r["kind"], r["src_n"], r["tgt_n"]) for r in got.collect()) == [(7, "changed", 1, 1), (9, "missing", 1, 0)]
    assert T.localize_against(opened, table(spark, 5_000)).collect() == []


def test_trees_of_other_shapes_and_unfinished_ones_are_refused(spark):
    a = T.store_tree(table(spark, 10), COLS, "k", scratch_dir(spark, "a"))
    b = T.store_tree(table(spark, 5_000), COLS, "k", scratch_dir(spark, "b"))
    with pytest.raises(ValueError):
        T.localize_trees(a, b)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        T.open_tree(spark, scratch_dir(spark, "none"))


def test_null_keys_duplicates_types_and_empty_sides(spark):
    a = spark.createDataFrame([(1, "x"), (None, "n"), (None, "n"), (2, "y"), (3, "z"), (3, "z")], "k long, v string")
    b = spark.createDataFrame([("1", "x"), (None, "n"), ("2.0", "q"), ("3", "z"), ("4", "w")], "k string, v string").select(F.col("k").cast("decimal(12,2)").alias("k"), "v")
    want = {(None, "under_count"), ("2", "changed"), ("3", "under_count"), ("4", "extra")}
    assert {(r["k"], r["kind"]) for r in T.localize(a, b, ["v"], "k").collect()} == want
    stored = T.store_tree(a, ["v"], "k", scratch_dir(spark, "a"))
    assert {(r["k"], r["kind"]) for r in T.localize_against(stored, b).collect()} == want
    assert {(r["k"], r["kind"]) for r in T.localize_against(stored, a.limit(0)).collect()} == {(None, "missing"), (1, "missing"), (2, "missing"), (3, "missing")}
    assert T.localize(a.limit(0), a.limit(0), ["v"], "k").collect() == []
