"""Skew-aware windows and pair-free interval counting against brute force."""

import datetime as dt
import random

from pyspark.sql import Window, functions as F

from paritylake.operators.rangejoin import range_count
from paritylake.operators.windows import global_rank, neighbours, ntile_col, percent_rank_col


def _events(spark, n=600, hot_share=0.4, seed=7):
    rnd = random.Random(seed)
    rows = []
    base = dt.datetime(2024, 1, 1)
    for i in range(n):
        k = 0 if rnd.random() < hot_share else rnd.randint(1, 20)     # key 0 holds ~40 % of rows
        rows.append((i, k, base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 40)), rnd.choice("abc")))
    return spark.createDataFrame(rows, "id long, k long, ts timestamp, v string")


def _jobs(spark):
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-time"))


def _with_nulls(spark):
    """A hot key, a NULL key with many rows, NULL order values."""
    df = _events(spark)
    null_key = F.when(F.col("id") % 5 != 0, F.col("k"))
    return df.withColumn("k", null_key).withColumn("ts", F.when(F.col("id") % 37 != 0, F.col("ts")))


def test_neighbours_equal_the_plain_window_and_run_no_job_while_planning(spark):
    df = _with_nulls(spark)
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_first(), "id")
    want = sorted((tuple(r) for r in df.select("id", F.lag("v").over(w), F.lead("ts").over(w)).collect()), key=repr)
    spark.sparkContext.setJobGroup("plan-time", "none expected")
    got = neighbours(df, "k", ["ts", "id"], prev_cols={"v": "pv"}, next_cols={"ts": "nts"})
    plan = got.select("id", "pv", "nts")
    assert _jobs(spark) == 0
    spark.sparkContext.setJobGroup("run", "")
    assert sorted((tuple(r) for r in plan.collect()), key=repr) == want


def test_running_sum_equals_plain(spark):
    from paritylake.operators.windows import running_sum
    df = _with_nulls(spark)
    for way in ("asc", "desc"):
        o = F.col("ts").asc_nulls_first() if way == "asc" else F.col("ts").desc_nulls_last()
        w = Window.partitionBy("k").orderBy(o, "id").rowsBetween(Window.unboundedPreceding, 0)
        want = sorted(tuple(r) for r in df.select("id", F.sum("id").over(w)).collect())
        got = running_sum(df, ["k"], [("ts", way), ("id", "asc")], F.col("id"), "s")
        assert sorted(tuple(r) for r in got.select("id", "s").collect()) == want


def test_buckets_keep_the_order_of_every_type(spark):
    from paritylake.operators.windows import bucket_of_order
    values = {"double": [float("-inf"), -1e300, -5.5, -1e-9, 0.0, 1e-9, 0.3, 7.0, 7.5, 1e18, float("inf"), float("nan")],
              "long": [-2**62, -5000, -1, 0, 1, 4095, 4096, 2**62], "string": ["", "a", "aa", "aab", "ab", "b", "é", "zz"],
              "decimal(20,4)": [-7, 0, 1, 10**12], "date": [dt.date(1960, 1, 1), dt.date(2024, 1, 1)],
              "timestamp": [dt.datetime(1960, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 5)]}
    for kind, vs in values.items():
        if kind.startswith("decimal"):
            from decimal import Decimal
            vs = [Decimal(v) for v in vs]
        df = spark.createDataFrame([(v,) for v in vs], f"v {kind}")
        b = [r[0] for r in df.orderBy("v").select(bucket_of_order(df, "v")).collect()]
        assert b == sorted(b), kind


def test_global_rank_matches_single_task_window(spark):
    df = _events(spark).withColumn("score", F.when(F.col("id") % 11 != 0, (F.col("id") % 37).cast("double")))
    w = Window.orderBy("score")
    want = {r["id"]: (r["pr"], r["nt"], r["nd"]) for r in df.select(
        "id", F.percent_rank().over(w).alias("pr"), F.ntile(7).over(Window.orderBy("score", "id")).alias("nt"),
        F.ntile(4).over(Window.orderBy(F.col("score").desc(), "id")).alias("nd")).collect()}
    g1 = global_rank(df, [("score", "asc")]).withColumn("pr", percent_rank_col())
    g2 = global_rank(df, [("score", "asc"), ("id", "asc")]).withColumn("nt", ntile_col(7))
    g3 = global_rank(df, [("score", "desc"), ("id", "asc")]).withColumn("nd", ntile_col(4))
    pr, nt, nd = ({r["id"]: r[c] for r in g.select("id", c).collect()} for g, c in ((g1, "pr"), (g2, "nt"), (g3, "nd")))
    assert all(abs(pr[i] - want[i][0]) < 1e-12 and nt[i] == want[i][1] and nd[i] == want[i][2] for i in want)


def test_range_count_of_null_and_crossed_bounds(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    left = spark.createDataFrame([(1, 1, t(1), None), (2, 1, None, t(9)), (3, 1, t(9), t(1)), (4, 1, t(1), t(9)), (5, None, t(1), t(9)), (6, 2, t(1), t(9))],
                                 "id long, k long, lo timestamp, hi timestamp")
    right = spark.createDataFrame([(1, t(1)), (1, t(2)), (1, t(2)), (1, t(9)), (None, t(2)), (1, None)], "k long, t timestamp")
    got = {r["id"]: r["matches"] for r in range_count(left, right, "k", "id", "lo", "hi", "t").collect()}
    assert got == {1: 0, 2: 0, 3: 0, 4: 3, 5: 0, 6: 0}


def test_range_count_matches_brute_force(spark):
    df = _events(spark, n=400)
    left = df.withColumn("hi", F.col("ts") + F.expr("INTERVAL 7 DAYS"))
    got = {r["id"]: r["matches"] for r in range_count(left, df, "k", "id", "ts", "hi", "ts",
                                                      bucket_seconds=3 * 86400).collect()}
    rows = [tuple(r) for r in df.select("id", "k", "ts").collect()]
    for i, k, t in rows:
        want = sum(1 for _, k2, t2 in rows if k2 == k and t < t2 <= t + dt.timedelta(days=7))
        assert got[i] == want


def test_nearest_rank_matches_definition(spark):
    import math
    from paritylake.operators.aggregates import nearest_rank
    df = spark.createDataFrame([(g, float(v)) for g in ("a", "b") for v in range(1, 21 if g == "a" else 8)],
                               "g string, v double")
    got = {r["g"]: (r["p50"], r["p95"]) for r in nearest_rank(df, ["g"], "v", [0.5, 0.95]).collect()}
    for g, n in (("a", 20), ("b", 7)):
        vals = list(range(1, n + 1))
        assert got[g] == (vals[math.ceil(0.5 * n) - 1], vals[math.ceil(0.95 * n) - 1])


def test_one_key_with_all_rows_on_one_day_is_many_groups(spark):
    from paritylake.operators.windows import _grouped, running_sum
    base = dt.datetime(2024, 1, 1, 12)
    # a busy day, and within it one instant that half of all rows share
    rows = [(i, 1, base if i % 2 else base + dt.timedelta(milliseconds=i)) for i in range(4_000)]
    df = spark.createDataFrame(rows, "id long, k long, ts timestamp").repartition(5)
    small = {"group_rows": 200}
    sizes = [r["count"] for r in _grouped(df, ["k"], ["ts", "id"], None, **small).groupBy("_grp").count().collect()]
    assert sum(sizes) == 4_000 and len(sizes) >= 15 and max(sizes) <= 800
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = sorted(tuple(r) for r in df.select("id", F.lag("id").over(w), F.row_number().over(w)).collect())
    lagged = neighbours(df, "k", ["ts", "id"], prev_cols={"id": "p"}, **small)
    got = running_sum(lagged, ["k"], [("ts", "asc"), ("id", "asc")], F.lit(1), "n", **small)
    assert sorted(tuple(r) for r in got.select("id", "p", "n").collect()) == want


def test_rank_over_a_wide_range_of_numbers_has_no_one_task_step(spark):
    rnd = random.Random(2)
    values = [rnd.randrange(-2**62, 2**62) for _ in range(3_000)] + [None, 0, 0, 2**63 - 1, -2**63]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v long")
    for way in ("asc", "desc"):
        o = F.col("v").asc_nulls_first() if way == "asc" else F.col("v").desc_nulls_last()
        want = sorted(tuple(r) for r in df.select("id", F.rank().over(Window.orderBy(o)).cast("bigint")).collect())
        got = global_rank(df, [("v", way)])
        assert sorted(tuple(r) for r in got.select("id", "_grank").collect()) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # windows over a whole table see stretches of stretches only
    assert plan.count("_up") >= 4


def test_a_global_rank_of_two_columns_sorts_the_rows_once(spark, sf0001):
    from paritylake.plans.registry import QUERIES
    rnd = random.Random(3)
    value = lambda: rnd.choice([None, 5.0, 5.0, 5.0, float("nan"), 0.0, -0.0, rnd.random()])
    df = spark.createDataFrame([(i, value()) for i in range(3_000)], "id long, v double").repartition(8)
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # runs of one value go over several partitions
    try:
        for way in ("asc", "desc"):
            o = F.col("v").asc_nulls_first() if way == "asc" else F.col("v").desc_nulls_last()
            want = sorted(tuple(r) for r in df.select("id", F.row_number().over(Window.orderBy(o, "id")), F.rank().over(Window.orderBy(o)), F.lit(3_000)).collect())
            got = global_rank(df, [("v", way), ("id", "asc")])
            assert sorted(tuple(r) for r in got.select("id", "_grn", "_grank", "_gn").collect()) == want
            same = df.withColumn("v", F.lit(1.0))
            assert {r[0] for r in global_rank(same, [("v", way), ("id", "asc")]).select("_grank").collect()} == {1}
        assert global_rank(df.where("id < 0"), [("v", "asc"), ("id", "asc")]).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    # no row meets its value's rank in a join, and no window has rows
    plan = QUERIES["ntile_global"](spark, sf0001)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and plan.count("Window [") == 2, plan
