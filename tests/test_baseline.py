"""Stored performance baselines."""

import pytest

from paritylake.operators import baseline as B
from paritylake.session import scratch_dir


def stats(spark, p95):
    return spark.createDataFrame([("q", "ms", 1.0, p95, 9.0, 0.5, 3), ("r", "ms", 1.0, 2.0, 9.0, 0.5, 3)], B.STATS)


def seen(df):
    return sorted((r["target"].split(":")[1], r["status"], r["measurement"]) for r in df.collect())


def test_first_sight_then_gates_then_optimistic_commits(spark):
    path = scratch_dir(spark, "b")
    assert seen(B.gate(spark, path, stats(spark, 5.0))) == [("q", "PASS", True), ("r", "PASS", True)]
    assert seen(B.gate(spark, path, stats(spark, 5.1))) == [("q", "FAIL", False), ("r", "PASS", False)]
    assert seen(B.gate(spark, path, stats(spark, 5.1), growth_pct=10)) == [("q", "PASS", False), ("r", "PASS", False)]
    assert B.commit(spark, path, stats(spark, 6.0), 1) == 2
    with pytest.raises(RuntimeError):  # someone who had seen version 1 only
        B.commit(spark, path, stats(spark, 7.0), 1)
    assert seen(B.gate(spark, path, stats(spark, 5.9))) == [("q", "PASS", False), ("r", "PASS", False)]
    _, content = B.Manifest(spark, path).read()
    stats(spark, 100.0).write.mode("overwrite").parquet(f"{path}/{content['name']}")
    assert seen(B.gate(spark, path, stats(spark, 5.9))) == [("q", "FAIL", False), ("r", "FAIL", False)]
