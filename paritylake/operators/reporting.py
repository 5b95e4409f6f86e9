"""Reporting checks over check tables and run logs: V18 performance gates
(assert / compare / regression against a baseline table), V20 sign-off
roll-up with coverage gaps, and the re-aimed quality checks X3 (retention),
X4 (masking) and X5 (manifest parity).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paritylake.checks import CHECK_COLUMNS, worst_status
from paritylake.operators.aggregates import run_stats_fold


# ---------------------------------------------------------------- V18
# statistics a gate may name
STATISTICS = ("p50", "p95", "max", "min")


def perf_assert(stats: DataFrame, thresholds: DataFrame) -> DataFrame:
    """statistic ≤ threshold per (query_id, metric); ``thresholds`` may name the statistic in a column ``stat``
    (p95 without). A metric missing from the run log FAILs (an unavailable metric is not a pass); an unknown
    statistic is an ERROR."""
    t = thresholds if "stat" in thresholds.columns else thresholds.withColumn("stat", F.lit("p95"))
    j = t.join(stats, ["query_id", "metric"], "left")
    value = F.coalesce(*[F.when(F.col("stat") == s, F.col(s)) for s in STATISTICS])
    status = (F.when(~F.col("stat").isin(*STATISTICS), "ERROR")
              .when(value.isNotNull() & (value <= F.col("threshold")), "PASS").otherwise("FAIL"))
    return j.select(F.lit("query_performance").alias("pattern"),
                    F.concat_ws(":", F.lit("assert"), "query_id", "metric", F.when(F.col("stat") != "p95", F.col("stat"))).alias("target"),
                    status.alias("status"), F.col("threshold").cast("string").alias("expected"),
                    value.cast("string").alias("actual"), F.lit(False).alias("measurement"))


def perf_compare(stats: DataFrame, pairs: DataFrame) -> DataFrame:
    """A/B: condition ``b <op> a * k`` on p50 with <=, <, >= or >; ``report`` is a measurement without a gate; any other
    condition is an ERROR. ``pairs`` columns: name, a, b, metric, op, k."""
    a = stats.select(F.col("query_id").alias("a"), "metric", F.col("p50").alias("a_p50"))
    b = stats.select(F.col("query_id").alias("b"), "metric", F.col("p50").alias("b_p50"))
    j = pairs.join(a, ["a", "metric"], "left").join(b, ["b", "metric"], "left")
    bound, got, op = F.col("a_p50") * F.col("k"), F.col("b_p50"), F.col("op")
    holds = (F.when(op == "<=", got <= bound).when(op == "<", got < bound)
             .when(op == ">=", got >= bound).when(op == ">", got > bound))
    status = (F.when(op == "report", "PASS").when(~op.isin("<=", "<", ">=", ">"), "ERROR")
              .when(F.coalesce(holds, F.lit(False)), "PASS").otherwise("FAIL"))
    return j.select(F.lit("query_performance").alias("pattern"), F.concat_ws(":", F.lit("compare"), "name").alias("target"),
                    status.alias("status"), bound.cast("string").alias("expected"), got.cast("string").alias("actual"),
                    (op == "report").alias("measurement"))


def perf_regression(stats: DataFrame, baseline: DataFrame, growth_pct: float = 0.0) -> DataFrame:
    """Current p95 ≤ baseline p95 × (1 + growth); no baseline yet → a
    measurement row (first sight establishes it)."""
    j = stats.join(baseline.select("query_id", "metric", F.col("p95").alias("base_p95")),
                   ["query_id", "metric"], "left")
    limit = F.col("base_p95") * (1 + growth_pct / 100.0)
    return j.select(F.lit("query_performance").alias("pattern"),
                    F.concat_ws(":", F.lit("regression"), "query_id", "metric").alias("target"),
                    F.when(F.col("base_p95").isNull() | (F.col("p95") <= limit), "PASS")
                    .otherwise("FAIL").alias("status"),
                    limit.cast("string").alias("expected"), F.col("p95").cast("string").alias("actual"),
                    F.col("base_p95").isNull().alias("measurement"))


# ---------------------------------------------------------------- V20
def signoff(checks: DataFrame, required: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per pattern: worst status (ERROR > FAIL > PASS) and counts, measurement
    rows excluded from the assertion counts; gaps = required patterns with no
    PASS row."""
    gate = checks.where(~F.col("measurement"))
    summary = gate.groupBy("pattern").agg(
        worst_status(F.col("status")).alias("status"),
        F.count(F.lit(1)).cast("bigint").alias("checks"),
        F.count_if(F.col("status") == "PASS").cast("bigint").alias("passed"),
        F.count_if(F.col("status") == "FAIL").cast("bigint").alias("failed"),
        F.count_if(F.col("status") == "ERROR").cast("bigint").alias("errors"))
    return summary, uncovered(checks, required)


def uncovered(checks: DataFrame, required: DataFrame) -> DataFrame:
    """Rows of ``required`` (patterns, or patterns of flow groups) whose pattern has no PASS row; a measurement covers nothing."""
    passed = checks.where(~F.col("measurement") & (F.col("status") == "PASS")).select("pattern").distinct()
    return required.join(passed, "pattern", "left_anti")


# ---------------------------------------------------------------- X3 / X4 / X5
def retention(df: DataFrame, part_col: Column, ts_col: str, keep_days: int) -> DataFrame:
    """Partitions whose newest row is older than ``keep_days`` before the
    table's newest row."""
    p = df.groupBy(part_col.alias("partition")).agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"), F.max(ts_col).alias("_newest"))
    j = p.select("*", df.agg(F.max(ts_col)).scalar().alias("_latest"))
    age = F.datediff(F.to_date("_latest"), F.to_date("_newest"))
    return j.select("partition", "rows", age.alias("age_days"), (age > keep_days).alias("expired"))


def leaked_values(masked: DataFrame, raw: DataFrame, col: str) -> DataFrame:
    """Masked rows whose value equals some raw value of the column
    (semi join on the distinct raw values)."""
    rv = raw.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    return masked.join(rv, masked[col] == rv["_v"], "left_semi")


def manifest_compare(live: DataFrame, manifest: DataFrame, target: str) -> DataFrame:
    """Live (n, s1, s2, x) against a saved manifest row."""
    live = live.withColumn("_s", F.lit(1))
    man = manifest.select("n", "s1", "s2", "x").withColumn("_s", F.lit(2))
    u = live.unionByName(man)
    pick = lambda s, c: F.max(F.when(F.col("_s") == s, F.col(c)))
    j = u.agg(*[pick(s, c).alias(f"{p}{c}") for s, p in ((1, "l_"), (2, "m_")) for c in ("n", "s1", "s2", "x")])
    same = ((F.col("l_s1") == F.col("m_s1")) & (F.col("l_s2") == F.col("m_s2")) & (F.col("l_x") == F.col("m_x")))
    cnt = j.select(F.lit("manifest_parity").alias("pattern"), F.lit(f"{target}:rowcount").alias("target"),
                   F.when(F.col("l_n") == F.col("m_n"), "PASS").otherwise("FAIL").alias("status"),
                   F.col("m_n").cast("string").alias("expected"), F.col("l_n").cast("string").alias("actual"),
                   F.lit(False).alias("measurement"))
    dig = j.select(F.lit("manifest_parity").alias("pattern"), F.lit(f"{target}:fingerprint").alias("target"),
                   F.when(same & (F.col("l_n") == F.col("m_n")), "PASS").otherwise("FAIL").alias("status"),
                   F.col("m_s1").cast("string").alias("expected"), F.col("l_s1").cast("string").alias("actual"),
                   F.lit(False).alias("measurement"))
    return cnt.unionByName(dig).select(*CHECK_COLUMNS)


__all__ = ["run_stats_fold", "perf_assert", "perf_compare", "perf_regression", "signoff", "uncovered",
           "retention", "leaked_values", "manifest_compare"]
