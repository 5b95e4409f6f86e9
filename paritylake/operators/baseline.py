"""Stored performance baselines (V18): versioned, established on first sight, replaced by optimistic commit.

A version is a table of statistics and its fingerprint, put in force by the manifest's atomic rename. A gate against a path
without a baseline stores the present statistics and passes as a measurement; later gates compare with what is stored. Rows
that do not agree with the fingerprint they were committed with fail every gate: a baseline is not edited in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from paritylake.checks import CHECK_COLUMNS
from paritylake.functions.canon import digest
from paritylake.operators.reporting import perf_regression
from paritylake.streaming.compaction import Manifest

STATS = "query_id string, metric string, p50 double, p95 double, max double, min double, runs long"
COLS = [c.split(" ")[0] for c in STATS.split(", ")]


def _seal(rows: DataFrame) -> str:
    """Fingerprint of the statistics as text."""
    return "/".join(str(v) for v in digest(rows.select(*COLS), COLS).first())


def stored(spark: SparkSession, path: str) -> tuple[int, DataFrame | None, bool]:
    """``(version, statistics, are they as committed)``; version 0 has none."""
    version, content = Manifest(spark, path).read()
    if not version:
        return 0, None, True
    rows = spark.read.schema(STATS).parquet(f"{path}/{content['name']}")
    return version, rows, _seal(rows) == content["seal"]


def commit(spark: SparkSession, path: str, stats: DataFrame, seen: int) -> int:
    """Put ``stats`` in force after version ``seen``; an error if another commit came first. Returns the new version."""
    name = f"stats-{uuid.uuid4().hex[:12]}"
    stats.select(*COLS).write.parquet(f"{path}/{name}")
    Manifest(spark, path).swap(seen + 1, {"name": name, "seal": _seal(spark.read.schema(STATS).parquet(f"{path}/{name}"))})
    return seen + 1


def gate(spark: SparkSession, path: str, stats: DataFrame, growth_pct: float = 0.0) -> DataFrame:
    """Check rows of ``stats`` against the stored baseline, which the first call establishes."""
    version, base, whole = stored(spark, path)
    if not version:
        commit(spark, path, stats, 0)
        base = stats.limit(0)
    rows = perf_regression(stats, base, growth_pct)
    if whole:
        return rows
    seal = F.lit("FAIL")
    return rows.withColumn("status", seal).withColumn("expected", F.lit(f"baseline version {version} as committed")).withColumn(
        "actual", F.lit("other rows")).withColumn("measurement", F.lit(False)).select(*CHECK_COLUMNS)
