"""Check-result rows, tolerance text and the worst-of roll-up.

A *checks* DataFrame has the columns of ``CHECK_COLUMNS``; status is one of
PASS / FAIL / ERROR (never SKIP) and ``measurement`` rows record a value
without gating. Checks are built from one-row aggregates, so collecting them
moves a handful of rows, never table data.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

CHECK_COLUMNS = ["pattern", "target", "status", "expected", "actual", "measurement"]
CHECKS_DDL = ("pattern string, target string, status string, expected string, "
              "actual string, measurement boolean")

# fixed values: statuses and their severity order for roll-ups
PASS, FAIL, ERROR = "PASS", "FAIL", "ERROR"
SEVERITY = {PASS: 0, FAIL: 1, ERROR: 2}


def check_row(pattern: str, target: Column | str, ok: Column, expected: Column,
              actual: Column, measurement: bool = False) -> list[Column]:
    """Select items of one check row from columns of a (small) aggregate."""
    tgt = F.lit(target) if isinstance(target, str) else target
    return [F.lit(pattern).alias("pattern"), tgt.alias("target"),
            F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
            expected.cast("string").alias("expected"), actual.cast("string").alias("actual"),
            F.lit(measurement).alias("measurement")]


def error_rows(spark: SparkSession, pattern: str, target: str, message: str) -> DataFrame:
    return spark.createDataFrame([(pattern, target, ERROR, "", message, False)], CHECKS_DDL)


def union_checks(frames: list[DataFrame]) -> DataFrame:
    out = frames[0].select(*CHECK_COLUMNS)
    for f in frames[1:]:
        out = out.unionByName(f.select(*CHECK_COLUMNS))
    return out


@dataclass(frozen=True)
class Tolerance:
    """Allowed absolute delta: a number, or a percent of the source value."""
    absolute: float = 0.0
    percent: float | None = None

    def allowed(self, source: Column) -> Column:
        if self.percent is not None:
            return F.abs(source.cast("double")) * F.lit(self.percent / 100.0)
        return F.lit(float(self.absolute))


_PCT = re.compile(r"^\s*([0-9]*\.?[0-9]+)\s*%\s*$")


def parse_tolerance(tol) -> Tolerance:
    """``0`` / ``5`` / ``"0.1%"`` → Tolerance; anything else is an error."""
    if tol is None:
        return Tolerance()
    if isinstance(tol, (int, float)):
        return Tolerance(absolute=float(tol))
    m = _PCT.match(str(tol))
    if m:
        return Tolerance(percent=float(m.group(1)))
    return Tolerance(absolute=float(str(tol).strip()))


def worst_status(col: Column) -> Column:
    """Aggregate: worst status of a group (ERROR > FAIL > PASS)."""
    sev = (F.when(col == ERROR, 2).when(col == FAIL, 1).otherwise(0))
    m = F.max(sev)
    return F.when(m == 2, F.lit(ERROR)).when(m == 1, F.lit(FAIL)).otherwise(F.lit(PASS))
