"""V12 foreign-key orphan parity.

Orphans are child rows without a parent (a NULL child key is an orphan).
Counting is skew-proof: child rows are first reduced to (key, rows) by a
partial aggregate, so a key holding a third of the table is one row before
the anti join; duplicate parents (e.g. SCD-2 versions) are reduced to
distinct keys and do not change the count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def orphan_counts(child: DataFrame, parent: DataFrame, child_key: str,
                  parent_key: str) -> DataFrame:
    """One row (rows, orphans) for a child/parent pair."""
    ck = child.groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    pk = (parent.select(F.col(parent_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
          .withColumn("_hit", F.lit(True)))
    j = ck.join(pk, "_k", "left")
    return j.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
                 F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0))
                 .cast("bigint").alias("orphans"))


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """The orphan child rows themselves (left anti join keeps NULL keys)."""
    pk = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(pk, F.col(child_key) == F.col("_pk"), "left_anti")


def fk_orphan(name: str, src_child: DataFrame, src_parent: DataFrame, tgt_child: DataFrame,
              tgt_parent: DataFrame, child_key: str, parent_key: str, tol_pp: float = 0.0,
              max_rate: float | None = None) -> DataFrame:
    """Orphan rate on each side; |Δ rate| ≤ tol_pp percentage points and, when
    given, the target rate ≤ ``max_rate`` percent. Empty child → rate 0."""
    s = orphan_counts(src_child, src_parent, child_key, parent_key).withColumn("_side", F.lit(1))
    t = orphan_counts(tgt_child, tgt_parent, child_key, parent_key).withColumn("_side", F.lit(2))
    pick = lambda side, c: F.max(F.when(F.col("_side") == side, F.col(c)))
    both = s.unionByName(t).agg(pick(1, "rows").alias("src_rows"), pick(1, "orphans").alias("src_orphans"),
                                pick(2, "rows").alias("tgt_rows"), pick(2, "orphans").alias("tgt_orphans"))
    rate = lambda o, r: F.when(F.col(r) == 0, F.lit(0.0)).otherwise(
        F.col(o).cast("double") * 100.0 / F.col(r).cast("double"))
    j = both.select("*", rate("src_orphans", "src_rows").alias("_sr"),
                    rate("tgt_orphans", "tgt_rows").alias("_tr"))
    ok = F.abs(F.col("_sr") - F.col("_tr")) <= F.lit(float(tol_pp))
    if max_rate is not None:
        ok = ok & (F.col("_tr") <= F.lit(float(max_rate)))
    return j.select(F.lit(name).alias("relation"), "src_rows", "src_orphans", "tgt_rows",
                    "tgt_orphans", F.round("_sr", 6).alias("src_rate_pct"),
                    F.round("_tr", 6).alias("tgt_rate_pct"),
                    F.when(ok, "PASS").otherwise("FAIL").alias("status"))
