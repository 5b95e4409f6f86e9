"""SCD-2: build versions from ordered changes (D2) and check continuity (V9).

Both use the bucketed neighbour pass of ``paritylake.operators.windows``; the
check counts current versions with one ``groupBy(key)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paritylake.operators.windows import neighbours
from paritylake.session import materialize

# fixed values: open-ended version end and hash separator
TERMINAL_TS = "9999-12-31 00:00:00"
HASH_SEP = "|"


def row_hash_md5(cols: list[str]):
    """Stored-hash rule: md5 of the '|'-joined text of the columns (NULLs skipped)."""
    return F.md5(F.concat_ws(HASH_SEP, *[F.col(c).cast("string") for c in cols]))


def scd2_build(changes: DataFrame, key: str, ts: str, attrs: list[str],
               tie: str | None = None) -> DataFrame:
    """Versions (key, eff_from, eff_to, is_current, *attrs, row_hash).

    A version starts where the attribute tuple differs from the previous
    change of the same key (ordered by ts, tie); it ends where the next
    version starts; the last one is current and ends at the terminal.
    """
    order = [ts] + ([tie] if tie else [])
    sig = F.concat_ws("\u0001", *[F.coalesce(F.col(a).cast("string"), F.lit("\u0000"))
                                   for a in attrs])
    base = changes.select(key, *order, *[a for a in attrs if a not in order]) \
        .withColumn("_sig", sig)
    with_prev = neighbours(base, key, order, prev_cols={"_sig": "_prev_sig"})
    # kept once: the second pass reads the version starts twice, each reading would repeat the first pass
    starts = materialize(with_prev.where(F.col("_prev_sig").isNull() | (F.col("_prev_sig") != F.col("_sig"))))
    closed = neighbours(starts.drop("_prev_sig"), key, order, next_cols={ts: "_next_from"})
    terminal = F.lit(TERMINAL_TS).cast(closed.schema[ts].dataType)
    return closed.select(
        F.col(key), F.col(ts).alias("eff_from"),
        F.coalesce(F.col("_next_from"), terminal).alias("eff_to"),
        F.col("_next_from").isNull().alias("is_current"),
        *[F.col(a) for a in attrs],
        row_hash_md5([key] + attrs).alias("row_hash"))


def scd2_violations(df: DataFrame, key: str, eff_from: str = "eff_from",
                    eff_to: str = "eff_to", current: str = "is_current",
                    terminal: str = TERMINAL_TS, hash_col: str | None = "row_hash",
                    hash_cols: list[str] | None = None) -> DataFrame:
    """Row-level violations (key, eff_from, rule).

    rules: ``gap_or_overlap`` (eff_to != next eff_from, second precision),
    ``current_not_terminal``, ``terminal_not_current``, ``hash_mismatch``;
    per entity: ``current_count`` (≠ 1 current version, eff_from NULL).
    """
    w = neighbours(df, key, [eff_from], next_cols={eff_from: "_next_from"})
    sec = lambda c: F.date_trunc("second", F.col(c).cast("timestamp"))
    term_date = F.to_date(F.lit(terminal))
    rules = [
        (F.col("_next_from").isNotNull() & ~(sec(eff_to) == sec("_next_from")), "gap_or_overlap"),
        (F.col(current) & (F.to_date(F.col(eff_to)) != term_date), "current_not_terminal"),
        (~F.col(current) & (F.to_date(F.col(eff_to)) == term_date), "terminal_not_current"),
    ]
    if hash_col and hash_cols:
        rules.append((~F.col(hash_col).eqNullSafe(row_hash_md5(hash_cols)), "hash_mismatch"))
    arr = F.array(*[F.when(cond, F.lit(name)) for cond, name in rules])
    row_v = (w.select(F.col(key), F.col(eff_from).alias("eff_from"),
                      F.explode(F.array_compact(arr)).alias("rule")))
    per_key = (df.groupBy(key)
               .agg(F.count_if(F.col(current)).alias("_n_cur"))
               .where(F.col("_n_cur") != 1)
               .select(F.col(key), F.lit(None).cast(df.schema[eff_from].dataType).alias("eff_from"),
                       F.lit("current_count").alias("rule")))
    return row_v.unionByName(per_key)


def scd2_continuity(df: DataFrame, key: str, **kw) -> tuple[DataFrame, DataFrame]:
    """V9: (violations, per-rule counts)."""
    v = scd2_violations(df, key, **kw)
    return v, v.groupBy("rule").agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
