"""Silent-corruption checks: epoch conversion (V6), epoch quarantine (V7),
decimal round trip (V8), and the guarded conversion functions (F4, F6).

All conversions are range-guarded *before* converting, so an absurd epoch
becomes NULL instead of raising ``long overflow`` in a plain select.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, functions as F

from paritylake.functions.canon import canon_col

# fixed values: epoch units, default sane year range, compact timestamp format
UNIT_PER_SECOND = {"seconds": 1, "millis": 1_000, "micros": 1_000_000}
SANE_YEARS = (1970, 2100)
ORACLE_TS_FORMAT = "yyyyMMddHHmmss"

# violation classes of V6
MATCHED, NULL_OK, NULL_MISMATCH = "matched", "null_ok", "null_mismatch"
NULLED_OK, NOT_NULLED, LYING, MISMATCH = "nulled_ok", "not_nulled", "lying", "mismatch"
TARGET_CONFLICT = "target_conflict"


def year_bounds(unit: str, years: tuple[int, int]) -> tuple[int, int]:
    """[lo, hi) in ``unit`` covering Jan 1 of years[0] to Jan 1 of years[1]+1 (UTC)."""
    epoch = _dt.datetime(1970, 1, 1)
    lo = int((_dt.datetime(years[0], 1, 1) - epoch).total_seconds()) * UNIT_PER_SECOND[unit]
    hi = int((_dt.datetime(years[1] + 1, 1, 1) - epoch).total_seconds()) * UNIT_PER_SECOND[unit]
    return lo, hi


def epoch_to_ts(c: Column, unit: str, sane_years: tuple[int, int] = SANE_YEARS) -> Column:
    """Epoch number → TIMESTAMP; NULL when outside the sane years (never raises)."""
    lo, hi = year_bounds(unit, sane_years)
    v = c.cast("bigint")
    conv = {"seconds": F.timestamp_seconds, "millis": F.timestamp_millis,
            "micros": F.timestamp_micros}[unit]
    return F.when((v >= lo) & (v < hi), conv(v))


def ts_to_epoch_seconds(c: Column) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ → epoch seconds (UTC)."""
    return F.unix_seconds(c.cast("timestamp"))


def compact_to_ts(c: Column) -> Column:
    """``YYYYMMDDHH24MISS`` text → TIMESTAMP_NTZ; invalid text → NULL."""
    return F.try_to_timestamp(c, F.lit(ORACLE_TS_FORMAT)).cast("timestamp_ntz")


def _one_per_key(tgt: DataFrame, values: list[str]) -> DataFrame:
    """One row per ``_key``: each value, whether the key's rows disagree on it, and the number of rows."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("_rows")]
    for v in values:
        aggs += [F.min(v).alias(v), (~F.min(v).eqNullSafe(F.max(v)) | ((F.count(v) > 0) & (F.count(v) < F.count(F.lit(1)))))
                 .alias(f"{v}_conflict")]
    return tgt.groupBy("_key").agg(*aggs)


def epoch_classes(src: DataFrame, tgt: DataFrame, key: str, src_col: str, tgt_col: str,
                  unit: str, expect_years: tuple[int, int],
                  sane_years: tuple[int, int] = SANE_YEARS, oor_null: bool = True) -> DataFrame:
    """V6 per source row: (key, src value, tgt value, class).

    Every source key is looked up on the target (left join, NULL keys equal;
    target-only keys ignored). A target that repeats a key with one value
    counts once; with several values it is a conflict. NULL in must be NULL out; outside the sane years the target must
    be NULL (``oor_null``); inside but outside the expected years the column
    is lying about its unit; otherwise equal to the second.
    """
    lo, hi = year_bounds(unit, sane_years)
    s = src.select(F.col(key), F.col(src_col).cast("bigint").alias("_src"))
    t = _one_per_key(tgt.select(F.col(key).alias("_key"), F.col(tgt_col).cast("timestamp").alias("_tgt")), ["_tgt"])
    j = s.join(t, F.col(key).eqNullSafe(F.col("_key")), "left")
    v = F.col("_src")
    conv = epoch_to_ts(v, unit, sane_years)
    in_sane = (v >= lo) & (v < hi)
    yr = F.year(conv)
    sec = lambda c: F.date_trunc("second", c)
    cls = (F.when(F.col("_tgt_conflict"), F.lit(TARGET_CONFLICT))
           .when(v.isNull() & F.col("_tgt").isNull(), F.lit(NULL_OK))
           .when(v.isNull(), F.lit(NULL_MISMATCH))
           .when(~in_sane & F.col("_tgt").isNull(), F.lit(NULLED_OK if oor_null else NOT_NULLED))
           .when(~in_sane, F.lit(NOT_NULLED if oor_null else MATCHED))
           .when((yr < expect_years[0]) | (yr > expect_years[1]), F.lit(LYING))
           .when(sec(F.col("_tgt")) == sec(conv), F.lit(MATCHED))
           .otherwise(F.lit(MISMATCH)))
    return j.select(key, F.col("_src").alias(src_col), F.col("_tgt").alias(tgt_col),
                    cls.alias("class"))


def epoch_conversion(src: DataFrame, tgt: DataFrame, key: str, src_col: str, tgt_col: str,
                     unit: str, expect_years: tuple[int, int], **kw) -> tuple[DataFrame, DataFrame]:
    """V6: (violations, class counts). Violations are classes other than
    matched / null_ok / nulled_ok."""
    rows = epoch_classes(src, tgt, key, src_col, tgt_col, unit, expect_years, **kw)
    bad = rows.where(~F.col("class").isin(MATCHED, NULL_OK, NULLED_OK))
    counts = rows.groupBy("class").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return bad, counts


def audit_coverage(classes: DataFrame, audit: DataFrame, src_table: str, src_column: str) -> DataFrame:
    """V6 option: the quarantine audit must hold at least one row per nulled
    epoch of the column → one check row (expected = nulled, actual = audited)."""
    nulled = classes.where(F.col("class") == NULLED_OK).select(F.lit(1).alias("_s"))
    audited = (audit.where((F.col("src_table") == src_table) & (F.col("src_column") == src_column))
               .select(F.lit(2).alias("_s")))
    c = nulled.unionByName(audited).agg(F.count_if(F.col("_s") == 1).alias("nulled"),
                                        F.count_if(F.col("_s") == 2).alias("audited"))
    return c.select(F.lit("epoch_conversion").alias("pattern"),
                    F.lit(f"{src_table}.{src_column}:audit").alias("target"),
                    F.when(F.col("audited") >= F.col("nulled"), "PASS").otherwise("FAIL").alias("status"),
                    F.col("nulled").cast("string").alias("expected"),
                    F.col("audited").cast("string").alias("actual"), F.lit(False).alias("measurement"))


def epoch_quarantine(df: DataFrame, col: str, unit: str, id_col: str, table_name: str,
                     out_col: str | None = None,
                     sane_years: tuple[int, int] = SANE_YEARS) -> tuple[DataFrame, DataFrame]:
    """V7: converted copy with bad epochs NULL, and one audit row per bad epoch
    (src_table, src_column, row_id, reason). One scan feeds both outputs."""
    lo, hi = year_bounds(unit, sane_years)
    v = F.col(col).cast("bigint")
    clean = df.withColumn(out_col or col, epoch_to_ts(F.col(col), unit, sane_years))
    audit = df.where(v.isNotNull() & ((v < lo) | (v >= hi))).select(
        F.lit(table_name).alias("src_table"), F.lit(col).alias("src_column"),
        F.col(id_col).cast("bigint").alias("row_id"),
        F.when(v < lo, F.lit("before_sane_range")).otherwise(F.lit("after_sane_range"))
        .alias("reason"))
    return clean, audit


def decimal_roundtrip(src: DataFrame, tgt: DataFrame, key: str, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """V8: per key and column, numeric equality of the canonical number texts (1.50 = 1.5, whatever the types, at any
    number of digits); a missing target row counts as NULL, a key whose target rows
    disagree is a violation, NULL keys equal. Returns
    (violations (key, column, src_value, tgt_value, tgt_rows), per-column counts)."""
    text = lambda df, c: canon_col(df, c, coerce_numeric=True)
    s = src.select(key, *[text(src, c).alias(f"_s_{c}") for c in cols])
    t = _one_per_key(tgt.select(F.col(key).alias("_key"), *[text(tgt, c).alias(f"_t_{c}") for c in cols]), [f"_t_{c}" for c in cols])
    j = s.join(t, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("tgt_rows", F.coalesce("_rows", F.lit(0).cast("bigint")))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                               F.col(f"_s_{c}").alias("src_value"),
                               F.col(f"_t_{c}").alias("tgt_value"),
                               F.coalesce(f"_t_{c}_conflict", F.lit(False)).alias("conflict")) for c in cols])
    long = j.select(key, "tgt_rows", F.inline(pairs))
    bad = long.where(F.col("conflict") | ~F.col("src_value").eqNullSafe(F.col("tgt_value"))).drop("conflict")
    counts = bad.groupBy("column").agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
    return bad, counts
