"""Parity checks V1-V5: row counts, aggregates, multiset fingerprints,
localisation of differing keys, and query-result parity.

Plans are built for size: every table is scanned once per stage, hashes are
native expressions inside whole-stage codegen, aggregates are partial
(map-side) so hot keys never reach one task, and nothing is broadcast by hand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from paritylake.checks import CHECK_COLUMNS, check_row, parse_tolerance, union_checks
from paritylake.functions.canon import bucket_of, canon_col, canon_text, digest_aggs, with_row_hash
from paritylake.functions.exactsum import exact_totals
from paritylake.operators import digesttree
from paritylake.operators.digesttree import LEAF_ROWS


# ---------------------------------------------------------------- V1
def rowcount_counts(src: DataFrame, tgt: DataFrame, src_filter: str | None = None,
                    tgt_filter: str | None = None) -> DataFrame:
    """One row (src_n, tgt_n): both sides tagged and counted in ONE aggregate
    (no columns are read beyond the filters)."""
    s = src.where(src_filter) if src_filter else src
    t = tgt.where(tgt_filter) if tgt_filter else tgt
    u = s.select(F.lit(1).alias("_side")).unionByName(t.select(F.lit(2).alias("_side")))
    return u.agg(F.count_if(F.col("_side") == 1).cast("bigint").alias("src_n"),
                 F.count_if(F.col("_side") == 2).cast("bigint").alias("tgt_n"))


def rowcount_parity(pairs: list[tuple]) -> DataFrame:
    """``pairs`` of (name, src, tgt, src_filter, tgt_filter, tol) → one row each:
    name, src_n, tgt_n, delta, pct_of_source, status. All pairs in one job."""
    rows = []
    for name, src, tgt, sf, tf, tol in pairs:
        t = parse_tolerance(tol)
        c = rowcount_counts(src, tgt, sf, tf)
        delta = F.abs(F.col("src_n") - F.col("tgt_n"))
        rows.append(c.select(
            F.lit(name).alias("pair"), "src_n", "tgt_n", delta.cast("bigint").alias("delta"),
            F.round(F.when(F.col("src_n") == 0, F.lit(None))
                    .otherwise(delta * 100.0 / F.col("src_n")), 6).alias("pct_of_source"),
            F.when(delta.cast("double") <= t.allowed(F.col("src_n")), F.lit("PASS"))
            .otherwise(F.lit("FAIL")).alias("status")))
    return reduce(DataFrame.unionByName, rows)


# ---------------------------------------------------------------- V2
# value classes: how two aggregate values are compared
NUMBER, MOMENT, TEXT = "number", "moment", "text"
_COMPARE = "decimal(38,18)"
#: Places at which a double counts in a sum.
SUM_PLACES = 9


def _agg_expr(df: DataFrame, column: str, fn: str) -> tuple[Column, str]:
    """(canonical text, value class) of one aggregate but a sum; the class follows the column's type, not its text."""
    c = F.col(column)
    dt = df.schema[column].dataType
    if fn in ("count", "count_distinct"):
        return (F.count(c) if fn == "count" else F.count_distinct(c)).cast("string"), NUMBER
    if fn in ("min", "max"):
        f = F.min if fn == "min" else F.max
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            return f(F.date_trunc("second", c.cast("timestamp"))).cast("string"), MOMENT
        if isinstance(dt, T.DateType):
            return f(c).cast("timestamp").cast("string"), MOMENT
        if isinstance(dt, T.NumericType):
            return canon_text(f(c), dt), NUMBER
        return f(c).cast("string"), TEXT
    raise ValueError(f"unknown aggregate {fn}")


def aggregate_values(df: DataFrame, specs: list[tuple[str, str]], float_places: int | None = SUM_PLACES) -> DataFrame:
    """All aggregates of ``specs``, unpivoted to (i, col, fn, value text, kind), in ONE scan; sums are exact at any size (of
    doubles: at ``float_places`` places each, or as they stand with None), for which columns that may hold numbers beyond
    ``decimal(38,18)`` are looked through once more for just those."""
    plain = {i: _agg_expr(df, c, fn) for i, (c, fn) in enumerate(specs) if fn != "sum"}
    summed = [i for i, (_, fn) in enumerate(specs) if fn == "sum"]
    one = exact_totals(df, [specs[i][0] for i in summed], [e.alias(f"v{i}") for i, (e, _) in plain.items()], float_places)
    names = {i: f"t{n}" for n, i in enumerate(summed)} | {i: f"v{i}" for i in plain}
    stack = ", ".join(f"{i}, '{c}', '{fn}', {names[i]}, '{plain[i][1] if i in plain else NUMBER}'" for i, (c, fn) in enumerate(specs))
    return one.selectExpr(f"stack({len(specs)}, {stack}) AS (i, col, fn, value, kind)")


def _numbers_within(a: Column, b: Column, allowed: Column) -> Column:
    """|a - b| <= allowed for two number texts that are not equal: exact in decimals where they fit, else in doubles; with
    nothing allowed, no two texts are within it."""
    da, db = a.try_cast(_COMPARE), b.try_cast(_COMPARE)
    exact = F.try_subtract(da, db)
    near = F.coalesce(F.abs(exact).cast("double") <= allowed, F.abs(a.try_cast("double") - b.try_cast("double")) <= allowed, F.lit(False))
    return (allowed > 0) & near


def aggregate_parity(src: DataFrame, tgt: DataFrame, specs: list[tuple],
                     target: str = "table") -> DataFrame:
    """V2: per (column, fn, tol) compare source and target aggregate by position.

    Numbers: |src-tgt| <= tol (absolute or % of |src|); moments: truncated to
    the second, tolerance in seconds; other types, and values of different
    classes, exact; both NULL equal.
    """
    plain = [(c, fn) for c, fn, *_ in specs]
    tols = {i: parse_tolerance(s[2] if len(s) > 2 else 0) for i, s in enumerate(specs)}
    a = aggregate_values(src, plain).withColumnRenamed("value", "src_value").withColumnRenamed("kind", "src_kind")
    b = aggregate_values(tgt, plain).select("i", F.col("value").alias("tgt_value"), F.col("kind").alias("tgt_kind"))
    j = a.join(b, "i")
    sv, tv = F.col("src_value"), F.col("tgt_value")
    allowed = F.lit(0.0)
    for i, t in tols.items():
        allowed = F.when(F.col("i") == i, t.allowed(sv.try_cast("double")) if t.percent is not None
                         else F.lit(t.absolute)).otherwise(allowed)
    both = lambda kind: (F.col("src_kind") == kind) & (F.col("tgt_kind") == kind)
    seconds = F.abs(F.unix_seconds(sv.try_cast("timestamp")) - F.unix_seconds(tv.try_cast("timestamp"))).cast("double")
    ok = (sv.eqNullSafe(tv) | (both(NUMBER) & _numbers_within(sv, tv, allowed))
          | (both(MOMENT) & F.coalesce(seconds <= allowed, F.lit(False))))
    return j.select(F.lit("aggregate_parity").alias("pattern"),
                    F.concat_ws(".", F.lit(target), F.col("col"), F.col("fn")).alias("target"),
                    F.when(ok, "PASS").otherwise("FAIL").alias("status"),
                    sv.alias("expected"), tv.alias("actual"),
                    F.lit(False).alias("measurement"), F.col("i"))


# ---------------------------------------------------------------- V3
def fingerprint_pair(src: DataFrame, tgt: DataFrame, cols: list[str], coerce_numeric: bool = False) -> DataFrame:
    """One row with both sides' (n, s1, s2, x) digests over ``cols``: each side is folded by a partial aggregate of its own, so
    a side that several checks share is hashed once (Spark reuses its exchange), and the two rows meet."""
    sides = [with_row_hash(df, cols, coerce_numeric=coerce_numeric).agg(*digest_aggs()).withColumn("_side", F.lit(i))
             for i, df in ((1, src), (2, tgt))]
    u = sides[0].unionByName(sides[1])
    return u.agg(*[F.max(F.when(F.col("_side") == i, F.col(c))).alias(f"{p}{c}")
                   for i, p in ((1, "src_"), (2, "tgt_")) for c in ("n", "s1", "s2", "x")])


def fingerprint_parity(src: DataFrame, tgt: DataFrame, cols: list[str],
                       target: str = "table", coerce_numeric: bool = False) -> DataFrame:
    """V3: multiset equality of the canonical rows (order-free, duplicate-aware).
    ``coerce_numeric``: strings that read as numbers count as those numbers."""
    p = fingerprint_pair(src, tgt, cols, coerce_numeric)
    same = ((F.col("src_n") == F.col("tgt_n")) & (F.col("src_s1") == F.col("tgt_s1"))
            & (F.col("src_s2") == F.col("tgt_s2")) & (F.col("src_x") == F.col("tgt_x")))
    exp = F.concat_ws("/", *[F.col(f"src_{c}").cast("string") for c in ("n", "s1", "s2", "x")])
    act = F.concat_ws("/", *[F.col(f"tgt_{c}").cast("string") for c in ("n", "s1", "s2", "x")])
    return p.select(*check_row("fingerprint_parity", target, same, exp, act))


# ---------------------------------------------------------------- V4
def _side_digests(src: DataFrame, tgt: DataFrame, cols: list[str], key: str, n_buckets: int,
                  group: list, coerce_numeric: bool = False) -> DataFrame:
    """Both sides hashed, tagged, unioned and folded by ONE aggregation on
    ``group``: grouping treats NULL keys as equal, partial aggregation absorbs
    hot keys and duplicates, and no join is needed."""
    def side(df, s):
        rows = df.withColumn("_b", bucket_of(canon_col(df, key, coerce_numeric=coerce_numeric), n_buckets))
        return (with_row_hash(rows, cols, keep=[key, "_b"], coerce_numeric=coerce_numeric)
                .withColumnRenamed("_b", "b").withColumn("_side", F.lit(s)))
    u = side(src, 1).unionByName(side(tgt, 2))
    aggs = []
    z = F.lit(0).cast("decimal(38,0)")
    for s, p in ((1, "src_"), (2, "tgt_")):
        on = F.col("_side") == s
        aggs += [F.count_if(on).cast("bigint").alias(f"{p}n"),
                 F.coalesce(F.sum(F.when(on, F.col("h1").cast("decimal(38,0)"))), z).alias(f"{p}s1"),
                 F.coalesce(F.sum(F.when(on, F.col("h2").cast("decimal(38,0)"))), z).alias(f"{p}s2")]
    return u.groupBy(*group).agg(*aggs)


def _differs() -> Column:
    return ~((F.col("src_n") == F.col("tgt_n")) & (F.col("src_s1") == F.col("tgt_s1"))
             & (F.col("src_s2") == F.col("tgt_s2")))


def bucket_compare(src: DataFrame, tgt: DataFrame, cols: list[str], key: str,
                   n_buckets: int = 256, coerce_numeric: bool = False) -> DataFrame:
    """Per-bucket digests of both sides in one aggregate: (b, src_*, tgt_*, differs)."""
    return _side_digests(src, tgt, cols, key, n_buckets, ["b"], coerce_numeric=coerce_numeric).withColumn("differs", _differs())


def localize(src: DataFrame, tgt: DataFrame, cols: list[str], key: str, leaf_rows: int = LEAF_ROWS, coerce_numeric: bool = False) -> DataFrame:
    """V4: keys whose row multiset differs → (key, kind, src_n, tgt_n), by digest trees (``digesttree``).

    The number of leaves follows the rows; only rows of differing leaves are hashed by key. Duplicated rows are seen; NULL
    keys form their own group. kind ∈ missing / extra / changed / duplicated / under_count.
    """
    return digesttree.localize(src, tgt, cols, key, leaf_rows, coerce_numeric)


def localize_summary(diffs: DataFrame) -> DataFrame:
    return diffs.groupBy("kind").agg(F.count(F.lit(1)).cast("bigint").alias("keys"))


def diff_sample(diffs: DataFrame, key: str, n: int = 10) -> DataFrame:
    """First ``n`` differing keys in key order (TakeOrderedAndProject)."""
    return diffs.orderBy(F.col(key).asc_nulls_first()).limit(n)


# ---------------------------------------------------------------- V5
def align_columns(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Lower-case names; a column absent on one side becomes NULL there."""
    a = a.toDF(*[c.lower() for c in a.columns])
    b = b.toDF(*[c.lower() for c in b.columns])
    names = sorted(set(a.columns) | set(b.columns))
    for c in names:
        if c not in a.columns:
            a = a.withColumn(c, F.lit(None).cast(b.schema[c].dataType))
        if c not in b.columns:
            b = b.withColumn(c, F.lit(None).cast(a.schema[c].dataType))
    return a.select(*names), b.select(*names), names


def query_parity(a: DataFrame, b: DataFrame, mode: str = "rowset", tol=0,
                 target: str = "query", coerce_numeric: bool = False) -> DataFrame:
    """V5: ``rowset`` — multiset fingerprint over the union of result columns;
    ``scalar`` — the one cell, numbers within ``tol``, else exact; a result of
    several rows is an ERROR row."""
    if mode == "rowset":
        a2, b2, names = align_columns(a, b)
        return fingerprint_parity(a2, b2, names, target, coerce_numeric).withColumn(
            "pattern", F.lit("query_parity"))
    if mode == "scalar":
        t = parse_tolerance(tol)
        # two rows of each side are enough to tell one from several
        sides = [df.select(canon_text(F.col(df.columns[0]), df.schema[0].dataType).alias("_v"), F.lit(i).alias("_side")).limit(2)
                 for i, df in ((1, a), (2, b))]
        j = sides[0].unionByName(sides[1]).agg(
            F.max(F.when(F.col("_side") == 1, F.col("_v"))).alias("va"), F.max(F.when(F.col("_side") == 2, F.col("_v"))).alias("vb"),
            F.count_if(F.col("_side") == 1).alias("na"), F.count_if(F.col("_side") == 2).alias("nb"))
        kinds = [df.schema[0].dataType for df in (a, b)]
        numbers = all(isinstance(k, T.NumericType) for k in kinds)
        ok = F.col("va").eqNullSafe(F.col("vb"))
        if numbers:
            ok = ok | _numbers_within(F.col("va"), F.col("vb"), t.allowed(F.col("va").try_cast("double")))
        rows = check_row("query_parity", target, ok, F.col("va"), F.col("vb"))
        several = (F.col("na") > 1) | (F.col("nb") > 1)
        return j.select(*rows, several.alias("_several")).withColumn(
            "status", F.when(F.col("_several"), "ERROR").otherwise(F.col("status"))).drop("_several")
    raise ValueError(mode)


__all__ = ["rowcount_parity", "aggregate_parity", "fingerprint_parity", "bucket_compare",
           "localize", "localize_summary", "diff_sample", "query_parity", "align_columns",
           "CHECK_COLUMNS", "union_checks"]
