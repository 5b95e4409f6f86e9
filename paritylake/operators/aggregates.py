"""Aggregate helpers: nearest-rank percentiles, run-statistics fold, control
totals and null profiles.

Nearest-rank percentiles are exact but never gather a group's rows: values
are first counted per (group, value) by a partial aggregate, then a running
sum over the *distinct* values of each group (see ``windows.running_sum``) finds the first value whose cumulative count
reaches ceil(p·N).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paritylake.functions.exactsum import exact_totals, is_summable

_EPS = 1e-9


def nearest_rank(df: DataFrame, group_cols: list[str], value: str, ps: list[float],
                 names: list[str] | None = None) -> DataFrame:
    """Per group: the nearest-rank percentile value for each p in ``ps``."""
    names = names or [f"p{int(round(p * 100))}" for p in ps]
    from paritylake.operators.windows import running_sum
    c = df.where(F.col(value).isNotNull()).groupBy(*group_cols, value).agg(
        F.count(F.lit(1)).alias("_c"))
    # one key column for the running sum; group sizes come from a partial aggregate
    gk = F.to_json(F.struct(*[F.col(g) for g in group_cols])) if group_cols else F.lit("")
    c = c.withColumn("_g", gk)
    n = c.groupBy("_g").agg(F.sum("_c").alias("_n"))
    cum = running_sum(c, ["_g"], [(value, "asc")], F.col("_c"), "_cum").join(n, "_g")
    aggs = []
    for p, name in zip(ps, names):
        target = F.greatest(F.ceil(F.lit(p) * F.col("_n") - F.lit(_EPS)), F.lit(1))
        aggs.append(F.min(F.when(F.col("_cum") >= target, F.col(value))).alias(name))
    return cum.groupBy(*group_cols).agg(*aggs) if group_cols else cum.agg(*aggs)


def run_stats_fold(run_log: DataFrame, keys: list[str] = ("query_id", "metric"),
                   value: str = "value") -> DataFrame:
    """p50 / p95 (nearest rank) / max / min / runs of every metric over runs."""
    keys = list(keys)
    pct = nearest_rank(run_log, keys, value, [0.5, 0.95], ["p50", "p95"])
    mm = run_log.groupBy(*keys).agg(F.max(value).alias("max"), F.min(value).alias("min"),
                                     F.count(F.lit(1)).cast("bigint").alias("runs"))
    # a group may have a NULL in its key, or no value to rank
    out = join_groups(mm, pct, keys, "left")
    return out.select(*keys, "p50", "p95", "max", "min", "runs")


def control_total(df: DataFrame, col: str) -> DataFrame:
    """(rows, total text): row count and exact sum in the number form, at any number of digits; values that are no numbers
    count as 0."""
    typed = df if is_summable(df.schema[col].dataType) else df.withColumn(col, F.col(col).cast("string"))
    one = exact_totals(typed, [col], [F.count(F.lit(1)).cast("bigint").alias("rows")])
    return one.select("rows", F.coalesce("t0", F.lit("0")).alias("total"))


def distinct_counts(df: DataFrame, groups: list[str], counted: dict[str, Column]) -> DataFrame:
    """COUNT(DISTINCT x) per group for several x: each value is reduced to its distinct (group, value) pairs on its
    own and the counts are joined on the (NULL-safe) group, so no row is expanded once per counted value."""
    out = None
    for alias, value in counted.items():
        one = (df.select(*groups, value.alias("_v")).distinct().groupBy(*groups)
               .agg(F.count("_v").cast("bigint").alias(alias)))
        out = one if out is None else join_groups(out, one, groups)
    return out


def join_groups(a: DataFrame, b: DataFrame, groups: list[str], how: str = "inner") -> DataFrame:
    """Join two group tables; NULL group values match each other."""
    b = b.select(*[F.col(g).alias(f"_b_{g}") for g in groups], *[c for c in b.columns if c not in groups])
    on = [F.col(g).eqNullSafe(F.col(f"_b_{g}")) for g in groups]
    return a.join(b, on, how).drop(*[f"_b_{g}" for g in groups])


def null_profile(df: DataFrame) -> DataFrame:
    """(col, nulls) for every column in one pass."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return one.selectExpr(f"stack({len(df.columns)}, {stack}) AS (col, nulls)")


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as a double, NULL when den is 0 or NULL (never raises)."""
    return F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0)))
