"""Transform checks: given → expect (V16), old-versus-new SQL (V17), typed
seeding of declared rows (S5), uniqueness and NULL asserts (A9, A10).

Multiset comparisons count each distinct row on both sides and join the
counts (one shuffle), never a driver-side diff.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paritylake.operators.parity import align_columns


def multiset_diff(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """Rows whose multiplicity differs: cols + side ('only_a'/'only_b') + copies.
    Both sides are tagged +1/-1 and summed per distinct row in ONE aggregation
    (NULLs group together; partial aggregation absorbs repeated rows)."""
    u = (a.select(*cols, F.lit(1).alias("_w"))
         .unionByName(b.select(*cols, F.lit(-1).alias("_w"))))
    g = u.groupBy(*cols).agg(F.sum("_w").alias("_d"))
    return g.where(F.col("_d") != 0).select(
        *cols, F.when(F.col("_d") > 0, F.lit("only_a")).otherwise(F.lit("only_b")).alias("side"),
        F.abs(F.col("_d")).cast("bigint").alias("copies"))


def expect_rows(actual: DataFrame, expected: DataFrame, cols: list[str] | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """V16 compare on the *expected* columns only: (missing, unexpected)."""
    cols = cols or expected.columns
    d = multiset_diff(expected.select(*cols), actual.select(*cols), cols)
    return (d.where("side = 'only_a'").drop("side"), d.where("side = 'only_b'").drop("side"))


def assert_properties(df: DataFrame, target: str, rowcount: int | None = None,
                      unique: list[str] | None = None,
                      no_nulls: list[str] | None = None) -> DataFrame:
    """rowcount / unique-key / no-NULL asserts in ONE aggregate → check rows.
    Uniqueness counts NULLs as a value (distinct over a struct)."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("_rows")]
    if unique:
        aggs.append(F.count_distinct(F.struct(*[F.col(c) for c in unique])).cast("bigint")
                    .alias("_distinct"))
    for c in no_nulls or []:
        aggs.append(F.count_if(F.col(c).isNull()).cast("bigint").alias(f"_null_{c}"))
    one = df.agg(*aggs)
    rows = []
    if rowcount is not None:
        rows.append(("rowcount", F.col("_rows") == rowcount, F.lit(str(rowcount)), F.col("_rows")))
    if unique:
        rows.append((f"unique({','.join(unique)})", F.col("_rows") == F.col("_distinct"),
                     F.col("_rows"), F.col("_distinct")))
    for c in no_nulls or []:
        rows.append((f"no_nulls({c})", F.col(f"_null_{c}") == 0, F.lit("0"), F.col(f"_null_{c}")))
    out = None
    for name, ok, exp, act in rows:
        r = one.select(F.lit("transform_unit").alias("pattern"),
                       F.lit(f"{target}:{name}").alias("target"),
                       F.when(ok, "PASS").otherwise("FAIL").alias("status"),
                       exp.cast("string").alias("expected"), act.cast("string").alias("actual"),
                       F.lit(False).alias("measurement"))
        out = r if out is None else out.unionByName(r)
    return out


def transform_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Lower-cased names, multiset equality over BOTH column sets (a column
    present on one side only is NULL on the other, so it cannot pass unseen)."""
    a2, b2, names = align_columns(a, b)
    return multiset_diff(a2, b2, names)


_PARSE = {
    "bigint": lambda c: c.cast("bigint"), "int": lambda c: c.cast("int"),
    "double": lambda c: c.cast("double"), "string": lambda c: c,
    "date": lambda c: F.to_date(c), "timestamp": lambda c: F.to_timestamp(c),
}


def typed_from_text(df: DataFrame, schema: list[tuple[str, str]]) -> DataFrame:
    """String columns → declared types (decimals, bool, ISO dates and
    timestamps); an absent column becomes NULL of its type."""
    sel = []
    for name, typ in schema:
        if name not in df.columns:
            sel.append(F.lit(None).cast(typ).alias(name))
            continue
        c = F.col(name)
        if typ.startswith("decimal"):
            v = c.cast(typ)
        elif typ == "boolean":
            v = F.when(c.isNull(), F.lit(None).cast("boolean")).otherwise(
                F.lower(F.trim(c)).isin("true", "1", "t", "yes"))
        else:
            v = _PARSE.get(typ, lambda x: x.cast(typ))(c)
        sel.append(v.alias(name))
    return df.select(*sel)


def seed_given(spark: SparkSession, schema: list[tuple[str, str]], rows: list[dict]) -> DataFrame:
    """Declared columns + literal rows (values as text) → typed DataFrame."""
    st = T.StructType([T.StructField(n, T.StringType(), True) for n, _ in schema])
    data = [tuple(None if r.get(n) is None else str(r.get(n)) for n, _ in schema) for r in rows]
    return typed_from_text(spark.createDataFrame(data, st), schema)
