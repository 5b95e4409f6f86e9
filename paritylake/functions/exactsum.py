"""Exact, order-free sums of numbers of any size, as native partial aggregates.

A number is digits times a power of ten: an integer or decimal as it stands, a double by the decimal form that Spark
writes for it, a text by its own digits. The digits are cut into limbs of 18 at fixed places (limb j counts units of 10^(18 j)), and each place is
summed as ``decimal(38,0)``, which takes 10^20 rows. Only the sums are carried into one text. So 6e28 + 6e28 is
120000…, 1e30 + 1e-30 keeps both ends, and neither row order nor partitioning changes a digit.

Numbers that fit ``decimal(38,18)`` exactly, nearly all there are, contribute two sums (whole part, fraction) to the
aggregate that the caller runs anyway; the limbs of the others are exploded and summed by place. Which way a number takes
does not show in the result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from paritylake.functions.canon import EXPONENT_PATTERN, NUMBER_PATTERN, numeric_like

# fixed values: digits of a limb, the type of a number that needs no limbs, places of its whole part
LIMB = 18
PLAIN = "decimal(38,18)"
PLAIN_WHOLE_DIGITS = 20
_WHOLE = "decimal(38,0)"
_PARTS = rf"^\s*([+-]?)([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?\s*$"
_FLOATS = (T.FloatType, T.DoubleType)


def is_summable(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.StringType))


def _as_text(c: Column, dtype: T.DataType) -> Column:
    """Digits of a number as text; NULL for what is no finite number."""
    if isinstance(dtype, _FLOATS):
        d = c.cast("double")
        return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d.cast("string"))
    if isinstance(dtype, T.StringType):
        return F.when(numeric_like(c), c)
    return c.cast("string")


def plain_value(c: Column, dtype: T.DataType, float_places: int | None = None) -> Column:
    """The number as ``decimal(38,18)`` where that is exact, else NULL. ``float_places``: doubles are rounded to so many places
    first; those too large for the plain type have no places to round."""
    if isinstance(dtype, _FLOATS):
        d = c.cast("double")
        if float_places is not None:
            return d.try_cast(f"decimal(38,{float_places})").try_cast(PLAIN)
        m = d.try_cast(PLAIN)
        return F.when(m.cast("double") == d, m)  # what survives the way back has lost no digit of the shortest form
    if isinstance(dtype, T.DecimalType):
        m = c.try_cast(PLAIN)  # NULL beyond its whole part
        return m if dtype.scale <= LIMB else F.when(m.try_cast(dtype.simpleString()) == c, m)
    if isinstance(dtype, T.StringType):
        part = lambda i: F.regexp_extract(c, _PARTS, i)
        short = (F.length(F.ltrim(part(2), F.lit("0"))) <= PLAIN_WHOLE_DIGITS) & (F.length(F.rtrim(part(3), F.lit("0"))) <= LIMB)
        return F.when(c.rlike(NUMBER_PATTERN) & short, c.try_cast(PLAIN)).when(c.rlike(EXPONENT_PATTERN), c.try_cast(PLAIN))
    return c.cast(PLAIN)


def plain_sums(c: Column, v: Column, dtype: T.DataType) -> Column:
    """Aggregate: what the plain values ``v`` of a column add up to, and how many values, NaN and infinities there are."""
    whole = F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v)).cast(_WHOLE)
    d = c.cast("double") if isinstance(dtype, _FLOATS) else None
    count = lambda value: F.count_if(d == F.lit(float(value))) if d is not None else F.lit(0).cast("bigint")
    return F.struct(F.sum(whole).alias("whole"), F.sum((v % F.lit(Decimal(1))).cast(PLAIN)).alias("frac"),
                    F.count(_as_text(c, dtype) if isinstance(dtype, T.StringType) else c).alias("n"),
                    count("nan").alias("nan"), count("inf").alias("pos"), count("-inf").alias("neg"))


def limbs(texts: DataFrame, text: str = "text") -> DataFrame:
    """``texts`` with the digits of each number, in signed limbs: one row ``j, v`` per place, zeros left out.

    In projections of their own, so that a text is taken apart once.
    """
    part = lambda i: F.regexp_extract(text, _PARTS, i)
    kept = [c for c in texts.columns if c != text]
    parts = texts.select(*kept, F.when(part(1) == "-", F.lit(-1)).otherwise(F.lit(1)).cast("bigint").alias("sign"), part(2).alias("whole"),
                         part(3).alias("frac"), F.coalesce(F.nullif(part(4), F.lit("")).cast("int"), F.lit(0)).alias("power"))
    power = F.col("power") - F.length("frac")
    placed = parts.select(*kept, "sign", "whole", "frac", power.alias("power"), F.floor(power / LIMB).cast("int").alias("first"))
    digits = F.concat("whole", "frac", F.repeat(F.lit("0"), F.col("power") - F.col("first") * LIMB))
    lined = placed.select(*kept, "sign", "first", digits.alias("digits"), F.greatest(F.ceil(F.length(digits) / LIMB).cast("int"), F.lit(1)).alias("count"))
    at = lambda i: (F.col("count") - i - 1) * LIMB + 1
    each = F.transform(F.sequence(F.lit(0), F.col("count") - 1), lambda i: F.struct((F.col("first") + i).alias("j"), (
        F.col("sign") * F.substring("padded", at(i), F.lit(LIMB)).try_cast("bigint")).alias("v")))
    padded = lined.withColumn("padded", F.lpad("digits", F.col("count") * LIMB, F.lit("0")))
    return padded.select(*kept, F.inline(each)).where("v <> 0")


def limb_sums(valued: DataFrame, cols: dict[int, str]) -> DataFrame:
    """``i, sums`` (map of place to sum) over the numbers that are not plain; ``cols``: column by the caller's number, whose
    plain value is the column ``_v<number>``."""
    some = valued.where(F.expr(" OR ".join(f"(`{c}` IS NOT NULL AND _v{i} IS NULL)" for i, c in cols.items())))
    texts = [F.struct(F.lit(i).alias("i"), F.when(F.col(f"_v{i}").isNull(), _as_text(F.col(c), valued.schema[c].dataType)).alias("text"))
             for i, c in cols.items()]
    rows = limbs(some.select(F.inline(F.array(*texts))).where("text IS NOT NULL"))
    return (rows.groupBy("i", "j").agg(F.sum(F.col("v").cast(_WHOLE)).alias("v"))
            .groupBy("i").agg(F.map_from_entries(F.collect_list(F.struct("j", "v"))).alias("sums")))  # a few dozen places at most


def _carried(sums: Column, low: Column, high: Column, sign: int) -> Column:
    """Digits (most significant first) of sum_j sums[j] * 10^(18 j) times ``sign``, and the last carry: 0, or -1 if it is negative."""
    base = Decimal(10) ** LIMB

    def step(acc: Column, j: Column) -> Column:
        v = (F.coalesce(F.try_element_at(sums, j.cast("int")), F.lit(0).cast(_WHOLE)) * sign + acc["carry"]).cast(_WHOLE)
        rest = F.pmod(v, F.lit(base).cast(_WHOLE)).cast(_WHOLE)
        up = ((v - rest) / F.lit(base).cast("decimal(20,0)")).cast(_WHOLE)
        return F.struct(up.alias("carry"), F.concat(F.lpad(rest.cast("string"), LIMB, "0"), acc["digits"]).alias("digits"))

    # two places above the highest take what its sum carries over
    start = F.struct(F.lit(0).cast(_WHOLE).alias("carry"), F.lit("").alias("digits"))
    return F.aggregate(F.sequence(low, high + 2), start, step)


def with_totals(one: DataFrame, totals: dict[int, Column | None]) -> DataFrame:
    """The one-row frame with the plain text of each sum (``t0``, ``t1``, ...) from its ``plain_sums`` (``_p<number>``) and its
    map of limb sums; NULL if there was no value. In steps, so that each is computed once."""
    zero = F.lit(0).cast(_WHOLE)
    none = F.map_from_arrays(F.array().cast("array<int>"), F.array().cast(f"array<{_WHOLE}>"))

    def step(df: DataFrame, name: str, value) -> DataFrame:
        return df.withColumns({f"_{name}{i}": value(i, lambda n: F.col(f"_{n}{i}")) for i in totals})

    def places(i, c):
        frac = F.regexp_replace(c("p")["frac"].cast(PLAIN).cast("string"), r"\.", "").cast(_WHOLE)
        own = F.map_from_arrays(F.array(F.lit(-1), F.lit(0)), F.array(F.coalesce(frac, zero), F.coalesce(c("p")["whole"], zero)))
        return own if totals[i] is None else F.map_zip_with(own, F.coalesce(totals[i], none), lambda j, a, b: (F.coalesce(a, zero) + F.coalesce(b, zero)).cast(_WHOLE))

    def text(i, c):
        p = c("p")
        plain = F.concat(F.when(c("neg"), F.lit("-")).otherwise(F.lit("")), F.when(c("whole") == "", F.lit("0")).otherwise(c("whole")),
                         F.when(c("part") == "", F.lit("")).otherwise(F.concat(F.lit("."), c("part"))))
        infinite = F.when((p["nan"] > 0) | ((p["pos"] > 0) & (p["neg"] > 0)), F.lit("NaN")).when(
            p["pos"] > 0, F.lit("Inf")).when(p["neg"] > 0, F.lit("-Inf"))
        return F.when(p["n"] > 0, F.coalesce(infinite, plain))

    run = step(step(one, "m", places), "ends", lambda i, c: F.sort_array(F.map_keys(c("m"))))
    low = lambda c: F.element_at(c("ends"), 1)
    high = lambda c: F.element_at(c("ends"), -1)
    run = step(run, "up", lambda i, c: _carried(c("m"), low(c), high(c), 1))
    run = step(run, "neg", lambda i, c: c("up")["carry"] < 0)
    run = step(run, "digits", lambda i, c: F.when(c("neg"), _carried(c("m"), low(c), high(c), -1)["digits"]).otherwise(c("up")["digits"]))
    run = step(run, "at", lambda i, c: F.length(c("digits")) + low(c) * LIMB)
    run = step(run, "whole", lambda i, c: F.ltrim(F.substring(c("digits"), F.lit(1), c("at")), F.lit("0")))
    run = step(run, "part", lambda i, c: F.rtrim(F.substring(c("digits"), c("at") + 1, F.length(c("digits"))), F.lit("0")))
    return run.withColumns({f"t{i}": text(i, lambda n: F.col(f"_{n}{i}")) for i in totals})


def needs_limbs(dtype: T.DataType) -> bool:
    """May a value of the type not be plain?"""
    if isinstance(dtype, T.DecimalType):
        return dtype.scale > LIMB or dtype.precision - dtype.scale > PLAIN_WHOLE_DIGITS
    return isinstance(dtype, (*_FLOATS, T.StringType))


def exact_totals(df: DataFrame, cols: list[str], others: list[Column] = (), float_places: int | None = None) -> DataFrame:
    """One row: the exact total of each column as plain text (``t0``, ``t1``, ...) beside other aggregates.

    ``float_places``: each double counts as rounded to so many places (binary noise left out); without it, as it stands.

    Texts that are no numbers count as none; a total without a value is NULL.
    """
    own = list(dict.fromkeys(cols))
    types = [df.schema[c].dataType for c in own]
    valued = df.withColumns({f"_v{i}": plain_value(F.col(c), t, float_places) for i, (c, t) in enumerate(zip(own, types))}) if own else df
    one = valued.agg(*others, *[plain_sums(F.col(c), F.col(f"_v{i}"), t).alias(f"_p{i}") for i, (c, t) in enumerate(zip(own, types))])
    kept = one.columns[:len(one.columns) - len(own)]
    wide = {i: c for i, (c, t) in enumerate(zip(own, types)) if needs_limbs(t)}
    if wide:
        rest = limb_sums(valued, wide).agg(F.map_from_entries(F.collect_list(F.struct("i", "sums"))).alias("all"))
        one = one.withColumn("_rest", rest.scalar())
    if own:
        one = with_totals(one, {i: F.try_element_at("_rest", F.lit(i)) if i in wide else None for i in range(len(own))})
    return one.select(*kept, *[F.col(f"t{own.index(c)}").alias(f"total_{i}") for i, c in enumerate(cols)]).toDF(
        *kept, *[f"t{i}" for i in range(len(cols))])
