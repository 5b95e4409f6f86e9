"""Canonical value text, row hashes and multiset digests as native Columns.

Canonical text (one rule set, used on both sides of every comparison):

* numbers share one form: plain digits, no trailing zeros after the point, no
  ``-0``, so 1.5 as DECIMAL(12,2), DECIMAL(38,18) or DOUBLE and 2 as INT or
  DECIMAL agree. Integers and decimals are exact at any scale; floats are
  rounded to ``float_decimals`` places, with NaN / Inf / -Inf spelled out;
* strings, booleans, dates: their plain text. With ``coerce_numeric`` a
  string that reads as a number takes the number's form;
* timestamps: whole epoch seconds in UTC (floor — truncated to the second);
* binary: lower-case hex;
* arrays ``[a,b]``, structs ``{name=v,...}`` with fields sorted by name,
  maps as their entries sorted by key.

Each value then becomes a token and NULL the token ``-``. Text-like values
(strings, arrays, structs, maps) are length-prefixed ``<len>:<text>``; the
fixed-format texts of numbers, dates, timestamps, booleans and hex contain
no comma and are never a lone ``-``, so they need no prefix. No value can
imitate NULL and no separator inside a value can shift column boundaries.
A row digest is the md5 of the comma-joined tokens; two 60-bit lanes of it
are summed (as decimal(38,0)) and xor-ed by the digest aggregates, which are
order-independent and duplicate-sensitive.

Hashing is staged in three projections (canonical texts → md5 → lanes):
Catalyst does not inline a non-cheap expression used twice, so each text and
the md5 are computed once per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

# fixed values of the canonical form
NULL_TOKEN = "-"
FLOAT_DECIMALS = 6
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"
EXPONENT_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+\s*$"
LONG_SAFE = 9.0e18
LANE_HEX_DIGITS = 15

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def _stripped(text: Column) -> Column:
    """Plain decimal text (with a point) without trailing zeros."""
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def _scaled_text(r: Column, places: int) -> Column:
    """Number form of the integer ``r`` divided by 10^places: a decimal's text, which takes little generated code."""
    return _stripped((r.cast("decimal(19,0)") * F.lit(Decimal(1).scaleb(-places))).cast("string"))


def _bound(value: Column, body) -> Column:
    """``body(v)`` with ``value`` computed once: inside a lambda, Spark computes a repeated expression each time."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def float_rounded(c: Column, float_decimals: int = FLOAT_DECIMALS) -> Column:
    """A float times 10^float_decimals as an integer, half away from zero on the binary value; NULL outside the long range."""
    y = c.cast("double") * F.lit(float(10 ** float_decimals))
    # in long arithmetic: Spark's round() on doubles goes through BigDecimal and is far slower
    t = y.try_cast("bigint")
    frac = y - t.cast("double")
    r = t + F.when(frac >= 0.5, F.lit(1)).when(frac <= -0.5, F.lit(-1)).otherwise(F.lit(0))
    return F.when(F.abs(y) < F.lit(LONG_SAFE), r)


def float_text_of(c: Column, rounded: Column, float_decimals: int = FLOAT_DECIMALS) -> Column:
    """Number form of a float from its ``float_rounded`` value."""
    # outside the long range: plain digits while they fit, else the shortest form; Infinity is spelled Inf
    other = F.coalesce(_stripped(c.try_cast("decimal(38,4)").cast("string")), F.replace(c.cast("string"), F.lit("inity")))
    return F.coalesce(_scaled_text(rounded, float_decimals), other)


def float_text(c: Column, float_decimals: int = FLOAT_DECIMALS, nested: bool = False) -> Column:
    """Number form of a float rounded to ``float_decimals`` places. ``nested``: the column is a lambda's variable."""
    if nested:
        return _bound(float_rounded(c, float_decimals), lambda r: float_text_of(c, r, float_decimals))
    return float_text_of(c, float_rounded(c, float_decimals), float_decimals)


def _plain_integer(c: Column) -> Column:
    """Is the string an integer in number form already? Most keys kept as strings are, and need none of the patterns below."""
    return F.coalesce(c.try_cast("bigint").cast("string") == c, F.lit(False))


def numeric_like(c: Column) -> Column:
    """Does the string read as a number?"""
    return _plain_integer(c) | c.rlike(NUMBER_PATTERN) | (c.rlike(EXPONENT_PATTERN) & c.try_cast("decimal(38,18)").isNotNull())


def _number_of_string(c: Column) -> Column:
    """Number form of a numeric-looking string, of any length; other strings as they are."""
    t = F.trim(F.regexp_replace(c, r"\s", ""))
    sign = F.when(t.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    body = F.regexp_replace(t, "^[+-]", "")
    whole = F.ltrim(F.split_part(body, F.lit("."), F.lit(1)), F.lit("0"))
    frac = F.rtrim(F.split_part(body, F.lit("."), F.lit(2)), F.lit("0"))
    digits = F.concat(F.when(whole == "", F.lit("0")).otherwise(whole), F.when(frac == "", F.lit("")).otherwise(F.concat(F.lit("."), frac)))
    plain = F.when(digits == "0", digits).otherwise(F.concat(sign, digits))
    return (F.when(_plain_integer(c), c).when(c.rlike(NUMBER_PATTERN), plain)
            .when(c.rlike(EXPONENT_PATTERN), F.coalesce(_stripped(c.try_cast("decimal(38,18)").cast("string")), c))
            .otherwise(c))


def canon_text(c: Column, dtype: T.DataType, float_decimals: int = FLOAT_DECIMALS,
               coerce_numeric: bool = False, nested: bool = False) -> Column:
    """Canonical text of one value; NULL in gives NULL out. ``nested``: ``c`` is a lambda's variable."""
    if isinstance(dtype, _INTS):
        return c.cast("string")
    if isinstance(dtype, _FLOATS):
        return float_text(c, float_decimals, nested)
    if isinstance(dtype, T.DecimalType):
        return _stripped(c.cast("string")) if dtype.scale > 0 else c.cast("string")
    if isinstance(dtype, T.StringType):
        return _number_of_string(c) if coerce_numeric else c
    if isinstance(dtype, T.BooleanType):
        return c.cast("string")
    if isinstance(dtype, T.DateType):
        return c.cast("string")
    if isinstance(dtype, T.TimestampType):
        return F.floor(F.unix_micros(c) / F.lit(1_000_000)).cast("string")
    if isinstance(dtype, T.TimestampNTZType):
        return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000)).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(c))
    if isinstance(dtype, T.ArrayType):
        et = dtype.elementType
        inner = F.transform(c, lambda x: token(x, et, float_decimals, nested=True))
        return F.concat(F.lit("["), F.array_join(inner, ","), F.lit("]"))
    if isinstance(dtype, T.StructType):
        parts = []
        for f in sorted(dtype.fields, key=lambda f: f.name.lower()):
            parts.append(F.concat(F.lit(f.name.lower() + "="),
                                  token(c.getField(f.name), f.dataType, float_decimals)))
        return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    if isinstance(dtype, T.MapType):
        kt, vt = dtype.keyType, dtype.valueType
        entries = F.array_sort(F.map_entries(c))
        inner = F.transform(entries, lambda e: F.concat(
            token(e.getField("key"), kt, float_decimals), F.lit("="),
            token(e.getField("value"), vt, float_decimals)))
        return F.concat(F.lit("{"), F.array_join(inner, ","), F.lit("}"))
    raise TypeError(f"no canonical form for {dtype.simpleString()}")


_FIXED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
          T.DecimalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType)


def is_fixed_format(dtype: T.DataType) -> bool:
    return isinstance(dtype, _FIXED)


def token_of_text(t: Column, dtype: T.DataType, coerce_numeric: bool = False) -> Column:
    """Token from an already computed canonical text (NULL text = NULL value).
    A coerced string that reads as a number takes the number's token."""
    if is_fixed_format(dtype):
        return F.when(t.isNull(), F.lit(NULL_TOKEN)).otherwise(t)   # two uses keep the text a projection of its own
    prefixed = F.concat(F.length(t).cast("string"), F.lit(":"), t)
    if coerce_numeric and isinstance(dtype, T.StringType):
        prefixed = F.when(numeric_like(t), t).otherwise(prefixed)
    return F.coalesce(prefixed, F.lit(NULL_TOKEN))


def token(c: Column, dtype: T.DataType, float_decimals: int = FLOAT_DECIMALS, nested: bool = False) -> Column:
    """Canonical token of one value; NULL becomes the NULL token."""
    return token_of_text(canon_text(c, dtype, float_decimals, nested=nested), dtype)


def canon_col(df: DataFrame, name: str, float_decimals: int = FLOAT_DECIMALS,
              coerce_numeric: bool = False) -> Column:
    """Canonical text of column ``name`` of ``df`` (type taken from the schema)."""
    return canon_text(F.col(name), df.schema[name].dataType, float_decimals, coerce_numeric)


def row_text(df: DataFrame, cols: list[str], float_decimals: int = FLOAT_DECIMALS) -> Column:
    """Canonical row text over ``cols`` in the given order."""
    return F.concat_ws(",", *[token(F.col(c), df.schema[c].dataType, float_decimals)
                              for c in cols])


def lanes(md5_hex: Column) -> tuple[Column, Column]:
    """Two independent 60-bit integers from an md5 hex string."""
    h1 = F.conv(F.substring(md5_hex, 1, LANE_HEX_DIGITS), 16, 10).cast("bigint")
    h2 = F.conv(F.substring(md5_hex, 1 + LANE_HEX_DIGITS, LANE_HEX_DIGITS), 16, 10).cast("bigint")
    return h1, h2


def with_row_hash(df: DataFrame, cols: list[str], float_decimals: int = FLOAT_DECIMALS,
                  keep: list[str] | None = None, coerce_numeric: bool = False) -> DataFrame:
    """Project ``keep`` columns plus the two hash lanes ``h1``, ``h2``."""
    keep = list(keep or [])
    types = [df.schema[c].dataType for c in cols]
    floats = [isinstance(t, _FLOATS) for t in types]
    # floats are rounded in a projection of their own: the text needs the value twice
    kept, at = [F.col(k) for k in keep], [i for i, f in enumerate(floats) if f]
    values = df.select(*kept, *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)], *[float_rounded(F.col(cols[i]), float_decimals).alias(f"_r{i}") for i in at])
    texts = values.select(*kept, *[
        (float_text_of(F.col(f"_c{i}"), F.col(f"_r{i}"), float_decimals) if floats[i]
         else canon_text(F.col(f"_c{i}"), t, float_decimals, coerce_numeric)).alias(f"_t{i}") for i, t in enumerate(types)])
    hashed = texts.select(*[F.col(k) for k in keep], F.md5(F.concat_ws(",", *[
        token_of_text(F.col(f"_t{i}"), t, coerce_numeric) for i, t in enumerate(types)])).alias("_m"))
    h1, h2 = lanes(F.col("_m"))
    return hashed.select(*[F.col(k) for k in keep], h1.alias("h1"), h2.alias("h2"))


def digest_aggs(prefix: str = "") -> list[Column]:
    """(n, s1, s2, x) over ``h1``/``h2`` — partial-aggregatable, order-free."""
    return [F.count(F.lit(1)).cast("bigint").alias(f"{prefix}n"),
            F.coalesce(F.sum(F.col("h1").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
            .alias(f"{prefix}s1"),
            F.coalesce(F.sum(F.col("h2").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
            .alias(f"{prefix}s2"),
            F.coalesce(F.bit_xor(F.col("h1")), F.lit(0).cast("bigint")).alias(f"{prefix}x")]


def digest(df: DataFrame, cols: list[str], float_decimals: int = FLOAT_DECIMALS) -> DataFrame:
    """One-row multiset fingerprint (n, s1, s2, x) of ``df`` over ``cols``."""
    return with_row_hash(df, cols, float_decimals).agg(*digest_aggs())


def pushdown_digest(df: DataFrame, cols: list[str]) -> DataFrame:
    """Single-lane form: (n, sum of the first 60-bit lane)."""
    h = with_row_hash(df, cols)
    return h.agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                 F.coalesce(F.sum(F.col("h1").cast("decimal(38,0)")),
                            F.lit(0).cast("decimal(38,0)")).alias("s1"))


def bucket_of(key_text: Column, n_buckets: int) -> Column:
    """Bucket of a key by the first lane of the md5 of its canonical text; NULL keys → -1."""
    kh = F.conv(F.substring(F.md5(key_text), 1, LANE_HEX_DIGITS), 16, 10).cast("bigint")
    return F.when(key_text.isNull(), F.lit(-1)).otherwise(F.pmod(kh, F.lit(n_buckets))).cast("int")


def bucket_digest(df: DataFrame, cols: list[str], key: str, n_buckets: int = 256) -> DataFrame:
    """Per-bucket (b, n, s1, s2): one partial aggregate, at most n+1 rows."""
    h = with_row_hash(df, cols, keep=[key])
    h = h.withColumn("b", bucket_of(canon_col(h, key), n_buckets))
    return h.groupBy("b").agg(*digest_aggs()[:3])
