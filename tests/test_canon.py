"""Canonical value rules and digests (golden values of the canonical form)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F, types as T

from paritylake.functions.canon import canon_text, digest, row_text, token


def one(spark, value, dtype):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", dtype)]))
    return df.select(canon_text(F.col("v"), dtype).alias("c")).first()[0]


def test_scalar_rules(spark):
    assert one(spark, 42, T.LongType()) == "42"
    assert one(spark, 1.5, T.DoubleType()) == "1.5"
    assert one(spark, 1.0000004, T.DoubleType()) == one(spark, 1.0, T.DoubleType())
    assert one(spark, float("nan"), T.DoubleType()) == "NaN"
    assert one(spark, float("-inf"), T.DoubleType()) == "-Inf"
    assert one(spark, True, T.BooleanType()) == "true"
    assert one(spark, dt.date(2024, 1, 2), T.DateType()) == "2024-01-02"


def test_decimal_scale_independent(spark):
    a = one(spark, Decimal("1.50"), T.DecimalType(12, 2))
    b = one(spark, Decimal("1.5000"), T.DecimalType(12, 4))
    assert a == b == "1.5" == one(spark, 1.5, T.DoubleType())


def test_one_number_has_one_text_in_every_type(spark):
    for v in (0, 7, -12, 9_007_199_254_740_993, 10**17):
        assert one(spark, v, T.LongType()) == str(v) == one(spark, Decimal(v), T.DecimalType(38, 0)) == one(spark, Decimal(v), T.DecimalType(30, 6))
    for v, text in ((1500.5, "1500.5"), (-0.25, "-0.25"), (100.0, "100"), (-0.0, "0"), (0.0000004, "0"), (-1e-7, "0"), (123456.789, "123456.789"),
                    (1e13, "10000000000000"), (-2.5e14, "-250000000000000"), (1e25, "1" + "0" * 25), (1e33, "1" + "0" * 33)):
        assert one(spark, v, T.DoubleType()) == text
    assert one(spark, 1e300, T.DoubleType()) == "1.0E300"
    tiny = T.DecimalType(38, 18)
    assert one(spark, Decimal("0.0000000001"), tiny) == "0.0000000001" != one(spark, Decimal("0.0000000002"), tiny)
    assert one(spark, Decimal("123456789012345678901234567890123456"), T.DecimalType(38, 0)) == "123456789012345678901234567890123456"


def test_numeric_strings_on_request(spark):
    texts = ["1.50", "+1.5", "001.5", " 1.5 ", "15e-1", "-0.0", ".5", "5.", "0" * 40 + "1", "1" * 60, "x1", "", "1_0", "--1", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.select(canon_text(F.col("v"), T.StringType(), coerce_numeric=True)).collect()]
    assert got == ["1.5"] * 5 + ["0", "0.5", "5", "1", "1" * 60, "x1", "", "1_0", "--1", None]


def test_numeric_types_hash_alike(spark):
    from paritylake.functions.canon import with_row_hash
    df = spark.createDataFrame([(7, "7.0")], "i long, s string")
    hashes = {tuple(with_row_hash(df.select(c.alias("v")), ["v"], coerce_numeric=True).first())
              for c in (F.col("i"), F.col("i").cast("double"), F.col("i").cast("decimal(38,18)"), F.col("s"))}
    assert len(hashes) == 1
    strict = {tuple(with_row_hash(df.select(c.alias("v")), ["v"]).first()) for c in (F.col("i"), F.col("s"))}
    assert len(strict) == 2


def test_timestamp_truncated_to_second(spark):
    a = one(spark, dt.datetime(2024, 1, 1, 0, 0, 7, 999999), T.TimestampNTZType())
    b = one(spark, dt.datetime(2024, 1, 1, 0, 0, 7), T.TimestampNTZType())
    assert a == b == str(1704067207)


def test_null_token_is_outside_the_value_domain(spark):
    sch = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([(None, "x"), ("-", "x"), ("a,b", "c"), ("a", "b,c")], sch)
    texts = [r[0] for r in df.select(row_text(df, ["a", "b"])).collect()]
    assert len(set(texts)) == 4          # NULL ≠ '-' and separators cannot shift boundaries


def test_nested_forms(spark):
    sch = T.StructType([T.StructField("m", T.MapType(T.StringType(), T.LongType())),
                        T.StructField("s", T.StructType([T.StructField("z", T.LongType()),
                                                         T.StructField("a", T.StringType())])),
                        T.StructField("arr", T.ArrayType(T.DoubleType()))])
    df = spark.createDataFrame([({"b": 2, "a": 1}, (1, "x"), [1.0, None])], sch)
    m, s, arr = df.select(*[canon_text(F.col(c), sch[c].dataType) for c in ("m", "s", "arr")]).first()
    assert m == "{1:a=1,1:b=2}"
    assert s == "{a=1:x,z=1}"
    assert arr == "[1,-]"


def test_digest_order_free_and_duplicate_sensitive(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    d1 = digest(df, ["k", "v"]).first()
    d2 = digest(df.orderBy(F.col("k").desc()), ["k", "v"]).first()
    d3 = digest(df.unionByName(df.limit(1)), ["k", "v"]).first()
    assert tuple(d1) == tuple(d2)
    assert tuple(d1) != tuple(d3)
