"""Exact sums against Python's integers and fractions."""

import random
from decimal import Decimal
from fractions import Fraction

from hypothesis import given, settings, strategies as st

from paritylake.functions.exactsum import exact_totals


def plain(total: Fraction) -> str:
    """Exact decimal text of a fraction whose denominator is a power of ten."""
    digits, places = total, 0
    while digits.denominator != 1:
        digits, places = digits * 10, places + 1
    n = str(abs(digits.numerator)).rjust(places + 1, "0")
    text = n[:len(n) - places] + ("." + n[len(n) - places:] if places else "")
    return ("-" if total < 0 else "") + text


def of(spark, values, kind):
    return exact_totals(spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(3), ["v"]).first()["t0"]


def by_texts(spark, values) -> str:
    """The sum of the decimal forms that Spark writes for doubles."""
    rows = spark.createDataFrame([(v,) for v in values], "v double").selectExpr("cast(v as string) AS t").collect()
    return plain(sum(Fraction(Decimal(r["t"])) for r in rows))


def test_doubles_of_every_size(spark):
    rnd = random.Random(3)
    cases = [[6e28, 6e28], [1e30, 1e-30], [1e30, -1e30, 1e-300], [0.1, 0.2], [-0.1, 0.05], [1e308] * 20, [5e-324], [-1e20, 1.0], [0.0, -0.0], [-2.5],
             [1e19, 9.999999999999999e19] * 3, [123456.78] * 7, [0.012345678901234567], [rnd.uniform(-1, 1) * 10.0**rnd.randrange(-40, 40) for _ in range(300)]]
    for vs in cases:
        assert of(spark, vs, "double") == by_texts(spark, vs), vs
    assert of(spark, [6e28, 6e28], "double") == "12" + "0" * 28
    assert of(spark, [1e30, 1e-30], "double") == "1" + "0" * 30 + "." + "0" * 29 + "1"


def test_doubles_that_are_not_finite_or_missing(spark):
    inf, nan = float("inf"), float("nan")
    for vs, want in (([inf, 1.0], "Inf"), ([-inf, 1e40], "-Inf"), ([inf, -inf], "NaN"), ([nan, 1.0], "NaN"), ([None, None], None), ([], None), ([None, 2.0], "2")):
        assert of(spark, vs, "double") == want


def test_decimals_beyond_38_digits(spark):
    nines = Decimal("9" * 38)
    for kind, vs in (("decimal(38,0)", [nines] * 5 + [nines.copy_negate()]), ("decimal(38,38)", [Decimal("0." + "9" * 38)] * 7), ("decimal(38,20)", [Decimal("9" * 18 + "." + "9" * 20)] * 4),
                     ("decimal(38,10)", [Decimal("9" * 28 + "." + "9" * 10)] * 4 + [Decimal("-0.0000000001")]), ("decimal(12,2)", [Decimal("-1.50"), Decimal("1.25")]),
                     ("bigint", [2**63 - 1] * 4), ("int", [-5, 3])):
        assert of(spark, vs, kind) == plain(sum(Fraction(v) for v in vs)), kind


def test_text_numbers_of_any_length(spark):
    long = "1" * 25 + "." + "2" * 30
    vs = [long, "-" + long, " +7.50 ", "0003", ".5", "5.", "1e3", "x", "", "-", None, "1,000", "9" * 60]
    want = Fraction("7.5") + 3 + Fraction("0.5") + 5 + 1000 + int("9" * 60)
    assert of(spark, vs, "string") == plain(want)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=40))
def test_any_doubles(spark, vs):
    assert of(spark, vs, "double") == by_texts(spark, vs)


def test_doubles_rounded_to_places_before_the_sum(spark):
    df = spark.createDataFrame([(0.1 + 0.2,), (6e28,), (6e28,), (1e-30,)], "v double")
    assert exact_totals(df, ["v"], float_places=9).first()["t0"] == "12" + "0" * 28 + ".3"
