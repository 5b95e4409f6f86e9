"""Parity checks: golden passes, negative twin fails for the right reason."""

from decimal import Decimal

from pyspark.sql import functions as F

from paritylake.operators import parity as P

INVOICE = "invoice_id long, contact_id long, amount decimal(12,2), op string"
ROWS = [(1, 10, Decimal("12.50"), "I"), (2, 11, Decimal("0.00"), "U"), (3, 12, Decimal("-4.10"), "U"),
        (4, 13, Decimal("99999.99"), "I"), (5, 14, Decimal("1.00"), "D")]


def _pair(spark, corrupt=False):
    src = spark.createDataFrame(ROWS, INVOICE)
    rows = list(ROWS)
    if corrupt:
        rows[2] = (3, 12, Decimal("-4.11"), "U")          # one amount off by a cent
    return src, spark.createDataFrame(rows, INVOICE)


def test_rowcount_golden_and_empty_target_twin(spark):
    src, tgt = _pair(spark)
    r = P.rowcount_parity([("same", src, tgt, None, None, 0),
                           ("empty", src, tgt, None, "op = 'X'", 0),
                           ("pct", src, tgt.where("invoice_id < 5"), None, None, "20%")])
    got = {x["pair"]: x["status"] for x in r.collect()}
    assert got == {"same": "PASS", "empty": "FAIL", "pct": "PASS"}


def test_aggregate_parity_tolerances(spark):
    src, tgt = _pair(spark, corrupt=True)
    r = P.aggregate_parity(src, tgt, [("amount", "sum", 0), ("amount", "sum", "1%"),
                                      ("invoice_id", "count", 0), ("op", "max", 0)])
    got = [x["status"] for x in r.orderBy("i").collect()]
    assert got == ["FAIL", "PASS", "PASS", "PASS"]


def test_fingerprint_golden_and_twin(spark):
    src, tgt = _pair(spark)
    assert P.fingerprint_parity(src, tgt, src.columns).first()["status"] == "PASS"
    src, bad = _pair(spark, corrupt=True)
    assert P.fingerprint_parity(src, bad, src.columns).first()["status"] == "FAIL"


def test_localize_finds_exactly_the_perturbed_keys(spark, sf0001):
    from paritylake.plans.derived import orders_tgt
    o = spark.read.parquet(f"{sf0001}/orders.parquet")
    t = orders_tgt(o)
    got = {(r["o_orderkey"], r["kind"]) for r in P.localize(o, t, o.columns, "o_orderkey", 64).collect()}
    keys = [r[0] for r in o.select("o_orderkey").collect()]
    want = set()
    for k in keys:
        if k % 97 == 0:
            want.add((k, "missing"))
        elif k % 103 == 0:
            want.add((k, "duplicated"))
        elif k % 101 == 0:
            want.add((k, "changed"))
    assert got == want


def test_localize_null_keys_and_duplicates(spark):
    a = spark.createDataFrame([(None, "x"), (1, "a"), (2, "b"), (2, "b")], "k long, v string")
    b = spark.createDataFrame([(None, "y"), (1, "a"), (2, "b")], "k long, v string")
    got = {(r["k"], r["kind"]) for r in P.localize(a, b, ["k", "v"], "k", 8).collect()}
    assert got == {(None, "changed"), (2, "under_count")}


def test_query_parity_rowset_and_scalar(spark):
    src, tgt = _pair(spark)
    assert P.query_parity(src, tgt.select(*reversed(tgt.columns)), "rowset").first()["status"] == "PASS"
    assert P.query_parity(src, tgt.where("op <> 'D'"), "rowset").first()["status"] == "FAIL"
    c1 = src.agg(F.count("*").alias("c"))
    c2 = tgt.agg((F.count("*") + 1).alias("c"))
    assert P.query_parity(c1, c2, "scalar", 1).first()["status"] == "PASS"
    assert P.query_parity(c1, c2, "scalar", 0).first()["status"] == "FAIL"


def test_a_side_of_several_fingerprints_is_hashed_once(spark):
    df = spark.range(500).selectExpr("id", "cast(id % 7 as string) AS v")
    both = P.fingerprint_parity(df, df.select("v", "id"), ["id", "v"], "self").unionByName(
        P.fingerprint_parity(df, df.where("id <> 3"), ["id", "v"], "other"))
    assert sorted((r["target"], r["status"]) for r in both.collect()) == [("other", "FAIL"), ("self", "PASS")]
    plan = both._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 2, plan


def test_strings_that_are_integers_already_take_their_number_form_unread(spark):
    from paritylake.functions.canon import _number_of_string, numeric_like
    forms = {"5": "5", "-12": "-12", "0": "0", "-0": "0", "007": "7", "+5": "5", " 5 ": "5", "5.0": "5", "9223372036854775807": "9223372036854775807",
             "9223372036854775808": "9223372036854775808", "-9223372036854775808": "-9223372036854775808", "1e3": "1000", "": "", "-": "-", "abc": "abc",
             "5a": "5a", "\x005": "\x005", None: None}
    df = spark.createDataFrame([(k,) for k in forms], "v string")
    got = {r[0]: (r[1], r[2]) for r in df.select("v", _number_of_string(F.col("v")), numeric_like(F.col("v"))).collect()}
    texts = {"", "-", "abc", "5a", "\x005"}
    assert got == {k: (v, None if k is None else k not in texts) for k, v in forms.items()}
    long_keys = spark.range(3).selectExpr("cast(id as string) AS k")
    # the patterns stand behind the cheap comparison
    plan = long_keys.select(_number_of_string(F.col("k")))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("as bigint)") < plan.find("RLIKE")
