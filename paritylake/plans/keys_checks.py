"""Registered queries for encoding, SCD-2, merge, foreign-key and transform
checks (V6-V12, V16, V17, D1, D2, W1, X2, J4, J5, J11, A9, A10, S5, S6, F4,
F6) with their DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from paritylake.operators import encoding as E
from paritylake.operators import fk as FK
from paritylake.operators import merge as M
from paritylake.operators import scd2 as S
from paritylake.operators import transform as TR
from paritylake.plans import derived as D
from paritylake.plans.oracle import (ORDERS_DELTA, ORDERS_EPOCH, ORDERS_SNAPSHOT, ORDERS_TGT,
                                     EVENTS_SCD2, EVENTS_SCD2_BROKEN, hashed)
from paritylake.functions.canon_sql import stripped_sql, digest_aggs_sql
from paritylake.session import materialize
from paritylake.sources.tables import table, register_views

EXPECT_YEARS = (1990, 2030)


def _orders(spark, sf):
    return table(spark, sf, "orders")


# ------------------------------------------------------------------ V6 / V7 / V8
def q_epoch_conversion(spark, sf):
    o = _orders(spark, sf)
    src = D.orders_epoch(o)
    k = F.col("o_orderkey")
    # a target that repeats keys: with the same date (counted once) and with another one (a conflict)
    tgt = (o.select("o_orderkey", "o_orderdate").unionByName(o.where(k % 109 == 0).select("o_orderkey", "o_orderdate"))
           .unionByName(o.where(k % 113 == 0).select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("o_orderdate"))))
    out = None
    for unit in ("millis", "seconds"):
        rows = E.epoch_classes(src, tgt, "o_orderkey", "issued_sec", "o_orderdate", unit, EXPECT_YEARS)
        c = rows.groupBy("class").agg(F.count(F.lit(1)).cast("bigint").alias("n")) \
            .select(F.lit(unit).alias("unit"), "class", "n")
        out = c if out is None else out.unionByName(c)
    return out


def q_epoch_quarantine(spark, sf):
    src = D.orders_epoch(_orders(spark, sf))
    _, audit = E.epoch_quarantine(src, "issued_sec", "millis", "o_orderkey", "orders_epoch",
                                  out_col="issued_ts")
    return audit


def q_decimal_roundtrip(spark, sf):
    o = _orders(spark, sf)
    src = D.orders_target_snapshot(o)
    tgt = D.orders_target_snapshot(D.orders_tgt(o))
    # a target that repeats a key with another amount
    again = tgt.where(F.col("o_orderkey") % 107 == 1).withColumn("amount", (F.col("amount") + 1).cast("decimal(14,2)"))
    tgt = tgt.unionByName(again)
    bad, _ = E.decimal_roundtrip(src, tgt, "o_orderkey", ["amount", "o_custkey"])
    plain = lambda c: F.col(c).cast("decimal(38,18)").cast("string").alias(c)
    # twins that differ in the 20th place, and in the last of 25 digits; one side as text
    k = F.col("o_orderkey")
    deep = o.select("o_orderkey", F.col("o_totalprice").cast("decimal(14,2)").cast("decimal(38,20)").alias("place_20"),
                    (F.lit(str(10**24)).cast("decimal(38,0)") + k).cast("decimal(38,0)").alias("digits_25"))
    # in the target's text, as decimal arithmetic would round it away
    tail = F.when(k % 113 == 0, F.lit("0" * 17 + "1")).otherwise(F.lit("0" * 18))
    twin = o.select("o_orderkey", F.concat(F.col("o_totalprice").cast("decimal(14,2)").cast("string"), tail).cast("decimal(38,20)").alias("place_20"),
                    (F.lit(str(10**24)).cast("decimal(38,0)") + k + F.when(k % 127 == 0, 1).otherwise(0)).cast("decimal(38,0)").cast("string").alias("digits_25"))
    more, _ = E.decimal_roundtrip(deep, twin, "o_orderkey", ["place_20", "digits_25"])
    return bad.select("o_orderkey", "column", plain("src_value"), plain("tgt_value"), "tgt_rows").unionByName(more)


def q_fn_epoch(spark, sf):
    src = D.orders_epoch(_orders(spark, sf))
    ts = E.epoch_to_ts(F.col("issued_sec"), "millis")
    secs = E.ts_to_epoch_seconds(ts)
    return src.select(
        "o_orderkey", "issued_sec", ts.cast("timestamp_ntz").alias("issued_ts"),
        secs.alias("epoch_s"),
        E.epoch_to_ts(secs, "seconds").cast("timestamp_ntz").alias("from_seconds"),
        E.epoch_to_ts(secs * 1_000_000, "micros").cast("timestamp_ntz").alias("from_micros"))


def q_fn_oracle_ts(spark, sf):
    o = _orders(spark, sf)
    k = F.col("o_orderkey")
    good = F.date_format(F.col("o_orderdate"), E.ORACLE_TS_FORMAT)
    raw = F.when(k % 89 == 0, F.concat(F.substring(good, 1, 4), F.lit("13"), F.substring(good, 7, 8))) \
        .otherwise(good)
    return o.select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw", E.compact_to_ts(F.col("raw")).alias("parsed"))


# ------------------------------------------------------------------ SCD-2
def q_scd2_build(spark, sf):
    return D.events_scd2(table(spark, sf, "events"))


def q_scd2_continuity(spark, sf):
    built = D.events_scd2(table(spark, sf, "events"))     # one build, kept, for both variants and all rules
    out = None
    for variant, v in (("golden", built), ("broken", D.broken_scd2(built))):
        _, counts = S.scd2_continuity(v, "user_id", hash_col="row_hash",
                                      hash_cols=["user_id", "event_type"])
        c = counts.select(F.lit(variant).alias("variant"), "rule", "violations")
        out = c if out is None else out.unionByName(c)
    return out


def q_adjacent_versions(spark, sf):
    """Each version's eff_to next to the following eff_from (broken twin)."""
    v = D.broken_scd2(D.events_scd2(table(spark, sf, "events")))
    from paritylake.operators.windows import neighbours
    n = neighbours(v, "user_id", ["eff_from"], next_cols={"eff_from": "next_from"})
    return n.select("user_id", "eff_from", "eff_to", "next_from",
                    (F.col("next_from").isNotNull() & (F.col("eff_to") != F.col("next_from")))
                    .alias("broken_link"))


def q_latest_version(spark, sf):
    """W1 at scale: max_by per key (partial aggregation), no per-key sort."""
    ev = table(spark, sf, "events")
    r = ev.groupBy("user_id").agg(F.max_by(F.struct("event_id", "ts", "event_type", "value"),
                                           F.struct("ts", "event_id")).alias("r"))
    return r.select("user_id", "r.event_id", "r.ts", "r.event_type", "r.value")


# ------------------------------------------------------------------ merge family
def _delta(spark, sf):
    return D.orders_delta(_orders(spark, sf))


def q_delta_latest(spark, sf):
    return M.delta_latest(_delta(spark, sf), ["o_orderkey"], ["change_ms"])


def _dirty_latest(o):
    """The reduced feed with refused rows among it: every thousandth key twice, some rows without a key."""
    latest = M.delta_latest(D.orders_delta(o), ["o_orderkey"], ["change_ms"])
    k = F.col("o_orderkey")
    no_key = F.lit(None).cast(latest.schema["o_orderkey"].dataType)
    return (latest.unionByName(latest.where(k % 1000 == 1))
            .unionByName(latest.where(k % 700 == 10).withColumn("o_orderkey", no_key)))


def q_merge_apply(spark, sf):
    o = _orders(spark, sf)
    out = M.merge_apply(D.orders_target_snapshot(o), _dirty_latest(o), ["o_orderkey"])
    return out.withColumn("amount", F.col("amount").cast("string"))


def q_merge_idempotency(spark, sf):
    o = _orders(spark, sf)
    t = D.orders_target_snapshot(o)
    latest = materialize(M.delta_latest(D.orders_delta(o), ["o_orderkey"], ["change_ms"]))   # kept: four merges read it
    good = M.merge_idempotency(t, latest, ["o_orderkey"]).withColumn(
        "target", F.concat(F.lit("merge:"), F.col("target")))
    bad = M.merge_idempotency(t, latest, ["o_orderkey"],
                              merge_fn=lambda a, d: M.append_merge(a, d, ["o_orderkey"])) \
        .withColumn("target", F.concat(F.lit("append:"), F.col("target")))
    return good.unionByName(bad)


def q_upsert_split(spark, sf):
    o = _orders(spark, sf)
    t = D.orders_target_snapshot(o)
    dirty = _dirty_latest(o)
    acts = M.merge_actions(t, dirty, ["o_orderkey"])
    res = M.merge_apply(t, dirty, ["o_orderkey"])
    keys = res.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("c"))
    dup = keys.agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).cast("bigint").alias("n")).select(F.lit("duplicate_keys").alias("action"), "n")
    refused = M.merge_refusals(dirty, ["o_orderkey"], "refused").select(F.col("target").alias("action"), F.col("actual").cast("bigint").alias("n"))
    return acts.unionByName(dup).unionByName(refused)


def q_delete_keys_present(spark, sf):
    o = _orders(spark, sf)
    t = D.orders_target_snapshot(o)
    delta = D.orders_delta(o)
    latest = M.delta_latest(delta, ["o_orderkey"], ["change_ms"])
    before = M.delete_keys_present(t, delta, ["o_orderkey"]).select(F.lit("before").alias("stage"), "n")
    after = M.delete_keys_present(M.merge_apply(t, latest, ["o_orderkey"]), delta, ["o_orderkey"]) \
        .select(F.lit("after").alias("stage"), "n")
    return before.unionByName(after)


# ------------------------------------------------------------------ FK / joins
def q_fk_orphan(spark, sf):
    o, c = _orders(spark, sf), table(spark, sf, "customer")
    li = table(spark, sf, "lineitem")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    t = D.orders_tgt(o)
    return (FK.fk_orphan("orders->customer", o, c, t, c.where(F.col("c_custkey") % 13 != 0),
                         "o_custkey", "c_custkey")
            .unionByName(FK.fk_orphan("lineitem->orders", li, o, li, t, "l_orderkey",
                                      "o_orderkey", tol_pp=2.0))
            .unionByName(FK.fk_orphan("documents->labels", docs, labels, docs, labels, "doc_id",
                                      "doc_id", max_rate=50.0)))


def q_fk_anti(spark, sf):
    li = table(spark, sf, "lineitem")
    t = D.orders_tgt(_orders(spark, sf))
    return FK.orphan_rows(li, t, "l_orderkey", "o_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


def q_keyed_lookup(spark, sf):
    o = _orders(spark, sf)
    t = D.orders_tgt(o).select("o_orderkey", F.col("o_totalprice").alias("tgt_price"))
    return o.select("o_orderkey", F.col("o_totalprice").alias("src_price")) \
        .join(t, "o_orderkey", "left")


# ------------------------------------------------------------------ A9 / A10
UNIQUE_KEYS = [("lineitem", ["l_orderkey", "l_linenumber"]), ("orders", ["o_orderkey"]),
               ("events", ["event_id"]), ("conversations", ["conv_id", "turn"]),
               ("documents", ["doc_id"])]


def q_unique_key_check(spark, sf):
    out = None
    for tbl, keys in UNIQUE_KEYS:
        d = table(spark, sf, tbl).agg(
            F.count(F.lit(1)).cast("bigint").alias("rows"),
            F.count_distinct(F.struct(*[F.col(k) for k in keys])).cast("bigint").alias("distinct_keys"))
        d = d.select(F.lit(tbl).alias("tbl"), F.lit(",".join(keys)).alias("keys"), "rows",
                     "distinct_keys", (F.col("rows") - F.col("distinct_keys")).alias("dup_rows"))
        out = d if out is None else out.unionByName(d)
    return out


NULL_TABLES = ["orders", "lineitem", "events", "documents", "labels", "customer"]


def q_null_count(spark, sf):
    out = None
    for tbl in NULL_TABLES:
        df = table(spark, sf, tbl)
        one = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in df.columns])
        stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
        long = one.selectExpr(f"stack({len(df.columns)}, {stack}) AS (col, nulls)") \
            .select(F.lit(tbl).alias("tbl"), "col", "nulls")
        out = long if out is None else out.unionByName(long)
    return out


# ------------------------------------------------------------------ V16 / V17 / S5 / S6
def q_transform_unit(spark, sf):
    delta = _delta(spark, sf)
    delta.createOrReplaceTempView("orders_delta")
    expected = spark.sql("SELECT o_orderkey, amount, upper(op) AS op FROM orders_delta "
                         "WHERE upper(op) IN ('I', 'U')")
    actual = delta.where(F.upper("op").isin("I", "U")).select(
        "o_orderkey", "amount", F.upper("op").alias("op"), "change_ms")
    buggy = delta.select("o_orderkey", "amount", F.upper("op").alias("op"))
    rows = []
    for name, act in (("transform", actual), ("buggy", buggy)):
        miss, unexp = TR.expect_rows(act, expected, ["o_orderkey", "amount", "op"])
        for part, d in (("missing", miss), ("unexpected", unexp)):
            rows.append(d.agg(F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint").alias("n")).select(
                F.lit("transform_unit").alias("pattern"), F.lit(f"{name}:{part}").alias("target"),
                F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"),
                F.lit("0").alias("expected"), F.col("n").cast("string").alias("actual"),
                F.lit(False).alias("measurement")))
    rows.append(TR.assert_properties(actual, "transform", unique=["o_orderkey"],
                                     no_nulls=["amount", "op"]))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def q_transform_diff(spark, sf):
    register_views(spark, sf, ["orders"])
    legacy = spark.sql("SELECT o_orderstatus, COUNT(*) AS n, "
                       "SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS total FROM orders "
                       "GROUP BY o_orderstatus")
    o = _orders(spark, sf)
    migrated = o.groupBy(F.col("o_orderstatus").alias("O_ORDERSTATUS")).agg(
        F.count(F.lit(1)).alias("N"), F.sum(F.col("o_totalprice").cast("decimal(14,2)")).alias("TOTAL"))
    rewrite_bad = migrated.where("O_ORDERSTATUS <> 'P'")
    out = None
    for variant, m in (("migrated", migrated), ("rewrite_bad", rewrite_bad)):
        d = TR.transform_diff(legacy, m).select(
            F.lit(variant).alias("variant"), "o_orderstatus", F.col("n").cast("bigint").alias("n"),
            F.col("total").cast("string").alias("total"), "side", "copies")
        out = d if out is None else out.unionByName(d)
    return out


SEED_SCHEMA = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
               ("c_acctbal", "decimal(12,2)"), ("c_mktsegment", "string"), ("c_flag", "boolean")]


def q_seed_given(spark, sf):
    """S5 over table-derived text rows: every column arrives as text (a CSV/given
    feed) and is typed by the declared schema; the absent column is NULL."""
    c = table(spark, sf, "customer")
    text = c.select(*[F.col(n).cast("string").alias(n) for n in c.columns])
    typed = TR.typed_from_text(text, SEED_SCHEMA)
    return typed.withColumn("c_acctbal", F.col("c_acctbal").cast("string"))


def q_inline_rows(spark, sf):
    register_views(spark, sf, ["orders"])
    return spark.sql("""
        SELECT s.label, COUNT(*) AS orders
        FROM orders o
        JOIN (VALUES ('F', 'fulfilled'), ('O', 'open'), ('P', 'partial')) AS s(code, label)
          ON o.o_orderstatus = s.code
        GROUP BY s.label""").select("label", F.col("orders").cast("bigint").alias("orders"))


QUERIES = {
    "epoch_conversion": q_epoch_conversion,
    "epoch_quarantine": q_epoch_quarantine,
    "decimal_roundtrip": q_decimal_roundtrip,
    "fn_epoch": q_fn_epoch,
    "fn_oracle_ts": q_fn_oracle_ts,
    "scd2_build": q_scd2_build,
    "scd2_continuity": q_scd2_continuity,
    "adjacent_versions": q_adjacent_versions,
    "latest_version": q_latest_version,
    "delta_latest": q_delta_latest,
    "merge_apply": q_merge_apply,
    "merge_idempotency": q_merge_idempotency,
    "upsert_split": q_upsert_split,
    "delete_keys_present": q_delete_keys_present,
    "fk_orphan": q_fk_orphan,
    "fk_anti": q_fk_anti,
    "keyed_lookup": q_keyed_lookup,
    "unique_key_check": q_unique_key_check,
    "null_count": q_null_count,
    "transform_unit": q_transform_unit,
    "transform_diff": q_transform_diff,
    "seed_given": q_seed_given,
    "inline_rows": q_inline_rows,
}


# ------------------------------------------------------------------ oracle SQL
def _epoch_classes_sql(unit):
    lo, hi = E.year_bounds(unit, E.SANE_YEARS)
    mult = {"millis": 1000, "seconds": 1000000, "micros": 1}[unit]
    conv = f"make_timestamp(CAST(e.issued_sec AS BIGINT) * {mult})"
    ins = f"(e.issued_sec >= {lo} AND e.issued_sec < {hi})"
    return f"""SELECT '{unit}' AS unit, cls AS class, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE
    WHEN e.o_orderkey % 113 = 0 THEN 'target_conflict'
    WHEN e.issued_sec IS NULL AND o.o_orderdate IS NULL THEN 'null_ok'
    WHEN e.issued_sec IS NULL THEN 'null_mismatch'
    WHEN NOT {ins} AND o.o_orderdate IS NULL THEN 'nulled_ok'
    WHEN NOT {ins} THEN 'not_nulled'
    WHEN year({conv}) < {EXPECT_YEARS[0]} OR year({conv}) > {EXPECT_YEARS[1]} THEN 'lying'
    WHEN date_trunc('second', o.o_orderdate) = date_trunc('second', {conv}) THEN 'matched'
    ELSE 'mismatch' END AS cls
  FROM orders_epoch e LEFT JOIN orders o ON e.o_orderkey = o.o_orderkey) GROUP BY cls"""


_EPOCH_CONV_SQL = (f"WITH {ORDERS_EPOCH}\n{_epoch_classes_sql('millis')}\nUNION ALL\n"
                   f"{_epoch_classes_sql('seconds')}")

_lo, _hi = E.year_bounds("millis", E.SANE_YEARS)
_EPOCH_QUAR_SQL = f"""WITH {ORDERS_EPOCH}
SELECT 'orders_epoch' AS src_table, 'issued_sec' AS src_column, CAST(o_orderkey AS BIGINT) AS row_id,
       CASE WHEN issued_sec < {_lo} THEN 'before_sane_range' ELSE 'after_sane_range' END AS reason
FROM orders_epoch WHERE issued_sec IS NOT NULL AND (issued_sec < {_lo} OR issued_sec >= {_hi})"""

_DECIMAL_SQL = f"""WITH {ORDERS_TGT},
s AS (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(38,18)) AS amount,
             CAST(o_custkey AS DECIMAL(38,18)) AS o_custkey FROM orders),
copies AS (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(38,18)) AS amount,
             CAST(o_custkey AS DECIMAL(38,18)) AS o_custkey FROM orders_tgt),
t AS (SELECT o_orderkey, min(amount) AS amount, count(DISTINCT amount) > 1 AS torn, min(o_custkey) AS o_custkey, CAST(count(*) AS BIGINT) AS tgt_rows
      FROM (SELECT * FROM copies UNION ALL SELECT o_orderkey, amount + 1, o_custkey FROM copies WHERE o_orderkey % 107 = 1) GROUP BY o_orderkey),
j AS (SELECT s.o_orderkey, s.amount AS sa, t.amount AS ta, s.o_custkey AS sc, t.o_custkey AS tc, coalesce(torn, false) AS torn,
             coalesce(tgt_rows, 0) AS tgt_rows
      FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey)
SELECT o_orderkey, 'amount' AS "column", CAST(sa AS VARCHAR) AS src_value, CAST(ta AS VARCHAR) AS tgt_value, tgt_rows
FROM j WHERE torn OR sa IS DISTINCT FROM ta
UNION ALL
SELECT o_orderkey, 'o_custkey', CAST(sc AS VARCHAR), CAST(tc AS VARCHAR), tgt_rows FROM j WHERE sc IS DISTINCT FROM tc
UNION ALL
SELECT o_orderkey, 'place_20', {stripped_sql("CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR)")},
       CAST(CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(38,20)) + CAST('0.00000000000000000001' AS DECIMAL(38,20)) AS VARCHAR), 1
FROM orders WHERE o_orderkey % 113 = 0
UNION ALL
SELECT o_orderkey, 'digits_25', CAST(CAST('1000000000000000000000000' AS HUGEINT) + o_orderkey AS VARCHAR),
       CAST(CAST('1000000000000000000000000' AS HUGEINT) + o_orderkey + 1 AS VARCHAR), 1 FROM orders WHERE o_orderkey % 127 = 0"""

_lo_s, _hi_s = E.year_bounds("seconds", E.SANE_YEARS)
_lo_u, _hi_u = E.year_bounds("micros", E.SANE_YEARS)
_FN_EPOCH_SQL = f"""WITH {ORDERS_EPOCH},
a AS (SELECT o_orderkey, issued_sec,
             CASE WHEN issued_sec >= {_lo} AND issued_sec < {_hi} THEN make_timestamp(issued_sec * 1000) END AS issued_ts
      FROM orders_epoch),
b AS (SELECT *, CAST(epoch(issued_ts) AS BIGINT) AS epoch_s FROM a)
SELECT o_orderkey, issued_sec, issued_ts, epoch_s,
       CASE WHEN epoch_s >= {_lo_s} AND epoch_s < {_hi_s} THEN make_timestamp(epoch_s * 1000000) END AS from_seconds,
       CASE WHEN epoch_s * 1000000 >= {_lo_u} AND epoch_s * 1000000 < {_hi_u} THEN make_timestamp(epoch_s * 1000000) END AS from_micros
FROM b"""

_FN_ORACLE_TS_SQL = """WITH r AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 89 = 0
      THEN substr(strftime(o_orderdate, '%Y%m%d%H%M%S'), 1, 4) || '13' || substr(strftime(o_orderdate, '%Y%m%d%H%M%S'), 7, 8)
      ELSE strftime(o_orderdate, '%Y%m%d%H%M%S') END AS raw FROM orders)
SELECT o_orderkey, raw, try_strptime(raw, '%Y%m%d%H%M%S') AS parsed FROM r"""

_SCD2_BUILD_SQL = f"WITH {EVENTS_SCD2}\nSELECT user_id, eff_from, eff_to, is_current, event_type, row_hash FROM events_scd2"


def _scd2_rules_sql(tbl, variant):
    return f"""SELECT '{variant}' AS variant, rule, CAST(count(*) AS BIGINT) AS violations FROM (
  SELECT CASE WHEN next_from IS NOT NULL AND date_trunc('second', eff_to) <> date_trunc('second', next_from)
              THEN 'gap_or_overlap' END AS r1,
         CASE WHEN is_current AND CAST(eff_to AS DATE) <> DATE '9999-12-31' THEN 'current_not_terminal' END AS r2,
         CASE WHEN NOT is_current AND CAST(eff_to AS DATE) = DATE '9999-12-31' THEN 'terminal_not_current' END AS r3,
         CASE WHEN row_hash IS DISTINCT FROM md5(concat_ws('|', CAST(user_id AS VARCHAR), event_type))
              THEN 'hash_mismatch' END AS r4
  FROM (SELECT *, lead(eff_from) OVER (PARTITION BY user_id ORDER BY eff_from) AS next_from FROM {tbl})
) UNPIVOT (rule FOR k IN (r1, r2, r3, r4)) WHERE rule IS NOT NULL GROUP BY rule
UNION ALL
SELECT '{variant}', 'current_count', CAST(count(*) AS BIGINT) FROM (
  SELECT user_id FROM {tbl} GROUP BY user_id HAVING count_if(is_current) <> 1) HAVING count(*) > 0"""


_SCD2_CONT_SQL = (f"WITH {EVENTS_SCD2_BROKEN}\n{_scd2_rules_sql('events_scd2', 'golden')}\n"
                  f"UNION ALL\n{_scd2_rules_sql('events_scd2_broken', 'broken')}")

_ADJ_SQL = f"""WITH {EVENTS_SCD2_BROKEN}
SELECT user_id, eff_from, eff_to, next_from, (next_from IS NOT NULL AND eff_to <> next_from) AS broken_link
FROM (SELECT *, lead(eff_from) OVER (PARTITION BY user_id ORDER BY eff_from) AS next_from FROM events_scd2_broken)"""

_LATEST_SQL = """SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

_DELTA_LATEST_CTE = """delta_latest AS (SELECT * FROM orders_delta
  QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY change_ms DESC) = 1)"""

_DELTA_LATEST_SQL = f"WITH {ORDERS_DELTA}, {_DELTA_LATEST_CTE}\nSELECT o_orderkey, o_custkey, amount, op, change_ms FROM delta_latest"


def _merge_cte(name, tgt, delta="delta_latest"):
    return f"""{name} AS (
  SELECT coalesce(t.o_orderkey, d.o_orderkey) AS o_orderkey,
         CASE WHEN d.d_hit IS NOT NULL THEN d.o_custkey ELSE t.o_custkey END AS o_custkey,
         CASE WHEN d.d_hit IS NOT NULL THEN d.amount ELSE t.amount END AS amount,
         CASE WHEN t.t_hit IS NOT NULL AND d.d_hit IS NOT NULL THEN 'update'
              WHEN t.t_hit IS NOT NULL THEN 'keep' ELSE 'insert' END AS _action
  FROM (SELECT o_orderkey, o_custkey, amount, 1 AS t_hit FROM {tgt}) t
  FULL JOIN (SELECT o_orderkey, o_custkey, amount, op, 1 AS d_hit FROM {delta} WHERE o_orderkey IS NOT NULL) d
    ON t.o_orderkey = d.o_orderkey
  WHERE (t.t_hit IS NOT NULL AND d.d_hit IS NOT NULL AND d.op IS DISTINCT FROM 'D')
     OR (t.t_hit IS NOT NULL AND d.d_hit IS NULL)
     OR (t.t_hit IS NULL AND d.op <> 'D'))"""


_DIRTY_CTE = """delta_ok AS (SELECT * FROM delta_latest WHERE o_orderkey % 1000 <> 1)"""
_MERGE_DIRTY_SQL = (f"WITH {ORDERS_DELTA}, {_DELTA_LATEST_CTE}, {_DIRTY_CTE}, {ORDERS_SNAPSHOT},\n{_merge_cte('m1', 'orders_snap', 'delta_ok')}\n"
                    "SELECT o_orderkey, o_custkey, CAST(amount AS VARCHAR) AS amount, _action FROM m1")
_MERGE_SQL = (f"WITH {ORDERS_DELTA}, {_DELTA_LATEST_CTE}, {ORDERS_SNAPSHOT},\n{_merge_cte('m1', 'orders_snap')}\n"
              "SELECT o_orderkey, o_custkey, CAST(amount AS VARCHAR) AS amount, _action FROM m1")

_MCOLS = [("o_orderkey", "int"), ("o_custkey", "int"), ("amount", "decimal")]


def _idem_rows(prefix, once, twice):
    return f"""SELECT 'merge_idempotency' AS pattern, '{prefix}:fingerprint_once_vs_twice' AS target,
  CASE WHEN a.n = b.n AND a.s1 = b.s1 AND a.s2 = b.s2 AND a.x = b.x THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(a.n AS VARCHAR) AS expected, CAST(b.n AS VARCHAR) AS actual, false AS measurement
FROM (SELECT {digest_aggs_sql()} FROM {hashed(once, _MCOLS)}) a,
     (SELECT {digest_aggs_sql()} FROM {hashed(twice, _MCOLS)}) b
UNION ALL
SELECT 'merge_idempotency', '{prefix}:deleted_keys_present',
  CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END, '0', CAST(n AS VARCHAR), false
FROM (SELECT count(*) AS n FROM {twice} x
      JOIN (SELECT DISTINCT o_orderkey FROM delta_latest WHERE op = 'D') k ON x.o_orderkey = k.o_orderkey)"""


_IDEM_SQL = (f"WITH {ORDERS_DELTA}, {_DELTA_LATEST_CTE}, {ORDERS_SNAPSHOT},\n"
             f"{_merge_cte('m1', 'orders_snap')},\n{_merge_cte('m2', 'm1')},\n"
             "a1 AS (SELECT o_orderkey, o_custkey, amount FROM orders_snap UNION ALL "
             "SELECT o_orderkey, o_custkey, amount FROM delta_latest WHERE op <> 'D'),\n"
             "a2 AS (SELECT * FROM a1 UNION ALL SELECT o_orderkey, o_custkey, amount FROM delta_latest "
             "WHERE op <> 'D')\n"
             f"{_idem_rows('merge', 'm1', 'm2')}\nUNION ALL\n{_idem_rows('append', 'a1', 'a2')}")

_UPSERT_SQL = f"""WITH {ORDERS_DELTA}, {_DELTA_LATEST_CTE}, {_DIRTY_CTE}, {ORDERS_SNAPSHOT},
{_merge_cte('m1', 'orders_snap', 'delta_ok')}
SELECT action, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT CASE WHEN t.o_orderkey IS NOT NULL AND d.o_orderkey IS NOT NULL AND d.op = 'D' THEN 'delete'
              WHEN t.o_orderkey IS NOT NULL AND d.o_orderkey IS NOT NULL THEN 'update'
              WHEN t.o_orderkey IS NOT NULL THEN 'keep'
              WHEN d.op <> 'D' THEN 'insert' ELSE 'skip' END AS action
  FROM orders_snap t FULL JOIN delta_ok d ON t.o_orderkey = d.o_orderkey) GROUP BY action
UNION ALL
SELECT 'duplicate_keys', CAST(count(*) - count(DISTINCT o_orderkey) AS BIGINT) FROM m1
UNION ALL
SELECT 'refused:null_keys', CAST(count(*) AS BIGINT) FROM delta_latest WHERE o_orderkey % 700 = 10
UNION ALL
SELECT 'refused:repeated_keys', CAST(2 * count(*) AS BIGINT) FROM delta_latest WHERE o_orderkey % 1000 = 1"""

_DEL_KEYS_SQL = f"""WITH {ORDERS_DELTA}, {_DELTA_LATEST_CTE}, {ORDERS_SNAPSHOT},
{_merge_cte('m1', 'orders_snap')},
dk AS (SELECT DISTINCT o_orderkey FROM orders_delta WHERE op = 'D')
SELECT 'before' AS stage, CAST(count(*) AS BIGINT) AS n FROM orders_snap JOIN dk USING (o_orderkey)
UNION ALL
SELECT 'after', CAST(count(*) AS BIGINT) FROM m1 JOIN dk USING (o_orderkey)"""


def _fk_sql(name, child, parent, tchild, tparent, ck, pk, tol, max_rate=None):
    ok = f"abs(sr - tr) <= {float(tol)}"
    if max_rate is not None:
        ok += f" AND tr <= {float(max_rate)}"

    def side(c, p):
        return (f"(SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE NOT EXISTS "
                f"(SELECT 1 FROM {p} pp WHERE pp.{pk} = cc.{ck})) AS BIGINT) AS orphans FROM {c} cc)")
    return f"""SELECT '{name}' AS relation, src_rows, src_orphans, tgt_rows, tgt_orphans,
  round(sr, 6) AS src_rate_pct, round(tr, 6) AS tgt_rate_pct,
  CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT s.rows AS src_rows, s.orphans AS src_orphans, t.rows AS tgt_rows, t.orphans AS tgt_orphans,
             CASE WHEN s.rows = 0 THEN 0.0 ELSE s.orphans * 100.0 / s.rows END AS sr,
             CASE WHEN t.rows = 0 THEN 0.0 ELSE t.orphans * 100.0 / t.rows END AS tr
      FROM {side(child, parent)} s, {side(tchild, tparent)} t)"""


_FK_SQL = (f"WITH {ORDERS_TGT}, cust_t AS (SELECT * FROM customer WHERE c_custkey % 13 <> 0)\n"
           + _fk_sql("orders->customer", "orders", "customer", "orders_tgt", "cust_t",
                     "o_custkey", "c_custkey", 0.0)
           + "\nUNION ALL\n" + _fk_sql("lineitem->orders", "lineitem", "orders", "lineitem", "orders_tgt",
                                       "l_orderkey", "o_orderkey", 2.0)
           + "\nUNION ALL\n" + _fk_sql("documents->labels", "documents", "labels", "documents", "labels",
                                       "doc_id", "doc_id", 0.0, 50.0))

_FK_ANTI_SQL = f"""WITH {ORDERS_TGT}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders_tgt t WHERE t.o_orderkey = l.l_orderkey)"""

_KEYED_LOOKUP_SQL = f"""WITH {ORDERS_TGT}
SELECT o.o_orderkey, o.o_totalprice AS src_price, t.o_totalprice AS tgt_price
FROM orders o LEFT JOIN orders_tgt t ON o.o_orderkey = t.o_orderkey"""

_UNIQUE_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tbl, '{','.join(k)}' AS keys, CAST(count(*) AS BIGINT) AS rows, "
    f"CAST(count(DISTINCT ({', '.join(k)}{',' if len(k) == 1 else ''})) AS BIGINT) AS distinct_keys, "
    f"CAST(count(*) - count(DISTINCT ({', '.join(k)}{',' if len(k) == 1 else ''})) AS BIGINT) AS dup_rows FROM {t}"
    for t, k in UNIQUE_KEYS)

_NULL_COLS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
    "labels": ["doc_id", "quality", "toxic"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
}
_NULL_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tbl, '{c}' AS col, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulls FROM {t}"
    for t in NULL_TABLES for c in _NULL_COLS[t])

_TU_SQL = f"""WITH {ORDERS_DELTA},
expected AS (SELECT o_orderkey, amount, upper(op) AS op FROM orders_delta WHERE upper(op) IN ('I','U')),
actual AS (SELECT o_orderkey, amount, upper(op) AS op FROM orders_delta WHERE upper(op) IN ('I','U')),
buggy AS (SELECT o_orderkey, amount, upper(op) AS op FROM orders_delta),
ce AS (SELECT o_orderkey, amount, op, count(*) AS n FROM expected GROUP BY ALL),
ca AS (SELECT o_orderkey, amount, op, count(*) AS n FROM actual GROUP BY ALL),
cb AS (SELECT o_orderkey, amount, op, count(*) AS n FROM buggy GROUP BY ALL),
da AS (SELECT coalesce(ce.n, 0) - coalesce(ca.n, 0) AS d FROM ce FULL JOIN ca
       ON ce.o_orderkey = ca.o_orderkey AND ce.amount = ca.amount AND ce.op = ca.op),
db AS (SELECT coalesce(ce.n, 0) - coalesce(cb.n, 0) AS d FROM ce FULL JOIN cb
       ON ce.o_orderkey = cb.o_orderkey AND ce.amount = cb.amount AND ce.op = cb.op),
r AS (
  SELECT 'transform:missing' AS target, coalesce(sum(d) FILTER (WHERE d > 0), 0) AS n FROM da
  UNION ALL SELECT 'transform:unexpected', coalesce(sum(-d) FILTER (WHERE d < 0), 0) FROM da
  UNION ALL SELECT 'buggy:missing', coalesce(sum(d) FILTER (WHERE d > 0), 0) FROM db
  UNION ALL SELECT 'buggy:unexpected', coalesce(sum(-d) FILTER (WHERE d < 0), 0) FROM db)
SELECT 'transform_unit' AS pattern, target, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       '0' AS expected, CAST(CAST(n AS BIGINT) AS VARCHAR) AS actual, false AS measurement FROM r
UNION ALL
SELECT 'transform_unit', 'transform:unique(o_orderkey)',
       CASE WHEN count(*) = count(DISTINCT (o_orderkey,)) THEN 'PASS' ELSE 'FAIL' END,
       CAST(count(*) AS VARCHAR), CAST(count(DISTINCT (o_orderkey,)) AS VARCHAR), false FROM actual
UNION ALL
SELECT 'transform_unit', 'transform:no_nulls(amount)', CASE WHEN count(*) FILTER (WHERE amount IS NULL) = 0
       THEN 'PASS' ELSE 'FAIL' END, '0', CAST(count(*) FILTER (WHERE amount IS NULL) AS VARCHAR), false FROM actual
UNION ALL
SELECT 'transform_unit', 'transform:no_nulls(op)', CASE WHEN count(*) FILTER (WHERE op IS NULL) = 0
       THEN 'PASS' ELSE 'FAIL' END, '0', CAST(count(*) FILTER (WHERE op IS NULL) AS VARCHAR), false FROM actual"""

_TD_SQL = """WITH legacy AS (SELECT o_orderstatus, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(14,2))) AS total
                FROM orders GROUP BY o_orderstatus),
good AS (SELECT * FROM legacy), bad AS (SELECT * FROM legacy WHERE o_orderstatus <> 'P'),
d1 AS (SELECT coalesce(l.o_orderstatus, g.o_orderstatus) AS o_orderstatus, coalesce(l.n, g.n) AS n,
              coalesce(l.total, g.total) AS total, coalesce(l.c, 0) - coalesce(g.c, 0) AS d
       FROM (SELECT *, 1 AS c FROM legacy) l FULL JOIN (SELECT *, 1 AS c FROM good) g
       ON l.o_orderstatus = g.o_orderstatus AND l.n = g.n AND l.total = g.total),
d2 AS (SELECT coalesce(l.o_orderstatus, g.o_orderstatus) AS o_orderstatus, coalesce(l.n, g.n) AS n,
              coalesce(l.total, g.total) AS total, coalesce(l.c, 0) - coalesce(g.c, 0) AS d
       FROM (SELECT *, 1 AS c FROM legacy) l FULL JOIN (SELECT *, 1 AS c FROM bad) g
       ON l.o_orderstatus = g.o_orderstatus AND l.n = g.n AND l.total = g.total)
SELECT 'migrated' AS variant, o_orderstatus, CAST(n AS BIGINT) AS n, CAST(total AS VARCHAR) AS total,
       CASE WHEN d > 0 THEN 'only_a' ELSE 'only_b' END AS side, CAST(abs(d) AS BIGINT) AS copies FROM d1 WHERE d <> 0
UNION ALL
SELECT 'rewrite_bad', o_orderstatus, CAST(n AS BIGINT), CAST(total AS VARCHAR),
       CASE WHEN d > 0 THEN 'only_a' ELSE 'only_b' END, CAST(abs(d) AS BIGINT) FROM d2 WHERE d <> 0"""

_SEED_SQL = """SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
       CAST(CAST(CAST(c_acctbal AS VARCHAR) AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal, c_mktsegment,
       CAST(NULL AS BOOLEAN) AS c_flag FROM customer"""

_INLINE_SQL = """SELECT s.label, CAST(count(*) AS BIGINT) AS orders FROM orders o
JOIN (VALUES ('F', 'fulfilled'), ('O', 'open'), ('P', 'partial')) AS s(code, label) ON o.o_orderstatus = s.code
GROUP BY s.label"""

ORACLE = {
    "epoch_conversion": _EPOCH_CONV_SQL,
    "epoch_quarantine": _EPOCH_QUAR_SQL,
    "decimal_roundtrip": _DECIMAL_SQL,
    "fn_epoch": _FN_EPOCH_SQL,
    "fn_oracle_ts": _FN_ORACLE_TS_SQL,
    "scd2_build": _SCD2_BUILD_SQL,
    "scd2_continuity": _SCD2_CONT_SQL,
    "adjacent_versions": _ADJ_SQL,
    "latest_version": _LATEST_SQL,
    "delta_latest": _DELTA_LATEST_SQL,
    "merge_apply": _MERGE_DIRTY_SQL,
    "merge_idempotency": _IDEM_SQL,
    "upsert_split": _UPSERT_SQL,
    "delete_keys_present": _DEL_KEYS_SQL,
    "fk_orphan": _FK_SQL,
    "fk_anti": _FK_ANTI_SQL,
    "keyed_lookup": _KEYED_LOOKUP_SQL,
    "unique_key_check": _UNIQUE_SQL,
    "null_count": _NULL_SQL,
    "transform_unit": _TU_SQL,
    "transform_diff": _TD_SQL,
    "seed_given": _SEED_SQL,
    "inline_rows": _INLINE_SQL,
}
