"""Registered reporting and quality queries: V13 schema conformance, V18
performance gates, V19 build-and-verify ELT, V20 sign-off, X3 retention, X4
masking, X5 manifest parity — with DuckDB oracle SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paritylake.checks import CHECK_COLUMNS, CHECKS_DDL, error_rows
from paritylake.functions.canon import digest
from paritylake.operators import reporting as R
from paritylake.operators.aggregates import run_stats_fold
from paritylake.operators.encoding import epoch_to_ts
from paritylake.operators.parity import fingerprint_parity, rowcount_counts
from paritylake.operators.schema import ColumnSpec, fk_type_agreement, logical_type, nested_signature, schema_conformance
from paritylake.plans import derived as D
from paritylake.plans.keys_parity import TABLE_COLS
from paritylake.plans.oracle import ORDERS_COLS, ORDERS_EPOCH, ORDERS_TGT, digest_of
from paritylake.session import materialize, scratch_dir, scratch_scope
from paritylake.sources.tables import table
from paritylake.streaming.compaction import Manifest

Q_: dict = {}
O_: dict = {}

# ------------------------------------------------------------------ V13
# declared expectations: a golden set and a negative twin with known errors
SCHEMA_EXPECT = [
    ("orders", [("o_orderkey", "bigint", False), ("o_custkey", "int64", False), ("o_orderstatus", "varchar", True),
                ("o_totalprice", "double", False), ("o_orderdate", "timestamp", True),
                ("o_orderpriority", "string", True)]),
    ("embeddings", [("vec_id", "integer", False), ("embedding", "array<float>", True, False), ("label", "int", True)]),
    ("orders_snap", [("amount", "numeric(14,2)", False), ("o_orderkey", "bigint", False)]),
    ("twin_orders", [("o_totalprice", "numeric", False), ("o_orderdate", "date", True), ("o_comment", "string", True)]),
    ("twin_embeddings", [("embedding", "array<double>", True)]),
    ("twin_events", [("props", "string", False), ("value", "numeric(12,1)", True)]),
    # nested values with NULLs inside; source types that map to another type, or to none
    ("twin_vectors", [("embedding", "array<float>", True, False)]),
    ("mapped_orders", [("o_orderkey", "bigint", True, True, "NUMBER(19)"), ("o_totalprice", "double", True, True, "NUMBER(12,2)"),
                       ("o_orderstatus", "string", True, True, "CLOB")]),
]
TYPE_MAP = {"number(19)": "bigint", "number(12,2)": "decimal(12,2)", "varchar2": "string"}
JOIN_PATHS = [("orders_customer", "orders", "o_custkey", "customer", "c_custkey"), ("lineitem_orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
              ("twin_priority_customer", "orders", "o_orderpriority", "customer", "c_custkey")]
_SOURCE = {"twin_orders": "orders", "twin_embeddings": "embeddings", "twin_events": "events", "twin_vectors": "embeddings",
           "mapped_orders": "orders"}


def _schema_df(spark, sf, name):
    base = _SOURCE.get(name, name)
    if base == "orders_snap":
        return D.orders_target_snapshot(table(spark, sf, "orders"))
    df = table(spark, sf, base)
    if name == "twin_vectors":      # every fiftieth vector loses its third component
        gone = F.transform("embedding", lambda x, i: F.when((i != 2) | (F.col("vec_id") % 50 != 0), x))
        df = df.withColumn("embedding", gone)
    return df


def q_v13(spark, sf):
    out = None
    for name, cols in SCHEMA_EXPECT:
        df = _schema_df(spark, sf, name)
        c = schema_conformance(spark, df, name, [ColumnSpec(*spec) for spec in cols], TYPE_MAP)
        out = c if out is None else out.unionByName(c)
    paths = [(n, table(spark, sf, a), ac, table(spark, sf, b), bc) for n, a, ac, b, bc in JOIN_PATHS]
    return out.unionByName(fk_type_agreement(spark, paths))


_ORACLE_TYPES = {"int": "bigint", "double": "double", "string": "string", "timestamp": "timestamp",
                 "list<float>": "array<float>", "decimal": "decimal(14,2)"}


def _v13_sql():
    """Metadata rows follow from the known input schemas; data rows are computed."""
    cols = dict(TABLE_COLS)
    cols["orders_snap"] = [("amount", "decimal"), ("o_orderkey", "int")]
    rows = []
    for name, specs in SCHEMA_EXPECT:
        base = _SOURCE.get(name, name)
        actual = {c: t for c, t in cols[base]}
        src = "(SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) AS amount FROM orders)" \
            if base == "orders_snap" else base
        for n, t, nullable, *more in specs:
            tgt = f"{name}.{n}"
            if n not in actual:
                rows.append(f"SELECT 'schema_conformance', '{tgt}:exists', 'FAIL', 'present', 'missing', false")
                continue
            rows.append(f"SELECT 'schema_conformance', '{tgt}:exists', 'PASS', 'present', 'present', false")
            efam, escale = logical_type(t)
            sp = _ORACLE_TYPES[actual[n]]
            afam, ascale = logical_type(sp) if not sp.startswith("array") else (nested_signature(sp), None)
            ok = efam == afam and (efam != "NUMERIC" or escale is None or ascale is None or escale == ascale)
            rows.append(f"SELECT 'schema_conformance', '{tgt}:type', '{'PASS' if ok else 'FAIL'}', '{efam}', '{afam}', false")
            if len(more) > 1:
                want = TYPE_MAP.get(more[1].lower())
                shown = logical_type(want)[0] if want else f"no mapping of {more[1]}"
                rows.append(f"SELECT 'schema_conformance', '{tgt}:source_type', CASE WHEN '{shown}' = '{efam}' THEN 'PASS' ELSE 'FAIL' END, "
                            f"'{shown}', '{efam}', false")
            if more and not more[0]:
                holes = "vec_id % 50 = 0" if name == "twin_vectors" else "len(list_filter(embedding, lambda x: x IS NULL)) > 0"
                rows.append(f"SELECT 'schema_conformance', '{tgt}:no_null_inside_on_data', CASE WHEN count(*) FILTER (WHERE {holes}) = 0 "
                            f"THEN 'PASS' ELSE 'FAIL' END, '0', CAST(count(*) FILTER (WHERE {holes}) AS VARCHAR), false FROM {src}")
            if efam == "NUMERIC" and escale is None:
                rows.append(f"SELECT 'schema_conformance', '{tgt}:scale_declared', 'FAIL', 'scale', 'none', false")
            if not nullable:
                rows.append(f"SELECT 'schema_conformance', '{tgt}:not_null_on_data', "
                            f"CASE WHEN count(*) FILTER (WHERE {n} IS NULL) = 0 THEN 'PASS' ELSE 'FAIL' END, '0', "
                            f"CAST(count(*) FILTER (WHERE {n} IS NULL) AS VARCHAR), false FROM {src}")
            if efam in ("NUMERIC", "FLOAT64") and escale is not None:
                if actual[n] == "decimal":
                    used = f"length(rtrim(split_part(CAST({n} AS VARCHAR), '.', 2), '0'))"
                else:
                    used = f"length(rtrim(split_part(CAST({n} AS VARCHAR), '.', 2), '0'))"
                rows.append(f"SELECT 'schema_conformance', '{tgt}:scale_on_data', "
                            f"CASE WHEN coalesce(max({used}), 0) <= {escale} THEN 'PASS' ELSE 'FAIL' END, "
                            f"'{escale}', CAST(max({used}) AS VARCHAR), false FROM {src}")
    kind = lambda t, c: (f"(SELECT CASE WHEN column_type IN ('BIGINT', 'INTEGER') THEN 'INT64' WHEN column_type = 'VARCHAR' THEN 'STRING' "
                         f"ELSE column_type END FROM (DESCRIBE {t}) WHERE column_name = '{c}')")
    for name, a, ac, b, bc in JOIN_PATHS:
        rows.append(f"SELECT 'schema_conformance', 'join:{name}', CASE WHEN {kind(a, ac)} = {kind(b, bc)} THEN 'PASS' ELSE 'FAIL' END, "
                    f"{kind(b, bc)}, {kind(a, ac)}, false")
    body = "\nUNION ALL\n".join(rows)
    return f"SELECT c0 AS pattern, c1 AS target, c2 AS status, c3 AS expected, c4 AS actual, c5 AS measurement FROM (\n{body}) AS t(c0, c1, c2, c3, c4, c5)"


Q_["schema_conformance"] = q_v13
O_["schema_conformance"] = _v13_sql()


META_RANGES = 16
# what the table is built with, and the checks (name, expected, is it a twin)
META_FACTS = {"exists": "present", "partitions": "key_range", "cluster": "o_custkey", "retention_days": "3650", "type": "TABLE",
              "labels": "domain=orders,tier=gold", "description": "orders by key range", "require_partition_filter": "True"}


def q_v13_meta(spark, sf):
    """V13 catalog part on a table built from ``orders`` (a fixed number of key ranges, clustered; retention, labels and
    the partition filter rule in TBLPROPERTIES): golden expectations and a twin, a missing table, the exact table count, and
    the landed row count against the source."""
    from paritylake.operators.schema import table_count, table_metadata_checks
    o = table(spark, sf, "orders")
    width = ((o.agg(F.max("o_orderkey")).first()[0] or 0) + META_RANGES) // META_RANGES
    loc = scratch_dir(spark, "orders_meta")
    name = f"paritylake_meta_{loc[-12:]}"
    o.select("o_orderkey", "o_custkey", "o_totalprice", F.call_function("div", F.col("o_orderkey"), F.lit(width)).alias("key_range")) \
        .createOrReplaceTempView(f"{name}_src")
    spark.sql(f"""CREATE TABLE {name} USING parquet PARTITIONED BY (key_range) CLUSTERED BY (o_custkey) INTO 4 BUCKETS LOCATION '{loc}'
        COMMENT 'orders by key range'
        TBLPROPERTIES ('retention_days' = '3650', 'labels' = 'domain=orders,tier=gold', 'require_partition_filter' = 'true')
        AS SELECT /*+ REPARTITION(key_range) */ * FROM {name}_src""")
    golden = table_metadata_checks(spark, name, partitions=["key_range"], retention_days=3650, labels={"domain": "orders"}, table_type="TABLE",
                                   description="orders by key range", cluster=["o_custkey"], require_partition_filter=True, label="golden")
    twin = table_metadata_checks(spark, name, partitions=["order_month"], retention_days=30, labels={"tier": "silver"}, table_type="VIEW",
                                 description="other", cluster=["o_orderkey", "o_custkey"], require_partition_filter=False, label="twin")
    gone = table_metadata_checks(spark, f"{name}_gone", partitions=["key_range"], label="gone")
    count = [table_count(spark, f"{name}*", n).withColumn("target", F.lit(f"tables:{n}")) for n in (1, 2)]
    rc = rowcount_counts(o, spark.table(name)).select(
        F.lit("schema_conformance").alias("pattern"), F.lit("rows").alias("target"),
        F.when(F.col("src_n") == F.col("tgt_n"), "PASS").otherwise("FAIL").alias("status"),
        F.col("src_n").cast("string").alias("expected"), F.col("tgt_n").cast("string").alias("actual"),
        F.lit(False).alias("measurement"))
    u = golden
    for part in (twin, gone, *count, rc):
        u = u.unionByName(part)
    return u.select("target", "status")


def _v13_meta_sql():
    """The facts the table was built with against the two sets of expectations."""
    facts = ", ".join(f"('{k}', '{v}')" for k, v in META_FACTS.items())
    twin = {"exists": "present", "partitions": "order_month", "cluster": "o_orderkey,o_custkey", "retention_days": "30", "type": "VIEW",
            "labels": "tier=silver", "description": "other", "require_partition_filter": "False"}
    want = ", ".join(f"('golden', '{k}', '{'domain=orders' if k == 'labels' else v}')" for k, v in META_FACTS.items())
    want += ", " + ", ".join(f"('twin', '{k}', '{v}')" for k, v in twin.items())
    return f"""WITH facts AS (SELECT * FROM (VALUES {facts}) AS f(what, have)),
want AS (SELECT * FROM (VALUES {want}) AS w(side, what, wanted)),
built AS (SELECT count(*) AS n FROM orders)
SELECT side || ':' || what AS target, CASE WHEN have = wanted OR (what = 'labels' AND contains(have, wanted)) THEN 'PASS' ELSE 'FAIL' END AS status
FROM want JOIN facts USING (what)
UNION ALL SELECT 'gone:exists', CASE WHEN (SELECT count(*) FROM information_schema.tables WHERE table_name = 'paritylake_gone') = 1 THEN 'PASS' ELSE 'FAIL' END
UNION ALL SELECT 'tables:' || k, CASE WHEN k = (SELECT count(DISTINCT side) FROM want WHERE side = 'golden') THEN 'PASS' ELSE 'FAIL' END FROM (VALUES (1), (2)) AS t(k)
UNION ALL SELECT 'rows', CASE WHEN n = (SELECT count(o_orderkey) FROM orders) THEN 'PASS' ELSE 'FAIL' END FROM built"""


O_["table_metadata_conformance"] = _v13_meta_sql()
Q_["table_metadata_conformance"] = q_v13_meta


# ------------------------------------------------------------------ V18
PERF_THRESHOLDS = [("click", "value", 400.0, "p95"), ("view", "value", 300.0, "p95"), ("purchase", "value", 350.0, "p95"),
                   ("click", "bytes_scanned", 1e6, "p95"), ("view", "value", 60.0, "p50"), ("view", "value", 1.0, "max"),
                   ("click", "value", 1.0, "min"), ("click", "value", 1.0, "p42")]
PERF_PAIRS = [("click_vs_view", "view", "click", "value", "<=", 1.1),
              ("purchase_vs_view", "view", "purchase", "value", "report", 1.0),
              ("signup_vs_error", "error", "signup", "value", "<", 1.0),
              ("click_at_least_a_tenth", "view", "click", "value", ">=", 0.1),
              ("click_over_ten_times", "view", "click", "value", ">", 10.0),
              ("unknown_condition", "view", "click", "value", "!=", 1.0)]
BASELINE_CUTOFF = "2024-01-15 00:00:00"


def _run_log(ev):
    """Run log in long form read from events: each event is one run of its
    event type's query, ``value`` its metric."""
    return ev.select(F.col("event_type").alias("query_id"), F.col("event_id").alias("run"),
                     F.lit("value").alias("metric"), "value", "ts")


def q_v18(spark, sf):
    ev = table(spark, sf, "events")
    log = _run_log(ev)
    stats = run_stats_fold(log.drop("ts"))
    thr = spark.createDataFrame(PERF_THRESHOLDS, "query_id string, metric string, threshold double, stat string")
    pairs = spark.createDataFrame(PERF_PAIRS, "name string, a string, b string, metric string, op string, k double")
    base = run_stats_fold(log.where(F.col("ts") < F.lit(BASELINE_CUTOFF).cast("timestamp_ntz"))
                          .where(F.col("query_id") != "error").drop("ts"))
    return (R.perf_assert(stats, thr).unionByName(R.perf_compare(stats, pairs))
            .unionByName(R.perf_regression(stats, base))).select("pattern", "target", "status", "measurement")


def _v18_sql():
    from paritylake.plans.keys_ops import _nearest_rank_sql
    thr = ", ".join(f"('{q}', '{m}', {t}, '{st}')" for q, m, t, st in PERF_THRESHOLDS)
    pairs = ", ".join(f"('{n}', '{a}', '{b}', '{m}', '{op}', {k})" for n, a, b, m, op, k in PERF_PAIRS)
    return f"""WITH log AS (SELECT event_type AS query_id, 'value' AS metric, value, ts FROM events),
stats AS {_nearest_rank_sql('log', 'query_id, metric', 'value', [(0.5, 'p50'), (0.95, 'p95')])},
blog AS (SELECT * FROM log WHERE ts < TIMESTAMP '{BASELINE_CUTOFF}' AND query_id <> 'error'),
base AS {_nearest_rank_sql('blog', 'query_id, metric', 'value', [(0.5, 'p50'), (0.95, 'p95')])},
ends AS (SELECT query_id, metric, min(value) AS lo, max(value) AS hi FROM log GROUP BY 1, 2),
thr AS (SELECT * FROM (VALUES {thr}) AS t(query_id, metric, threshold, stat)),
pairs AS (SELECT * FROM (VALUES {pairs}) AS p(name, a, b, metric, op, k))
SELECT 'query_performance' AS pattern,
  'assert:' || thr.query_id || ':' || thr.metric || CASE WHEN thr.stat = 'p95' THEN '' ELSE ':' || thr.stat END AS target,
  CASE WHEN thr.stat NOT IN ('p50', 'p95', 'min', 'max') THEN 'ERROR'
       WHEN CASE thr.stat WHEN 'p50' THEN s.p50 WHEN 'p95' THEN s.p95 WHEN 'min' THEN e.lo WHEN 'max' THEN e.hi END <= thr.threshold
       THEN 'PASS' ELSE 'FAIL' END AS status, false AS measurement
FROM thr LEFT JOIN stats s ON s.query_id = thr.query_id AND s.metric = thr.metric
LEFT JOIN ends e ON e.query_id = thr.query_id AND e.metric = thr.metric
UNION ALL
SELECT 'query_performance', 'compare:' || p.name,
  CASE WHEN p.op = 'report' THEN 'PASS' WHEN p.op NOT IN ('<', '<=', '>', '>=') THEN 'ERROR'
       WHEN (p.op = '<=' AND sb.p50 <= sa.p50 * p.k) OR (p.op = '<' AND sb.p50 < sa.p50 * p.k)
         OR (p.op = '>=' AND sb.p50 >= sa.p50 * p.k) OR (p.op = '>' AND sb.p50 > sa.p50 * p.k) THEN 'PASS' ELSE 'FAIL' END,
  p.op = 'report'
FROM pairs p LEFT JOIN stats sa ON sa.query_id = p.a AND sa.metric = p.metric
LEFT JOIN stats sb ON sb.query_id = p.b AND sb.metric = p.metric
UNION ALL
SELECT 'query_performance', 'regression:' || s.query_id || ':' || s.metric,
  CASE WHEN b.p95 IS NULL OR s.p95 <= b.p95 THEN 'PASS' ELSE 'FAIL' END, b.p95 IS NULL
FROM stats s LEFT JOIN base b ON b.query_id = s.query_id AND b.metric = s.metric"""


Q_["query_performance"] = q_v18
O_["query_performance"] = _v18_sql()


def q_v18_baseline(spark, sf):
    """Gates against a stored baseline, read from the run log of the first days: the first call establishes it (measurements), the
    second holds the whole log against it, the third comes after a commit of the whole log, and the last after that version's
    rows were changed behind the manifest's back."""
    from paritylake.operators import baseline as B
    log, path = _run_log(table(spark, sf, "events")), scratch_dir(spark, "perf-baseline")
    first = run_stats_fold(log.where(F.col("ts") < F.lit(BASELINE_CUTOFF).cast("timestamp_ntz")).where("query_id <> 'error'").drop("ts"))
    stats = materialize(run_stats_fold(log.drop("ts")))
    # each step's rows are kept before the next one touches the stored files
    steps = [("first", materialize(B.gate(spark, path, first))), ("second", materialize(B.gate(spark, path, stats)))]
    version = B.commit(spark, path, stats, 1)
    steps.append(("replaced", materialize(B.gate(spark, path, stats))))
    _, content = Manifest(spark, path).read()
    stats.withColumn("p95", F.col("p95") * 2).write.mode("overwrite").parquet(f"{path}/{content['name']}")
    steps.append(("tampered", B.gate(spark, path, stats)))
    out = None
    for name, rows in steps:
        r = rows.select(F.lit(name).alias("step"), "target", "status", "measurement")
        out = r if out is None else out.unionByName(r)
    return out.withColumn("last_version", F.lit(version))


def _v18_baseline_sql():
    from paritylake.plans.keys_ops import _nearest_rank_sql
    return f"""WITH log AS (SELECT event_type AS query_id, 'value' AS metric, value, ts FROM events),
stats AS {_nearest_rank_sql('log', 'query_id, metric', 'value', [(0.95, 'p95')])},
blog AS (SELECT * FROM log WHERE ts < TIMESTAMP '{BASELINE_CUTOFF}' AND query_id <> 'error'),
base AS {_nearest_rank_sql('blog', 'query_id, metric', 'value', [(0.95, 'p95')])},
rows AS (
  SELECT 'first' AS step, query_id, metric, 'PASS' AS status, true AS measurement FROM base
  UNION ALL SELECT 'second', s.query_id, s.metric, CASE WHEN b.p95 IS NULL OR s.p95 <= b.p95 THEN 'PASS' ELSE 'FAIL' END, b.p95 IS NULL
  FROM stats s LEFT JOIN base b ON b.query_id = s.query_id AND b.metric = s.metric
  UNION ALL SELECT 'replaced', query_id, metric, 'PASS', false FROM stats
  UNION ALL SELECT 'tampered', query_id, metric, 'FAIL', false FROM stats)
SELECT step, 'regression:' || query_id || ':' || metric AS target, status, measurement, 2 AS last_version FROM rows"""


Q_["performance_baseline"] = q_v18_baseline
O_["performance_baseline"] = _v18_baseline_sql()


# ------------------------------------------------------------------ V19
def _elt(spark, sf, bad: bool):
    """load (staged CSV with declared schema) → transform (drop NULL epochs,
    convert the lying millis column, type the amount) → write → verify."""
    o = table(spark, sf, "orders")
    stg = D.orders_epoch(o)
    stage_path = scratch_dir(spark, "elt_staging")
    stg.write.mode("overwrite").option("header", "true").csv(stage_path)
    loaded = spark.read.schema(stg.schema).option("header", "true").csv(stage_path)
    mart = loaded.where(F.col("issued_sec").isNotNull()).select(
        "o_orderkey", epoch_to_ts(F.col("issued_sec"), "millis").alias("issued_ts"), "amount")
    if bad:   # the negative twin: one value changed in the transform, count unchanged
        mart = mart.withColumn("amount", F.when(F.col("o_orderkey") == F.lit(1), F.col("amount") + 1)
                               .otherwise(F.col("amount")))
    mart_path = scratch_dir(spark, "elt_mart")
    mart.write.mode("overwrite").parquet(mart_path)
    written = spark.read.parquet(mart_path)
    expected = stg.where(F.col("issued_sec").isNotNull()).select(
        "o_orderkey", epoch_to_ts(F.col("issued_sec"), "millis").alias("issued_ts"), "amount")
    label = "elt_mart_bad" if bad else "elt_mart"
    c = rowcount_counts(expected, written)
    rc = c.select(F.lit("rowcount_parity").alias("pattern"), F.lit(label).alias("target"),
                  F.when(F.col("src_n") == F.col("tgt_n"), "PASS").otherwise("FAIL").alias("status"),
                  F.col("src_n").cast("string").alias("expected"), F.col("tgt_n").cast("string").alias("actual"),
                  F.lit(False).alias("measurement"))
    fp = fingerprint_parity(expected, written, ["o_orderkey", "issued_ts", "amount"], label)
    cols_ok = set(written.columns) == {"o_orderkey", "issued_ts", "amount"}
    sc = spark.createDataFrame([("schema_conformance", label, "PASS" if cols_ok else "FAIL",
                                 "o_orderkey,issued_ts,amount", ",".join(sorted(written.columns)), False)], CHECKS_DDL)
    return rc.unionByName(fp.select(*CHECK_COLUMNS)).unionByName(sc)


def q_v19(spark, sf):
    return _elt(spark, sf, False).unionByName(_elt(spark, sf, True)).select("pattern", "target", "status")


Q_["elt_pipeline"] = q_v19
# the pipeline again in SQL: staged rows, the mart built from them and its twin with one amount changed
O_["elt_pipeline"] = f"""WITH {ORDERS_EPOCH},
want AS (SELECT o_orderkey, issued_sec, amount FROM orders_epoch WHERE issued_sec IS NOT NULL),
elt_mart AS (SELECT o_orderkey, issued_sec, amount FROM orders_epoch WHERE NOT (issued_sec IS NULL)),
elt_mart_bad AS (SELECT o_orderkey, issued_sec, CASE WHEN o_orderkey = 1 THEN amount + 1 ELSE amount END AS amount FROM elt_mart),
marts AS (SELECT 'elt_mart' AS mart, * FROM elt_mart UNION ALL SELECT 'elt_mart_bad', * FROM elt_mart_bad),
names AS (SELECT unnest(['elt_mart', 'elt_mart_bad']) AS mart),
compared AS (SELECT mart, (SELECT count(*) FROM want) AS wanted, (SELECT count(*) FROM marts m WHERE m.mart = names.mart) AS got,
  (SELECT count(*) FROM marts m JOIN want w ON w.o_orderkey = m.o_orderkey AND w.issued_sec = m.issued_sec AND w.amount = m.amount
   WHERE m.mart = names.mart) AS equal_rows,
  (SELECT string_agg(column_name, ',' ORDER BY column_name) FROM (DESCRIBE SELECT o_orderkey, issued_sec AS issued_ts, amount FROM elt_mart)) AS cols
  FROM names)
SELECT 'rowcount_parity' AS pattern, mart AS target, CASE WHEN wanted = got THEN 'PASS' ELSE 'FAIL' END AS status FROM compared
UNION ALL SELECT 'fingerprint_parity', mart, CASE WHEN wanted = got AND equal_rows = got THEN 'PASS' ELSE 'FAIL' END FROM compared
UNION ALL SELECT 'schema_conformance', mart, CASE WHEN cols = 'amount,issued_ts,o_orderkey' THEN 'PASS' ELSE 'FAIL' END FROM compared"""


# ------------------------------------------------------------------ V20
REQUIRED_PATTERNS = ["rowcount_parity", "fingerprint_parity", "fk_orphan", "merge_idempotency",
                     "transform_unit", "egress_parity", "schema_conformance", "aggregate_parity", "query_parity", "epoch_conversion",
                     "decimal_roundtrip", "scd2_continuity", "bulk_load", "transform_diff", "query_performance"]
# flow groups and the patterns each of them needs
FLOW_PATTERNS = {
    "Target Schema": ["epoch_conversion", "schema_conformance"],
    "Extract-Load": ["decimal_roundtrip", "bulk_load"],
    "Transform": ["rowcount_parity", "aggregate_parity", "fingerprint_parity", "epoch_conversion", "scd2_continuity", "merge_idempotency", "fk_orphan"],
    "Consumer Migration": ["query_parity"],
    "Egress": ["egress_parity"],
    "Historical Backfill": ["rowcount_parity", "aggregate_parity", "fingerprint_parity", "epoch_conversion", "scd2_continuity", "fk_orphan"],
}
# queries that list violations instead of check rows: the column that names the check, its checks, and which rows violate one
VIOLATIONS = {
    "epoch_conversion": ("unit", ["millis", "seconds"], "class NOT IN ('matched', 'null_ok', 'nulled_ok')"),
    "decimal_roundtrip": ("column", ["amount", "o_custkey", "place_20", "digits_25"], "true"),
    "scd2_continuity": ("variant", ["golden", "broken"], "violations > 0"),
    "transform_diff": ("variant", ["migrated", "rewrite_bad"], "true"),
}


def _signoff_rows(spark, sf, pattern):
    """(pattern, status, measurement) of every check of the query registered under the pattern's name, kept; a check without
    violations passes. A query that Spark refuses is one ERROR, and the other patterns go on. Files the query staged go once
    its rows are kept."""
    try:
        with scratch_scope(spark):
            return materialize(_status_rows(spark, sf, pattern))
    except PySparkException as e:
        return error_rows(spark, pattern, pattern, str(e)).select("pattern", "status", "measurement")


def _status_rows(spark, sf, pattern):
    from paritylake.plans.registry import QUERIES as ALL
    rows = ALL[pattern](spark, sf)
    if pattern in VIOLATIONS:
        by, names, bad = VIOLATIONS[pattern]
        found = rows.where(bad).agg(F.array(*[F.count_if(F.col(by) == n) for n in names]).alias("n")).select(F.explode("n").alias("n"))
        rows = found.select(F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"))
    own = lambda c, other: (F.col(c) if c in rows.columns else F.lit(other)).alias(c)
    return rows.select(own("pattern", pattern), "status", own("measurement", False))


def q_v20(spark, sf):
    """The checks of every pattern are run once each, so that the driver holds one pattern's plan at a time, and stored; the report
    reads the stored table: a row per pattern, and a GAP row for each required pattern, and each pattern of a flow group
    (``group: pattern``), without a PASS."""
    path = scratch_dir(spark, "signoff_checks")
    checks = reduce(lambda a, b: a.unionByName(b), [_signoff_rows(spark, sf, p) for p in REQUIRED_PATTERNS])
    checks.coalesce(1).write.parquet(path)
    u = spark.read.parquet(path)
    req = spark.createDataFrame([(p,) for p in REQUIRED_PATTERNS], "pattern string")
    flows = spark.createDataFrame([(f, p) for f, ps in FLOW_PATTERNS.items() for p in ps], "flow string, pattern string")
    summary, gaps = R.signoff(u, req)
    missing = gaps.select("pattern").unionByName(R.uncovered(u, flows).select(F.concat_ws(": ", "flow", "pattern").alias("pattern")))
    gap_rows = missing.select("pattern", F.lit("GAP").alias("status"), *[F.lit(0).cast("bigint").alias(c)
                                                                        for c in ("checks", "passed", "failed", "errors")])
    return summary.unionByName(gap_rows)


def _v20_sql():
    from paritylake.plans.registry import ORACLE as ALL

    def rows(p):
        if p in VIOLATIONS:
            by, names, bad = VIOLATIONS[p]
            return (f"SELECT '{p}' AS pattern, CASE WHEN name IN (SELECT \"{by}\" FROM ({ALL[p]}) WHERE {bad}) THEN 'FAIL' ELSE 'PASS' END AS status "
                    f"FROM (SELECT unnest({names}) AS name)")
        gate = " WHERE NOT measurement" if "AS measurement" in ALL[p] else ""
        return f"SELECT '{p}' AS pattern, status FROM ({ALL[p]}){gate}"
    u = "\nUNION ALL\n".join(rows(p) for p in REQUIRED_PATTERNS)
    req = ", ".join(f"('{p}')" for p in REQUIRED_PATTERNS)
    flows = ", ".join(f"('{f}', '{p}')" for f, ps in FLOW_PATTERNS.items() for p in ps)
    return f"""WITH u AS MATERIALIZED ({u}),
s AS (SELECT pattern,
        CASE max(CASE status WHEN 'ERROR' THEN 2 WHEN 'FAIL' THEN 1 ELSE 0 END) WHEN 2 THEN 'ERROR' WHEN 1 THEN 'FAIL' ELSE 'PASS' END AS status,
        CAST(count(*) AS BIGINT) AS checks, CAST(count(*) FILTER (WHERE status = 'PASS') AS BIGINT) AS passed,
        CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS failed,
        CAST(count(*) FILTER (WHERE status = 'ERROR') AS BIGINT) AS errors FROM u GROUP BY pattern),
req AS (SELECT * FROM (VALUES {req}) AS r(pattern)),
flows AS (SELECT * FROM (VALUES {flows}) AS f(flow, pattern))
SELECT * FROM s
UNION ALL
SELECT pattern, 'GAP', 0, 0, 0, 0 FROM req WHERE pattern NOT IN (SELECT pattern FROM u WHERE status = 'PASS')
UNION ALL
SELECT flow || ': ' || pattern, 'GAP', 0, 0, 0, 0 FROM flows WHERE pattern NOT IN (SELECT pattern FROM u WHERE status = 'PASS')"""


Q_["signoff_report"] = q_v20


# ------------------------------------------------------------------ X3 / X4 / X5
RETENTION_DAYS = 5 * 365


def q_x3(spark, sf):
    o = table(spark, sf, "orders")
    return R.retention(o, F.trunc(F.to_date("o_orderdate"), "month"), "o_orderdate", RETENTION_DAYS)


O_["retention_check"] = f"""WITH p AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS partition, CAST(count(*) AS BIGINT) AS rows,
  max(o_orderdate) AS newest FROM orders GROUP BY 1)
SELECT partition, rows, CAST(date_diff('day', CAST(newest AS DATE), CAST((SELECT max(newest) FROM p) AS DATE)) AS INTEGER) AS age_days,
  date_diff('day', CAST(newest AS DATE), CAST((SELECT max(newest) FROM p) AS DATE)) > {RETENTION_DAYS} AS expired FROM p"""
Q_["retention_check"] = q_x3


def q_x4(spark, sf):
    """Masked views must expose no raw value: golden mask = sha-256 of the
    name; broken twin leaves every 20th name in clear."""
    c = table(spark, sf, "customer")
    good = c.select("c_custkey", F.sha2("c_name", 256).alias("c_name"))
    bad = c.select("c_custkey", F.when(F.col("c_custkey") % 20 == 0, F.col("c_name"))
                   .otherwise(F.sha2("c_name", 256)).alias("c_name"))
    out = None
    for variant, m in (("sha256_mask", good), ("partial_mask", bad)):
        leaks = R.leaked_values(m, c, "c_name").agg(F.count(F.lit(1)).cast("bigint").alias("leaked"))
        r = leaks.select(F.lit(variant).alias("variant"), F.lit("c_name").alias("column"), "leaked",
                         F.when(F.col("leaked") == 0, "PASS").otherwise("FAIL").alias("status"))
        out = r if out is None else out.unionByName(r)
    return out


O_["masking_check"] = """WITH good AS (SELECT c_custkey, sha256(c_name) AS c_name FROM customer),
bad AS (SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN c_name ELSE sha256(c_name) END AS c_name FROM customer),
raw AS (SELECT DISTINCT c_name AS v FROM customer WHERE c_name IS NOT NULL)
SELECT 'sha256_mask' AS variant, 'c_name' AS "column", CAST(count(*) AS BIGINT) AS leaked,
  CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM good WHERE c_name IN (SELECT v FROM raw)
UNION ALL
SELECT 'partial_mask', 'c_name', CAST(count(*) AS BIGINT), CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END
FROM bad WHERE c_name IN (SELECT v FROM raw)"""
Q_["masking_check"] = q_x4


def q_x5(spark, sf):
    """Manifest parity: a manifest of the source (count + digest) is saved to
    the shared folder; the live target is compared with it after the source
    is no longer read."""
    o = table(spark, sf, "orders")
    names = [c for c, _ in ORDERS_COLS]
    path = scratch_dir(spark, "orders_manifest")
    digest(o, names).write.mode("overwrite").parquet(path)
    manifest = spark.read.parquet(path)
    live_same = digest(table(spark, sf, "orders"), names)
    live_tgt = digest(D.orders_tgt(table(spark, sf, "orders")), names)
    return (R.manifest_compare(live_same, manifest, "orders_reload")
            .unionByName(R.manifest_compare(live_tgt, manifest, "orders_tgt"))).select("pattern", "target", "status")


O_["manifest_parity"] = f"""WITH {ORDERS_TGT},
m AS {digest_of('orders', ORDERS_COLS)}, t AS {digest_of('orders_tgt', ORDERS_COLS)},
r AS {digest_of('(SELECT * FROM orders ORDER BY o_totalprice) AS reloaded', ORDERS_COLS)}
SELECT 'manifest_parity' AS pattern, 'orders_reload:rowcount' AS target, CASE WHEN r.n = m.n THEN 'PASS' ELSE 'FAIL' END AS status FROM m, r
UNION ALL SELECT 'manifest_parity', 'orders_reload:fingerprint',
  CASE WHEN r.n = m.n AND r.s1 = m.s1 AND r.s2 = m.s2 AND r.x = m.x THEN 'PASS' ELSE 'FAIL' END FROM m, r
UNION ALL SELECT 'manifest_parity', 'orders_tgt:rowcount', CASE WHEN t.n = m.n THEN 'PASS' ELSE 'FAIL' END FROM m, t
UNION ALL SELECT 'manifest_parity', 'orders_tgt:fingerprint',
  CASE WHEN t.n = m.n AND t.s1 = m.s1 AND t.s2 = m.s2 AND t.x = m.x THEN 'PASS' ELSE 'FAIL' END FROM m, t"""
Q_["manifest_parity"] = q_x5

QUERIES = dict(Q_)
ORACLE = dict(O_)


def late_oracle():
    """Oracles that compose other families' SQL (resolved after registration)."""
    return {"signoff_report": _v20_sql()}
