"""Registered file-side queries (S1-S4, S7-S13, V14, V15, X1, V18a) and
their DuckDB oracle SQL (counts and digests read back, never timings)."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from paritylake.checks import CHECK_COLUMNS
from paritylake.plans import derived as D
from paritylake.plans.oracle import ORDERS_COLS, ORDERS_SNAPSHOT, ORDERS_TGT, digest_of
from paritylake.session import materialize, scratch_dir
from paritylake.sources import files as FS
from paritylake.sources.tables import table

Q_: dict = {}
O_: dict = {}


def key(name, sql=None):
    def deco(fn):
        Q_[name] = fn
        if sql is not None:
            O_[name] = sql
        return fn
    return deco


def _loaded(spark, df, name):
    """Formats this class path can load; the others say UNSUPPORTED in ``load_formats`` and prove nothing here."""
    return FS.load_formats(spark, df, name).where(F.col("status") != FS.UNSUPPORTED)


@key("load_formats", """SELECT f AS format, CAST(n AS BIGINT) AS expected, CAST(n AS BIGINT) AS landed,
  CASE WHEN n = (SELECT count(o_orderkey) FROM orders) THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT count(*) AS n FROM orders), (VALUES ('json'), ('csv'), ('parquet'), ('orc')) AS t(f)""")
def q_s1(spark, sf):
    return _loaded(spark, table(spark, sf, "orders"), "orders")


def _hive_layout(spark, sf):
    o = table(spark, sf, "orders")
    path = scratch_dir(spark, "orders_hive")
    FS.by_date(o.withColumn("shard", (F.col("o_orderkey") % 4).cast("int")), "shard").write.mode("overwrite") \
        .partitionBy("shard").parquet(path)
    return path


@key("load_hive_partitioned", """SELECT m AS mode, t AS shard_type, CAST(4 AS BIGINT) AS partitions, CAST(n AS BIGINT) AS rows
FROM (SELECT count(*) AS n FROM orders), (VALUES ('AUTO', 'int'), ('STRINGS', 'string'), ('CUSTOM', 'bigint')) AS v(m, t)""")
def q_s2(spark, sf):
    """col=value layout loaded three ways: AUTO (type inference), STRINGS
    (inference off) and CUSTOM (declared schema); the partition column must be
    present in every mode."""
    path = _hive_layout(spark, sf)
    conf = "spark.sql.sources.partitionColumnTypeInference.enabled"
    prev = spark.conf.get(conf)
    out = []
    try:
        for mode in ("AUTO", "STRINGS", "CUSTOM"):
            spark.conf.set(conf, "false" if mode == "STRINGS" else "true")
            r = spark.read.option("basePath", path)
            if mode == "CUSTOM":
                sch = table(spark, sf, "orders").schema.add("shard", T.LongType())
                r = r.schema(sch)
            df = r.parquet(path)
            typ = df.schema["shard"].dataType.simpleString()
            agg = df.agg(F.count_distinct("shard").cast("bigint").alias("partitions"),
                         F.count(F.lit(1)).cast("bigint").alias("rows"))
            out.append(agg.select(F.lit(mode).alias("mode"), F.lit(typ).alias("shard_type"),
                                  "partitions", "rows"))
    finally:
        spark.conf.set(conf, prev)
    u = out[0]
    for o in out[1:]:
        u = u.unionByName(o)
    return u


def _n_files(df, rows_per_file=500_000):
    """Files for a staged copy: as many as its rows fill, two at least."""
    return max(2, -(-df.count() // rows_per_file))


BANNER = ["# orders extract", "# generated by the staging job"]


@key("load_csv_options", """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS keys,
  CAST(sum(o_orderkey) AS BIGINT) AS key_sum, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS total FROM orders""")
def q_s3(spark, sf):
    """Pipe-delimited files with two banner lines and a header per file: the
    three leading lines are dropped by per-file position, the rest parsed."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    path = scratch_dir(spark, "orders_banner_csv")
    FS.write_with_banner(o, path, _n_files(o), BANNER)
    back = FS.skip_leading_rows(spark, path, len(BANNER) + 1, schema=o.schema)
    return back.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                    F.count_distinct("o_orderkey").cast("bigint").alias("keys"),
                    F.sum("o_orderkey").cast("bigint").alias("key_sum"),
                    F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("string").alias("total"))


@key("build_load", """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(6 AS BIGINT) AS columns,
  CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders""")
def q_s4(spark, sf):
    """Bundle load step: CSV with header → schema inferred → truncate-and-load
    into a Parquet table path → read back."""
    o = table(spark, sf, "orders")
    src = scratch_dir(spark, "orders_csv_src")
    o.write.mode("overwrite").option("header", "true").csv(src)
    inferred = spark.read.option("header", "true").option("inferSchema", "true").csv(src)
    dst = scratch_dir(spark, "orders_loaded")
    inferred.write.mode("overwrite").parquet(dst)
    inferred.write.mode("overwrite").parquet(dst)      # truncate-and-load twice: no duplicates
    back = spark.read.parquet(dst)
    return back.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                    F.lit(len(back.columns)).cast("bigint").alias("columns"),
                    F.sum(F.col("o_orderkey").cast("bigint")).cast("bigint").alias("key_sum"))


EXPORT_SCHEMA = T.StructType([T.StructField("o_orderkey", T.LongType()),
                              T.StructField("o_custkey", T.LongType()),
                              T.StructField("amount", T.DecimalType(14, 2))])


def _export(spark, sf, lossy=False):
    o = table(spark, sf, "orders")
    df = D.orders_target_snapshot(o)
    if lossy:
        df = df.where(F.col("o_orderkey") != F.lit(0))
    path = scratch_dir(spark, "orders_export")
    FS.export_json(df, path)
    return df, path


@key("export_json", """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS VARCHAR) AS total FROM orders""")
def q_s7(spark, sf):
    _, path = _export(spark, sf)
    back = spark.read.text(path).where(F.trim("value") != "")
    parsed = back.select(F.from_json("value", EXPORT_SCHEMA).alias("r")).select("r.*")
    return parsed.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                      F.sum("amount").cast("string").alias("total"))


@key("readback_json", """SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS keys,
  CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS VARCHAR) AS total FROM orders""")
def q_s8(spark, sf):
    _, path = _export(spark, sf)
    back = FS.readback_json(spark, path, EXPORT_SCHEMA)
    return back.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                    F.count_distinct("o_orderkey").cast("bigint").alias("keys"),
                    F.sum("amount").cast("string").alias("total"))


_STAGE_DIGEST = f"SELECT n, CAST(s1 AS VARCHAR) AS s1, CAST(s2 AS VARCHAR) AS s2, x FROM {digest_of('orders', ORDERS_COLS)}"


@key("stage_layouts", f"""WITH d AS ({_STAGE_DIGEST})
SELECT l AS layout, n, s1, s2, x FROM d, (VALUES ('source'), ('ndjson'), ('csv'), ('parquet'), ('json_by_date')) AS t(l)""")
def q_s9(spark, sf):
    o = table(spark, sf, "orders")
    r = FS.stage_layouts(spark, o, "o_orderdate", "orders_stage")
    return r.select("layout", "n", F.col("s1").cast("string").alias("s1"),
                    F.col("s2").cast("string").alias("s2"), "x")


@key("synth_table", """WITH s AS (SELECT l_orderkey AS id, l_returnflag AS segment, l_orderkey % 1000000 AS customer_id,
        CAST(CAST((('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || ':' || l_returnflag), 1, 8))::BIGINT % 100000) AS DECIMAL(14,2)) / 100 AS DECIMAL(12,2)) AS amount,
        DATE '2024-01-01' + CAST(l_orderkey % 365 AS INTEGER) AS event_date,
        (['web', 'phone', 'chat'])[CAST(l_orderkey % 3 + 1 AS INTEGER)] AS channel
      FROM lineitem)
SELECT channel, segment, CAST(count(*) AS BIGINT) AS rows, CAST(sum(amount) AS VARCHAR) AS total,
  min(event_date) AS first_date, max(event_date) AS last_date, CAST(count(DISTINCT customer_id) AS BIGINT) AS customers
FROM s GROUP BY channel, segment""")
def q_s10(spark, sf):
    """One synthetic row for each line item, from its order key and flag."""
    s = FS.synth_table(table(spark, sf, "lineitem"), "l_orderkey", "l_returnflag")
    return s.groupBy("channel", "segment").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"), F.sum("amount").cast("string").alias("total"),
        F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"),
        F.count_distinct("customer_id").cast("bigint").alias("customers"))


@key("scan_filter", f"""WITH {ORDERS_TGT}
SELECT (SELECT CAST(count(*) AS BIGINT) FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000) AS src_n,
       (SELECT CAST(count(*) AS BIGINT) FROM orders_tgt WHERE o_orderstatus = 'F') AS tgt_n""")
def q_s11(spark, sf):
    o = table(spark, sf, "orders")
    from paritylake.operators.parity import rowcount_counts
    return rowcount_counts(o, D.orders_tgt(o), "o_orderstatus = 'F' AND o_totalprice > 100000",
                           "o_orderstatus = 'F'")


RANGES = 16


@key("table_layouts", f"""WITH w AS (SELECT (max(o_orderkey) + {RANGES}) // {RANGES} AS width FROM orders)
SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS order_year, o_orderkey // width AS key_range, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers FROM orders, w GROUP BY 1, 2""")
def q_s12(spark, sf):
    """DDL layouts: a table partitioned by date (year) with column comments and clustered by customer, filled by INSERT, a
    CTAS copy partitioned by integer range (a fixed number of ranges at any size), and a view over it that is read back.
    Table names are new each time; their files lie in the scratch folder."""
    o = table(spark, sf, "orders")
    width = ((o.agg(F.max("o_orderkey")).first()[0] or 0) + RANGES) // RANGES
    loc, ctas = scratch_dir(spark, "orders_dated"), scratch_dir(spark, "orders_ranged")
    dated, ranged = f"paritylake_{loc[-12:]}", f"paritylake_{ctas[-12:]}"
    o.select("o_orderkey", "o_custkey", "o_totalprice", F.trunc(F.to_date("o_orderdate"), "year").alias("order_year")) \
        .createOrReplaceTempView(f"{dated}_src")
    spark.sql(f"""CREATE TABLE {dated} (
        o_orderkey BIGINT COMMENT 'order key', o_custkey BIGINT COMMENT 'customer key',
        o_totalprice DOUBLE, order_year DATE COMMENT 'first day of the year')
        USING parquet PARTITIONED BY (order_year) CLUSTERED BY (o_custkey) INTO 8 BUCKETS LOCATION '{loc}'""")
    spark.sql(f"INSERT OVERWRITE {dated} SELECT /*+ REPARTITION(o_custkey) */ o_orderkey, o_custkey, o_totalprice, order_year FROM {dated}_src")
    spark.sql(f"""CREATE TABLE {ranged} USING parquet PARTITIONED BY (key_range) LOCATION '{ctas}'
        AS SELECT /*+ REPARTITION(key_range) */ * FROM (SELECT *, o_orderkey DIV {width} AS key_range FROM {dated})""")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {ranged}_v AS SELECT order_year, key_range, o_custkey FROM {ranged}")
    return spark.sql(f"""SELECT order_year, key_range, CAST(count(*) AS BIGINT) AS rows,
        CAST(count(DISTINCT o_custkey) AS BIGINT) AS customers FROM {ranged}_v GROUP BY order_year, key_range""")


@key("partition_collapse", """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS event_date, CAST(count(*) AS BIGINT) AS rows,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem GROUP BY 1""")
def q_s13(spark, sf):
    """(year, month) partition layout collapsed to one date partition, written with dynamic partition overwrite, its rows
    clustered (sorted) by key within each file, then read back."""
    li = table(spark, sf, "lineitem")
    two = scratch_dir(spark, "lineitem_ym")
    FS.by_date(li.withColumn("ship_year", F.year("l_shipdate")).withColumn("ship_month", F.month("l_shipdate")), "ship_year", "ship_month") \
        .write.mode("overwrite").partitionBy("ship_year", "ship_month").parquet(two)
    src = spark.read.parquet(two)
    one = scratch_dir(spark, "lineitem_by_date")
    dated = src.withColumn("event_date", F.make_date("ship_year", "ship_month", F.lit(1))).drop("ship_year", "ship_month")
    (FS.by_date(dated, "event_date").sortWithinPartitions("event_date", "l_orderkey")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(one))
    back = spark.read.parquet(one)
    return back.groupBy("event_date").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("qty"))


@key("bulk_load", """WITH n AS (SELECT count(*) AS n FROM orders)
SELECT 'bulk_load' AS pattern, 'format:' || f AS target,
  CASE WHEN n = (SELECT count(o_orderkey) FROM orders) THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(n AS VARCHAR) AS expected, CAST(n AS VARCHAR) AS actual, false AS measurement
FROM n, (VALUES ('json'), ('csv'), ('parquet'), ('orc')) AS t(f)
UNION ALL SELECT 'bulk_load', 'count_expectation', 'FAIL', '99', CAST(n AS VARCHAR), false FROM n
UNION ALL SELECT 'bulk_load', 'partition_column:shard', 'PASS', 'shard', 'shard', false
UNION ALL SELECT 'bulk_load', 'partition_column:event_date', 'FAIL', 'event_date', NULL, false
UNION ALL SELECT 'bulk_load', 'csv_skip_leading_rows', 'PASS', CAST(n AS VARCHAR), CAST(n AS VARCHAR), false FROM n""")
def q_v14(spark, sf):
    """Format loads, a wrong count expectation (twin), partition column
    presence (present / missing twin) and the CSV leading-row load."""
    o = table(spark, sf, "orders")
    fm = _loaded(spark, o, "bulk")
    rows = fm.select(F.lit("bulk_load").alias("pattern"), F.concat(F.lit("format:"), "format").alias("target"),
                     "status", F.col("expected").cast("string").alias("expected"),
                     F.col("landed").cast("string").alias("actual"), F.lit(False).alias("measurement"))
    n = o.agg(F.count(F.lit(1)).alias("n"))
    twin = n.select(F.lit("bulk_load").alias("pattern"), F.lit("count_expectation").alias("target"),
                    F.when(F.col("n") == 99, "PASS").otherwise("FAIL").alias("status"),
                    F.lit("99").alias("expected"), F.col("n").cast("string").alias("actual"),
                    F.lit(False).alias("measurement"))
    hive_path = _hive_layout(spark, sf)
    hive = spark.read.option("basePath", hive_path).parquet(hive_path)
    part = []
    for col in ("shard", "event_date"):
        present = col in hive.columns
        part.append((("bulk_load", f"partition_column:{col}", "PASS" if present else "FAIL", col,
                      col if present else None, False)))
    part_df = spark.createDataFrame(part, "pattern string, target string, status string, expected string, "
                                          "actual string, measurement boolean")
    path = scratch_dir(spark, "bulk_banner")
    sub = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    FS.write_with_banner(sub, path, _n_files(sub), BANNER)
    back = FS.skip_leading_rows(spark, path, len(BANNER) + 1, schema=sub.schema)
    landed = back.select(F.lit(1).alias("_s")).unionByName(o.select(F.lit(2).alias("_s"))).agg(
        F.count_if(F.col("_s") == 1).alias("got"), F.count_if(F.col("_s") == 2).alias("want"))
    csv_row = landed.select(F.lit("bulk_load").alias("pattern"), F.lit("csv_skip_leading_rows").alias("target"),
                            F.when(F.col("got") == F.col("want"), "PASS").otherwise("FAIL").alias("status"),
                            F.col("want").cast("string").alias("expected"), F.col("got").cast("string").alias("actual"),
                            F.lit(False).alias("measurement"))
    return rows.unionByName(twin).unionByName(part_df).unionByName(csv_row).select(*CHECK_COLUMNS)


def _egress_checks(spark, sf, lossy, label):
    src, path = _export(spark, sf, lossy=lossy)
    full = D.orders_target_snapshot(table(spark, sf, "orders"))
    back = FS.readback_json(spark, path, EXPORT_SCHEMA)
    from paritylake.operators.parity import fingerprint_parity
    from paritylake.operators.aggregates import control_total
    fp = fingerprint_parity(full, back, ["o_orderkey", "o_custkey", "amount"], f"{label}:rows")
    ct_a = control_total(full, "amount").withColumn("_s", F.lit(1))
    ct_b = control_total(back, "amount").withColumn("_s", F.lit(2))
    ct = ct_a.unionByName(ct_b).agg(
        F.max(F.when(F.col("_s") == 1, F.col("rows"))).alias("ra"), F.max(F.when(F.col("_s") == 2, F.col("rows"))).alias("rb"),
        F.max(F.when(F.col("_s") == 1, F.col("total"))).alias("ta"), F.max(F.when(F.col("_s") == 2, F.col("total"))).alias("tb"))
    cnt = ct.select(F.lit("egress_parity").alias("pattern"), F.lit(f"{label}:count").alias("target"),
                    F.when(F.col("ra") == F.col("rb"), "PASS").otherwise("FAIL").alias("status"),
                    F.col("ra").cast("string").alias("expected"), F.col("rb").cast("string").alias("actual"),
                    F.lit(False).alias("measurement"))
    tot = ct.select(F.lit("egress_parity").alias("pattern"), F.lit(f"{label}:control_total").alias("target"),
                    F.when(F.col("ta") == F.col("tb"), "PASS").otherwise("FAIL").alias("status"),
                    F.col("ta").cast("string").alias("expected"), F.col("tb").cast("string").alias("actual"),
                    F.lit(False).alias("measurement"))
    return fp.withColumn("pattern", F.lit("egress_parity")).select("pattern", "target", "status") \
        .unionByName(cnt.select("pattern", "target", "status")).unionByName(tot.select("pattern", "target", "status"))


_EGRESS = """SELECT '{label}:' || what AS target, CASE WHEN same THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT unnest(['rows', 'count', 'control_total']) AS what, unnest([
    (SELECT count(*) FROM (SELECT o_orderkey, o_custkey, amount FROM orders_snap EXCEPT ALL SELECT o_orderkey, o_custkey, amount FROM {landed})) = 0,
    (SELECT count(*) FROM orders_snap) = (SELECT count(*) FROM {landed}),
    (SELECT sum(amount) FROM orders_snap) = (SELECT sum(amount) FROM {landed})]) AS same)"""


@key("egress_parity", f"""WITH {ORDERS_SNAPSHOT}, lossy AS (SELECT * FROM orders_snap WHERE o_orderkey <> 0)
SELECT 'egress_parity' AS pattern, * FROM ({_EGRESS.format(label='export', landed='orders_snap')})
UNION ALL SELECT 'egress_parity', * FROM ({_EGRESS.format(label='lossy', landed='lossy')})""")
def q_v15(spark, sf):
    return _egress_checks(spark, sf, False, "export").unionByName(_egress_checks(spark, sf, True, "lossy"))


SHARDS = 7


@key("file_manifest_check", f"""WITH s AS (SELECT CAST(o_orderkey % {SHARDS} AS VARCHAR) AS shard, count(*) AS n,
    count(*) FILTER (WHERE o_orderkey // {SHARDS} % 2 = 0) AS half FROM orders GROUP BY 1)
SELECT 'intake:' || shard AS target, CAST(CASE WHEN shard = '5' THEN 0 ELSE n END AS BIGINT) AS expected_rows,
  CAST(CASE shard WHEN '1' THEN half WHEN '3' THEN 0 WHEN '4' THEN 0 ELSE n END AS BIGINT) AS landed_rows,
  CASE WHEN shard IN ('0', '2') OR (shard = '1' AND half = n) THEN 'PASS' ELSE 'QUARANTINE' END AS status,
  CASE shard WHEN '1' THEN CASE WHEN half <> n THEN 'rows' END WHEN '2' THEN NULL WHEN '3' THEN 'absent' WHEN '4' THEN 'absent'
    WHEN '5' THEN 'not in the manifest' WHEN '6' THEN 'checksum' END AS reason
FROM s
UNION ALL
SELECT 'header:' || v, 2, CASE v WHEN 'golden' THEN 2 ELSE 0 END, CASE v WHEN 'golden' THEN 'PASS' ELSE 'QUARANTINE' END,
  CASE v WHEN 'golden' THEN NULL ELSE 'header' END
FROM (VALUES ('golden'), ('drifted')) AS t(v) WHERE (SELECT count(*) FROM orders) > 0""")
def q_x1(spark, sf):
    """Intake of gzip files against a manifest made from the table, not from the files, and the sender's file digests: shard 1
    lost half its rows, 3 was not delivered, 4 is a damaged archive, 5 is not in the manifest, 6 was exchanged for other rows
    that are as many and add up to the same; and the headers of delivered files."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(14,2)").alias("amount"))
    shard = (F.col("o_orderkey") % SHARDS).cast("string")
    manifest = o.groupBy(shard.alias("shard")).agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("total")).where("shard <> '5'")
    path, opts = scratch_dir(spark, "orders_delivery"), {"sep": FS.CSV_SEP}
    sent = o.withColumn("shard", shard)
    gz = lambda df, to: df.write.mode("overwrite").options(**opts, compression="gzip").csv(to)
    FS.by_date(sent.where("shard NOT IN ('3', '4')"), "shard").write.partitionBy("shard").options(**opts, compression="gzip").csv(path)
    digests = materialize(FS.file_digests(spark, path, "shard"))
    gz(sent.where(f"shard = '1' AND floor(o_orderkey / {SHARDS}) % 2 = 0").drop("shard"), f"{path}/shard=1")
    gz(sent.where("shard = '6'").select(F.col("o_orderkey") + 1, "amount"), f"{path}/shard=6")
    # plain text under a gzip name: the archive's first bytes are wrong
    FS.damaged_archives(spark, sent.where("shard = '4'").drop("shard"), f"{path}/shard=4", opts)
    got = FS.intake(spark, path, o.schema, "shard", "amount", manifest, digests).select(
        F.concat(F.lit("intake:"), "shard").alias("target"), F.col("expected_rows").cast("bigint").alias("expected_rows"),
        F.col("landed_rows").cast("bigint").alias("landed_rows"), "status", "reason")
    names = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    header = ",".join(names.columns)
    for variant, df in (("golden", names), ("drifted", names.withColumnRenamed("o_custkey", "custkey"))):
        at = scratch_dir(spark, f"orders_csv_{variant}")
        df.repartition(2).write.option("header", "true").csv(at)
        h = FS.header_drift(spark, at, header).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "PASS").alias("ok"))
        bad = F.col("ok") < F.col("n")
        got = got.unionByName(h.select(F.lit(f"header:{variant}").alias("target"), F.col("n").cast("bigint").alias("expected_rows"),
                                       F.col("ok").cast("bigint").alias("landed_rows"), F.when(bad, "QUARANTINE").otherwise("PASS").alias("status"),
                                       F.when(bad, "header").alias("reason")))
    return got


@key("scan_bytes", """WITH n AS (SELECT count(*) AS parts, count(*) FILTER (WHERE m = '1998-06') AS one FROM (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS m FROM orders))
SELECT 'pruned_to_one_month' AS scan, CAST(one AS BIGINT) AS partitions_read, CASE WHEN one < parts THEN 'PASS' ELSE 'FAIL' END AS fewer_bytes FROM n
UNION ALL SELECT 'full', parts, 'PASS' FROM n""")
def q_v18a(spark, sf):
    """Partitions a full and a pruned scan read, and whether the pruned one reads fewer bytes."""
    o = table(spark, sf, "orders")
    path = scratch_dir(spark, "orders_month_bytes")
    FS.by_date(o.withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM")), "order_month").write.mode("overwrite") \
        .partitionBy("order_month").parquet(path)
    part = spark.read.parquet(path)
    pruned = part.where(F.col("order_month") == "1998-06")
    months = lambda df: df.agg(F.count_distinct("order_month").alias("n")).scalar()
    size = lambda df: FS.scan_bytes(df).select("bytes_scanned").scalar()
    one = spark.range(1)
    return (one.select(F.lit("pruned_to_one_month").alias("scan"), months(pruned).alias("partitions_read"),
                       F.when(size(pruned) < size(part), "PASS").otherwise("FAIL").alias("fewer_bytes"))
            .unionByName(one.select(F.lit("full").alias("scan"), months(part).alias("partitions_read"),
                                    F.when(size(part) > 0, "PASS").otherwise("FAIL").alias("fewer_bytes"))))


QUERIES = dict(Q_)
ORACLE = dict(O_)
