"""Registered per-operator queries: projection / filter (P1-P9), joins (J1-J3,
J7, J8, J12, J13), aggregation (A2-A8, A15-A21), windows (W2-W4, T2, T3),
set operations (U2, U4, U5) and scalar functions (F1-F3, F5, F7-F13), with
their DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import Window, functions as F, types as T

from paritylake.functions.canon import canon_text, row_text
from paritylake.functions.canon_sql import row_text_sql, stripped_sql, text_sql
from paritylake.operators import aggregates as AG
from paritylake.operators import parity as P
from paritylake.operators.windows import global_rank, neighbours, ntile_col, percent_rank_col
from paritylake.plans import derived as D
from paritylake.plans import marts as Q
from paritylake.plans.oracle import (ORDERS_DELTA, ORDERS_EPOCH, ORDERS_TGT, ORDERS_NAMES,
                                     EVENTS_SCD2, EVENTS_SCD2_BROKEN)
from paritylake.session import scratch_dir
from paritylake.sources.files import by_date
from paritylake.sources.tables import table

Q_ = {}
O_ = {}


def key(name, sql=None):
    def deco(fn):
        Q_[name] = fn
        if sql is not None:
            O_[name] = sql
        return fn
    return deco


# =============================================================== 2.2 projection / filter
@key("elt_project_filter", f"""WITH {ORDERS_DELTA}
SELECT o_orderkey, amount, op FROM orders_delta WHERE op IN ('I', 'U')""")
def q_p1(spark, sf):
    d = D.orders_delta(table(spark, sf, "orders"))
    return d.where(F.col("op").isin("I", "U")).select("o_orderkey", F.col("amount").cast("string").alias("amount"), "op")


O_["elt_project_filter"] = O_["elt_project_filter"].replace(
    "SELECT o_orderkey, amount, op", "SELECT o_orderkey, CAST(amount AS VARCHAR) AS amount, op")


def _mixed_case_delta(spark, sf):
    d = D.orders_delta(table(spark, sf, "orders"))
    return d.withColumn("op", F.when(F.col("o_orderkey") % 3 == 0, F.lower("op")).otherwise(F.col("op")))


@key("normalize_then_filter", f"""WITH {ORDERS_DELTA},
m AS (SELECT o_orderkey, amount, CASE WHEN o_orderkey % 3 = 0 THEN lower(op) ELSE op END AS op FROM orders_delta)
SELECT o_orderkey, upper(op) AS op FROM m WHERE upper(op) IN ('I', 'U')""")
def q_p2(spark, sf):
    d = _mixed_case_delta(spark, sf)
    return d.where(F.upper("op").isin("I", "U")).select("o_orderkey", F.upper("op").alias("op"))


@key("case_banding", """SELECT o_orderkey,
  CASE WHEN o_totalprice >= 300000 OR o_orderpriority = '1-URGENT' THEN 'TOP'
       WHEN o_totalprice >= 150000 AND o_orderstatus = 'O' THEN 'OPEN_HIGH'
       WHEN o_totalprice >= 150000 THEN 'HIGH' ELSE 'STANDARD' END AS band FROM orders""")
def q_p3(spark, sf):
    o = table(spark, sf, "orders")
    p = F.col("o_totalprice")
    band = (F.when((p >= 300000) | (F.col("o_orderpriority") == "1-URGENT"), "TOP")
            .when((p >= 150000) & (F.col("o_orderstatus") == "O"), "OPEN_HIGH")
            .when(p >= 150000, "HIGH").otherwise("STANDARD"))
    return o.select("o_orderkey", band.alias("band"))


@key("null_blank_filter", f"""WITH {ORDERS_EPOCH},
e AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(issued_sec AS VARCHAR) END AS ref FROM orders_epoch)
SELECT 'usable' AS kind, CAST(count(*) AS BIGINT) AS n FROM e WHERE ref IS NOT NULL AND ref <> ''
UNION ALL SELECT 'null_root', CAST(count(*) AS BIGINT) FROM e WHERE ref IS NULL""")
def q_p4(spark, sf):
    e = D.orders_epoch(table(spark, sf, "orders")).select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, F.lit("")).otherwise(
            F.col("issued_sec").cast("string")).alias("ref"))
    usable = e.where(F.col("ref").isNotNull() & (F.col("ref") != "")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit("usable").alias("kind"), "n")
    root = e.where(F.col("ref").isNull()).agg(F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.lit("null_root").alias("kind"), "n")
    return usable.unionByName(root)


@key("like_in_predicates", """SELECT l_returnflag,
  CAST(sum(CASE WHEN p_type LIKE 'ECON%' THEN 1 ELSE 0 END) AS BIGINT) AS econ_lines,
  CAST(sum(CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') THEN 1 ELSE 0 END) AS BIGINT) AS brand_lines,
  CAST(sum(CASE WHEN p_name LIKE '%bolt%' AND l_linestatus IN ('F') THEN 1 ELSE 0 END) AS BIGINT) AS bolt_f_lines
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_returnflag""")
def q_p5(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    j = li.join(p, li["l_partkey"] == p["p_partkey"])
    one = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("bigint")
    return j.groupBy("l_returnflag").agg(
        one(F.col("p_type").like("ECON%")).alias("econ_lines"),
        one(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3")).alias("brand_lines"),
        one(F.col("p_name").like("%bolt%") & F.col("l_linestatus").isin("F")).alias("bolt_f_lines"))


@key("bool_flag_filter", f"""WITH {EVENTS_SCD2_BROKEN}
SELECT user_id, eff_from, event_type FROM events_scd2_broken WHERE is_current = TRUE AND event_type <> 'error'""")
def q_p6(spark, sf):
    v = D.broken_scd2(D.events_scd2(table(spark, sf, "events")))
    return v.where((F.col("is_current") == F.lit(True)) & (F.col("event_type") != "error")).select(
        "user_id", "eff_from", "event_type")


@key("date_partition_filter", None)
def q_p7(spark, sf):
    """Partition pruning: orders written partitioned by order month into the
    shared scratch folder, read back with an equality filter on the partition
    column (a PartitionFilters scan), compared with the unpartitioned filter."""
    o = table(spark, sf, "orders")
    path = scratch_dir(spark, "orders_by_month")
    (by_date(o.withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM")), "order_month")
     .write.mode("overwrite").partitionBy("order_month").parquet(path))
    part = spark.read.parquet(path)
    pruned = part.where(F.col("order_month") == "1998-06").agg(
        F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit("pruned").alias("scan"), "n")
    full = o.where(F.date_format("o_orderdate", "yyyy-MM") == "1998-06").agg(
        F.count(F.lit(1)).cast("bigint").alias("n")).select(F.lit("full").alias("scan"), "n")
    return pruned.unionByName(full)


O_["date_partition_filter"] = """SELECT 'pruned' AS scan, CAST(count(*) AS BIGINT) AS n FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1998-06'
UNION ALL SELECT 'full', CAST(count(*) AS BIGINT) FROM orders WHERE strftime(o_orderdate, '%Y-%m') = '1998-06'"""


@key("conditional_replace", """SELECT o_orderkey,
  CASE WHEN o_orderkey % 101 = 0 THEN CAST(o_totalprice AS DECIMAL(14,2)) + 0.01 ELSE CAST(o_totalprice AS DECIMAL(14,2)) END AS amount
FROM orders""")
def q_p8(spark, sf):
    o = table(spark, sf, "orders")
    amt = F.col("o_totalprice").cast("decimal(14,2)")
    r = F.expr("if(o_orderkey % 101 = 0, CAST(o_totalprice AS DECIMAL(14,2)) + 0.01, CAST(o_totalprice AS DECIMAL(14,2)))")
    return o.select("o_orderkey", r.cast("decimal(15,2)").cast("double").alias("amount"))


O_["conditional_replace"] = """SELECT o_orderkey,
  CAST(CASE WHEN o_orderkey % 101 = 0 THEN CAST(o_totalprice AS DECIMAL(14,2)) + 0.01 ELSE CAST(o_totalprice AS DECIMAL(14,2)) END AS DOUBLE) AS amount
FROM orders"""


@key("arith_margin", """WITH rev AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue FROM lineitem GROUP BY 1),
ret AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT o.o_orderkey, CAST(coalesce(rev.revenue, 0) - coalesce(ret.returned, 0) - CAST(o.o_totalprice AS DECIMAL(18,2)) * 0.01 AS DOUBLE) AS margin
FROM orders o LEFT JOIN rev ON rev.l_orderkey = o.o_orderkey LEFT JOIN ret ON ret.l_orderkey = o.o_orderkey""")
def q_p9(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    ext = F.col("l_extendedprice").cast("decimal(18,2)")
    rev = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(ext).alias("revenue"))
    ret = li.where(F.col("l_returnflag") == "R").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(ext).alias("returned"))
    j = o.join(rev, "o_orderkey", "left").join(ret, "o_orderkey", "left")
    z = F.lit(0).cast("decimal(18,2)")
    m = (F.coalesce("revenue", z) - F.coalesce("returned", z)
         - F.col("o_totalprice").cast("decimal(18,2)") * F.lit(0.01).cast("decimal(3,2)"))
    return j.select("o_orderkey", m.cast("double").alias("margin"))


# =============================================================== 2.3 joins
@key("inner_equi", """SELECT p_type, CAST(count(*) AS BIGINT) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def q_j1(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return li.join(p, li["l_partkey"] == p["p_partkey"], "inner").groupBy("p_type").agg(
        F.count(F.lit(1)).cast("bigint").alias("lines"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("qty"))


@key("left_outer_multi", """WITH oa AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1),
la AS (SELECT o_custkey, count(*) AS n_lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT c.c_custkey, CAST(coalesce(oa.n_orders, 0) AS BIGINT) AS n_orders, CAST(coalesce(la.n_lines, 0) AS BIGINT) AS n_lines
FROM customer c LEFT JOIN oa ON oa.o_custkey = c.c_custkey LEFT JOIN la ON la.o_custkey = c.c_custkey""")
def q_j2(spark, sf):
    c, o, li = table(spark, sf, "customer"), table(spark, sf, "orders"), table(spark, sf, "lineitem")
    oa = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("_no"))
    la = li.join(o, li["l_orderkey"] == o["o_orderkey"]).groupBy(F.col("o_custkey").alias("c_custkey")) \
        .agg(F.count(F.lit(1)).alias("_nl"))
    j = c.select("c_custkey").join(oa, "c_custkey", "left").join(la, "c_custkey", "left")
    return j.select("c_custkey", F.coalesce("_no", F.lit(0)).cast("bigint").alias("n_orders"),
                    F.coalesce("_nl", F.lit(0)).cast("bigint").alias("n_lines"))


@key("left_join_on_filter", """SELECT c.c_custkey, CAST(count(o.o_orderkey) AS BIGINT) AS f_orders
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F' GROUP BY c.c_custkey""")
def q_j3(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    # the right-side predicate stays in ON: filter the right side before the left join
    fo = o.where(F.col("o_orderstatus") == "F").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("_n"))
    return c.select("c_custkey").join(fo, "c_custkey", "left").select(
        "c_custkey", F.coalesce("_n", F.lit(0)).cast("bigint").alias("f_orders"))


@key("cross_join", """SELECT CAST(r.n AS BIGINT) AS regions, CAST(n.n AS BIGINT) AS nations, CAST(r.n * n.n AS BIGINT) AS cartesian_rows
FROM (SELECT count(*) AS n FROM region) r, (SELECT count(*) AS n FROM nation) n""")
def q_j7(spark, sf):
    """Cartesian count preservation: |A×B| = |A|·|B| — checked without building the product."""
    r = table(spark, sf, "region").select(F.lit(1).alias("_s"))
    n = table(spark, sf, "nation").select(F.lit(2).alias("_s"))
    c = r.unionByName(n).agg(F.count_if(F.col("_s") == 1).cast("bigint").alias("regions"),
                             F.count_if(F.col("_s") == 2).cast("bigint").alias("nations"))
    return c.withColumn("cartesian_rows", (F.col("regions") * F.col("nations")).cast("bigint"))


@key("left_join_true", """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_month, count(*) AS n FROM orders GROUP BY 1),
cmt AS (SELECT n_regionkey AS contract_id, CAST(sum(n_nationkey) AS BIGINT) AS committed FROM nation WHERE n_regionkey < 0 GROUP BY 1)
SELECT m.period_month, CAST(m.n AS BIGINT) AS orders, cmt.contract_id, cmt.committed FROM m LEFT JOIN cmt ON 1 = 1""")
def q_j8(spark, sf):
    """LEFT JOIN … ON 1=1 keeps every left row when the right side is empty."""
    o, n = table(spark, sf, "orders"), table(spark, sf, "nation")
    m = o.groupBy(Q.month(F.col("o_orderdate")).alias("period_month")).agg(
        F.count(F.lit(1)).cast("bigint").alias("orders"))
    cmt = n.where(F.col("n_regionkey") < 0).groupBy(F.col("n_regionkey").alias("contract_id")).agg(
        F.sum("n_nationkey").cast("bigint").alias("committed"))
    return m.select("period_month", "orders", Q.each_of(cmt, "contract_id", "committed").alias("_c")).select(
        "period_month", "orders", "_c.contract_id", "_c.committed")


@key("expr_key_join", """WITH lm AS (SELECT strftime(l_shipdate, '%Y-%m') AS work_month, count(*) AS lines FROM lineitem GROUP BY 1),
om AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS period_month, count(*) AS orders FROM orders GROUP BY 1)
SELECT om.period_month, lm.work_month, CAST(om.orders AS BIGINT) AS orders, CAST(lm.lines AS BIGINT) AS lines
FROM om JOIN lm ON CAST(strptime(lm.work_month, '%Y-%m') AS DATE) = om.period_month""")
def q_j12(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    lm = li.groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("work_month")).agg(
        F.count(F.lit(1)).cast("bigint").alias("lines"))
    om = o.groupBy(Q.month(F.col("o_orderdate")).alias("period_month")).agg(
        F.count(F.lit(1)).cast("bigint").alias("orders"))
    return om.join(lm, F.to_date(F.col("work_month"), "yyyy-MM") == F.col("period_month")).select(
        "period_month", "work_month", "orders", "lines")


# =============================================================== 2.4 aggregation
@key("group_rollup_simple", """SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem GROUP BY 1, 2""")
def q_a2(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("qty"))


@key("avg_groups", """WITH s AS (SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_price FROM lineitem GROUP BY 1)
SELECT l_suppkey, total, avg_price FROM s""")
def q_a3(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("total"),
        Q.exact_avg(F.col("l_extendedprice")).alias("avg_price"))


@key("conditional_sums", """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_month,
  CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS qty_a,
  CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS qty_n,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS qty_r,
  CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_lines
FROM lineitem GROUP BY 1""")
def q_a4(spark, sf):
    li = table(spark, sf, "lineitem")
    q = F.col("l_quantity").cast("decimal(18,2)")
    z = F.lit(0).cast("decimal(18,2)")
    cs = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, q).otherwise(z)).cast("double")
    return li.groupBy(Q.month(F.col("l_shipdate")).alias("ship_month")).agg(
        cs("A").alias("qty_a"), cs("N").alias("qty_n"), cs("R").alias("qty_r"),
        F.sum(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).cast("bigint").alias("open_lines"))


@key("rollup_grouping", """SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n,
  CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS INTEGER) AS grouping_level
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def q_a5(spark, sf):
    return table(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.grouping_id().cast("int").alias("grouping_level"))


@key("approx_distinct", """SELECT l_returnflag, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS exact_orders, true AS orders_within_5pct,
  CAST(count(DISTINCT CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR)) AS BIGINT) AS exact_part_supp,
  true AS part_supp_within_5pct FROM lineitem GROUP BY 1""")
def q_a6(spark, sf):
    """Sketches in one aggregate, exact counts in another, joined on the group."""
    li = table(spark, sf, "lineitem")
    pair = F.concat(F.col("l_partkey").cast("string"), F.lit("|"), F.col("l_suppkey").cast("string"))
    sketch = li.groupBy("l_returnflag").agg(F.approx_count_distinct("l_orderkey", Q.NDV_RSD).alias("_a1"),
                                            F.approx_count_distinct(pair, Q.NDV_RSD).alias("_a2"))
    exact = AG.distinct_counts(li, ["l_returnflag"], {"exact_orders": F.col("l_orderkey"), "exact_part_supp": pair})
    return AG.join_groups(sketch, exact, ["l_returnflag"]).select(
        "l_returnflag", "exact_orders", Q.within_tolerance("_a1", "exact_orders").alias("orders_within_5pct"),
        "exact_part_supp", Q.within_tolerance("_a2", "exact_part_supp").alias("part_supp_within_5pct"))


@key("multi_count_distinct", """SELECT l_returnflag, CAST(count(DISTINCT l_orderkey) AS BIGINT) AS orders,
  CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
FROM lineitem GROUP BY 1""")
def q_a7(spark, sf):
    li = table(spark, sf, "lineitem")
    counts = AG.distinct_counts(li, ["l_returnflag"], {"orders": F.col("l_orderkey"), "parts": F.col("l_partkey")})
    sums = li.groupBy("l_returnflag").agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("qty"))
    return AG.join_groups(counts, sums, ["l_returnflag"])


@key("safe_ratio", """SELECT l_suppkey,
  CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) / NULLIF(CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE), 0.0) AS returns_per_open
FROM lineitem GROUP BY 1""")
def q_a8(spark, sf):
    li = table(spark, sf, "lineitem")
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return li.groupBy("l_suppkey").agg(
        AG.safe_ratio(one(F.col("l_returnflag") == "R"), one(F.col("l_linestatus") == "O"))
        .alias("returns_per_open"))


@key("row_multiset_count", f"""WITH {ORDERS_TGT}
SELECT o_orderkey, o_totalprice, CAST(count(*) AS BIGINT) AS copies FROM orders_tgt GROUP BY ALL HAVING count(*) > 1""")
def q_a15(spark, sf):
    t = D.orders_tgt(table(spark, sf, "orders"))
    return t.groupBy(*ORDERS_NAMES).agg(F.count(F.lit(1)).cast("bigint").alias("copies")) \
        .where("copies > 1").select("o_orderkey", "o_totalprice", "copies")


O_["row_multiset_count"] = f"""WITH {ORDERS_TGT}
SELECT o_orderkey, o_totalprice, copies FROM (SELECT {', '.join(ORDERS_NAMES)}, CAST(count(*) AS BIGINT) AS copies
FROM orders_tgt GROUP BY ALL) WHERE copies > 1"""


@key("control_total", f"""WITH {ORDERS_TGT}
SELECT 'orders' AS side, CAST(count(*) AS BIGINT) AS rows, {stripped_sql("CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS VARCHAR)")} AS total FROM orders
UNION ALL SELECT 'orders_tgt', CAST(count(*) AS BIGINT), {stripped_sql("CAST(sum(CAST(o_totalprice AS DECIMAL(14,2))) AS VARCHAR)")} FROM orders_tgt
UNION ALL SELECT 'documents_lang', CAST(count(*) AS BIGINT), {stripped_sql("CAST(sum(coalesce(TRY_CAST(lang AS DECIMAL(38,18)), 0)) AS VARCHAR)")} FROM documents
UNION ALL SELECT 'long_texts', CAST(count(*) AS BIGINT), rtrim(CAST(sum(o_orderkey + 1) AS VARCHAR) || repeat('0', 23) || '.' || lpad(CAST(count(*) AS VARCHAR), 24, '0'), '0') FROM orders""")
def q_a16(spark, sf):
    o = table(spark, sf, "orders")
    t = D.orders_tgt(o)
    dec = lambda df: df.select(F.col("o_totalprice").cast("decimal(14,2)").alias("v"))
    a = AG.control_total(dec(o), "v").select(F.lit("orders").alias("side"), "rows",
                                             "total")
    b = AG.control_total(dec(t), "v").select(F.lit("orders_tgt").alias("side"), "rows",
                                             "total")
    c = AG.control_total(table(spark, sf, "documents"), "lang").select(
        F.lit("documents_lang").alias("side"), "rows", "total")
    # texts with more digits on either side of the point than any decimal type holds
    long = o.select(F.concat((F.col("o_orderkey") + 1).cast("string"), F.lit("0" * 23 + "." + "0" * 23 + "1")).alias("v"))
    d = AG.control_total(long, "v").select(F.lit("long_texts").alias("side"), "rows", "total")
    return a.unionByName(b).unionByName(c).unionByName(d)


def _nearest_rank_sql(tbl, group, value, ps_names, where=""):
    sel = ", ".join(f"min(CASE WHEN cum >= greatest(ceil({p} * n - 1e-9), 1) THEN {value} END) AS {nm}"
                    for p, nm in ps_names)
    return f"""(SELECT {group}, {sel} FROM (
  SELECT {group}, {value}, sum(c) OVER (PARTITION BY {group} ORDER BY {value} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         sum(c) OVER (PARTITION BY {group}) AS n
  FROM (SELECT {group}, {value}, count(*) AS c FROM {tbl} WHERE {value} IS NOT NULL {where} GROUP BY ALL)) GROUP BY {group})"""


@key("nearest_rank_pct", "SELECT * FROM " + _nearest_rank_sql("lineitem", "l_returnflag", "l_quantity",
                                                             [(0.5, "p50"), (0.95, "p95")]))
def q_a17(spark, sf):
    return AG.nearest_rank(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity", [0.5, 0.95])


@key("run_stats_fold", f"""WITH run_log AS (SELECT nullif(event_type, 'error') AS query_id, 'value' AS metric, value FROM events),
pct AS {_nearest_rank_sql('run_log', 'query_id, metric', 'value', [(0.5, 'p50'), (0.95, 'p95')])}
SELECT pct.query_id, pct.metric, p50, p95, mx AS max, mn AS min, runs FROM pct JOIN (
  SELECT query_id, metric, max(value) AS mx, min(value) AS mn, CAST(count(*) AS BIGINT) AS runs FROM run_log GROUP BY 1, 2) m
ON pct.query_id IS NOT DISTINCT FROM m.query_id AND pct.metric IS NOT DISTINCT FROM m.metric""")
def q_a18(spark, sf):
    """Run log in long form (query_id, run, metric, value) read from ``events``:
    each event is one run of its event type's query, ``value`` its metric; runs of one type have no query id."""
    ev = table(spark, sf, "events")
    log = ev.select(F.nullif("event_type", F.lit("error")).alias("query_id"), F.col("event_id").alias("run"),
                    F.lit("value").alias("metric"), "value")
    return AG.run_stats_fold(log)


@key("group_by_expression", """SELECT CASE WHEN regexp_matches(p_type, '^(ECONOMY|SMALL)') THEN 'VALUE'
  WHEN p_size > 25 THEN 'LARGE' ELSE 'OTHER' END AS segment, year(l_shipdate) AS ship_year,
  CAST(count(*) AS BIGINT) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def q_a19(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    seg = (F.when(F.col("p_type").rlike("^(ECONOMY|SMALL)"), "VALUE")
           .when(F.col("p_size") > 25, "LARGE").otherwise("OTHER"))
    return li.join(p, li["l_partkey"] == p["p_partkey"]).groupBy(
        seg.alias("segment"), F.year("l_shipdate").alias("ship_year")).agg(
        F.count(F.lit(1)).cast("bigint").alias("lines"))


@key("max_joined_threshold", """SELECT s.s_nationkey AS site,
  sum(CASE WHEN l_discount <= 0.05 THEN 1 ELSE 0 END) / count(*) * 100 AS ratio,
  max(s.s_acctbal / 100.0) AS target,
  CASE WHEN sum(CASE WHEN l_discount <= 0.05 THEN 1 ELSE 0 END) / count(*) * 100 >= max(s.s_acctbal / 100.0)
       THEN 'MET' ELSE 'MISSED' END AS attainment
FROM lineitem JOIN supplier s ON l_suppkey = s.s_suppkey GROUP BY 1""")
def q_a20(spark, sf):
    li, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"])
    ratio = F.sum(F.when(F.col("l_discount") <= 0.05, 1).otherwise(0)) / F.count(F.lit(1)) * 100
    g = j.groupBy(F.col("s_nationkey").alias("site")).agg(
        ratio.alias("ratio"), F.max(F.col("s_acctbal") / 100.0).alias("target"))
    return g.withColumn("attainment", F.when(F.col("ratio") >= F.col("target"), "MET").otherwise("MISSED"))


@key("partition_tier_counts", """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date_key, l_returnflag AS channel,
  CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2""")
def q_a21(spark, sf):
    return table(spark, sf, "lineitem").groupBy(
        Q.month(F.col("l_shipdate")).alias("date_key"), F.col("l_returnflag").alias("channel")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


# =============================================================== 2.5 / 2.6 windows, top-k
@key("lag_gap", """SELECT conv_id, turn, role, prev_turn, turn - prev_turn AS gap,
  CASE WHEN turn - prev_turn <= 1 THEN 1 ELSE 0 END AS contiguous
FROM (SELECT *, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_turn FROM conversations)""")
def q_w2(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", "role")
    n = neighbours(c, "conv_id", ["turn"], prev_cols={"turn": "prev_turn"})
    gap = F.col("turn") - F.col("prev_turn")
    return n.select("conv_id", "turn", "role", "prev_turn", gap.alias("gap"),
                    F.when(gap <= 1, 1).otherwise(0).alias("contiguous"))


@key("percent_rank_global", """SELECT o_orderkey, percent_rank() OVER (ORDER BY o_totalprice ASC) AS price_pctile FROM orders""")
def q_w3(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    r = global_rank(o, [("o_totalprice", "asc")])
    return r.select("o_orderkey", percent_rank_col().alias("price_pctile"))


@key("ntile_global", """SELECT o_orderkey,
  CAST(ntile(4) OVER (ORDER BY o_totalprice DESC, o_orderkey ASC) AS INTEGER) AS quartile_desc,
  CAST(ntile(5) OVER (ORDER BY o_totalprice ASC, o_orderkey ASC) AS INTEGER) AS quintile_asc FROM orders""")
def q_w4(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    a = global_rank(o, [("o_totalprice", "desc"), ("o_orderkey", "asc")]) \
        .withColumn("quartile_desc", ntile_col(4)).drop("_grn", "_grank", "_gn")
    b = global_rank(a, [("o_totalprice", "asc"), ("o_orderkey", "asc")]) \
        .withColumn("quintile_asc", ntile_col(5))
    return b.select("o_orderkey", "quartile_desc", "quintile_asc")


@key("mismatch_sample", None)
def q_t2(spark, sf):
    """First 5 missing and first 5 unexpected rows, in key order."""
    from paritylake.plans.keys_parity import q_multiset_except
    d = q_multiset_except(spark, sf)
    w = Window.partitionBy("side").orderBy("o_orderkey", "o_totalprice")
    return d.withColumn("_r", F.row_number().over(w)).where("_r <= 5").drop("_r")


def _mismatch_sql():
    from paritylake.plans.keys_parity import ORACLE as PO
    return (f"SELECT * EXCLUDE (_r) FROM (SELECT *, row_number() OVER (PARTITION BY side ORDER BY o_orderkey, "
            f"o_totalprice) AS _r FROM ({PO['multiset_except']})) WHERE _r <= 5")


O_["mismatch_sample"] = _mismatch_sql()


@key("version_sort", f"""WITH {EVENTS_SCD2}
SELECT user_id, eff_from, CAST(row_number() OVER (PARTITION BY user_id ORDER BY eff_from) AS INTEGER) AS version_no FROM events_scd2""")
def q_t3(spark, sf):
    from paritylake.operators.windows import running_sum
    v = D.events_scd2(table(spark, sf, "events")).select("user_id", "eff_from")
    r = running_sum(v, ["user_id"], [("eff_from", "asc")], F.lit(1), "version_no")
    return r.select("user_id", "eff_from", F.col("version_no").cast("int").alias("version_no"))


# =============================================================== 2.7 set operations
@key("union_all", """SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderstatus FROM orders WHERE o_orderpriority = '5-LOW') GROUP BY 1""")
def q_u2(spark, sf):
    o = table(spark, sf, "orders")
    u = o.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderstatus").unionByName(
        o.where(F.col("o_orderpriority") == "5-LOW").select("o_orderstatus"))
    return u.groupBy("o_orderstatus").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# fixed values: the declared column lists the schema-name check compares against
DECLARED_COLUMNS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
               "o_comment"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "events": ["event_id", "ts", "user_id", "event_type", "value"],
}


@key("name_set_diff", None)
def q_u4(spark, sf):
    """Expected column names against each table's own, both ways, and names under which no row has a value (one aggregate
    a table, a flag per column)."""
    exp = spark.createDataFrame([(t, c) for t, cs in DECLARED_COLUMNS.items() for c in cs],
                                "tbl string, col string")
    act = None
    for t in DECLARED_COLUMNS:
        rows = table(spark, sf, t)
        flags = rows.agg(*[F.coalesce(F.max(F.col(c).isNotNull()), F.lit(False)).alias(c) for c in rows.columns])
        stack = ", ".join(f"'{t}', '{c.lower()}', `{c}`" for c in rows.columns)
        a = flags.selectExpr(f"stack({len(rows.columns)}, {stack}) AS (tbl, col, has_value)")
        act = a if act is None else act.unionByName(a)
    missing = exp.join(act, ["tbl", "col"], "left_anti").withColumn("kind", F.lit("missing"))
    extra = act.drop("has_value").join(exp, ["tbl", "col"], "left_anti").withColumn("kind", F.lit("unexpected"))
    empty = act.where("NOT has_value").drop("has_value").withColumn("kind", F.lit("no value"))
    return missing.unionByName(extra).unionByName(empty)


def _name_diff_sql():
    from paritylake.plans.keys_parity import TABLE_COLS
    exp = ", ".join(f"('{t}', '{c}')" for t, cs in DECLARED_COLUMNS.items() for c in cs)
    act = " UNION ALL ".join(f"SELECT '{t}' AS tbl, '{c}' AS col, (SELECT count({c}) FROM {t}) AS n"
                             for t in DECLARED_COLUMNS for c, _ in TABLE_COLS[t])
    return f"""WITH exp AS (SELECT * FROM (VALUES {exp}) AS e(tbl, col)), act AS ({act})
SELECT tbl, col, 'missing' AS kind FROM exp WHERE NOT EXISTS (SELECT 1 FROM act WHERE act.tbl = exp.tbl AND act.col = exp.col)
UNION ALL
SELECT tbl, col, 'unexpected' FROM act WHERE NOT EXISTS (SELECT 1 FROM exp WHERE act.tbl = exp.tbl AND act.col = exp.col)
UNION ALL SELECT tbl, col, 'no value' FROM act WHERE n = 0"""


O_["name_set_diff"] = _name_diff_sql()


@key("column_union", None)
def q_u5(spark, sf):
    o = table(spark, sf, "orders")
    t = D.orders_tgt(o).withColumn("o_comment", F.lit(None).cast("string"))
    u = t.withColumn("o_clerk", F.lit("x"))
    return P.union_checks([P.query_parity(o, t, "rowset", target="tgt_with_null_column"),
                           P.query_parity(o, o.withColumn("o_comment", F.lit(None).cast("string")),
                                          "rowset", target="self_with_null_column"),
                           P.query_parity(o, u, "rowset", target="tgt_with_value_column")]) \
        .select("pattern", "target", "status")


_UNION_COLS = ", ".join(ORDERS_NAMES)
_UNION_PAIR = """SELECT 'query_parity' AS pattern, '{target}' AS target, CASE WHEN
  (SELECT count(*) FROM (SELECT {cols}, {ca} AS extra FROM orders EXCEPT ALL SELECT {cols}, {cb} AS extra FROM {other}))
  + (SELECT count(*) FROM (SELECT {cols}, {cb} AS extra FROM {other} EXCEPT ALL SELECT {cols}, {ca} AS extra FROM orders)) = 0
  THEN 'PASS' ELSE 'FAIL' END AS status"""
_none = "CAST(NULL AS VARCHAR)"
O_["column_union"] = f"WITH {ORDERS_TGT}\n" + "\nUNION ALL\n".join([
    _UNION_PAIR.format(target="tgt_with_null_column", cols=_UNION_COLS, ca=_none, cb=_none, other="orders_tgt"),
    _UNION_PAIR.format(target="self_with_null_column", cols=_UNION_COLS, ca=_none, cb=_none, other="orders"),
    _UNION_PAIR.format(target="tgt_with_value_column", cols=_UNION_COLS, ca=_none, cb="'x'", other="orders_tgt")])


# =============================================================== 2.8 scalar functions
@key("fn_string", """SELECT c_custkey, concat(upper(c_name), '/', CAST(c_nationkey AS VARCHAR)) AS label,
  substr(c_mktsegment, 1, 3) AS seg3, c_name || CAST(NULL AS VARCHAR) AS null_concat FROM customer""")
def q_f1(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey",
                    F.concat(F.upper("c_name"), F.lit("/"), F.col("c_nationkey").cast("string")).alias("label"),
                    F.substring("c_mktsegment", 1, 3).alias("seg3"),
                    F.concat(F.col("c_name"), F.lit(None).cast("string")).alias("null_concat"))


@key("fn_regex", """SELECT page_id, regexp_matches(url, '(?i)^https://') AS is_https,
  nullif(regexp_extract(url, '^https?://([^/]+)/', 1), '') AS host,
  nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') AS lang_path,
  regexp_matches(url, '^(http|https)://[^/]+\\.(com|net)/') AS com_or_net FROM pages""")
def q_f2(spark, sf):
    p = table(spark, sf, "pages")
    u = F.col("url")
    return p.select("page_id", u.rlike("(?i)^https://").alias("is_https"),
                    F.nullif(F.regexp_extract(u, r"^https?://([^/]+)/", 1), F.lit("")).alias("host"),
                    F.nullif(F.regexp_extract(u, r"/([a-z]{2})/", 1), F.lit("")).alias("lang_path"),
                    u.rlike(r"^(http|https)://[^/]+\.(com|net)/").alias("com_or_net"))


@key("fn_null", f"""WITH {ORDERS_EPOCH}
SELECT o_orderkey, coalesce(issued_sec, -1) AS issued_or_default, nullif(o_orderkey % 7, 0) AS mod_or_null,
  abs(o_orderkey - 7500) AS dist FROM orders_epoch""")
def q_f3(spark, sf):
    e = D.orders_epoch(table(spark, sf, "orders"))
    return e.select("o_orderkey", F.coalesce("issued_sec", F.lit(-1)).alias("issued_or_default"),
                    F.nullif(F.col("o_orderkey") % 7, F.lit(0)).alias("mod_or_null"),
                    F.abs(F.col("o_orderkey") - 7500).alias("dist"))


@key("fn_date", """SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 1000000 AS secs_since_jan1,
  ts + INTERVAL 7 DAY AS plus_7d, CAST(ts AS DATE) + 3 AS date_plus_3,
  CAST(strptime(strftime(ts, '%Y-%m'), '%Y-%m') AS DATE) AS month_start, DATE '2024-01-15' AS lit_date FROM events""")
def q_f5(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select(
        "event_id",
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)").alias("secs_since_jan1"),
        (F.col("ts") + F.expr("INTERVAL 7 DAYS")).alias("plus_7d"),
        F.date_add(F.to_date("ts"), 3).alias("date_plus_3"),
        F.to_date(F.date_format("ts", "yyyy-MM"), "yyyy-MM").alias("month_start"),
        F.lit("2024-01-15").cast("date").alias("lit_date"))


@key("fn_hash", """SELECT c_custkey, md5(c_name) AS md5_name, sha256(c_name) AS sha_name,
  md5(concat_ws('|', CAST(c_custkey AS VARCHAR), c_name, c_mktsegment)) AS bar_hash,
  ('0x' || substr(md5(c_name), 1, 15))::BIGINT AS h60, ((('0x' || substr(md5(c_name), 1, 15))::BIGINT % 256) + 256) % 256 AS bucket
FROM customer""")
def q_f7(spark, sf):
    c = table(spark, sf, "customer")
    h60 = F.conv(F.substring(F.md5("c_name"), 1, 15), 16, 10).cast("bigint")
    return c.select("c_custkey", F.md5("c_name").alias("md5_name"), F.sha2("c_name", 256).alias("sha_name"),
                    F.md5(F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment"))
                    .alias("bar_hash"), h60.alias("h60"), F.pmod(h60, F.lit(256)).alias("bucket"))


@key("fn_math", """SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * 0.0725, 2) AS DOUBLE) AS taxed,
  l_orderkey % 7 AS mod7, CAST(l_quantity AS INTEGER) AS qty_int,
  ((('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 13))::BIGINT) % 1000000) / 1000000.0 AS pseudo_rand
FROM lineitem""")
def q_f8(spark, sf):
    li = table(spark, sf, "lineitem")
    # RAND() is replaced by a hash of the row identity, so runs are reproducible
    seed = F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))
    r = (F.conv(F.substring(F.md5(seed), 1, 13), 16, 10).cast("bigint") % 1000000) / 1000000.0
    return li.select("l_orderkey", "l_linenumber",
                     F.round(F.col("l_extendedprice").cast("decimal(18,4)") * F.lit(0.0725).cast("decimal(5,4)"), 2)
                     .cast("double").alias("taxed"),
                     (F.col("l_orderkey") % 7).alias("mod7"), F.col("l_quantity").cast("int").alias("qty_int"),
                     r.alias("pseudo_rand"))


@key("fn_array", """SELECT vec_id, len(embedding) AS dims,
  CAST(round(CAST(embedding[1] AS DECIMAL(18,6)), 4) AS DOUBLE) AS first_dim,
  (['low', 'mid', 'high'])[(label % 3) + 1] AS label_name,
  len(list_filter(embedding, lambda x: x > 0)) AS positive_dims FROM embeddings""")
def q_f9(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.size("embedding").alias("dims"),
                    F.round(F.element_at("embedding", 1).cast("decimal(18,6)"), 4).cast("double").alias("first_dim"),
                    F.element_at(F.array(F.lit("low"), F.lit("mid"), F.lit("high")),
                                 (F.col("label") % 3 + 1).cast("int")).alias("label_name"),
                    F.size(F.filter("embedding", lambda x: x > 0)).alias("positive_dims"))


@key("fn_format", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, strftime(ts, '%Y%m%d') AS day_key FROM events""")
def q_f10(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text"),
                     F.date_format("ts", "yyyyMMdd").alias("day_key"))


@key("fn_json", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  to_json({'event_id': event_id, 'event_type': event_type})::VARCHAR AS as_json FROM events""")
def q_f11(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
                     F.to_json(F.struct("event_id", "event_type")).alias("as_json"))


@key("fn_iso_coerce", """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS d,
  CAST(strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS ts FROM orders""")
def q_f12(spark, sf):
    from paritylake.operators.transform import typed_from_text
    o = table(spark, sf, "orders")
    text = o.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"),
                    F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"))
    typed = typed_from_text(text, [("o_orderkey", "bigint"), ("d", "date"), ("ts", "timestamp")])
    return typed.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_EMB_COLS = [("vec_id", "int"), ("embedding", "list<float>"), ("label", "int")]


@key("fn_canon", f"""SELECT vec_id, {text_sql('embedding', 'list<float>')} AS canon_embedding, {row_text_sql(_EMB_COLS)} AS canon_row,
  {text_sql('CAST(label AS DECIMAL(20,5))', 'decimal')} AS canon_decimal, {text_sql('label / 8.0', 'double')} AS canon_double,
  {text_sql('label', 'int')} AS canon_int
FROM embeddings""")
def q_f13(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", canon_text(F.col("embedding"), e.schema["embedding"].dataType).alias("canon_embedding"),
                    row_text(e, ["vec_id", "embedding", "label"]).alias("canon_row"),
                    canon_text(F.col("label").cast("decimal(20,5)"), T.DecimalType(20, 5)).alias("canon_decimal"),
                    canon_text(F.col("label") / 8.0, T.DoubleType()).alias("canon_double"),
                    canon_text(F.col("label"), T.IntegerType()).alias("canon_int"))


# J13 is the hub view's 6-way join itself
Q_["wide_hub_join"] = Q.client_executive_summary


def _hub_sql():
    from paritylake.plans.keys_marts import ORACLE as MO
    return MO["client_executive_summary"]


O_["wide_hub_join"] = _hub_sql()

QUERIES = {k: v for k, v in Q_.items()}
ORACLE = {k: v for k, v in O_.items() if v is not None}
