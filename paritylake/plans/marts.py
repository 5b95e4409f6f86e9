"""The 15 analyst views (Q1-Q15) re-expressed on the driver tables.

Stand-ins: part is a 3-ary org tree; supplier is the agent dimension;
lineitem / orders / events / documents are the facts; nation / region are
program and client. Every average is an exact decimal sum divided as a
double, and every ratio is a double division, so results do not depend on
summation order. Global ranks use ``global_rank`` (no single-task window);
the 7-day interval self join counts matches with ``range_count`` instead of
materialising pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paritylake.operators import aggregates as AG
from paritylake.operators.encoding import epoch_to_ts
from paritylake.operators.hierarchy import unreached, walk
from paritylake.operators.merge import delta_latest
from paritylake.operators.rangejoin import range_count
from paritylake.operators.windows import global_rank, neighbours, ntile_col, percent_rank_col
from paritylake.plans import derived as D
from paritylake.session import materialize
from paritylake.sources.tables import table

# fixed values used by the views and their stand-ins
MAX_DEPTH = 6
REPEAT_WINDOW_SECONDS = 259200
FCR_DAYS = 7
LABOR_RATE = 18.50
HANDLE_STATES = ("click", "purchase", "signup")
READY_STATE = "view"
AUX_PATTERN = "err%"
DRIVER_PATTERNS = [("(?i)(bill|invoice|charge|refund)", "BILLING"),
                   ("(?i)(password|login|locked|reset)", "ACCESS"),
                   ("(?i)(cancel|churn|retention)", "RETENTION")]
TAG_PATTERN = r"^\[([A-Z]{2,5})\]"
REF_PATTERN = r"ref#(\d+)"
# approximate distinct: sketch precision and accepted relative error
NDV_RSD, NDV_TOLERANCE = 0.01, 0.05
# queues (flag, code, media, id) and service-level targets (queue id, metric, value) of the stand-in
QUEUES = [("A", "A-queue", "voice", 1), ("N", "N-queue", "chat", 2), ("R", "R-queue", "email", 3)]
SLA_TARGETS = [(1, "SL_20_80", 50.0), (1, "ASA", 30.0), (2, "SL_20_80", 55.0), (3, "OTHER", 10.0)]
SLA_METRIC = "SL_20_80"
IN_SLA_DISCOUNT = 0.05


def exact_avg(c) -> F.Column:
    """AVG as exact decimal sum / count, returned as a double."""
    return F.sum(c.cast("decimal(18,2)")).cast("double") / F.count(c).cast("double")


def each_of(rows: DataFrame, *cols: str) -> F.Column:
    """LEFT JOIN ... ON 1=1 with a small aggregate: its rows as one array (a scalar subquery), exploded beside every
    row; an empty aggregate leaves one NULL."""
    value = F.col(cols[0]) if len(cols) == 1 else F.struct(*cols)
    return F.explode_outer(rows.agg(F.collect_list(value)).scalar())


def month(c) -> F.Column:
    return F.date_trunc("month", c).cast("date")


# ---------------------------------------------------------------- Q1 / J9
def org_units(spark: SparkSession, sf: str, fan_out: int | None = None) -> DataFrame:
    """``part`` as a tree: node k hangs under (k - 1) DIV fan-out. Without a given fan-out it is the fifth root
    of the table's size (3 at least), which keeps the tree within MAX_DEPTH levels at any size."""
    p = table(spark, sf, "part")
    if fan_out is None:
        size = p.agg((F.max("p_partkey") + 1).cast("double").alias("n"))
        p = p.join(F.broadcast(size.select(F.greatest(F.lit(3), F.ceil(F.pow("n", F.lit(0.2)))).cast("bigint").alias("_fan"))), F.lit(True))
    else:
        p = p.withColumn("_fan", F.lit(fan_out).cast("bigint"))
    k = F.col("p_partkey")
    return p.select(k.alias("org_unit_id"), F.col("p_brand").alias("unit_code"),
                    F.col("p_name").alias("unit_name"), F.col("p_type").alias("unit_type"),
                    F.col("p_size").alias("site_code"),
                    F.when(k != 0, F.call_function("div", k - 1, F.col("_fan"))).alias("parent_unit_id"))


def _tree(units: DataFrame, max_depth: int | None) -> DataFrame:
    found = walk(units, "org_unit_id", "parent_unit_id", "unit_name", max_depth)
    return units.drop("parent_unit_id").join(found, "org_unit_id").select(
        "org_unit_id", "unit_code", "unit_name", "unit_type", "site_code",
        F.col("root").alias("root_unit_id"), "depth", F.col("path").alias("path_names"))


def org_hierarchy(spark, sf):
    """Q1: every unit with root, depth and path of names, down to MAX_DEPTH levels below the root."""
    return _tree(materialize(org_units(spark, sf)), MAX_DEPTH)


def recursive_hierarchy(spark, sf):
    """A tree of fan-out 3, whose depth grows with the table, walked to its leaves."""
    return _tree(org_units(spark, sf, fan_out=3), None)


def hierarchy_unreached(spark, sf):
    """Rows of the fan-out-3 tree that no root reaches, after every 50th unit was hung under a unit that does not exist and
    the units 7, 22 and 67 (each below the one before) were closed to a ring."""
    u = org_units(spark, sf, fan_out=3)
    k = F.col("org_unit_id")
    broken = u.withColumn("parent_unit_id", F.when(k == 7, F.lit(67).cast("bigint")).when((k > 0) & (k % 50 == 0), -k).otherwise(F.col("parent_unit_id")))
    return unreached(broken, "org_unit_id", "parent_unit_id")


# ---------------------------------------------------------------- Q2
def within_tolerance(approx, exact) -> F.Column:
    return F.abs(F.col(approx) - F.col(exact)) <= F.col(exact) * NDV_TOLERANCE


def active_agents_ndv(spark, sf):
    """Sketches and exact counts are separate aggregates joined on the group: in one aggregate every distinct
    value would carry its own sketch."""
    li = table(spark, sf, "lineitem")
    s = table(spark, sf, "supplier")
    pair = F.concat(F.col("l_suppkey").cast("string"), F.lit("|"), F.col("l_returnflag"))
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"]).select(
        month(F.col("l_shipdate")).alias("date_key"), F.col("s_nationkey").alias("site_code"), "l_suppkey", pair.alias("_pair"))
    groups = ["date_key", "site_code"]
    sketch = j.groupBy(*groups).agg(
        F.approx_count_distinct("l_suppkey", NDV_RSD).alias("_a1"), F.approx_count_distinct("_pair", NDV_RSD).alias("_a2"),
        F.count(F.lit(1)).cast("bigint").alias("interactions"))
    exact = AG.distinct_counts(j, groups, {"exact_active_agents": F.col("l_suppkey"), "exact_agent_channel_pairs": F.col("_pair")})
    g = AG.join_groups(sketch, exact, groups)
    return g.select("date_key", "site_code", "exact_active_agents",
                    within_tolerance("_a1", "exact_active_agents").alias("agents_within_5pct"),
                    "exact_agent_channel_pairs",
                    within_tolerance("_a2", "exact_agent_channel_pairs").alias("pairs_within_5pct"), "interactions")


# ---------------------------------------------------------------- Q3
def csat_rollup(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"]).select(
        F.col("n_regionkey").alias("client_id"), F.col("n_name").alias("program_code"), "c_acctbal")
    return j.rollup("client_id", "program_code").agg(
        F.count(F.lit(1)).cast("bigint").alias("surveys"),
        exact_avg(F.col("c_acctbal")).alias("avg_csat"),
        (F.sum(F.when(F.col("c_acctbal") >= 5000, 1).otherwise(0)) / F.count(F.lit(1)) * 100)
        .alias("pct_promoters"),
        (F.grouping("client_id") * 2 + F.grouping("program_code")).cast("int").alias("grouping_level"))


# ---------------------------------------------------------------- Q4
def driver_expr(text) -> F.Column:
    tag = F.nullif(F.regexp_extract(text, TAG_PATTERN, 1), F.lit(""))
    e = None
    for pat, label in DRIVER_PATTERNS:
        e = F.when(text.rlike(pat), F.lit(label)) if e is None else e.when(text.rlike(pat), F.lit(label))
    return e.when(tag.isNotNull(), tag).otherwise(F.lit("OTHER"))


def call_driver_regex(spark, sf):
    d = table(spark, sf, "documents")
    t = F.col("text")
    return d.groupBy(
        F.col("lang").alias("call_date"), F.col("source").alias("queue_id"),
        driver_expr(t).alias("call_driver"),
        F.nullif(F.regexp_extract(t, REF_PATTERN, 1), F.lit("")).alias("embedded_ref_no")).agg(
        F.count(F.lit(1)).cast("bigint").alias("calls"),
        (F.sum("n_chars").cast("double") / F.count(F.lit(1))).alias("avg_talk_seconds"))


# ---------------------------------------------------------------- Q5 / W2
def repeat_contact_window(spark, sf):
    ev = table(spark, sf, "events").where(
        F.col("user_id").isNotNull() & (F.col("user_id").cast("string") != ""))
    # event_id breaks ties of equal times: the previous contact is one certain event
    w = neighbours(ev.select("event_id", "user_id", "event_type", "ts"), "user_id", ["ts", "event_id"],
                   prev_cols={"ts": "prev_contact_ts"})
    gap = F.expr("timestampdiff(SECOND, prev_contact_ts, ts)")
    return w.select(F.col("event_id").alias("interaction_id"), F.col("user_id").alias("customer_ref"),
                    F.col("event_type").alias("channel"), F.col("ts").alias("start_ts"),
                    "prev_contact_ts",
                    F.when(gap <= REPEAT_WINDOW_SECONDS, 1).otherwise(0).alias("repeat_within_72h"))


# ---------------------------------------------------------------- Q6
def billing_reconciliation(spark, sf):
    o = table(spark, sf, "orders")
    s = D.orders_epoch(o)
    a = D.orders_tgt(o).select("o_orderkey", F.col("o_totalprice").cast("decimal(14,2)").alias("ods_amount"),
                               F.col("o_orderdate").alias("ods_issued_ts"))
    j = s.join(a, "o_orderkey")
    ods_sec = F.unix_seconds(F.col("ods_issued_ts").cast("timestamp"))
    stg_sec = F.expr("issued_sec DIV 1000")
    status = (F.when(F.abs(F.col("amount") - F.col("ods_amount")) > F.lit(0.01), F.lit("AMOUNT_MISMATCH"))
              .when(ods_sec != stg_sec, F.lit("TS_MISMATCH")).otherwise(F.lit("OK")))
    return j.select(F.col("o_orderkey").alias("invoice_no"),
                    F.col("amount").cast("string").alias("staged_amount"),
                    F.col("ods_amount").cast("string").alias("ods_amount"),
                    epoch_to_ts(F.col("issued_sec"), "millis").cast("timestamp_ntz").alias("staged_issued_ts"),
                    "ods_issued_ts", (ods_sec - stg_sec).alias("drift_seconds"),
                    status.alias("recon_status"))


# ---------------------------------------------------------------- Q7
def agent_roster_current(spark, sf):
    ev = table(spark, sf, "events")
    hist = materialize(D.events_scd2(ev))
    latest = delta_latest(hist.select("user_id", "eff_from", "event_type"), ["user_id"], ["eff_from"])
    asg = D.broken_scd2(hist).where(F.col("is_current")).select(
        F.col("user_id"), F.col("event_type").alias("current_program_id"),
        F.col("eff_from").alias("role_since"))
    return latest.join(asg, "user_id", "left").select(
        F.col("user_id").alias("agent_id"), F.col("event_type").alias("status"),
        F.col("eff_from").alias("eff_from_ts"), "current_program_id", "role_since")


# ---------------------------------------------------------------- Q8
def agent_scorecard(spark, sf):
    li, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    # one scan: per (agent, part) first, whose rows then tell the distinct parts of an agent
    dec = lambda c: F.col(c).cast("decimal(18,2)")
    qa_row = F.col("l_returnflag") == "R"
    parts = li.groupBy(F.col("l_suppkey").alias("agent_sk"), "l_partkey").agg(
        F.sum(dec("l_quantity")).alias("_q"), F.count("l_quantity").alias("_qn"),
        F.sum(dec("l_discount")).alias("_d"), F.count("l_discount").alias("_dn"),
        F.sum(F.when(qa_row, dec("l_tax"))).alias("_t"), F.count(F.when(qa_row, F.col("l_tax"))).alias("_tn"),
        F.count(F.lit(1)).alias("_rows"),
        F.max((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A")).alias("_skill"))
    avg = lambda total, n: F.when(F.sum(n) > 0, F.sum(total).cast("double") / F.sum(n).cast("double"))
    perf = parts.groupBy("agent_sk").agg(
        avg("_q", "_qn").alias("aht"), avg("_d", "_dn").alias("adherence"), F.sum("_rows").cast("bigint").alias("volume"),
        avg("_t", "_tn").alias("avg_qa_pct"),
        F.count_if(F.col("_skill") & F.col("l_partkey").isNotNull()).cast("bigint").alias("certified_skills"))
    a = s.select(F.col("s_suppkey").alias("agent_sk"), F.col("s_name").alias("full_name"),
                 F.col("s_nationkey").alias("site_code"),
                 F.when(F.col("s_acctbal") >= 5000, "senior").otherwise("junior").alias("job_grade"))
    # one row per agent, read by two ranks: kept, so that the facts are read once
    j = materialize(a.join(perf, "agent_sk"))
    r1 = materialize(global_rank(j, [("aht", "asc")]).withColumn("aht_pctile", percent_rank_col()).drop("_grank", "_gn"))
    r2 = global_rank(r1, [("avg_qa_pct", "desc"), ("agent_sk", "asc")]) \
        .withColumn("qa_quartile", ntile_col(4)).drop("_grn", "_grank", "_gn")
    return r2.select("agent_sk", "full_name", "site_code", "job_grade", "aht", "adherence", "volume",
                     "avg_qa_pct", "certified_skills", "aht_pctile", "qa_quartile")


# ---------------------------------------------------------------- Q9
def attrition_risk(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    urgent = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    per = o.groupBy(F.col("o_custkey").alias("agent_sk")).agg(
        exact_avg(F.col("o_totalprice")).alias("adherence_90d"), F.count_if(urgent).cast("bigint").alias("notice_events"))
    a = c.where(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("agent_sk"), F.col("c_custkey").alias("agent_id"),
        F.col("c_name").alias("full_name"), F.col("c_nationkey").alias("site_code"))
    b = global_rank(materialize(a.join(per, "agent_sk")), [("adherence_90d", "asc"), ("agent_sk", "asc")]) \
        .withColumn("adherence_band", ntile_col(5))
    risk = (F.when((F.col("adherence_band") == 1) | (F.col("notice_events") > 0), "HIGH")
            .when(F.col("adherence_band") == 2, "MEDIUM").otherwise("LOW"))
    return b.select("agent_sk", "agent_id", "full_name", "site_code", "adherence_90d",
                    "notice_events", risk.alias("attrition_risk"))


# ---------------------------------------------------------------- Q10
def queue_sla_attainment(spark, sf):
    """Q10: share of lines within the service level per queue and month, against the queue's target if it has one."""
    li = table(spark, sf, "lineitem")
    queues = spark.createDataFrame(QUEUES, "flag string, queue_code string, media_type string, queue_id int")
    goals = spark.createDataFrame([(q, v) for q, metric, v in SLA_TARGETS if metric == SLA_METRIC], "queue_id int, sl_target double")
    lines = li.groupBy(F.col("l_returnflag").alias("flag"), month(F.col("l_shipdate")).alias("date_key")).agg(
        F.count(F.lit(1)).alias("answered"), F.count_if(F.col("l_discount") <= IN_SLA_DISCOUNT).alias("in_time"))
    rated = lines.withColumn("sl_pct", F.col("in_time") / F.col("answered") * 100)
    met = F.when(F.col("sl_pct") >= F.col("sl_target"), "MET").otherwise("MISSED")
    return rated.join(queues, "flag").join(goals, "queue_id", "left").select(
        "queue_code", "media_type", "date_key", "sl_pct", "sl_target", met.alias("attainment"))


# ---------------------------------------------------------------- Q11 / J6
def fcr_matches(spark, sf):
    """Per resolved order: # later orders of the same customer within 7 days."""
    o = table(spark, sf, "orders")
    f = o.where(F.col("o_orderstatus") == "F").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate",
        (F.col("o_orderdate") + F.expr(f"INTERVAL {FCR_DAYS} DAYS")).alias("_hi"))
    return range_count(f, o, key="o_custkey", left_id="o_orderkey", lo="o_orderdate", hi="_hi",
                       right_t="o_orderdate")


def first_contact_resolution(spark, sf):
    m = fcr_matches(spark, sf)
    g = m.groupBy(month(F.col("o_orderdate")).alias("date_key"),
                  F.col("o_orderpriority").alias("program_sk")).agg(
        F.sum(F.greatest(F.col("matches"), F.lit(1))).cast("bigint").alias("resolved_interactions"),
        F.sum(F.when(F.col("matches") == 0, 1).otherwise(0)).cast("bigint").alias("fcr_count"))
    return g.withColumn("fcr_pct", F.col("fcr_count") / F.col("resolved_interactions") * 100)


def interval_self_join(spark, sf):
    return fcr_matches(spark, sf).select("o_orderkey", "o_custkey", "matches")


# ---------------------------------------------------------------- Q12
def occupancy_utilization(spark, sf):
    ev, c = table(spark, sf, "events"), table(spark, sf, "customer")
    j = ev.join(c, ev["user_id"] == c["c_custkey"])
    secs = F.col("value").cast("decimal(18,2)")
    st = F.col("event_type")
    zero = F.lit(0).cast("decimal(18,2)")
    handle = F.sum(F.when(st.isin(*HANDLE_STATES), secs).otherwise(zero))
    ready = F.sum(F.when(st == READY_STATE, secs).otherwise(zero))
    aux = F.sum(F.when(st.like(AUX_PATTERN), secs).otherwise(zero))
    busy = F.sum(F.when(st.isin(*HANDLE_STATES, READY_STATE), secs).otherwise(zero))
    g = j.groupBy(F.to_date("ts").alias("date_key"), F.col("c_nationkey").alias("site_code"),
                  F.col("user_id").alias("agent_sk")).agg(
        handle.alias("_h"), ready.alias("_r"), aux.alias("_a"), busy.alias("_b"))
    return g.select("date_key", "site_code", "agent_sk",
                    F.col("_h").cast("double").alias("handle_seconds"),
                    F.col("_r").cast("double").alias("ready_seconds"),
                    F.col("_a").cast("double").alias("aux_seconds"),
                    (F.col("_h").cast("double") / F.nullif(F.col("_b").cast("double"), F.lit(0.0)) * 100)
                    .alias("occupancy_pct"))


# ---------------------------------------------------------------- Q13
def shrinkage_analysis(spark, sf):
    li, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    o, p = table(spark, sf, "orders"), table(spark, sf, "part")
    f = li.select("l_orderkey", "l_suppkey", "l_partkey", month(F.col("l_shipdate")).alias("date_key"),
                  F.col("l_quantity").cast("decimal(18,2)").alias("scheduled"),
                  F.col("l_extendedprice").cast("decimal(18,2)").alias("worked"),
                  F.col("l_discount").cast("decimal(18,2)") * 100,
                  F.col("l_tax").cast("decimal(18,2)") * 100)
    f = f.toDF(*f.columns[:-2], "exc", "toff")
    a = s.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("site_code"))
    sched = o.select(F.col("o_orderkey").alias("_sid"), month(F.col("o_orderdate")).alias("_sdate"))
    shift = p.where(F.col("p_size") > 40).select(F.col("p_partkey").alias("_shift"))
    groups = ["date_key", "site_code"]
    sited = f.join(a, "l_suppkey")
    sums = sited.groupBy(*groups).agg(F.sum("scheduled").alias("_sch"), F.sum("worked").alias("_wk"),
                                      F.sum(F.col("exc") + F.col("toff")).alias("_shr"))
    # the counted keys are reduced to distinct pairs before their joins; the sums meet no join that could fan out
    orders_of = sited.select(*groups, "l_orderkey").distinct().join(
        sched, (F.col("_sid") == F.col("l_orderkey")) & (F.col("_sdate") == F.col("date_key")))
    parts_of = sited.select(*groups, "l_partkey").distinct().join(shift, F.col("_shift") == F.col("l_partkey"))
    g = AG.join_groups(sums, AG.distinct_counts(orders_of, groups, {"schedules": F.col("_sid")}), groups, "left")
    g = AG.join_groups(g, AG.distinct_counts(parts_of, groups, {"overnight_shifts": F.col("_shift")}), groups, "left")
    g = g.fillna(0, ["schedules", "overnight_shifts"])
    return g.select("date_key", "site_code", F.col("_sch").cast("double").alias("scheduled_minutes"),
                    F.col("_wk").cast("double").alias("worked_minutes"),
                    F.col("_shr").cast("double").alias("shrinkage_minutes"),
                    (F.col("_shr").cast("double") / F.nullif(F.col("_sch").cast("double"), F.lit(0.0)) * 100)
                    .alias("shrinkage_pct"), "schedules", "overnight_shifts")


# ---------------------------------------------------------------- Q14
def program_margin(spark, sf):
    o, li, n = table(spark, sf, "orders"), table(spark, sf, "lineitem"), table(spark, sf, "nation")
    b = o.groupBy(month(F.col("o_orderdate")).alias("period_month"),
                  F.col("o_orderpriority").alias("client_sk"),
                  F.col("o_orderstatus").alias("program_sk")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_billed"))
    b = b.withColumn("_net", F.col("_billed") * F.lit(0.95).cast("decimal(3,2)"))
    lab = li.groupBy(F.col("l_returnflag").alias("program_id"),
                     F.date_format("l_shipdate", "yyyy-MM").alias("work_month")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("billable_cost_minutes"))
    adj = o.where(F.col("o_orderpriority") == "5-LOW").groupBy(
        F.date_format("o_orderdate", "yyyy-MM").alias("adj_month")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_adjustments"))
    cmt = n.groupBy(F.col("n_regionkey").alias("contract_id")).agg(
        F.sum("n_nationkey").cast("bigint").alias("committed_min"))
    j = (b.join(lab, F.to_date(F.col("work_month"), "yyyy-MM") == F.col("period_month"), "left")
         .join(adj, F.to_date(F.col("adj_month"), "yyyy-MM") == F.col("period_month"), "left")
         .withColumn("committed_min", each_of(cmt, "committed_min")))   # the view's ON 1=1
    labor = F.col("billable_cost_minutes").cast("double") / 60.0 * LABOR_RATE
    return j.select(
        "period_month", "client_sk", "program_sk", F.col("_billed").cast("double").alias("billed_amount"),
        F.col("_net").cast("double").alias("net_revenue"), labor.alias("est_labor_cost"),
        F.col("total_adjustments").cast("double").alias("total_adjustments"),
        (F.col("_net").cast("double") - labor
         - F.coalesce(F.col("total_adjustments").cast("double"), F.lit(0.0))).alias("est_margin"),
        "committed_min")


# ---------------------------------------------------------------- Q15
def client_executive_summary(spark, sf):
    r, n = table(spark, sf, "region"), table(spark, sf, "nation")
    c, o, li = table(spark, sf, "customer"), table(spark, sf, "orders"), table(spark, sf, "lineitem")
    oc = o.join(c, o["o_custkey"] == c["c_custkey"]).select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "c_acctbal",
        F.col("c_nationkey").alias("nk"), month(F.col("o_orderdate")).alias("pm_month"))
    share = lambda priority: F.sum(F.when(F.col("o_orderpriority") == priority, 1).otherwise(0)) / F.count(F.lit(1)) * 100
    is_open = F.col("o_orderstatus").isin("O", "P")
    breached = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "O")
    # the finest level of the rollup is all the view keeps; tickets are its months added up
    pm = materialize(oc.groupBy("nk", "pm_month").agg(
        F.count(F.lit(1)).cast("bigint").alias("interactions"),
        exact_avg(F.col("o_totalprice")).alias("avg_handle_seconds"), exact_avg(F.col("c_acctbal")).alias("avg_csat"),
        share("1-URGENT").alias("pct_promoters"), share("5-LOW").alias("pct_detractors"),
        F.count_if(is_open).alias("_open"), F.count_if(breached).alias("_breached")))
    tk = pm.groupBy(F.col("nk").alias("tk_nk")).agg(F.sum("_open").cast("bigint").alias("open_tickets"),
                                                   F.sum("_breached").cast("bigint").alias("sla_breached_tickets"))
    bm = li.join(oc, li["l_orderkey"] == oc["o_orderkey"]).groupBy(
        F.col("nk").alias("bm_nk"), F.col("pm_month").alias("bm_month")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("_billed"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(18,2)"))
        .alias("_credit"))
    cl = r.select(F.col("r_regionkey").alias("client_id"), F.col("r_name").alias("client_code"),
                  F.lower("r_name").alias("client_name"))
    pr = n.select(F.col("n_nationkey").alias("program_sk"), F.col("n_regionkey").alias("client_id"),
                  F.col("n_name").alias("program_code"))
    j = (cl.join(pr, "client_id")
         .join(pm, pm["nk"] == pr["program_sk"])
         .join(bm, (bm["bm_nk"] == pr["program_sk"]) & (bm["bm_month"] == pm["pm_month"]), "left")
         .join(tk, tk["tk_nk"] == pr["program_sk"], "left"))
    return j.select("client_code", "client_name", F.col("pm_month").alias("period_month"), "program_code",
                    "interactions", "avg_handle_seconds", "avg_csat", "pct_promoters", "pct_detractors",
                    F.col("_billed").cast("double").alias("billed_amount"),
                    F.col("_credit").cast("double").alias("sla_credit_amount"),
                    (F.col("_billed") - F.col("_credit")).cast("double").alias("net_revenue"),
                    "open_tickets", "sla_breached_tickets")
