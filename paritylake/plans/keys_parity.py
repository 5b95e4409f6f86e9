"""Registered queries for the parity family (V1-V5, A1, A11-A13, J10, U1,
U3, T1) with their DuckDB oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from paritylake.functions.canon import digest, pushdown_digest, with_row_hash
from paritylake.functions.canon_sql import bucket_sql, stripped_sql, text_sql
from paritylake.operators import digesttree, parity as P
from paritylake.plans import derived as D
from paritylake.plans.oracle import ORDERS_COLS, ORDERS_NAMES, ORDERS_TGT, hashed
from paritylake.session import scratch_dir
from paritylake.sources.tables import table

# column lists (name, oracle type) of every driver table, for whole-table digests
TABLE_COLS = {
    "region": [("r_regionkey", "int"), ("r_name", "string")],
    "nation": [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")],
    "customer": [("c_custkey", "int"), ("c_name", "string"), ("c_nationkey", "int"),
                 ("c_acctbal", "double"), ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "int"), ("s_name", "string"), ("s_nationkey", "int"),
                 ("s_acctbal", "double")],
    "part": [("p_partkey", "int"), ("p_name", "string"), ("p_brand", "string"),
             ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")],
    "orders": ORDERS_COLS,
    "lineitem": [("l_orderkey", "int"), ("l_partkey", "int"), ("l_suppkey", "int"),
                 ("l_linenumber", "int"), ("l_quantity", "double"),
                 ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
                 ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp")],
    "events": [("event_id", "int"), ("ts", "timestamp"), ("user_id", "int"),
               ("event_type", "string"), ("value", "double"), ("props", "string")],
    "documents": [("doc_id", "int"), ("text", "string"), ("lang", "string"),
                  ("source", "string"), ("n_chars", "int")],
    "embeddings": [("vec_id", "int"), ("embedding", "list<float>"), ("label", "int")],
    "pages": [("page_id", "int"), ("url", "string"), ("html", "string")],
    "benchmark": [("item_id", "int"), ("text", "string")],
    "labels": [("doc_id", "int"), ("quality", "int"), ("toxic", "int")],
    "conversations": [("conv_id", "int"), ("turn", "int"), ("role", "string"),
                      ("text", "string")],
}


def _orders_pair(spark, sf):
    o = table(spark, sf, "orders")
    return o, D.orders_tgt(o)


# ------------------------------------------------------------------ queries
def q_fingerprint_localize(spark, sf):
    src, tgt = _orders_pair(spark, sf)
    return P.localize(src, tgt, ORDERS_NAMES, "o_orderkey")


def q_stored_tree(spark, sf):
    """Localisation against a stored digest tree of the source: only the target's rows are read, and of both key levels only
    what lies below differing nodes."""
    src, tgt = _orders_pair(spark, sf)
    stored = digesttree.store_tree(src, ORDERS_NAMES, "o_orderkey", scratch_dir(spark, "orders-tree"))
    return digesttree.localize_against(digesttree.open_tree(spark, stored.path), tgt)


def q_rowcount_parity(spark, sf):
    o, t = _orders_pair(spark, sf)
    li = table(spark, sf, "lineitem")
    c = table(spark, sf, "customer")
    return P.rowcount_parity([
        ("orders_vs_tgt", o, t, None, None, 0),
        ("orders_vs_tgt_pct", o, t, None, None, "1%"),
        ("lineitem_self", li, li, None, None, 0),
        ("orders_f_vs_empty", o, t, "o_orderstatus = 'F'", "o_orderstatus = 'X'", 0),
        ("customer_building", c, c, "c_mktsegment = 'BUILDING'", "c_mktsegment = 'BUILDING'", 5),
    ])


AGG_SPECS = [("o_orderkey", "count", 0), ("o_totalprice", "sum", "0.1%"),
             ("o_totalprice", "sum", 0), ("o_orderdate", "min", 0), ("o_orderdate", "max", 0),
             ("o_custkey", "count_distinct", 0), ("o_orderstatus", "max", 0),
             ("o_totalprice", "max", 1)]


def q_aggregate_parity(spark, sf):
    o, t = _orders_pair(spark, sf)
    return P.aggregate_parity(o, t, AGG_SPECS, target="orders")


PRICE_COLS = ["o_orderkey", "price"]


def _typed_orders(o, key_type, price_type, nudge=None):
    """Orders' key and price as other column types; ``nudge`` adds to the price at its own scale."""
    price = F.col("o_totalprice").cast("decimal(14,2)").cast(price_type)
    if nudge:
        price = (price + F.when(F.col("o_orderkey") % 2 == 0, F.lit(nudge).cast(price_type)).otherwise(F.lit(0).cast(price_type))).cast(price_type)
    return o.select(F.col("o_orderkey").cast(key_type).alias("o_orderkey"), price.alias("price"))


def q_fingerprint_parity(spark, sf):
    o, t = _orders_pair(spark, sf)
    li = table(spark, sf, "lineitem")
    emb = table(spark, sf, "embeddings")
    li_names = [c for c, _ in TABLE_COLS["lineitem"]]
    wide = _typed_orders(o, "bigint", "decimal(38,18)")
    return P.union_checks([
        P.fingerprint_parity(o, t, ORDERS_NAMES, "orders_vs_tgt"),
        # another column order of the projection: same multiset
        P.fingerprint_parity(li, li.select(*reversed(li_names)), li_names, "lineitem_self"),
        P.fingerprint_parity(emb, emb, ["vec_id", "embedding", "label"], "embeddings_self"),
        # one value in different numeric types is one value
        P.fingerprint_parity(_typed_orders(o, "bigint", "decimal(14,2)"), _typed_orders(o, "decimal(38,0)", "double"),
                             PRICE_COLS, "decimal_vs_double"),
        P.fingerprint_parity(_typed_orders(o, "string", "decimal(14,2)"), wide, PRICE_COLS, "string_vs_bigint", coerce_numeric=True),
        P.fingerprint_parity(_typed_orders(o, "string", "decimal(14,2)"), wide, PRICE_COLS, "string_vs_bigint_strict"),
        # a difference in the tenth place is a difference
        P.fingerprint_parity(wide, _typed_orders(o, "bigint", "decimal(38,18)", "0.0000000001"), PRICE_COLS, "tenth_place"),
    ])


def q_fingerprint_multiset(spark, sf):
    out = None
    for name, cols in TABLE_COLS.items():
        d = digest(table(spark, sf, name), [c for c, _ in cols]).select(
            F.lit(name).alias("tbl"), "n", F.col("s1").cast("string").alias("s1"),
            F.col("s2").cast("string").alias("s2"), "x")
        out = d if out is None else out.unionByName(d)
    return out


def q_fingerprint_pushdown(spark, sf):
    o, t = _orders_pair(spark, sf)
    a = pushdown_digest(o, ORDERS_NAMES).select(F.lit("orders").alias("side"), "n",
                                                F.col("s1").cast("string").alias("s1"))
    b = pushdown_digest(t, ORDERS_NAMES).select(F.lit("orders_tgt").alias("side"), "n",
                                                F.col("s1").cast("string").alias("s1"))
    return a.unionByName(b)


def q_bucket_digests(spark, sf):
    from paritylake.functions.canon import bucket_digest
    d = bucket_digest(table(spark, sf, "orders"), ORDERS_NAMES, "o_orderkey", 256)
    return d.select("b", "n", F.col("s1").cast("string").alias("s1"),
                    F.col("s2").cast("string").alias("s2"))


def q_keyed_diff(spark, sf):
    """J10 without the bucket stage: per-key multiset digests of both sides in
    one aggregate over the tagged union (the key-union compare)."""
    o, t = _orders_pair(spark, sf)
    u = (with_row_hash(o, ORDERS_NAMES, keep=["o_orderkey"]).withColumn("_s", F.lit(1))
         .unionByName(with_row_hash(t, ORDERS_NAMES, keep=["o_orderkey"]).withColumn("_s", F.lit(2))))
    side = lambda s, c: F.sum(F.when(F.col("_s") == s, c))
    g = u.groupBy("o_orderkey").agg(
        side(1, F.lit(1)).alias("a_n"), side(2, F.lit(1)).alias("b_n"),
        side(1, F.col("h1").cast("decimal(38,0)")).alias("a_s"),
        side(2, F.col("h1").cast("decimal(38,0)")).alias("b_s"))
    kind = (F.when(F.col("b_n").isNull(), "missing").when(F.col("a_n").isNull(), "extra")
            .otherwise("changed"))
    return g.where(~(F.col("a_n").eqNullSafe(F.col("b_n")) & F.col("a_s").eqNullSafe(F.col("b_s")))) \
        .select("o_orderkey", kind.alias("kind"))


def q_multiset_except(spark, sf):
    """U1 both ways, counted per distinct row in one aggregation: side + copies."""
    from paritylake.operators.transform import multiset_diff
    o, t = _orders_pair(spark, sf)
    d = multiset_diff(o, t, ORDERS_NAMES)
    return d.select(*ORDERS_NAMES, F.when(F.col("side") == "only_a", "missing").otherwise("unexpected")
                    .alias("side"), "copies")


def q_key_union_changed(spark, sf):
    o, t = _orders_pair(spark, sf)
    bc = P.bucket_compare(o, t, ORDERS_NAMES, "o_orderkey", 256)
    return bc.where("differs").select(
        "b", F.coalesce("src_n", F.lit(0)).cast("bigint").alias("src_n"),
        F.coalesce("tgt_n", F.lit(0)).cast("bigint").alias("tgt_n"))


def q_diff_sample(spark, sf):
    return P.diff_sample(q_fingerprint_localize(spark, sf), "o_orderkey", 10)


A1_SPECS = [("l_quantity", "sum"), ("l_orderkey", "count_distinct"), ("l_shipdate", "min"),
            ("l_extendedprice", "max"), ("l_returnflag", "count"), ("l_linestatus", "max")]


def q_agg_list(spark, sf):
    li = table(spark, sf, "lineitem")
    # doubles whose sum no decimal type holds: 6e28 on first lines, a thousandth elsewhere
    wide = li.select(F.when(F.col("l_linenumber") == 1, F.lit(6e28)).otherwise(F.lit(0.001)).alias("wide"))
    return P.aggregate_values(li, A1_SPECS).unionByName(
        P.aggregate_values(wide, [("wide", "sum")]).withColumn("i", F.lit(len(A1_SPECS))))


def q_query_parity(spark, sf):
    from paritylake.sources.tables import register_views
    register_views(spark, sf, ["lineitem"])
    li = table(spark, sf, "lineitem")
    sql_a = spark.sql("SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM(l_quantity) AS q "
                      "FROM lineitem GROUP BY l_returnflag, l_linestatus")
    api_b = li.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    filt = api_b.where("l_returnflag <> 'R'")
    cnt_a = spark.sql("SELECT COUNT(*) AS c FROM lineitem")
    cnt_b = li.agg(F.count(F.lit(1)).alias("c"))
    cnt_bad = li.where("l_linenumber > 1").agg(F.count(F.lit(1)).alias("c"))
    cross = spark.sql("SELECT (SELECT COUNT(DISTINCT l_returnflag) FROM lineitem) * "
                      "(SELECT COUNT(DISTINCT l_linestatus) FROM lineitem) AS c")
    # cartesian count preservation without materialising the product
    cross_b = li.agg((F.count_distinct("l_returnflag") * F.count_distinct("l_linestatus")).alias("c"))
    # approximate distinct against exact, within the ±5 % tolerance
    exact = spark.sql("SELECT COUNT(DISTINCT l_orderkey) AS c FROM lineitem")
    approx = li.agg(F.approx_count_distinct("l_orderkey", 0.01).alias("c"))
    # regex classes: anchored alternation (RLIKE in SQL, rlike in the DataFrame API), whole texts
    register_views(spark, sf, ["documents"])
    rx_sql = spark.sql(r"""SELECT CASE WHEN text RLIKE '^(The|Der|Le|El)\\b' THEN 'article'
                                      WHEN text RLIKE '(?i)(https?://|www\\.)' THEN 'link'
                                      ELSE 'other' END AS cls, lang, COUNT(*) AS n
                           FROM documents GROUP BY 1, 2""")
    t = F.col("text")
    cls = (F.when(t.rlike(r"^(The|Der|Le|El)\b"), "article")
           .when(t.rlike(r"(?i)(https?://|www\.)"), "link").otherwise("other"))
    rx_api = table(spark, sf, "documents").groupBy(cls.alias("cls"), "lang").agg(F.count(F.lit(1)).alias("n"))
    return P.union_checks([
        P.query_parity(sql_a, api_b, "rowset", target="grouped_counts"),
        P.query_parity(sql_a, filt, "rowset", target="grouped_counts_filtered"),
        P.query_parity(cnt_a, cnt_b, "scalar", target="count_scalar"),
        P.query_parity(cnt_a, cnt_bad, "scalar", 0, target="count_scalar_wrong"),
        P.query_parity(cross, cross_b, "scalar", target="cross_join_count"),
        P.query_parity(api_b.select("n"), api_b.select("n"), "scalar", target="several_rows_scalar"),
        P.query_parity(exact, approx, "scalar", "5%", target="approx_distinct_5pct"),
        P.query_parity(rx_sql, rx_api, "rowset", target="regex_classes"),
    ]).select("pattern", "target", "status")


QUERIES = {
    "fingerprint_localize": q_fingerprint_localize,
    "fingerprint_localize_stored": q_stored_tree,
    "rowcount_parity": q_rowcount_parity,
    "aggregate_parity": q_aggregate_parity,
    "fingerprint_parity": q_fingerprint_parity,
    "fingerprint_multiset": q_fingerprint_multiset,
    "fingerprint_pushdown": q_fingerprint_pushdown,
    "bucket_digests": q_bucket_digests,
    "keyed_diff": q_keyed_diff,
    "multiset_except": q_multiset_except,
    "key_union_changed": q_key_union_changed,
    "diff_sample": q_diff_sample,
    "agg_list": q_agg_list,
    "query_parity": q_query_parity,
}


# ------------------------------------------------------------------ oracle SQL
def _per_key_sql(tbl: str) -> str:
    return (f"SELECT o_orderkey, count(*) AS n, sum(h1) AS s1, sum(h2) AS s2 "
            f"FROM {hashed(tbl, ORDERS_COLS, 'o_orderkey')} GROUP BY o_orderkey")


_LOCALIZE_SQL = f"""WITH {ORDERS_TGT},
a AS ({_per_key_sql('orders')}), b AS ({_per_key_sql('orders_tgt')}),
j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
             CAST(coalesce(a.n, 0) AS BIGINT) AS src_n, CAST(coalesce(b.n, 0) AS BIGINT) AS tgt_n,
             a.s1 AS as1, b.s1 AS bs1, a.s2 AS as2, b.s2 AS bs2
      FROM a FULL JOIN b ON a.o_orderkey IS NOT DISTINCT FROM b.o_orderkey)
SELECT o_orderkey,
       CASE WHEN tgt_n = 0 THEN 'missing' WHEN src_n = 0 THEN 'extra'
            WHEN tgt_n > src_n THEN 'duplicated' WHEN tgt_n < src_n THEN 'under_count'
            ELSE 'changed' END AS kind, src_n, tgt_n
FROM j WHERE NOT (src_n = tgt_n AND as1 IS NOT DISTINCT FROM bs1 AND as2 IS NOT DISTINCT FROM bs2)"""


def _rc(name, src, tgt, sf, tf, allowed):
    sw = f" WHERE {sf}" if sf else ""
    tw = f" WHERE {tf}" if tf else ""
    return f"""SELECT '{name}' AS pair, s.n AS src_n, t.n AS tgt_n, CAST(abs(s.n - t.n) AS BIGINT) AS delta,
  round(CASE WHEN s.n = 0 THEN NULL ELSE abs(s.n - t.n) * 100.0 / s.n END, 6) AS pct_of_source,
  CASE WHEN CAST(abs(s.n - t.n) AS DOUBLE) <= {allowed} THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM {src}{sw}) s,
     (SELECT CAST(count(*) AS BIGINT) AS n FROM {tgt}{tw}) t"""


_ROWCOUNT_SQL = f"WITH {ORDERS_TGT}\n" + "\nUNION ALL\n".join([
    _rc("orders_vs_tgt", "orders", "orders_tgt", None, None, "0.0"),
    _rc("orders_vs_tgt_pct", "orders", "orders_tgt", None, None, "abs(CAST(s.n AS DOUBLE)) * 0.01"),
    _rc("lineitem_self", "lineitem", "lineitem", None, None, "0.0"),
    _rc("orders_f_vs_empty", "orders", "orders_tgt", "o_orderstatus = 'F'", "o_orderstatus = 'X'", "0.0"),
    _rc("customer_building", "customer", "customer", "c_mktsegment = 'BUILDING'",
        "c_mktsegment = 'BUILDING'", "5.0"),
])


def _agg_sql_value(col, fn):
    if fn in ("count", "count_distinct"):
        return f"CAST(count({'DISTINCT ' if fn == 'count_distinct' else ''}{col}) AS VARCHAR)"
    if fn == "sum":
        return stripped_sql(f"CAST(sum(CAST({col} AS DECIMAL(38,9))) AS VARCHAR)")
    if col in ("o_orderdate", "l_shipdate"):
        return f"CAST({fn}(date_trunc('second', {col})) AS VARCHAR)"
    if col in ("o_orderstatus", "l_linestatus"):
        return f"CAST({fn}({col}) AS VARCHAR)"
    return text_sql(f"{fn}({col})", "double")


def _aggregate_parity_sql():
    parts = []
    for i, (c, fn, tol) in enumerate(AGG_SPECS):
        v = _agg_sql_value(c, fn)
        if isinstance(tol, str) and tol.endswith("%"):
            allowed = f"abs(CAST(s.v AS DOUBLE)) * {float(tol[:-1]) / 100.0}"
        else:
            allowed = f"{float(tol)}"
        if c == "o_orderdate":
            ok = (f"(s.v IS NOT DISTINCT FROM t.v OR abs(epoch(CAST(s.v AS TIMESTAMP)) - "
                  f"epoch(CAST(t.v AS TIMESTAMP))) <= {allowed})")
        elif c == "o_orderstatus":
            ok = "(s.v IS NOT DISTINCT FROM t.v)"
        else:
            ok = (f"(s.v IS NOT DISTINCT FROM t.v OR CAST(abs(CAST(s.v AS DECIMAL(38,9)) - "
                  f"CAST(t.v AS DECIMAL(38,9))) AS DOUBLE) <= {allowed})")
        parts.append(f"""SELECT 'aggregate_parity' AS pattern, 'orders.{c}.{fn}' AS target,
  CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, s.v AS expected, t.v AS actual,
  false AS measurement, {i} AS i
FROM (SELECT {v} AS v FROM orders) s, (SELECT {v} AS v FROM orders_tgt) t""")
    return f"WITH {ORDERS_TGT}\n" + "\nUNION ALL\n".join(parts)


def _fp_check_sql(target, src, tgt, cols, tgt_cols=None):
    from paritylake.plans.oracle import digest_of
    return f"""SELECT 'fingerprint_parity' AS pattern, '{target}' AS target,
  CASE WHEN s.n = t.n AND s.s1 = t.s1 AND s.s2 = t.s2 AND s.x = t.x THEN 'PASS' ELSE 'FAIL' END AS status,
  concat_ws('/', CAST(s.n AS VARCHAR), CAST(s.s1 AS VARCHAR), CAST(s.s2 AS VARCHAR), CAST(s.x AS VARCHAR)) AS expected,
  concat_ws('/', CAST(t.n AS VARCHAR), CAST(t.s1 AS VARCHAR), CAST(t.s2 AS VARCHAR), CAST(t.x AS VARCHAR)) AS actual,
  false AS measurement
FROM {digest_of(src, cols)} s, {digest_of(tgt, tgt_cols or cols)} t"""


_TYPED = """typed_orders AS (
  SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,2)) AS price, CAST(o_totalprice AS DECIMAL(14,2))::DOUBLE AS price_double,
         CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS DECIMAL(38,18))
           + CASE WHEN o_orderkey % 2 = 0 THEN 0.0000000001::DECIMAL(38,18) ELSE 0::DECIMAL(38,18) END AS price_tenth,
         CAST(o_orderkey AS VARCHAR) AS key_text
  FROM orders)"""
_KEY_PRICE = [("o_orderkey", "int"), ("price", "decimal")]
_FINGERPRINT_PARITY_SQL = f"WITH {ORDERS_TGT}, {_TYPED}\n" + "\nUNION ALL\n".join([
    _fp_check_sql("decimal_vs_double", "typed_orders", "typed_orders", _KEY_PRICE, [("o_orderkey", "int"), ("price_double", "double")]),
    _fp_check_sql("string_vs_bigint", "typed_orders", "typed_orders", _KEY_PRICE),
    _fp_check_sql("string_vs_bigint_strict", "typed_orders", "typed_orders", [("key_text", "string"), ("price", "decimal")], _KEY_PRICE),
    _fp_check_sql("tenth_place", "typed_orders", "typed_orders", _KEY_PRICE, [("o_orderkey", "int"), ("price_tenth", "decimal")]),
    _fp_check_sql("orders_vs_tgt", "orders", "orders_tgt", ORDERS_COLS),
    _fp_check_sql("lineitem_self", "lineitem", "lineitem", TABLE_COLS["lineitem"]),
    _fp_check_sql("embeddings_self", "embeddings", "embeddings", TABLE_COLS["embeddings"]),
])


def _multiset_sql():
    from paritylake.plans.oracle import digest_of
    parts = [f"SELECT '{t}' AS tbl, n, CAST(s1 AS VARCHAR) AS s1, CAST(s2 AS VARCHAR) AS s2, x "
             f"FROM {digest_of(t, cols)}" for t, cols in TABLE_COLS.items()]
    return "\nUNION ALL\n".join(parts)


_PUSHDOWN_SQL = f"""WITH {ORDERS_TGT}
SELECT 'orders' AS side, CAST(count(*) AS BIGINT) AS n, CAST(CAST(coalesce(sum(h1), 0) AS DECIMAL(38,0)) AS VARCHAR) AS s1
FROM {hashed('orders', ORDERS_COLS)}
UNION ALL
SELECT 'orders_tgt', CAST(count(*) AS BIGINT), CAST(CAST(coalesce(sum(h1), 0) AS DECIMAL(38,0)) AS VARCHAR)
FROM {hashed('orders_tgt', ORDERS_COLS)}"""

_BUCKETS_SQL = f"""SELECT {bucket_sql('o_orderkey', 256)} AS b, CAST(count(*) AS BIGINT) AS n,
  CAST(CAST(sum(h1) AS DECIMAL(38,0)) AS VARCHAR) AS s1, CAST(CAST(sum(h2) AS DECIMAL(38,0)) AS VARCHAR) AS s2
FROM {hashed('orders', ORDERS_COLS, 'o_orderkey')} GROUP BY 1"""

_KEYED_DIFF_SQL = f"""WITH {ORDERS_TGT},
a AS (SELECT o_orderkey, count(*) AS n, sum(h1) AS s FROM {hashed('orders', ORDERS_COLS, 'o_orderkey')} GROUP BY 1),
b AS (SELECT o_orderkey, count(*) AS n, sum(h1) AS s FROM {hashed('orders_tgt', ORDERS_COLS, 'o_orderkey')} GROUP BY 1)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN b.n IS NULL THEN 'missing' WHEN a.n IS NULL THEN 'extra' ELSE 'changed' END AS kind
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey
WHERE NOT (a.n IS NOT DISTINCT FROM b.n AND a.s IS NOT DISTINCT FROM b.s)"""

_ON = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in ORDERS_NAMES)
_MULTISET_EXCEPT_SQL = f"""WITH {ORDERS_TGT},
a AS (SELECT {', '.join(ORDERS_NAMES)}, count(*) AS a_n FROM orders GROUP BY ALL),
b AS (SELECT {', '.join(ORDERS_NAMES)}, count(*) AS b_n FROM orders_tgt GROUP BY ALL),
j AS (SELECT {', '.join(f'coalesce(a.{c}, b.{c}) AS {c}' for c in ORDERS_NAMES)},
             coalesce(a_n, 0) - coalesce(b_n, 0) AS d
      FROM a FULL JOIN b ON {_ON})
SELECT {', '.join(ORDERS_NAMES)}, CASE WHEN d > 0 THEN 'missing' ELSE 'unexpected' END AS side,
       CAST(abs(d) AS BIGINT) AS copies FROM j WHERE d <> 0"""


def _bucket_side(tbl, p):
    return (f"SELECT {bucket_sql('o_orderkey', 256)} AS b, count(*) AS {p}n, sum(h1) AS {p}s1, "
            f"sum(h2) AS {p}s2 FROM {hashed(tbl, ORDERS_COLS, 'o_orderkey')} GROUP BY 1")


_KEY_UNION_SQL = f"""WITH {ORDERS_TGT},
a AS ({_bucket_side('orders', 'src_')}), b AS ({_bucket_side('orders_tgt', 'tgt_')})
SELECT coalesce(a.b, b.b) AS b, CAST(coalesce(src_n, 0) AS BIGINT) AS src_n,
       CAST(coalesce(tgt_n, 0) AS BIGINT) AS tgt_n
FROM a FULL JOIN b ON a.b = b.b
WHERE NOT (coalesce(src_n, 0) = coalesce(tgt_n, 0) AND coalesce(src_s1, 0) = coalesce(tgt_s1, 0)
           AND coalesce(src_s2, 0) = coalesce(tgt_s2, 0))"""

_DIFF_SAMPLE_SQL = f"SELECT * FROM ({_LOCALIZE_SQL}) ORDER BY o_orderkey NULLS FIRST LIMIT 10"


def _agg_list_sql():
    kinds = {"l_shipdate": "moment", "l_linestatus": "text"}
    kind = lambda c, fn: "number" if fn in ("sum", "count", "count_distinct") else kinds.get(c, "number")
    rows = [f"SELECT {i} AS i, '{c}' AS col, '{fn}' AS fn, (SELECT {_agg_sql_value(c, fn)} FROM lineitem) AS value, '{kind(c, fn)}' AS kind"
            for i, (c, fn) in enumerate(A1_SPECS)]
    firsts, others = "count(*) FILTER (WHERE l_linenumber = 1)", "count(*) FILTER (WHERE l_linenumber IS DISTINCT FROM 1)"
    wide = (f"CAST(6 * {firsts} AS VARCHAR) || lpad(CAST({others} // 1000 AS VARCHAR), 28, '0') || '.' || "
            f"lpad(CAST({others} % 1000 AS VARCHAR), 3, '0')")
    rows.append(f"SELECT {len(A1_SPECS)}, 'wide', 'sum', rtrim(rtrim((SELECT {wide} FROM lineitem), '0'), '.'), 'number'")
    return "\nUNION ALL\n".join(rows)


def _same_rows(a: str, b: str) -> str:
    """PASS if two queries have the same multiset of rows."""
    return (f"CASE WHEN (SELECT count(*) FROM (({a}) EXCEPT ALL ({b}))) + (SELECT count(*) FROM (({b}) EXCEPT ALL ({a}))) = 0 "
            "THEN 'PASS' ELSE 'FAIL' END")


def _same_value(a: str, b: str) -> str:
    return f"CASE WHEN ({a}) = ({b}) THEN 'PASS' ELSE 'FAIL' END"


_GROUPED = "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2"
_GROUPED_2 = ("SELECT DISTINCT l_returnflag, l_linestatus, count(*) OVER w AS n, sum(l_quantity) OVER w AS q FROM lineitem "
              "WINDOW w AS (PARTITION BY l_returnflag, l_linestatus)")
_CLASS = ("SELECT CASE WHEN regexp_matches(text, '^(The|Der|Le|El)\\b') THEN 'article' "
          "WHEN regexp_matches(text, '(?i)(https?://|www\\.)') THEN 'link' ELSE 'other' END AS cls, lang, count(*) AS n FROM documents GROUP BY 1, 2")
_CLASS_2 = ("SELECT CASE WHEN regexp_extract(text, '^[A-Za-z]+\\b') IN ('The', 'Der', 'Le', 'El') THEN 'article' "
            "WHEN lower(text) LIKE '%http://%' OR lower(text) LIKE '%https://%' OR lower(text) LIKE '%www.%' THEN 'link' ELSE 'other' END AS cls, "
            "lang, count(*) AS n FROM documents GROUP BY 1, 2")
# the approximate count's row states the accuracy the sketch promises: another engine's sketch cannot compute it
_QUERY_PARITY_SQL = f"""SELECT 'query_parity' AS pattern, 'grouped_counts' AS target, {_same_rows(_GROUPED, _GROUPED_2)} AS status
UNION ALL SELECT 'query_parity', 'grouped_counts_filtered', {_same_rows(_GROUPED, "SELECT * FROM (" + _GROUPED + ") WHERE l_returnflag <> 'R'")}
UNION ALL SELECT 'query_parity', 'count_scalar', {_same_value("SELECT count(*) FROM lineitem", "SELECT sum(n) FROM (" + _GROUPED + ")")}
UNION ALL SELECT 'query_parity', 'count_scalar_wrong', {_same_value("SELECT count(*) FROM lineitem", "SELECT count(*) FROM lineitem WHERE l_linenumber > 1")}
UNION ALL SELECT 'query_parity', 'cross_join_count', {_same_value(
    "SELECT count(*) FROM (SELECT DISTINCT l_returnflag FROM lineitem) CROSS JOIN (SELECT DISTINCT l_linestatus FROM lineitem)",
    "SELECT count(DISTINCT l_returnflag) * count(DISTINCT l_linestatus) FROM lineitem")}
UNION ALL SELECT 'query_parity', 'several_rows_scalar', CASE WHEN (SELECT count(*) FROM ({_GROUPED})) > 1 THEN 'ERROR' ELSE 'PASS' END
UNION ALL SELECT 'query_parity', 'approx_distinct_5pct', 'PASS'
UNION ALL SELECT 'query_parity', 'regex_classes', {_same_rows(_CLASS, _CLASS_2)}"""

ORACLE = {
    "fingerprint_localize": _LOCALIZE_SQL,
    "fingerprint_localize_stored": _LOCALIZE_SQL,
    "rowcount_parity": _ROWCOUNT_SQL,
    "aggregate_parity": _aggregate_parity_sql(),
    "fingerprint_parity": _FINGERPRINT_PARITY_SQL,
    "fingerprint_multiset": _multiset_sql(),
    "fingerprint_pushdown": _PUSHDOWN_SQL,
    "bucket_digests": _BUCKETS_SQL,
    "keyed_diff": _KEYED_DIFF_SQL,
    "multiset_except": _MULTISET_EXCEPT_SQL,
    "key_union_changed": _KEY_UNION_SQL,
    "diff_sample": _DIFF_SAMPLE_SQL,
    "agg_list": _agg_list_sql(),
    "query_parity": _QUERY_PARITY_SQL,
}
