"""DuckDB SQL for the correctness oracle: the derived inputs of
``paritylake.plans.derived`` and the canonical hashes, as CTE text."""

from __future__ import annotations

from paritylake.functions.canon_sql import (digest_aggs_sql, hash_cols_sql, bucket_sql)

ORDERS_COLS = [("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp"),
               ("o_orderpriority", "string")]
ORDERS_NAMES = [c for c, _ in ORDERS_COLS]

ORDERS_TGT = """orders_tgt AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderkey % 101 = 0 AND o_orderkey % 103 <> 0
              THEN o_totalprice + 0.01 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 97 <> 0
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 103 = 0 AND o_orderkey % 97 <> 0)"""

ORDERS_EPOCH = """orders_epoch AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 223 = 0 THEN NULL
              WHEN o_orderkey % 211 = 0 THEN epoch_ms(o_orderdate) * 1000000
              ELSE epoch_ms(o_orderdate) END AS issued_sec,
         CAST(o_totalprice AS DECIMAL(14,2)) AS amount
  FROM orders)"""

ORDERS_DELTA = """orders_delta AS (
  SELECT CASE WHEN o_orderkey % 10 = 2 THEN o_orderkey + 1000000000 ELSE o_orderkey END AS o_orderkey,
         o_custkey,
         CAST(CASE WHEN o_orderkey % 10 = 1 THEN CAST(o_totalprice AS DECIMAL(14,2)) + 1
                   ELSE CAST(o_totalprice AS DECIMAL(14,2)) END AS DECIMAL(14,2)) AS amount,
         CASE o_orderkey % 10 WHEN 0 THEN 'D' WHEN 1 THEN 'U' ELSE 'I' END AS op,
         o_orderkey AS change_ms
  FROM orders WHERE o_orderkey % 10 IN (0, 1, 2)
  UNION ALL
  SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(14,2)) + 2 AS DECIMAL(14,2)),
         'U', o_orderkey + 1
  FROM orders WHERE o_orderkey % 50 = 1)"""

ORDERS_SNAPSHOT = """orders_snap AS (
  SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(14,2)) AS amount FROM orders)"""

# SCD-2 versions of event_type per user_id, built from events
EVENTS_SCD2 = """ev_ord AS (
  SELECT user_id, ts, event_id, event_type,
         lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type
  FROM events),
ev_starts AS (
  SELECT user_id, ts AS eff_from, event_type,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_from
  FROM ev_ord WHERE prev_type IS NULL OR prev_type <> event_type),
events_scd2 AS (
  SELECT user_id, eff_from, coalesce(next_from, TIMESTAMP '9999-12-31 00:00:00') AS eff_to,
         next_from IS NULL AS is_current, event_type,
         md5(concat_ws('|', CAST(user_id AS VARCHAR), event_type)) AS row_hash
  FROM ev_starts)"""

EVENTS_SCD2_BROKEN = EVENTS_SCD2 + """,
events_scd2_broken AS (
  SELECT user_id, eff_from,
         CASE WHEN user_id % 7 = 0 THEN eff_to + INTERVAL 1 HOUR ELSE eff_to END AS eff_to,
         CASE WHEN user_id % 11 = 0 THEN NOT is_current ELSE is_current END AS is_current,
         event_type, row_hash
  FROM events_scd2)"""


def hashed(table: str, cols, keep: str = "") -> str:
    k = f"{keep}, " if keep else ""
    return f"(SELECT {k}{hash_cols_sql(cols)} FROM {table})"


def digest_of(table: str, cols, prefix: str = "") -> str:
    return f"(SELECT {digest_aggs_sql(prefix)} FROM {hashed(table, cols)})"


__all__ = ["ORDERS_COLS", "ORDERS_NAMES", "ORDERS_TGT", "ORDERS_EPOCH", "ORDERS_DELTA",
           "ORDERS_SNAPSHOT", "EVENTS_SCD2", "EVENTS_SCD2_BROKEN", "hashed", "digest_of",
           "bucket_sql"]
