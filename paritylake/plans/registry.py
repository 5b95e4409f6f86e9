"""All registered query keys and their oracle SQL, merged from the families."""

from __future__ import annotations

import importlib

FAMILIES = ["keys_parity", "keys_checks", "keys_marts", "keys_ops", "keys_files", "keys_reporting", "keys_streaming"]

QUERIES: dict = {}
ORACLE: dict = {}

for _m in FAMILIES:
    _mod = importlib.import_module(f"paritylake.plans.{_m}")
    for _k in _mod.QUERIES:
        if _k in QUERIES:
            raise ValueError(f"duplicate key {_k}")
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_mod.ORACLE)

for _m in FAMILIES:
    _mod = importlib.import_module(f"paritylake.plans.{_m}")
    if hasattr(_mod, "late_oracle"):
        ORACLE.update(_mod.late_oracle())

# Result columns rendered as ISO text on BOTH sides of the correctness gate:
# DATE and DECIMAL values come back from Spark and DuckDB as different Python
# types (date vs datetime64, Decimal vs float), text is identical in both.
TEXT_COLUMNS = {
    "delta_latest": ["amount"],
    "active_agents_ndv": ["date_key"], "queue_sla_attainment": ["date_key"],
    "first_contact_resolution": ["date_key"], "occupancy_utilization": ["date_key"],
    "shrinkage_analysis": ["date_key"], "partition_tier_counts": ["date_key"],
    "program_margin": ["period_month"], "client_executive_summary": ["period_month"],
    "wide_hub_join": ["period_month"], "left_join_true": ["period_month"], "expr_key_join": ["period_month"],
    "conditional_sums": ["ship_month"], "fn_date": ["date_plus_3", "month_start", "lit_date"],
    "fn_iso_coerce": ["d"], "table_layouts": ["order_year"], "synth_table": ["first_date", "last_date"],
    "partition_collapse": ["event_date"], "retention_check": ["partition"],
    # the open-ended SCD-2 terminal (9999-12-31) is outside pandas' nanosecond range
    "scd2_build": ["eff_to"], "adjacent_versions": ["eff_to"],
    "seed_given": ["c_flag"],
}

# nullable integer results as DOUBLE on both sides: pandas turns a nullable
# Spark integer into float64 but a nullable DuckDB integer into Int64
DOUBLE_COLUMNS = {
    "fn_epoch": ["issued_sec", "epoch_s"], "billing_reconciliation": ["drift_seconds"],
    "left_join_true": ["contract_id", "committed"], "lag_gap": ["prev_turn", "gap"],
    "fn_null": ["mod_or_null"], "load_formats": ["landed"], "csat_rollup": ["client_id"],
}


def _cast_cols(fn, cols, spark_type):
    from pyspark.sql import functions as F

    def run(spark, sf_dir):
        df = fn(spark, sf_dir)
        return df.select(*[F.col(c).cast(spark_type).alias(c) if c in cols else F.col(c) for c in df.columns])
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _in_session(fn):
    """The query in a session with the settings the canonical forms depend on."""
    from paritylake.session import ensure_session

    def run(spark, sf_dir):
        return fn(ensure_session(spark), sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


for _cols_map, _st, _dt in ((TEXT_COLUMNS, "string", "VARCHAR"), (DOUBLE_COLUMNS, "double", "DOUBLE")):
    for _k, _cols in _cols_map.items():
        QUERIES[_k] = _cast_cols(QUERIES[_k], _cols, _st)
        if _k in ORACLE:
            _rep = ", ".join(f'CAST("{c}" AS {_dt}) AS "{c}"' for c in _cols)
            ORACLE[_k] = f"SELECT * REPLACE ({_rep}) FROM ({ORACLE[_k]}) AS _q"

for _k in list(QUERIES):
    QUERIES[_k] = _in_session(QUERIES[_k])
