"""Derived inputs: deterministic "target side" tables built from the driver
tables, so every check has a realistic source/target pair whose differences
are known by construction (one logical row model, perturbed by key rules).

The same rules are written as SQL in ``paritylake.plans.oracle`` for the
DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# fixed values: perturbation moduli and offsets (by o_orderkey = k)
DROP_MOD, CHANGE_MOD, DUP_MOD = 97, 101, 103
PRICE_DELTA = 0.01
EPOCH_OOR_MOD, EPOCH_NULL_MOD, EPOCH_OOR_FACTOR = 211, 223, 10 ** 6
DELTA_DELETE, DELTA_UPDATE, DELTA_INSERT, DELTA_TWICE = 0, 1, 2, 1   # k % 10, k % 50
INSERT_KEY_OFFSET = 10 ** 9
SCD_SHIFT_MOD, SCD_FLIP_MOD = 7, 11
TERMINAL_TS = "9999-12-31 00:00:00"


def orders_tgt(orders: DataFrame) -> DataFrame:
    """Target copy of ``orders``: drop k%97, +0.01 on k%101, duplicate k%103.

    Precedence drop > duplicate > change; one scan, no shuffle: each row is
    emitted 0, 1 or 2 times by exploding a repeat count.
    """
    k = F.col("o_orderkey")
    copies = (F.when(k % DROP_MOD == 0, F.lit(0)).when(k % DUP_MOD == 0, F.lit(2))
              .otherwise(F.lit(1)))
    changed = orders.withColumn(
        "o_totalprice",
        F.when((k % CHANGE_MOD == 0) & (k % DUP_MOD != 0), F.col("o_totalprice") + F.lit(PRICE_DELTA))
        .otherwise(F.col("o_totalprice")))
    return (changed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies)))
            .drop("_copy"))


def orders_epoch(orders: DataFrame) -> DataFrame:
    """Source with a lying epoch column: ``issued_sec`` holds epoch *millis*;
    k%211 is blown out of range (×10^6), k%223 is NULL."""
    k = F.col("o_orderkey")
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return orders.select(
        "o_orderkey",
        F.when(k % EPOCH_NULL_MOD == 0, F.lit(None).cast("bigint"))
        .when(k % EPOCH_OOR_MOD == 0, millis * F.lit(EPOCH_OOR_FACTOR))
        .otherwise(millis).alias("issued_sec"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("amount"))


def orders_delta(orders: DataFrame) -> DataFrame:
    """CDC feed over ``orders``: D on k%10=0, U (+1) on k%10=1, I (k+10^9) on
    k%10=2; ``change_ms`` = k; a second, later change (U, +2) on k%50=1."""
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(14,2)")
    base = orders.where((k % 10).isin(DELTA_DELETE, DELTA_UPDATE, DELTA_INSERT)).select(
        F.when(k % 10 == DELTA_INSERT, k + F.lit(INSERT_KEY_OFFSET)).otherwise(k).alias("o_orderkey"),
        F.col("o_custkey"),
        F.when(k % 10 == DELTA_UPDATE, price + F.lit(1)).otherwise(price)
        .cast("decimal(14,2)").alias("amount"),
        F.when(k % 10 == DELTA_DELETE, F.lit("D")).when(k % 10 == DELTA_UPDATE, F.lit("U"))
        .otherwise(F.lit("I")).alias("op"),
        k.alias("change_ms"))
    twice = orders.where(k % 50 == DELTA_TWICE).select(
        k.alias("o_orderkey"), F.col("o_custkey"),
        (price + F.lit(2)).cast("decimal(14,2)").alias("amount"),
        F.lit("U").alias("op"), (k + F.lit(1)).alias("change_ms"))
    return base.unionByName(twice)


def orders_target_snapshot(orders: DataFrame) -> DataFrame:
    """Merge target: (o_orderkey, o_custkey, amount decimal(14,2))."""
    return orders.select("o_orderkey", "o_custkey",
                         F.col("o_totalprice").cast("decimal(14,2)").alias("amount"))


def events_scd2(events: DataFrame) -> DataFrame:
    """SCD-2 versions of ``event_type`` per ``user_id`` built from events.

    Ordered by (ts, event_id); equal neighbours collapse into one version;
    eff_to = next version's eff_from, the last one open until the terminal.
    """
    from paritylake.operators.scd2 import scd2_build
    from paritylake.session import materialize
    # kept: its readers go over it several times
    return materialize(scd2_build(events.select("user_id", "ts", "event_id", "event_type"),
                                  key="user_id", ts="ts", tie="event_id", attrs=["event_type"]))


def broken_scd2(v: DataFrame) -> DataFrame:
    """The negative twin of a history: eff_to shifted by one hour for user_id%7=0, is_current flipped for user_id%11=0."""
    u = F.col("user_id")
    return (v.withColumn("eff_to", F.when(u % SCD_SHIFT_MOD == 0,
                                          F.col("eff_to") + F.expr("INTERVAL 1 HOUR"))
                         .otherwise(F.col("eff_to")))
            .withColumn("is_current", F.when(u % SCD_FLIP_MOD == 0, ~F.col("is_current"))
                        .otherwise(F.col("is_current"))))
