"""Change feeds and MERGE without a transactional table: D1 ``delta_latest``,
V10 ``merge_apply`` (the MERGE as DataFrame joins), V11 idempotency,
J5 delete-keys-present and X2 upsert split.

The fold is a LEFT join of the target to the delta (matched + delete → row
dropped; matched otherwise → delta values; unmatched → kept) and the delta rows
whose key the target lacks (a non-NULL op other than delete → inserted). Neither
is a full outer join: AQE may broadcast a small delta or split a skewed key of
the target. A delta key that is NULL or occurs twice is refused: it changes
nothing and ``merge_refusals`` reports it. The target is never overwritten in
place: merge results are new DataFrames (write them to a new path and swap).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paritylake.operators.parity import fingerprint_pair
from paritylake.session import materialize


def delta_latest(delta: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last change per key by ``order`` — ``max_by`` is partial-aggregated,
    so a key with millions of changes never lands whole in one task."""
    other = [c for c in delta.columns if c not in keys]
    ordkey = F.struct(*[F.col(c) for c in order])
    r = delta.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in other]), ordkey).alias("_r"))
    return r.select(*keys, *[F.col("_r").getField(c).alias(c) for c in other])


def _keys_of_delta(delta: DataFrame, keys: list[str], cols: list[str], op: str) -> DataFrame:
    """One row per acceptable delta key: not NULL, and met once."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    values = [F.first(c).alias(f"_d_{c}") for c in cols if c not in keys]
    return (delta.where(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias("_d_rows"), F.first(op).alias("_d_op"), *values)
            .where("_d_rows = 1").drop("_d_rows"))


def merge_refusals(delta: DataFrame, keys: list[str], target: str = "delta") -> DataFrame:
    """Two check rows: delta rows with a NULL key, and rows of keys met more than once (ERROR if there are any)."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per = delta.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(null_key.alias("_null"), "_n")
    one = per.agg(F.coalesce(F.sum(F.when(F.col("_null"), F.col("_n"))), F.lit(0)).alias("null_keys"),
                  F.coalesce(F.sum(F.when(~F.col("_null") & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).alias("repeated_keys"))
    rows = one.selectExpr("stack(2, 'null_keys', null_keys, 'repeated_keys', repeated_keys) AS (reason, n)")
    return rows.select(F.lit("merge_apply").alias("pattern"), F.concat(F.lit(f"{target}:"), "reason").alias("target"),
                       F.when(F.col("n") == 0, "PASS").otherwise("ERROR").alias("status"), F.lit("0").alias("expected"),
                       F.col("n").cast("string").alias("actual"), F.lit(False).alias("measurement"))


def merge_apply(target: DataFrame, delta: DataFrame, keys: list[str], op: str = "op",
                delete: str = "D", action_col: str = "_action") -> DataFrame:
    """The corpus MERGE. ``delta`` should hold one row per key (reduce with ``delta_latest`` first); keys that
    are NULL or met twice are refused."""
    cols = [c for c in target.columns if c != action_col]
    d = _keys_of_delta(delta, keys, cols, op).withColumn("_d_hit", F.lit(True))
    t = target.select(*cols)
    hit, is_del = F.col("_d_hit").isNotNull(), F.col("_d_op").eqNullSafe(F.lit(delete))
    kept = t.join(d, keys, "left").where(~(hit & is_del))
    kept = kept.select(*[F.col(c) if c in keys else F.when(hit, F.col(f"_d_{c}")).otherwise(F.col(c)).alias(c) for c in cols],
                       F.when(hit, "update").otherwise("keep").alias(action_col))
    new = d.where(F.col("_d_op") != F.lit(delete)).join(t.select(*keys), keys, "left_anti")     # NULL op: not inserted
    new = new.select(*[F.col(c if c in keys else f"_d_{c}").alias(c) for c in cols], F.lit("insert").alias(action_col))
    return kept.unionByName(new)


def merge_actions(target: DataFrame, delta: DataFrame, keys: list[str], op: str = "op",
                  delete: str = "D") -> DataFrame:
    """Counts per merge action (keep / update / insert / delete / skip); refused delta rows take no action."""
    d = _keys_of_delta(delta, keys, [], op).withColumn("_d_hit", F.lit(True))
    t = target.select(*keys)
    hit, is_del = F.col("_d_hit").isNotNull(), F.col("_d_op").eqNullSafe(F.lit(delete))
    of_target = t.join(d, keys, "left").select(F.when(hit & is_del, "delete").when(hit, "update").otherwise("keep").alias("action"))
    of_delta = d.join(t, keys, "left_anti").select(F.when(F.col("_d_op") != F.lit(delete), "insert").otherwise("skip").alias("action"))
    return of_target.unionByName(of_delta).groupBy("action").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def append_merge(target: DataFrame, delta: DataFrame, keys: list[str], op: str = "op",
                 delete: str = "D") -> DataFrame:
    """The negative twin: inserts every non-delete change (append-only)."""
    cols = [c for c in target.columns if c != "_action"]
    return target.select(*cols).unionByName(
        delta.where(F.col(op) != F.lit(delete)).select(*cols))


def delete_keys_present(result: DataFrame, delta: DataFrame, keys: list[str],
                        op: str = "op", delete: str = "D") -> DataFrame:
    """Rows of ``result`` whose key has a delete in the delta (must be 0).
    Inner join count so duplicate survivors are all counted."""
    dk = delta.where(F.col(op) == F.lit(delete)).select(*keys).distinct()
    return result.join(dk, keys, "inner").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def merge_idempotency(target: DataFrame, delta: DataFrame, keys: list[str],
                      merge_fn=None, op: str = "op", delete: str = "D") -> DataFrame:
    """Apply the merge twice and compare the two multiset fingerprints,
    then count deleted keys still present. Returns check rows."""
    fn = merge_fn or (lambda t, d: merge_apply(t, d, keys, op, delete).drop("_action"))
    # each result is read several times (fingerprints, the second merge, the delete check): kept once
    once = materialize(fn(target, delta))
    twice = materialize(fn(once, delta))
    cols = once.columns
    pair = fingerprint_pair(once, twice, cols)
    pair = pair.toDF(*[c.replace("src_", "a_").replace("tgt_", "b_") for c in pair.columns])
    dk = delete_keys_present(twice, delta, keys, op, delete)
    same = ((F.col("a_n") == F.col("b_n")) & (F.col("a_s1") == F.col("b_s1"))
            & (F.col("a_s2") == F.col("b_s2")) & (F.col("a_x") == F.col("b_x")))
    fp = pair.select(
        F.lit("merge_idempotency").alias("pattern"), F.lit("fingerprint_once_vs_twice").alias("target"),
        F.when(same, "PASS").otherwise("FAIL").alias("status"),
        F.col("a_n").cast("string").alias("expected"), F.col("b_n").cast("string").alias("actual"),
        F.lit(False).alias("measurement"))
    dl = dk.select(
        F.lit("merge_idempotency").alias("pattern"), F.lit("deleted_keys_present").alias("target"),
        F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"),
        F.lit("0").alias("expected"), F.col("n").cast("string").alias("actual"),
        F.lit(False).alias("measurement"))
    return fp.unionByName(dl)
