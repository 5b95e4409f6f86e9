"""Sharding by jump consistent hashing.

A stable 64-bit key (XXH64 of the key columns) and the shard count alone decide
a row's shard: no ring table, no state. Going from n to n + 1 shards moves only
the share 1 / (n + 1) of the keys, and every moved row goes to the new shard.

Defined cases: null key columns hash like any other value, so all rows with a
null key share a shard; rows with equal keys always share a shard; an empty
table gives an empty result; null texts have size 1 and the CRC-32 of no bytes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from paritylake.llm.common import utf8_crc32

#: Multiplier of the 64-bit linear congruential generator (a fixed value of the published method).
_LCG = np.uint64(2862933555777941757)


def jump_buckets(keys: np.ndarray, n: int) -> np.ndarray:
    """Bucket in [0, n) of each unsigned 64-bit key; all keys that still jump take the next step together."""
    key = keys.astype(np.uint64, copy=True)
    bucket = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        key[live] = key[live] * _LCG + np.uint64(1)
        scale = float(1 << 31) / ((key[live] >> np.uint64(33)).astype(np.float64) + 1.0)
        step = np.floor((bucket[live] + 1) * scale).astype(np.int64)
        live, step = live[step < n], step[step < n]
        bucket[live] = step
    return bucket


def shard_of(n: int, *key_cols: str) -> Column:
    """Shard of a row by its key columns."""
    if n < 1:
        raise ValueError("a shard count of 1 or more is needed")

    @F.pandas_udf("int")
    def jump(key: pd.Series) -> pd.Series:
        return pd.Series(jump_buckets(key.to_numpy(np.int64).view(np.uint64), n).astype(np.int32))

    return jump(F.xxhash64(*key_cols))


def with_slots(df: DataFrame, shard_col: str, order_cols: list[str], spread: int = 1024) -> DataFrame:
    """Number the rows of each shard from 0 without a gap (column ``slot``).

    A shard is cut into ``spread`` parts by a hash of the order columns; rows are numbered within a part and
    shifted by the sizes of the parts before it, so no task holds a whole shard.
    """
    df = df.withColumn("_part", F.pmod(F.xxhash64(F.lit(7), *order_cols), F.lit(spread)).cast("int"))
    sizes = df.groupBy(F.col(shard_col).alias("_s"), F.col("_part").alias("_p")).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_s").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("_s", "_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    local = F.row_number().over(Window.partitionBy(shard_col, "_part").orderBy(*order_cols)) - 1
    out = df.withColumn("_local", local).join(
        base, (F.col(shard_col) == F.col("_s")) & (F.col("_part") == F.col("_p")))
    return out.withColumn("slot", (F.col("_base") + F.col("_local")).cast("long")).drop("_part", "_local", "_s", "_p", "_base")


def assign_shards(df: DataFrame, n: int, key_cols: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``; the text itself is never shuffled."""
    keys = key_cols or ["doc_id"]
    slim = df.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        utf8_crc32(F.col(text_col)).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(n, *keys).alias("shard"),
        shard_of(n + 1, *keys).alias("grown_shard"))
    out = with_slots(slim, "shard", ["doc_id", "text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(df: DataFrame, path: str, n: int, key_cols: list[str] | None = None, files_per_shard: int = 1) -> None:
    """Write all columns as Parquet, one folder per shard; ``files_per_shard`` tasks write a shard."""
    keys = key_cols or ["doc_id"]
    salt = F.pmod(F.xxhash64(F.lit(11), *df.columns), F.lit(files_per_shard))
    (df.withColumn("shard", shard_of(n, *keys)).repartition(n * files_per_shard, "shard", salt)
       .write.partitionBy("shard").parquet(path))
