"""Interval match counting without emitting pairs (the scale form of J6).

``range_count(left, right, ...)`` gives, for every left row, the number of
right rows with the same key whose time lies in ``(lo, hi]`` — what
``COUNT(*)`` over ``LEFT JOIN right ON key = key AND t > lo AND t <= hi``
needs, without materialising the pairs.

Right rows and the bounds of left rows are first reduced to distinct
(key, time) points, each with its number of right rows. A running sum over a
key's points (``windows.running_sum``: per key and time bucket, so a hot key
is many groups) gives the right rows up to each point. A left row's count is
that of ``hi`` less that of ``lo``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paritylake.operators.windows import running_sum

# the bucket only splits the running count, so it can be much finer than the interval
DEFAULT_BUCKET_SECONDS = 3600


def range_count(left: DataFrame, right: DataFrame, key: str, left_id: str, lo: str, hi: str,
                right_t: str, right_key: str | None = None,
                bucket_seconds: int = DEFAULT_BUCKET_SECONDS, out: str = "matches") -> DataFrame:
    """``left`` + column ``out``: # right rows with same key and lo < t <= hi.

    NULL keys and NULL bounds match nothing, nor does a ``lo`` at or after ``hi`` (count 0).
    """
    rk = right_key or key
    at = lambda c: F.col(c).cast("timestamp")
    whole = F.col(key).isNotNull() & F.col(lo).isNotNull() & F.col(hi).isNotNull()
    data = right.where(F.col(rk).isNotNull() & F.col(right_t).isNotNull()).select(
        F.col(rk).alias("_k"), at(right_t).alias("_t"), F.lit(1).alias("_c"))
    bounds = left.where(whole).select(F.col(key).alias("_k"), F.explode(F.array(at(lo), at(hi))).alias("_t"), F.lit(0).alias("_c"))
    points = data.unionByName(bounds).groupBy("_k", "_t").agg(F.sum("_c").alias("_c"), F.min("_c").alias("_asked"))
    bucket = F.floor(F.unix_micros("_t") / F.lit(bucket_seconds * 1_000_000))
    upto = running_sum(points, ["_k"], [("_t", "asc")], F.col("_c"), "_upto", bucket).where("_asked = 0")
    side = lambda n: upto.select(F.col("_k").alias(f"_k{n}"), F.col("_t").alias(f"_t{n}"), F.col("_upto").alias(f"_n{n}"))
    res = (left.join(side(0), (F.col(key) == F.col("_k0")) & (at(lo) == F.col("_t0")), "left")
           .join(side(1), (F.col(key) == F.col("_k1")) & (at(hi) == F.col("_t1")), "left"))
    n = F.when(whole, F.greatest(F.col("_n1") - F.col("_n0"), F.lit(0))).otherwise(F.lit(0))
    return res.withColumn(out, F.coalesce(n, F.lit(0)).cast("bigint")).drop("_k0", "_t0", "_n0", "_k1", "_t1", "_n1")
