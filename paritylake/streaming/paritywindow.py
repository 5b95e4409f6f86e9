"""Recurring two-sided window parity (D6): one stream over both sides.

Source and target files are one tagged stream. A micro-batch adds its rows' digests per (window, side) to a table of
partial digests; when the watermark (newest event time less the allowed delay, over both sides) passes a window's end,
the window is closed and gets one verdict row from all its partials. Rows of a window that was closed in an earlier
batch go to a side table of late rows, never into a verdict.

Partials, late rows, verdicts and the batch's watermark are written per batch id and replaced on replay, from the files of
the batch and the batches before it alone: a restart between any two steps neither repeats a verdict nor loses one.
Nothing is kept in memory between batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paritylake.functions.canon import with_row_hash
from paritylake.streaming.ingest import _file_stream, _run_available_now
from paritylake.streaming.ledger import read_or_empty

SIDES = ("src", "tgt")
_PARTIAL = "batch_id int, window_start timestamp, side string, n long, s1 decimal(38,0), s2 decimal(38,0)"
_PROGRESS = "batch_id int, watermark timestamp"
VERDICT = ("batch_id int, window_start timestamp, src_n long, src_s1 decimal(38,0), src_s2 decimal(38,0), tgt_n long, tgt_s1 decimal(38,0), "
           "tgt_s2 decimal(38,0), status string")


def _verdicts(partials: DataFrame) -> DataFrame:
    """One row per window: both sides' digests and whether they agree."""
    of = lambda side, c: F.sum(F.when(F.col("side") == side, F.col(c)))
    kinds = {"n": "bigint", "s1": "decimal(38,0)", "s2": "decimal(38,0)"}
    both = partials.groupBy("window_start").agg(*[of(s, c).cast(k).alias(f"{s}_{c}") for s in SIDES for c, k in kinds.items()])
    same = F.expr(" AND ".join(f"src_{c} <=> tgt_{c}" for c in kinds))
    return both.withColumn("status", F.when(same, "PASS").otherwise("FAIL"))


def stream_parity_windows(spark: SparkSession, landings: dict[str, str], schema: T.StructType, ts: str, cols: list[str], sink: str, delay: str,
                          window: str = "1 day", checkpoint: str | None = None, files_per_batch: int | None = None,
                          bytes_per_batch: int = 10 * 2**30) -> tuple[DataFrame, DataFrame]:
    """``(verdicts, late rows)`` of all windows closed so far; ``landings``: the folders of ``src`` and ``tgt``, and of ``beat`` if
    there is one, whose rows move the watermark alone. A second call goes on from the checkpoint."""
    sides = [_file_stream(spark, path, schema, files_per_batch, bytes_per_batch).withColumn("_side", F.lit(side)) for side, path in landings.items()]
    both = sides[0]
    for s in sides[1:]:
        both = both.unionByName(s)
    at = F.col(ts).cast("timestamp")
    late_schema = T.StructType([*schema.fields, T.StructField("_side", T.StringType())])

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        part = f"batch_id={batch_id}"
        before = read_or_empty(spark, f"{sink}/progress", _PROGRESS).where(F.col("batch_id") < batch_id).agg(F.max("watermark")).first()[0]
        closed = F.lit(before).cast("timestamp")
        rows = batch.withColumn("_start", F.window(at, window)["start"]).withColumn("_end", F.window(at, window)["end"]).persist()
        is_late = F.lit(before is not None) & (F.col("_end") <= closed)
        counted = F.col("_side").isin(*SIDES) & F.col("_start").isNotNull()
        rows.where(counted & is_late).select(*late_schema.fieldNames()).write.mode("overwrite").parquet(f"{sink}/late/{part}")
        hashed = with_row_hash(rows.where(counted & ~is_late), cols, keep=["_start", "_side"])
        partial = hashed.groupBy(F.col("_start").alias("window_start"), F.col("_side").alias("side")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(F.col(h).cast("decimal(38,0)")).cast("decimal(38,0)").alias(s) for h, s in (("h1", "s1"), ("h2", "s2"))])
        partial.write.mode("overwrite").parquet(f"{sink}/partials/{part}")
        newest = rows.agg((F.max(at) - F.expr(f"INTERVAL {delay}")).alias("m")).first()[0]
        rows.unpersist()
        after = max((t for t in (before, newest) if t is not None), default=None)
        known = read_or_empty(spark, f"{sink}/partials", _PARTIAL).where(F.col("batch_id") <= batch_id)
        ends = F.col("window_start") + F.expr(f"INTERVAL {window}")
        due = known.where(F.lit(after is not None) & (ends <= F.lit(after).cast("timestamp")) & (F.lit(before is None) | (ends > closed)))
        _verdicts(due).write.mode("overwrite").parquet(f"{sink}/verdicts/{part}")
        spark.createDataFrame([(after,)], "watermark timestamp").coalesce(1).write.mode("overwrite").parquet(f"{sink}/progress/{part}")

    _run_available_now(both.writeStream.foreachBatch(write_batch), checkpoint or f"{sink}-checkpoint")
    return (read_or_empty(spark, f"{sink}/verdicts", VERDICT).drop("batch_id"), read_or_empty(spark, f"{sink}/late", late_schema))
