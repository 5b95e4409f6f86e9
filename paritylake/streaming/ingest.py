"""Incremental and streaming variants.

* ``incremental_ingest`` (D3, in ``ledger``): batch append of rows above the
  watermark pair of the earlier runs, with a ledger of what was seen.
* ``stream_ingest`` (D4): a file stream deduplicated by key inside a
  watermark (``dropDuplicatesWithinWatermark``), written by an idempotent
  ``foreachBatch`` (one output folder per batch id, overwritten on replay).
  Rows without a key are no duplicates of each other: they pass.
* ``stream_merge`` (D5): each micro-batch appends its changes, reduced to the
  latest per key, to levelled runs under a manifest (``compaction``); the
  snapshot is one merge of the live runs onto the initial table. No batch
  rewrites the table; changes without a key are kept aside and reported.
* ``stream_window_digests`` (D6): per event-time window count and digest of a
  stream (update mode, state bounded by the watermark); the final value of
  each window is its last update. Both sides at once: ``paritywindow``.

A stream's checkpoint lies beside its sink (or where the caller says): a second
call goes on where the first ended. Nothing but per-batch ids passes through
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paritylake.functions.canon import with_row_hash
from paritylake.operators.merge import delta_latest, merge_apply
from paritylake.streaming.compaction import add_batch, live_runs, read_runs
from paritylake.streaming.ledger import incremental_ingest, read_or_empty, sink_rows

__all__ = ["incremental_ingest", "sink_rows", "land_files", "stream_ingest", "stream_merge", "refused_changes", "stream_window_digests"]


# ---------------------------------------------------------------- stream helpers
def land_files(df: DataFrame, path: str, part_col: str) -> None:
    """Land a table as files, one folder per ``part_col`` value: rows are brought together by value first, and a large value is
    split by its size, so neither a folder is one task nor every task writes every folder."""
    df.hint("rebalance", part_col).write.mode("overwrite").partitionBy(part_col).parquet(path)


def _file_stream(spark: SparkSession, landing: str, schema: T.StructType, files_per_batch: int | None, bytes_per_batch: int) -> DataFrame:
    """File source whose batches are bounded by bytes, or by a number of files if the caller gives one."""
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.parquet(landing)


def _run_available_now(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# ---------------------------------------------------------------- D4
def stream_ingest(spark: SparkSession, landing: str, schema: T.StructType, key: str, ts: str,
                  sink: str, watermark: str, checkpoint: str | None = None, files_per_batch: int | None = None,
                  bytes_per_batch: int = 10 * 2**30) -> tuple[DataFrame, DataFrame]:
    """File stream → dedupe by key within the watermark → idempotent sink.

    Returns the sink and the late rows: landed rows of keys that never reached it. Rows with a NULL key are all in the
    sink. Calling it again goes on from the checkpoint (beside the sink by default).
    """
    stream = _file_stream(spark, landing, schema, files_per_batch, bytes_per_batch)
    # event time must be a TIMESTAMP (UTC session); NTZ columns are cast
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    deduped = (timed.where(F.col(key).isNotNull()).withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])
               .unionByName(timed.where(F.col(key).isNull())))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    _run_available_now(deduped.writeStream.foreachBatch(write_batch), checkpoint or f"{sink}-checkpoint")
    kept = spark.read.parquet(sink).select(*schema.fieldNames())
    late = spark.read.schema(schema).parquet(landing).where(F.col(key).isNotNull()).join(kept.select(key), key, "left_anti")
    return kept, late


# ---------------------------------------------------------------- D5
def stream_merge(spark: SparkSession, landing: str, schema: T.StructType, initial: DataFrame,
                 keys: list[str], order: str, base: str, op: str = "op", delete: str = "D", checkpoint: str | None = None,
                 files_per_batch: int | None = None, bytes_per_batch: int = 10 * 2**30) -> DataFrame:
    """Change-file stream → latest change per key → one merge onto ``initial``.

    A micro-batch writes only its own changes, reduced to the latest per key, as a run of level 0; full levels are merged, and
    the manifest of live runs is swapped by one rename. The live runs are merged once, so the result depends neither on how
    files fall into batches nor on the order in which they are picked up, and a call reads a logarithmic number of runs.
    Calling it again with new files goes on from the checkpoint. Changes without a key: ``refused_changes``.
    """
    cols = initial.columns
    changes = fields_of(schema, [*cols, op, order])
    some_key_missing = F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys))
    latest = lambda df: delta_latest(df.select(*changes.fieldNames()), keys, [order])

    def reduce_batch(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*changes.fieldNames())
        rows.where(some_key_missing).write.mode("overwrite").parquet(f"{base}/refused/batch_id={batch_id}")
        add_batch(spark, base, batch_id, rows.where(~some_key_missing), changes, latest)

    stream = _file_stream(spark, landing, schema, files_per_batch, bytes_per_batch)
    _run_available_now(stream.writeStream.foreachBatch(reduce_batch), checkpoint or f"{base}/checkpoint")
    runs = live_runs(spark, base)
    if not runs:
        return initial
    return merge_apply(initial, latest(read_runs(spark, base, changes, runs)), keys, op, delete).select(*cols)


def refused_changes(spark: SparkSession, base: str, schema: T.StructType, keys: list[str], cols: list[str], order: str, op: str = "op") -> DataFrame:
    """Check rows of the changes that a merge refused: those without a key (ERROR with their number, PASS without any)."""
    changes = fields_of(schema, [*cols, op, order])
    rows = read_or_empty(spark, f"{base}/refused", changes)
    n = F.count(F.lit(1))
    return rows.agg(F.lit("stream_merge").alias("pattern"), F.lit("delta:null_keys").alias("target"),
                    F.when(n > 0, "ERROR").otherwise("PASS").alias("status"), F.lit("0").alias("expected"), n.cast("string").alias("actual"))


def fields_of(schema: T.StructType, names: list[str]) -> T.StructType:
    """The named fields of a schema, each once."""
    return T.StructType([schema[n] for n in dict.fromkeys(names)])


# ---------------------------------------------------------------- D6
def stream_window_digests(spark: SparkSession, landing: str, schema: T.StructType, ts: str,
                          cols: list[str], sink: str, watermark: str, window: str = "1 day",
                          checkpoint: str | None = None, files_per_batch: int | None = None,
                          bytes_per_batch: int = 10 * 2**30) -> DataFrame:
    """Per event-time window: (window_start, n, s1) of a stream, as the last
    update of each window (update mode; finalized windows leave the state)."""
    stream = _file_stream(spark, landing, schema, files_per_batch, bytes_per_batch)
    hashed = with_row_hash(stream, cols, keep=[ts]).withColumn(ts, F.col(ts).cast("timestamp"))
    agg = (hashed.withWatermark(ts, watermark).groupBy(F.window(ts, window).alias("w"))
           .agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                F.sum(F.col("h1").cast("decimal(38,0)")).alias("s1")))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.select(F.col("w.start").alias("window_start"), "n", "s1", F.lit(batch_id).alias("batch"))
         .write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}"))

    _run_available_now(agg.writeStream.outputMode("update").foreachBatch(write_batch),
                       checkpoint or f"{sink}-checkpoint")
    out = spark.read.parquet(sink)
    last = out.groupBy("window_start").agg(F.max_by(F.struct("n", "s1"), "batch").alias("r"))
    return last.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "r.n", "r.s1")
