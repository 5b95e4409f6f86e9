"""File sources and sinks: format loads with landed-count checks (S1-S4,
V14), partition layouts (S2, S12, S13), CSV leading-row skipping (S3), JSON
export and read-back (S7, S8, V15), staged layouts (S9), synthetic tables
(S10), file manifests (X1) and scanned-bytes measurement (V18a).

Every writer writes into a fresh sub-folder of the shared checkpoint folder
(``scratch_dir``); every reader is a distributed ``spark.read`` — nothing is
collected except per-file or per-format summaries.
"""

from __future__ import annotations

import hashlib
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from paritylake.functions.canon import digest
from paritylake.session import scratch_dir

# fixed values: supported load formats and the CSV layout of staged files
FORMATS = ("json", "csv", "parquet", "orc", "avro")
CSV_SEP = "|"
#: Largest file whose content is read for its digests (a file is one value in a task); larger ones are quarantined as such.
MAX_FILE_BYTES = 512 * 2**20


def by_date(df: DataFrame, *parts: str) -> DataFrame:
    """Rows brought together by partition value before a partitioned write: Spark splits a value's rows over tasks by their size
    and puts small values together, so a task writes few folders and a large folder is written by many."""
    return df.hint("rebalance", *parts)


def write_format(df: DataFrame, fmt: str, path: str, **opts) -> None:
    w = df.write.mode("overwrite")
    for k, v in opts.items():
        w = w.option(k, v)
    w.format(fmt).save(path)


def read_format(spark: SparkSession, fmt: str, path: str, schema=None, **opts) -> DataFrame:
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    for k, v in opts.items():
        r = r.option(k, v)
    return r.load(path)


UNSUPPORTED = "UNSUPPORTED"


def load_formats(spark: SparkSession, df: DataFrame, name: str,
                 formats=FORMATS) -> DataFrame:
    """Write ``df`` once per format, load it back (overwrite), assert the
    landed count equals the source count. A format whose data source is not on
    the class path is UNSUPPORTED here; any other fault is raised."""
    rows = []
    expected = df.count()
    for fmt in formats:
        path = scratch_dir(spark, f"{name}_{fmt}")
        try:
            opts = {"header": "true", "sep": CSV_SEP} if fmt == "csv" else {}
            write_format(df, fmt, path, **opts)
        except AnalysisException as e:
            if "DATA_SOURCE_NOT_FOUND" not in str(e) and "Failed to find data source" not in str(e):
                raise
            rows.append((fmt, expected, None, UNSUPPORTED))
            continue
        back = read_format(spark, fmt, path, schema=df.schema if fmt in ("json", "csv") else None, **opts)
        landed = back.count()
        rows.append((fmt, expected, landed, "PASS" if landed == expected else "FAIL"))
    return spark.createDataFrame(rows, "format string, expected bigint, landed bigint, status string")


def _positions(batches):
    """Line positions of one task's splits, as they are read: lines of a file's first split are numbered from 0."""
    seen: dict[str, int] = {}
    for b in batches:
        files, starts = b.column(1).to_pylist(), b.column(2).to_pylist()
        at = []
        for f, start in zip(files, starts):
            if start == 0:
                at.append(seen.get(f, 0))
                seen[f] = at[-1] + 1
            else:
                at.append(None)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.int64())], names=["value", "_f", "_pos"])


def lines_with_position(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with (_f file path, _pos line position inside the file for
    lines of the file's first split; NULL further on): one scan, each task
    numbering the lines of its own splits. No reader option gives a position."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_start"))
    return lines.mapInArrow(_positions, "value string, _f string, _pos long")


def skip_leading_rows(spark: SparkSession, path: str, n_skip: int, sep: str = CSV_SEP,
                      schema: T.StructType | None = None) -> DataFrame:
    """S3: CSV with ``n_skip`` leading lines per file (no reader option exists
    for N>1): lines at positions < n_skip of each file are dropped before
    parsing with native ``from_csv``."""
    pos = lines_with_position(spark, path)
    body = pos.where(F.col("_pos").isNull() | (F.col("_pos") >= n_skip)).select("value")
    return split_csv(body, schema, sep) if schema is not None else body


def header_drift(spark: SparkSession, path: str, expected: str) -> DataFrame:
    """First line of every file against the expected header → (file_name,
    header, status)."""
    pos = lines_with_position(spark, path).where(F.col("_pos") == 0)
    return pos.select(F.element_at(F.split("_f", "/"), -1).alias("file_name"),
                      F.col("value").alias("header"),
                      F.when(F.col("value") == F.lit(expected), "PASS").otherwise("FAIL").alias("status"))


def split_csv(lines: DataFrame, schema: T.StructType, sep: str = CSV_SEP) -> DataFrame:
    """Parse delimited text lines with native ``from_csv`` (no Python per row)."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return lines.select(F.from_csv("value", ddl, {"sep": sep}).alias("r")).select("r.*")


def write_with_banner(df: DataFrame, path: str, n_files: int, banner: list[str],
                      sep: str = CSV_SEP) -> None:
    """Staged CSV files whose first lines are ``banner`` lines, then a header:
    one file per bucket, ordered inside the file by (line kind, key)."""
    spark = df.sparkSession
    cols = df.columns
    body = df.select(F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(n_files)).alias("_b"),
                     F.lit(2).alias("_kind"),
                     F.to_csv(F.struct(*cols), {"sep": sep}).alias("value"))
    heads = [(b, 0, line) for b in range(n_files) for line in banner]
    heads += [(b, 1, sep.join(cols)) for b in range(n_files)]
    head_df = spark.createDataFrame(heads, "_b int, _kind int, value string")
    allrows = head_df.unionByName(body.select(F.col("_b").cast("int").alias("_b"), "_kind", "value"))
    (allrows.repartition(n_files, "_b").sortWithinPartitions("_b", "_kind").select("_b", "value")
     .write.mode("overwrite").partitionBy("_b").text(path))


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines, overwrite."""
    df.write.mode("overwrite").json(path)


def readback_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every non-blank JSON line under ``path``, with the export schema so
    decimals do not come back as floats. A line that does not parse is an error
    when the rows are read; a line of nulls is a row."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def scan_bytes(df: DataFrame) -> DataFrame:
    """Bytes of the files a scan actually reads — distinct
    ``_metadata.file_path`` → sum of ``file_size``. Honours partition pruning
    because the metadata columns come from the pruned scan itself."""
    m = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s"))
    return m.groupBy("f").agg(F.max("s").alias("s")).agg(
        F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("bytes_scanned"),
        F.count(F.lit(1)).cast("bigint").alias("files"))


def _unpacked_sha256(packed: bytes, piece: int = 2**20) -> str | None:
    """SHA-256 of what a gzip file unpacks to, in pieces; None for what is no whole archive."""
    sha, unpack = hashlib.sha256(), zlib.decompressobj(zlib.MAX_WBITS | 16)
    try:
        for at in range(0, len(packed), piece):
            rest = packed[at:at + piece]
            while rest:
                if unpack.eof:  # members may follow each other
                    unpack = zlib.decompressobj(zlib.MAX_WBITS | 16)
                sha.update(unpack.decompress(rest, 16 * piece))
                rest = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
    except zlib.error:
        return None
    return sha.hexdigest() if unpack.eof else None


def file_digests(spark: SparkSession, path: str, part: str, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """``part, bytes, sha256, plain_sha256`` of every file of the ``part=value`` folders: of the file as it lies there, and of what a gzip
    file holds. Files above ``max_bytes`` have neither: their content is not read."""
    files = spark.read.format("binaryFile").load(path).where(F.col("path").rlike(r"/[^_./][^/]*$"))
    small, large = files.where(F.col("length") <= max_bytes), files.where(F.col("length") > max_bytes)
    def unpack_all(content: pd.Series) -> pd.Series:
        return content.map(_unpacked_sha256, na_action="ignore")

    unpacked = F.pandas_udf(unpack_all, T.StringType())
    plain = F.when(F.col("path").endswith(".gz"), unpacked(F.when(F.col("path").endswith(".gz"), F.col("content"))))
    none = F.lit(None).cast("string")
    of = lambda df, sha, inner: df.select(F.col(part).cast("string").alias(part), F.col("length").alias("bytes"), sha.alias("sha256"), inner.alias("plain_sha256"))
    return of(small, F.sha2("content", 256), plain).unionByName(of(large, none, none))


def intake(spark: SparkSession, path: str, schema: T.StructType, part: str, control: str, manifest: DataFrame,
           digests: DataFrame | None = None, max_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """CSV files of ``part=value`` folders (plain or gzip) against a manifest (part, rows, total) that came with them, and against the
    sender's file digests (part, sha256, plain_sha256).

    Every folder gets one row: PASS, or QUARANTINE with the reason (absent, not in the manifest, rows, total, too large, checksum).
    A damaged archive gives up the lines before its fault, so its counts show it. A file fits if its own digest or that of its
    plain text is among the sender's, and every one of the sender's is met. Totals are compared at the manifest's scale, and in
    full where the delivered values have more places.
    """
    read = (spark.read.schema(schema.add(part, T.StringType())).option("sep", CSV_SEP).option("ignoreCorruptFiles", "true").csv(path))
    landed = read.groupBy(part).agg(F.count(F.lit(1)).alias("got_rows"), F.sum(F.col(control).cast("decimal(38,18)")).alias("got_total"))
    want = manifest.select(F.col(part).cast("string").alias(part), "rows", F.col("total").cast("decimal(38,18)").alias("total"))
    j = want.join(landed, part, "full")
    reason = (F.when(F.col("rows").isNull(), "not in the manifest").when(F.col("got_rows").isNull(), "absent")
              .when(F.col("got_rows") != F.col("rows"), "rows").when(~F.col("got_total").eqNullSafe(F.col("total")), "total"))
    if digests is not None:
        got = file_digests(spark, path, part, max_bytes)
        sent = digests.select(F.col(part).cast("string").alias(part), F.explode(F.array_compact(F.array("sha256", "plain_sha256"))).alias("sha")).distinct()
        # a few rows per file: which of its digests the sender knows
        own = got.withColumn("file", F.monotonically_increasing_id()).select(part, "file", "bytes", F.explode_outer(F.array_compact(F.array("sha256", "plain_sha256"))).alias("sha"))
        known = own.join(sent.withColumn("_sent", F.lit(1)), [part, "sha"], "left").groupBy(part, "file").agg(
            F.max("bytes").alias("bytes"), F.max("_sent").alias("_sent"))
        per_part = known.groupBy(part).agg(F.count_if(F.col("bytes") > max_bytes).alias("_large"),
                                           F.count_if(F.col("_sent").isNull() & (F.col("bytes") <= max_bytes)).alias("_strange"), F.count(F.lit(1)).alias("_files"))
        expected = digests.groupBy(F.col(part).cast("string").alias(part)).agg(F.count(F.lit(1)).alias("_expected"))
        j = j.join(per_part, part, "left").join(expected, part, "left")
        reason = F.coalesce(reason, F.when(F.col("_large") > 0, "too large").when(
            (F.col("_strange") > 0) | ~F.col("_files").eqNullSafe(F.col("_expected")), "checksum"))
    return j.select(part, F.coalesce("rows", F.lit(0)).alias("expected_rows"), F.coalesce("got_rows", F.lit(0)).alias("landed_rows"),
                    F.when(reason.isNull(), "PASS").otherwise("QUARANTINE").alias("status"), reason.alias("reason"))


def damaged_archives(spark: SparkSession, df: DataFrame, path: str, opts: dict) -> None:
    """Files with a gzip name that no gzip reader can open (a test delivery): plain text, renamed."""
    df.write.options(**opts).csv(path)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    for f in fs.listStatus(folder):
        if f.getPath().getName().startswith("part-"):
            fs.rename(f.getPath(), jvm.org.apache.hadoop.fs.Path(f"{f.getPath().toString()}.gz"))


def synth_table(rows: DataFrame, id_col: str, group_col: str) -> DataFrame:
    """Synthetic rows, one for each row of a table, from expressions over its key and a group column. RAND is
    replaced by an md5 of the key so every run (and every engine) produces the same rows."""
    ids = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(group_col).cast("string").alias("segment"))
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("id").cast("string"), "segment")), 1, 8), 16, 10).cast("bigint")
    return ids.select(
        F.col("id"), "segment",
        (F.col("id") % 1_000_000).alias("customer_id"),
        ((h % 100000).cast("decimal(14,2)") / F.lit(100)).cast("decimal(12,2)").alias("amount"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("event_date"),
        F.element_at(F.array(F.lit("web"), F.lit("phone"), F.lit("chat")),
                     (F.col("id") % 3 + 1).cast("int")).alias("channel"))


def stage_layouts(spark: SparkSession, df: DataFrame, date_col: str, name: str) -> DataFrame:
    """The same rows as NDJSON, pipe CSV with header, typed Parquet and
    date-partitioned JSON (one directory per month start date; the partition
    column lives only in the path). Each layout is read back and fingerprinted
    against the source."""
    cols = df.columns
    src = digest(df, cols).select(F.lit("source").alias("layout"), "*")
    out = [src]
    p_json = scratch_dir(spark, f"{name}_ndjson")
    df.write.mode("overwrite").json(p_json)
    out.append(digest(spark.read.schema(df.schema).json(p_json), cols).select(F.lit("ndjson").alias("layout"), "*"))
    p_csv = scratch_dir(spark, f"{name}_csv")
    df.write.mode("overwrite").option("header", "true").option("sep", CSV_SEP).csv(p_csv)
    back = spark.read.schema(df.schema).option("header", "true").option("sep", CSV_SEP).csv(p_csv)
    out.append(digest(back, cols).select(F.lit("csv").alias("layout"), "*"))
    p_pq = scratch_dir(spark, f"{name}_parquet")
    df.write.mode("overwrite").parquet(p_pq)
    out.append(digest(spark.read.parquet(p_pq), cols).select(F.lit("parquet").alias("layout"), "*"))
    p_part = scratch_dir(spark, f"{name}_json_by_date")
    by_date(df.withColumn("_part_date", F.trunc(F.to_date(F.col(date_col)), "month")), "_part_date").write.mode("overwrite") \
        .partitionBy("_part_date").json(p_part)
    back = spark.read.schema(df.schema.add("_part_date", T.DateType())).json(p_part)
    out.append(digest(back.select(*cols), cols).select(F.lit("json_by_date").alias("layout"), "*"))
    u = out[0]
    for o in out[1:]:
        u = u.unionByName(o)
    return u
