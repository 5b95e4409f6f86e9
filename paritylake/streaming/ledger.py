"""Incremental ingest with a ledger of keys (D3).

The watermark is the pair (check value, key): rows above it are new, ties at the last check value included. What was
seen is kept in a ledger of (key, check value, digest), cut into slices by the check value, with one digest per slice.
A run compares the digests of the source's rows at or below the watermark with the ledger's, slice by slice, and reads the
ledger only where they differ: rows read of the sink do not grow with the sink. Every row ends in the data or in a named
count of the audit row:

* ``appended``: above the watermark (``data``);
* ``late``: at or below it, never seen;
* ``changed``: seen with this key and check value, but with other content;
* ``no_key`` and ``no_check_value``: nothing to tell them by (these four in ``_aside``, with their reason);
* ``gone``: seen, and now neither there nor above the watermark under its key (``_gone``; complete sources only).

A run owns its folders and its audit row, which is written last: running it again replaces both, and a run without an
audit row counts for nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from paritylake.functions.canon import with_row_hash
from paritylake.operators.windows import bucket_of_order
from paritylake.session import materialize

AUDIT = ("run int, watermark_before string, key_before string, watermark_after string, key_after string, appended long, late long, changed long, "
         "gone long, no_key long, no_check_value long, ledger_rows_read long, status string")
#: Slices that a filter names; more are joined.
NAMED_SLICES = 2_000
_PAIR = ["_k", "_c"]


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The Parquet files of a path; an empty frame if there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def audit_of(spark: SparkSession, sink_path: str) -> DataFrame:
    return read_or_empty(spark, f"{sink_path}/_audit/*", AUDIT)


def sink_rows(spark: SparkSession, sink_path: str, schema: T.StructType) -> DataFrame:
    """All appended rows; an empty frame for a sink without a run."""
    return read_or_empty(spark, f"{sink_path}/data/*", schema)


def _above(check: Column, key: Column, wm_check: Column, wm_key: Column) -> Column:
    return (check > wm_check) | ((check == wm_check) & (key > wm_key))


def _digests(pairs: DataFrame, *groups: str) -> DataFrame:
    return pairs.groupBy(*groups).agg(F.sum("n").cast("bigint").alias("n"), *[F.sum(s).cast("decimal(38,0)").alias(s) for s in ("s1", "s2")])


def _per_pair(rows: DataFrame) -> DataFrame:
    one = rows.select("_slice", *_PAIR, F.lit(1).cast("bigint").alias("n"), *[F.col(h).cast("decimal(38,0)").alias(s) for h, s in (("h1", "s1"), ("h2", "s2"))])
    return _digests(one, "_slice", *_PAIR)


def _in_slices(rows: DataFrame, slices: list[str] | DataFrame) -> DataFrame:
    return rows.where(F.col("_slice").isin(slices)) if isinstance(slices, list) else rows.join(slices, "_slice", "left_semi")


def _named(slices: DataFrame) -> list[str] | DataFrame:
    """A list of slices while they are few."""
    few = [r[0] for r in slices.limit(NAMED_SLICES + 1).collect()]
    return few if len(few) <= NAMED_SLICES else slices


class Ledger:
    """Versions of slices by run; the latest finished run that wrote a slice holds all of it."""

    def __init__(self, spark: SparkSession, path: str, runs: list[int], key: T.DataType, check: T.DataType):
        self.spark, self.path, self.runs = spark, path, runs
        digest = [T.StructField("n", T.LongType()), T.StructField("s1", T.DecimalType(38, 0)), T.StructField("s2", T.DecimalType(38, 0))]
        head = [T.StructField("run", T.IntegerType()), T.StructField("_slice", T.StringType())]
        self.slice_schema = T.StructType(head + digest)
        self.pair_schema = T.StructType(head + [T.StructField("_k", key), T.StructField("_c", check)] + digest)

    def slices(self) -> DataFrame:
        """``run, _slice, n, s1, s2``: each slice's last version."""
        every = read_or_empty(self.spark, f"{self.path}/_slices", self.slice_schema).where(F.col("run").isin(self.runs))
        last = every.groupBy("_slice").agg(F.max_by(F.struct("run", "n", "s1", "s2"), "run").alias("v"))
        return last.select("v.run", "_slice", "v.n", "v.s1", "v.s2")

    def pairs(self, slices: list[str] | DataFrame) -> DataFrame:
        """``_slice, _k, _c, n, s1, s2`` of some slices: partition filters leave the others unread."""
        rows = _in_slices(read_or_empty(self.spark, f"{self.path}/_ledger", self.pair_schema).where(F.col("run").isin(self.runs)), slices)
        return rows.join(self.slices().select("run", "_slice"), ["run", "_slice"], "left_semi").drop("run")

    def write(self, run: int, pairs: DataFrame, touched: DataFrame) -> None:
        """A new version of the touched slices; one that has lost all its pairs gets an empty version."""
        part = f"{self.path}/_ledger/run={run}"
        pairs.hint("rebalance", "_slice").write.mode("overwrite").partitionBy("_slice").parquet(part)  # a busy slice is several tasks
        kept = read_or_empty(self.spark, part, T.StructType([f for f in self.pair_schema if f.name != "run"]))
        zero = F.lit(0).cast("decimal(38,0)")
        (touched.join(_digests(kept, "_slice"), "_slice", "left")
         .select("_slice", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), F.coalesce("s1", zero).alias("s1"), F.coalesce("s2", zero).alias("s2"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_slices/run={run}"))


def incremental_ingest(spark: SparkSession, src: DataFrame, sink_path: str, check_col: str, run_id: int, key: str,
                       complete: bool = True) -> DataFrame:
    """Append the rows above the watermark pair of the earlier runs; returns the run's audit row.

    ``complete``: the source holds all its rows (a snapshot), so rows that are gone show; else it is a feed of some rows.
    """
    kinds = src.schema[check_col].dataType, src.schema[key].dataType
    done = audit_of(spark, sink_path).where(F.col("run") < run_id)
    runs = [r[0] for r in done.select("run").collect()]
    last = done.orderBy(F.desc("run")).select("watermark_after", "key_after").head()
    wm = tuple(last) if last and last[0] is not None else (None, None)
    mark = [F.lit(v).cast("string").cast(k) for v, k in zip(wm, kinds)]
    ledger = Ledger(spark, sink_path, runs, kinds[1], kinds[0])

    whole = src.select(F.struct(*[F.col(f"`{c}`") for c in src.columns]).alias("_row"), F.col(key).alias("_k"), F.col(check_col).alias("_c"))
    told = whole.where("_k IS NOT NULL AND _c IS NOT NULL").withColumn("_slice", F.coalesce(bucket_of_order(whole, "_c").cast("string"), F.lit("-")))
    above = F.lit(True) if wm[0] is None else _above(F.col("_c"), F.col("_k"), *mark)
    new, old = told.where(above), told.where(~above)
    hashed = lambda df: with_row_hash(df.select("_slice", *_PAIR, "_row.*"), src.columns, keep=["_slice", *_PAIR])

    # which slices of what was seen differ from the source: digests only
    seen = ledger.slices()
    mine = _digests(_per_pair(hashed(old)), "_slice")
    if complete:
        both = seen.select("_slice", *[F.col(c).alias(f"_{c}") for c in ("n", "s1", "s2")]).join(mine, "_slice", "full")
        differ = both.where(" OR ".join(f"NOT coalesce({c}, 0) = coalesce(_{c}, 0)" for c in ("n", "s1", "s2"))).select("_slice")
    else:
        differ = mine.select("_slice")
    differ = _named(differ)
    held = ledger.pairs(differ)
    read = held.count()
    here = _per_pair(hashed(_in_slices(old, differ)))
    marked = [c for c in ("n", "s1", "s2")]
    met = held.select("_slice", *_PAIR, *[F.col(c).alias(f"_{c}") for c in marked]).join(here, ["_slice", *_PAIR], "full")
    fate = (F.when(F.col("_n").isNull(), "late").when(F.col("n").isNull(), "gone")
            .when(F.expr(" OR ".join(f"{c} <> _{c}" for c in marked)), "changed"))
    # few rows, read several times
    fates = materialize(met.select("_slice", *_PAIR, fate.alias("fate")).where("fate IS NOT NULL"))
    told_apart = {r["fate"]: r["n"] for r in fates.groupBy("fate").agg(F.count(F.lit(1)).alias("n")).collect()}
    gone = fates.where(F.lit(complete) & (F.col("fate") == "gone")).join(new.select("_k"), "_k", "left_anti").select(*_PAIR)

    # what is set aside: one table, by reason
    part = f"run={run_id}"
    aside = whole.where("_k IS NULL OR _c IS NULL").select("_row.*", F.when(F.col("_c").isNull(), "no_check_value").otherwise("no_key").alias("reason"))
    if told_apart.get("late", 0) + told_apart.get("changed", 0):
        known = fates.where("fate <> 'gone'").select(*_PAIR, F.col("fate").alias("reason"))
        aside = aside.unionByName(_in_slices(old, differ).join(known, _PAIR).select("_row.*", "reason"))
    aside.write.mode("overwrite").parquet(f"{sink_path}/_aside/{part}")
    counts = {r[0]: r[1] for r in spark.read.schema(aside.schema).parquet(f"{sink_path}/_aside/{part}").groupBy("reason").count().collect()}
    if told_apart.get("gone"):
        gone.write.mode("overwrite").parquet(f"{sink_path}/_gone/{part}")
        counts["gone"] = spark.read.schema(gone.schema).parquet(f"{sink_path}/_gone/{part}").count()
    new.select("_row.*").write.mode("overwrite").parquet(f"{sink_path}/data/{part}")
    landed = spark.read.schema(src.schema).parquet(f"{sink_path}/data/{part}").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.struct(F.col(check_col).alias("c"), F.col(key).alias("k"))).alias("m"))
    n, *at = landed.select("n", F.col("m.c").cast("string"), F.col("m.k").cast("string")).first()
    after = tuple(at) if at[0] is not None else wm

    fresh = new.select("_slice").distinct()
    changed_slices = spark.createDataFrame([(s,) for s in differ], "_slice string") if isinstance(differ, list) else differ
    touched = fresh.unionByName(changed_slices).distinct()
    names = _named(touched)
    content = _per_pair(hashed(_in_slices(told, names)))
    if not complete:  # a feed shows some of a slice's rows: the rest stays as the ledger has it
        content = content.unionByName(ledger.pairs(names).join(content.select(*_PAIR), _PAIR, "left_anti").select(*content.columns))
    ledger.write(run_id, content, touched)
    row = (run_id, *wm, *after, n, *[counts.get(c, 0) for c in ("late", "changed", "gone", "no_key", "no_check_value")], read, "SUCCESS")
    spark.createDataFrame([row], AUDIT).coalesce(1).write.mode("overwrite").parquet(f"{sink_path}/_audit/{part}")
    return spark.read.schema(AUDIT).parquet(f"{sink_path}/_audit/{part}")
