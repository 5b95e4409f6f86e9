"""Session helpers.

Settings every operator relies on: session time zone UTC (canonical
timestamps and epoch conversions are UTC), ANSI mode as shipped by Spark 4,
AQE on, no partitioning carried through a union. Lineage is cut with ``checkpoint()`` into the shared folder named by
``spark.checkpoint.dir``; a local folder is only chosen when the session has
none configured (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

_CKPT_CONF = "spark.checkpoint.dir"
_UNION_CONF = "spark.sql.unionOutputPartitioning"
_WRITTEN: list[str] = []
_OWN: dict[str, str] = {}
_SCOPE: ContextVar[list | None] = ContextVar("scratch_scope", default=None)


def get_spark(master: str | None = None, app: str = "paritylake",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects."""
    master = master or os.environ.get("PARITYLAKE_MASTER", "local[*]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         # call sites of every column expression: costs more than planning itself where a query has hundreds
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.driver.memory", os.environ.get("PARITYLAKE_DRIVER_MEM", "16g")))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the session settings the canonical forms depend on."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Spark 4.1 takes a union of two joins on one key as dealt by that key and plans a join above it without a shuffle. When AQE
    # then deals one of the branches in another way, the union only strings their partitions together, and that join fails
    if spark.conf.get(_UNION_CONF, None) != "false":
        spark.conf.set(_UNION_CONF, "false")
    checkpoint_dir(spark)
    return spark


def _in_one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder from the session. Only a session in one process (``local[...]``) may do without: it gets
    a private one; on a cluster an unset folder is an error, as executors cannot see each other's disks."""
    sc = spark.sparkContext
    d = sc.getConf().get(_CKPT_CONF, None) or spark.conf.get(_CKPT_CONF, None)
    if not d:
        if not _in_one_process(sc.master):
            raise RuntimeError(f"set {_CKPT_CONF} to a folder that the driver and all executors share")
        # a running session's setting cannot be changed: the folder is kept here
        d = _OWN.setdefault(sc.applicationId, "") or tempfile.mkdtemp(prefix="paritylake-ckpt-")
        _OWN[sc.applicationId] = d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append(path)
    if _SCOPE.get() is not None:
        _SCOPE.get().append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch folders handed out inside the block at its end; what is read later must have been kept by then."""
    token = _SCOPE.set([])
    try:
        yield
    finally:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for own in _SCOPE.get():
            path = jvm.org.apache.hadoop.fs.Path(own)
            path.getFileSystem(conf).delete(path, True)
            _WRITTEN.remove(own)
        _SCOPE.reset(token)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process has handed out and its checkpoints; results read from them must be done with."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    done = 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        done += bool(path.getFileSystem(conf).delete(path, True))
    own = spark.sparkContext.getCheckpointDir()  # Spark's own sub-folder of the shared one, this application's alone
    if own:
        top = jvm.org.apache.hadoop.fs.Path(own)
        fs = top.getFileSystem(conf)
        if fs.exists(top):
            for f in fs.listStatus(top):
                done += bool(fs.delete(f.getPath(), True))
    return done


def materialize(df):
    """Cut lineage: reliable checkpoint into the shared checkpoint folder.

    Used where two branches must see the *same* physical partitioning (range
    partition ids), and to keep recomputation after an executor loss bounded.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
