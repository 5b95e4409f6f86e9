"""A session without a configured checkpoint folder."""

import os
import subprocess
import sys

CODE = """
import os, sys
from paritylake.session import checkpoint_dir, clear_scratch, get_spark, materialize, scratch_dir
spark = get_spark("local[2]", shuffle_partitions=2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
d = checkpoint_dir(spark)
assert d == checkpoint_dir(spark)
df = materialize(spark.range(10))
spark.range(5).write.parquet(scratch_dir(spark, "t"))
assert df.count() == 10
files = lambda: sum(len(f) for _, _, f in os.walk(d.removeprefix("file://")))
assert files() > 0
clear_scratch(spark)
assert files() == 0, files()
print("fine")
"""


def test_a_local_session_needs_no_configured_folder_and_leaves_no_files(tmp_path):
    conf = tmp_path / "conf"
    conf.mkdir()
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK")} | {"SPARK_CONF_DIR": str(conf), "PARITYLAKE_DRIVER_MEM": "1g", "TMPDIR": str(tmp_path)}
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", CODE], env=env | {"PYTHONPATH": root}, cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def test_a_join_above_a_union_of_joins_is_dealt_again(spark, sf0001):
    from paritylake.plans.registry import QUERIES
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.unionOutputPartitioning")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as with tables too large for a broadcast
        spark.conf.set("spark.sql.unionOutputPartitioning", "true")    # as Spark 4.1 ships it
        got = {r["stage"]: r["n"] for r in QUERIES["delete_keys_present"](spark, sf0001).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == {"before": 150, "after": 0}


def test_a_scratch_scope_deletes_its_own_folders_only(spark):
    from paritylake import session
    before = session.scratch_dir(spark, "kept")
    spark.range(3).write.parquet(before)
    with session.scratch_scope(spark):
        inside = session.scratch_dir(spark, "staged")
        spark.range(5).write.parquet(inside)
        n = session.materialize(spark.read.parquet(inside))
    assert inside not in session._WRITTEN and before in session._WRITTEN
    assert n.count() == 5 and spark.read.parquet(before).count() == 3
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(inside)
    assert not path.getFileSystem(conf).exists(path)
