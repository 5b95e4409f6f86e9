"""Levelled change files under a manifest.

Each micro-batch's changes, reduced to the latest per key, are a run of level 0. When a level holds ``FAN`` runs they are
merged (latest per key) into one run of the level above, so a reader meets at most FAN - 1 runs a level, and levels grow
with the logarithm of the batches. Which runs are live stands in a manifest: a new one is written beside the old under a
temporary name and takes effect by one atomic rename. A call that dies before the rename leaves the old snapshot; runs that
no manifest names are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

FAN = 4


class Manifest:
    """The live runs of a folder: ``{"last_batch": ..., "runs": [{"name": ..., "level": ...}]}``, one file a version."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")

    def _fs(self):
        return self._path("_manifest").getFileSystem(self._conf)

    def versions(self) -> list[int]:
        fs, folder = self._fs(), self._path("_manifest")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())

    def read(self) -> tuple[int, dict]:
        """The last version and its content; version 0 is the empty one."""
        found = self.versions()
        if not found:
            return 0, {"last_batch": -1, "runs": []}
        text = self.spark.read.text(f"{self.base}/_manifest/v{found[-1]}", wholetext=True).first()[0]
        return found[-1], json.loads(text)

    def swap(self, version: int, content: dict) -> None:
        """Put ``content`` in force as ``version``; an error if that version is there already (another writer's)."""
        fs, tmp, target = self._fs(), self._path(f"_manifest/_{uuid.uuid4().hex}"), self._path(f"_manifest/v{version}")
        fs.mkdirs(self._path("_manifest"))
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        if fs.exists(target) or not fs.rename(tmp, target):
            raise RuntimeError(f"manifest version {version} of {self.base} was written by someone else")


def live_runs(spark: SparkSession, base: str) -> list[dict]:
    return Manifest(spark, base).read()[1]["runs"]


def read_runs(spark: SparkSession, base: str, schema: T.StructType, runs: list[dict] | None = None) -> DataFrame:
    """All rows of the live runs."""
    runs = live_runs(spark, base) if runs is None else runs
    if not runs:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f"{base}/{r['name']}" for r in runs])


def add_batch(spark: SparkSession, base: str, batch_id: int, changes: DataFrame, schema: T.StructType, latest: Callable[[DataFrame], DataFrame],
              fan: int = FAN) -> None:
    """Add a batch as a run of level 0, merge full levels, and put the new set of runs in force. A replayed batch that is in
    force already changes nothing.

    ``latest``: reduces changes to the latest of each key.
    """
    manifest = Manifest(spark, base)
    version, now = manifest.read()
    if batch_id <= now["last_batch"]:
        return

    def write(df: DataFrame, level: int) -> dict:
        name = f"level={level}/run-{uuid.uuid4().hex[:12]}"
        df.write.parquet(f"{base}/{name}")
        return {"name": name, "level": level}

    runs = [*now["runs"], write(latest(changes), 0)]
    level = 0
    while len(full := [r for r in runs if r["level"] == level]) >= fan:
        merged = write(latest(read_runs(spark, base, schema, full)), level + 1)
        runs = [r for r in runs if r["level"] != level] + [merged]
        level += 1
    manifest.swap(version + 1, {"last_batch": batch_id, "runs": runs})
