"""Readers for the driver tables (one parquet file set per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the driver tables as temp views for the SQL-written operators."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
