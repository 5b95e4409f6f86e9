"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paritylake.session import checkpoint_dir, scratch_dir


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, so that no other column can clash with a name used here."""
    return df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def utf8_crc32(c: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null counts as empty."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet in the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)  # read a few times by the same job: size matters more than time
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint; its files go when the frame is no longer referenced."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
