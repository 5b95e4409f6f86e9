"""Corpus preparation: quality rules, line dedup, SimHash near-dedup, mixing to target weights, packing.

Each stage takes the rows its predecessor kept and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paritylake.llm import linededup, mixing, packing, quality, simhash
from paritylake.llm.common import written
from paritylake.llm.queries import tokenizer_path
from paritylake.sources.tables import table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and the repetition rules."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line or come within 1 to 4 edits of one, by length, go, short lines included; ``n_chars``
    follows the text; emptied documents go."""
    out = linededup.dedup(docs, tau=linededup.EDITS, min_chars=20, short=True)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 3 bits)."""
    return simhash.keep_one(docs, shingle=3, distance=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of each document by its source's target rate (square root of the source's bytes), globally shuffled."""
    return mixing.mix(docs, power=0.5, epochs=1.0, seed=42)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens, with their token ids."""
    return packing.pack(docs, tokenizer_path(), end_id=1, window=2048)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("simhash near-dedup", near_dedup),
          ("mixing", mix_sources), ("packing", pack_sequences)]

#: Fingerprints and tokens have no SQL form; the tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
