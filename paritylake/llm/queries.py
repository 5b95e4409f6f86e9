"""Registered queries of the corpus operators: each applies one operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from paritylake.llm import exactdedup, hardneg, langid, linededup, mixing, packing, pii, prefixtrie, quality, sharding, simhash, suffixdedup, topk
from paritylake.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f
    return add


#: Tokenizer file of the packing query, by name in the installed tokenizer package.
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query("op1_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line or come within 1 to 4 edits of one, by length; counts and digest per document."""
    return linededup.summarise(table(spark, sf_dir, "documents"), tau=linededup.EDITS, min_chars=20, short=True)


@_query("op2_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by a 200-byte string that also starts elsewhere."""
    return suffixdedup.remove_repeats(table(spark, sf_dir, "documents"), length=200, with_kept=False)


@_query("op3_jump_shards")
def jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 8 shards by jump consistent hashing of doc_id; grown_shard is the shard of 9."""
    return sharding.assign_shards(table(spark, sf_dir, "documents"), 8)


@_query("op4_topk", topk.ORACLE)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products for every vector whose id is divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


@_query("op5_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by rank-order profiles learned from the documents that are not held out."""
    return langid.identify(table(spark, sf_dir, "documents"))


@_query("op6_repetition")
def repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdict of every document."""
    return quality.score(table(spark, sf_dir, "documents"))


@_query("op7_packing")
def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=1, window=2048, with_ids=False)


@_query("op8_simhash")
def simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints (3-word shingles) and components at 3 differing bits or fewer."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op9_personal_data")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: strict spans and those that confident patterns add."""
    return pii.find(table(spark, sf_dir, "documents")).drop("n_found")


@_query("op10_poisson_mix", mixing.ORACLE)
def poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's copies in a mix of the sources by the square root of their bytes, globally shuffled."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    copies = mixing.replicate(docs, mixing.rates(docs))
    return copies.select("doc.doc_id", "doc.source", "doc.text", "chunk", "copy", "shuffle_key")


@_query("op11_hard_negatives", hardneg.ORACLE)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every vector whose id is divisible by 50."""
    rows = hardneg.integer_rows(table(spark, sf_dir, "embeddings"))
    return hardneg.mine(hardneg.relabelled(rows), every=50, positives=5, negatives=3, least=50, most=95)


@_query("op12_prefix_trie", prefixtrie.ORACLE)
def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefixtrie.conversation_trie(table(spark, sf_dir, "conversations"))


@_query("op13_exact_dedup", exactdedup.ORACLE)
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays of those equal to it after white space runs become one space."""
    return exactdedup.group_copies(table(spark, sf_dir, "documents"))
