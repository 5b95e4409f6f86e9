"""Exact dedup by a tree-merge of sorted digest runs, in native DataFrame functions.

Texts are equal when they are identical after every run of ASCII white space is replaced by one space. A row is known
by the SHA-256 of that form; its byte length and an independent 64-bit hash go with the digest as the check under which
two entries are merged.

Each input partition (slot) turns its rows into a run: one entry per digest with the smallest identifier and the number
of rows, sorted by digest. The runs meet in binomial rounds: in a round the nodes ``f * i .. f * i + f - 1`` hand their
runs to node ``i``, where a sort aggregate merges up to ``f`` entries of a digest, verifies length and hash, and keeps the
smallest identifier. A node's run is spread over tasks by digest, so no task ever holds a whole run, and a digest
never has more than ``f`` entries in a node, however many rows share it. After ceil(log_f(slots)) rounds one run is left.
Its verdicts go back down the same way: to the slots' entries first (one per slot and digest), then from a slot's entry
to the slot's rows, so a text that a third of all rows share is never one join group.

Defined cases: null and missing texts count as empty, and are equal to each other; a text of white space alone is one
space; of rows with equal texts the smallest doc_id stays, null ids last; of rows equal in text and id exactly one stays;
texts of any length are hashed whole; an empty table gives no rows; other columns are neither read nor in the way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paritylake.llm.common import written

#: What identifies a text: the digest, and what has to agree with it before two entries are merged.
_SAME = ["digest", "n_bytes", "hash"]
#: Matches what differs from a single space, so that ordinary word gaps are left alone.
_GAP = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _GAP, " ")


def digested(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """``doc_id, digest, n_bytes, hash, slot, row`` of every row: ``slot`` is the input partition, ``row`` the row's own number.

    ``whole``: the row itself goes along as the struct ``doc``.
    """
    doc = [F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("doc")] if whole else []
    rows = df.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("text"), *doc)
    return rows.select("doc_id", F.sha2("text", 256).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"),
                       F.xxhash64("text").alias("hash"), F.spark_partition_id().alias("slot"), F.monotonically_increasing_id().alias("row"),
                       *(["doc"] if whole else []))


def runs(rows: DataFrame) -> DataFrame:
    """One entry per slot and digest: the smallest identifier and the number of rows."""
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    return rows.groupBy(F.col("slot").alias("node"), *_SAME).agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("group_size"))


def merge_round(entries: DataFrame, fan_in: int) -> DataFrame:
    """``fan_in`` neighbouring nodes hand their runs to one node, which merges them."""
    up = F.floor(F.col("node") / fan_in).cast("int").alias("node")
    return entries.groupBy(up, *_SAME).agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size"))


def tree_merge(entries: DataFrame, n_slots: int, fan_in: int = 8) -> DataFrame:
    """The one run that is left after all rounds: ``digest, n_bytes, hash, best, group_size``."""
    while n_slots > 1:
        entries, n_slots = merge_round(entries, fan_in), -(-n_slots // fan_in)
    return entries.drop("node")


def _final(rows: DataFrame, entries: DataFrame, fan_in: int) -> DataFrame:
    last = rows.agg(F.max("slot")).first()[0]
    return tree_merge(entries, 0 if last is None else last + 1, fan_in)


def group_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row, dropped ones too."""
    rows = written(digested(df, id_col, text_col), "digests")
    entries = runs(rows)
    down = entries.select(F.col("node").alias("slot"), *_SAME).join(_final(rows, entries, fan_in), _SAME)
    return rows.join(down, ["slot", *_SAME]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """The rows that stay, with all their columns."""
    rows = written(digested(df, id_col, text_col, whole=True), "digests")
    stay = _final(rows, runs(rows.drop("doc")), fan_in)
    return rows.join(stay.select(F.col("best.row").alias("row")), "row", "left_semi").select("doc.*")


#: The query's rows in DuckDB.
ORACLE = r"""
WITH texts AS (SELECT doc_id, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, MIN(doc_id) OVER (PARTITION BY t) AS keep_id, COUNT(*) OVER (PARTITION BY t) AS group_size,
       ROW_NUMBER() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM texts
"""
