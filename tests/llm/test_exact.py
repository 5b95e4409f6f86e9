"""Exact dedup against plain Python."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from paritylake.llm import exactdedup
from paritylake.llm.common import written
from tests.llm.helpers import edge_docs, edge_rows, empty_docs


def plain_groups(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, ids[0], len(ids), n == 0, sha) for n, i in enumerate(ids)]
    return sorted(out, key=str)


def got(df, **kw):
    return sorted((tuple(r) for r in exactdedup.group_copies(df, **kw).collect()), key=str)


def test_whole_table_matches_brute_force(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    assert got(docs) == plain_groups([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_edge_rows_and_empty_table(spark):
    df = edge_docs(spark).repartition(7)
    want = plain_groups([r[:2] for r in edge_rows()])
    assert got(df) == want
    assert got(df, fan_in=2) == want
    assert got(empty_docs(spark)) == []
    stay = exactdedup.dedup(df)
    assert stay.columns == df.columns
    assert sorted((str(r["doc_id"]) for r in stay.collect())) == sorted(str(i) for i, _, _, k, _ in want if k)
    assert exactdedup.dedup(empty_docs(spark)).collect() == []


def test_gaps_of_every_kind_are_one_space(spark):
    texts = ["a b", "a  b", "a\tb", "a \n b", "a\x0b\x0c\r b", " a b", "\ta b", "a b ", "a b\n\n", "a b", "a\x1cb", "ab", "", None, " ", "\n", "A b"]
    docs = [(100 - i, t) for i, t in enumerate(texts)]
    assert got(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)) == plain_groups(docs)


def test_rounds_merge_few_entries_and_keep_the_smallest(spark):
    # one text in two thirds of the rows, over 27 slots: no node meets more than fan_in entries of it
    docs = [(1000 - i, "common  text" if i % 3 else f"text {i}") for i in range(900)]
    rows = written(exactdedup.digested(spark.createDataFrame(docs, "doc_id long, text string").repartition(27)), "rounds")
    level, n = exactdedup.runs(rows), 27
    while n > 1:
        met = level.groupBy(F.floor(F.col("node") / 3), "digest").count().agg(F.max("count")).first()[0]
        assert met <= 3
        level, n = exactdedup.merge_round(level, 3), -(-n // 3)
    common = level.orderBy(F.desc("group_size")).first()
    assert (common["group_size"], common["best"]["doc_id"]) == (600, 101)
    assert level.count() == 301


def test_plan_is_native(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    plan = exactdedup.group_copies(docs)._jdf.queryExecution().toString()
    assert "SortAggregate" in plan and "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
