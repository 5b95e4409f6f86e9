"""Sharding, quality rules and language ID against plain Python."""

import random
import zlib
from collections import Counter

import pytest

from paritylake.llm import langid, quality, sharding
from tests.llm.helpers import edge_docs, edge_rows, empty_docs


def jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_matches_the_scalar_form():
    import numpy as np
    rnd = random.Random(1)
    keys = [rnd.randrange(2**64) for _ in range(3000)] + [0, 1, 2**64 - 1]
    for n in (1, 2, 8, 9, 1000):
        assert sharding.jump_buckets(np.array(keys, np.uint64), n).tolist() == [jump(k, n) for k in keys]


def test_shards(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    got = sharding.assign_shards(docs, 8).collect()
    assert len(got) == docs.count()
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert all(r["grown_shard"] in (r["shard"], 8) for r in got)
    text = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    assert all(r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in got)


def test_shards_of_edge_rows(spark):
    got = sharding.assign_shards(edge_docs(spark), 8).collect()
    assert len(got) == len(edge_rows())
    assert len({r["shard"] for r in got if r["doc_id"] is None}) == 1
    assert [r["size"] for r in got if r["doc_id"] == 4] == [1]
    assert sharding.assign_shards(empty_docs(spark), 8).collect() == []


def test_written_shards_hold_every_row(spark, tmp_path):
    df = edge_docs(spark).drop("a.b")
    sharding.write_shards(df, str(tmp_path / "s"), 4, files_per_shard=2)
    assert spark.read.parquet(str(tmp_path / "s")).count() == len(edge_rows())


def base(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit),
            len(words) < 50 or 100 * len(hit) > 50 * len(words))


def dup_share(words, n):
    grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    hit = {i + j for i, g in enumerate(grams) if grams.index(g) < i for j in range(n)}
    return sum(len(words[i]) for i in hit) / max(1, sum(map(len, words)))


def test_quality_matches_brute_force(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet").select("doc_id", "text").collect()
    rules = quality.Rules()
    for text in [r["text"] for r in docs] + [r[1] for r in edge_rows()]:
        got = quality.measure(text)
        assert got[:6] == base(text)
        words = (text or "").split(" ") if text and "\n" not in text else None
        if words and "" not in words and not any(c in text for c in "\t\r\x0b\x0c"):
            assert got[9] == pytest.approx(max([dup_share(words, n) for n in rules.dup], default=0))


def test_repeated_text_is_rejected_and_clean_text_kept():
    rnd = random.Random(3)
    clean = " ".join("".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(200))
    assert quality.measure(clean)[6]
    assert not quality.measure("\n".join([clean[:80]] * 12))[6]
    part = clean[:400]
    assert not quality.measure(part + " sep " + part + " " + clean[400:900])[6]


def test_quality_edges(spark):
    docs = edge_docs(spark)
    got = quality.score(docs).collect()
    assert len(got) == len(edge_rows())
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in got)
    assert quality.keep_good(empty_docs(spark)).collect() == [] == quality.score(empty_docs(spark)).collect()


def test_gram_counts_in_chunks(monkeypatch):
    monkeypatch.setattr(langid, "_CHUNK", 7)
    codes, counts = langid.gram_counts("Abc abd\n\n42 xyz ab")
    assert counts.sum() > 0 and len(codes) == len(set(codes.tolist()))


def test_language_accuracy_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    out = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.97 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_out_of_place_distance_by_hand():
    model = langid.Profiles({"x": langid.most_frequent(*langid.gram_counts("aab"), 300).tolist(),
                             "y": langid.most_frequent(*langid.gram_counts("zzq"), 300).tolist()}, 300)
    assert model.predict("aab") == ("x", 1.0)
    assert model.predict("zzq")[0] == "y"
    assert model.predict("123 !") == ("und", 0.0) == model.predict(None)


def test_language_edges(spark):
    got = langid.identify(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    assert {r["lang_pred"] for r in got if r["doc_id"] in (3, 4, 9)} == {"und"}
    assert langid.identify(empty_docs(spark)).collect() == []
