"""SimHash fingerprints and anchor linking against brute force."""

import random

import numpy as np
import xxhash

from paritylake.llm import simhash
from paritylake.llm.components import components
from tests.llm.helpers import edge_docs, edge_rows, empty_docs


def plain_fingerprint(text):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((sum(h >> b & 1 for h in hashes) * 2 > len(hashes)) << b for b in range(64))


def plain_components(fps, distance=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def same_groups(a, b):
    return len(set(a)) == len(set(b)) == len(set(zip(a, b)))


def test_golay_code_is_perfect():
    assert len(set(simhash._leaders().tolist())) == 2048
    x = np.random.default_rng(1).integers(0, 1 << 32, 5000)
    h = simhash.home(x)
    assert (np.bitwise_count(x ^ h) <= 3).all()
    assert (simhash.home(h) == h).all()


def test_fingerprints_and_components(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    want = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    ids = sorted(want)
    roots = dict(zip(ids, plain_components([want[i] for i in ids])))
    for r in simhash.near_duplicates(docs).collect():
        assert r["fingerprint"] == f"{want[r['doc_id']]:016x}"
        assert r["component_id"] == ids[roots[r["doc_id"]]]


def test_links_lose_nothing_in_dense_clusters(spark):
    rnd = random.Random(4)
    fps = set()
    for _ in range(12):
        c = rnd.getrandbits(64)
        fps.add(c)
        for _ in range(60):
            x = c
            for _ in range(rnd.randrange(1, 5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    want = plain_components(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for tile in (2048, 16):
        roots = {r["node"]: r["root"] for r in components(simhash.links(df, 3, tile)).collect()}
        assert same_groups([roots.get(x, x) for x in signed], want)


def test_components_of_a_path_and_loops(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert set(got.values()) == {0, 500} and len(got) == 203
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_edges(spark):
    docs = edge_docs(spark)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(edge_rows())
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2, -3)} == {-3}
    zero = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["component_id"] for r in zero} == {3} and len(zero) == 5
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # id 7 names two components, as two texts have it
    assert kept.count() == len({r["component_id"] for r in got}) + 1
    assert simhash.near_duplicates(empty_docs(spark)).collect() == []
    assert simhash.keep_one(empty_docs(spark)).collect() == []


def test_a_long_text_is_hashed_in_pieces(monkeypatch):
    text = " ".join(str(i * 7919 % 1013) for i in range(500))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_PIECE", 64)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)
