"""Top-k search, packing, mixing and personal data against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from paritylake.llm import mixing, packing, pii, topk
from tests.llm.helpers import edge_docs, edge_rows, empty_docs

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def plain_top(rows, every, k):
    q = {i: [math.floor(256 * x) for x in v] for i, v in rows
         if v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for i in q:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)[:k]
            out |= {(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)}
    return out


def test_top_k_matches_brute_force(spark, sf0001):
    df = spark.read.parquet(f"{sf0001}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert {tuple(r) for r in topk.top_k(df).collect()} == plain_top(rows, 50, 5)


def test_top_k_over_many_blocks_and_edges(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([0.0, 0.5, rnd.gauss(0, 0.2)]) for _ in range(8)]) for i in range(300)]
    rows[20:40] = [(i, rows[0][1]) for i in range(20, 40)]  # ties
    rows += [(300, None), (350, [None] * 8), (400, [float("nan")] * 8), (401, [float("inf")] * 8), (450, []), (451, [0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumnRenamed("none", "block")
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = plain_top([(i, v) for i, v in exact], 50, 5)
    ints = df.where(topk.usable("embedding")).select("vec_id", topk.quantised("embedding").alias("q"))
    index = topk.build_index(ints, block_rows=64, least_rows=64)
    got = topk.search(index, ints.where("vec_id % 50 = 0"), 5, query_rows=2, few=12)
    assert {tuple(r) for r in got.collect()} == want
    assert topk.top_k(df.where("vec_id < 0")).collect() == []
    assert {tuple(r) for r in topk.top_k(df.where("vec_id in (0, 1, 2)")).collect()} == plain_top(exact[:3], 50, 5)


def test_top_k_of_a_query_id_repeated_ten_times(spark):
    rnd = random.Random(4)
    rows = [(i, [float(rnd.randrange(-8, 9)) for _ in range(8)]) for i in range(1, 200)]
    rows += [(0, [20.0] * 8)] * 10 + [(50, [-30.0, 30.0] * 4)] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    q = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    want = []
    for own in (0, 50, 100, 150):
        # every pair of rows, as the oracle's join has them
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for i, v in q if i == own for j, w in q if j != own)[:5]
        want += [(own, r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == want


def test_top_k_of_components_beyond_32_bits(spark):
    rnd = random.Random(7)
    rows = [(i, [rnd.uniform(-1, 1) * 2.0**rnd.choice([0, 5, 22, 24]) for _ in range(4)]) for i in range(1, 120)]
    rows += [(0, [0.25, -0.5, 1.0, 0.0]), (200, [float(2**23), 1.0, -float(2**24), 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ints = df.select("vec_id", topk.quantised("embedding").alias("q"))
    got = topk.search(topk.build_index(ints), ints.where("vec_id in (0, 50)"), 5)
    want = {x for x in plain_top(rows, 50, 5) if x[0] in (0, 50)}
    assert {tuple(r) for r in got.collect()} == want
    huge = df.where("vec_id in (0, 200)").union(spark.createDataFrame([(1, [1e10] * 4), (50, [1e10] * 4)], df.schema))
    try:
        topk.top_k(huge).collect()
    except Exception as e:
        assert "can pass 64 bits" in str(e)
    else:
        raise AssertionError("no error")


def test_search_stops_on_proof_only():
    rng = np.random.default_rng(1)
    import pandas as pd
    x = np.floor(rng.normal(0, 30, (400, 16))).astype(np.int64)
    x[7] *= 8
    rows = []
    impact = np.frexp(np.abs(x).astype(float))[1]
    for level in sorted(set(impact.ravel().tolist()) | {0}, reverse=True):
        r, d = np.nonzero((impact == level) & (x != 0))
        rows.append((0, level, r.astype(np.int32).tobytes(), d.astype(np.int32).tobytes(), x[r, d].astype(np.int32).tobytes(), 400, 16,
                     np.arange(400).tobytes() if level == 0 else b""))
    seg = pd.DataFrame(rows, columns=[c.split(" ")[0] for c in topk._SEGMENT.split(", ")])
    for few in (1, 20, 399):
        got = topk.search_block(seg, np.arange(0, 400, 50), x[::50], 5, few, slice_rows=3)
        for q in range(0, 400, 50):
            s = sorted((-int(x[q] @ x[j]), j) for j in range(400) if j != q)[:5]
            assert [(v, sc) for i, v, sc in got if i == q] == [(j, -v) for v, j in s]


def check_pieces(pieces, want, window=2048):
    """want: multiset of (doc_id, ids). Returns the share of padding."""
    from collections import defaultdict
    seqs, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        seqs[p["sequence_id"]].append((p["offset"], p["length"]))
        docs[p["doc_id"]].append(p)
    total = pad = 0
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at and n > 0
            at += n
        assert at <= window
        total += at
        pad += 0 if at & (at - 1) == 0 else window - at
    assert total == sum(len(i) for _, i in want)
    by_id = defaultdict(list)
    for d, ids in want:
        by_id[d].append(ids)
    assert {d for d in by_id} == set(docs)
    for d, all_ids in by_id.items():
        if len(all_ids) > 1:
            continue
        at = 0
        for p in sorted(docs[d], key=lambda p: p["start"]):
            part = np.array(all_ids[0][at:at + p["length"]], "<u4")
            assert p["start"] == at and p["doc_tokens"] == len(all_ids[0]) and p["ids_crc32"] == zlib.crc32(part.tobytes())
            if "ids" in p:
                assert list(p["ids"]) == part.tolist()
            at += p["length"]
        assert at == len(all_ids[0])
    return pad / max(1, total)


def tokens(texts):
    t = Tokenizer.from_file(TOKENIZER)
    return [e.ids + [1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_word_table_equals_the_tokenizer():
    rnd = random.Random(9)
    odd = ["\x1c", "\x1f", "\x85", "\xa0", " ", "　", "​", " ", "\n", "\t", "\x0b", "\x00", "'s", "don't", "J̌", "İ", "ΑΣ", "Σ.",
           "<|endoftext|>", "a.b,", "é", "é", "12,5", "...", "?!", "\U0001f600", "ﬁ", "ǅ", "中文", "x'll"]
    texts = ["".join(rnd.choice(odd) + rnd.choice(["", " ", "ab"]) for _ in range(30)) for _ in range(300)]
    texts += [r[1] or "" for r in edge_rows()]
    texts += ["".join(map(chr, range(a, a + 64))) for a in (*range(0, 0x3000, 64), *range(0xFB00, 0xFE00, 64), 0x1F600)]
    tok = packing.WordTokenizer(TOKENIZER, pieces=200)
    assert [tok.encode(t).tolist() for t in texts] == [x[:-1] for x in tokens(texts)]


def test_packing(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    rows = docs.collect()
    want = list(zip([r["doc_id"] for r in rows], tokens([r["text"] for r in rows])))
    got = [r.asDict() for r in packing.pack(docs, TOKENIZER).collect()]
    assert check_pieces(got, want) < 0.01
    # the order of the partition is kept
    one = [r.asDict() for r in packing.pack(docs.coalesce(1), TOKENIZER, chunk=1 << 14, with_ids=False).collect()]
    assert check_pieces(one, want) < 0.01
    order = [r["doc_id"] for r in docs.coalesce(1).select("doc_id").collect()]
    seen = [p["doc_id"] for p in sorted(one, key=lambda p: (p["sequence_id"], p["offset"]))]
    assert list(dict.fromkeys(seen)) == order


def test_cuts_are_optimal():
    rnd = random.Random(4)
    for _ in range(60):
        pos = sorted({0, *(rnd.randrange(1, 90) for _ in range(25)), *range(0, 90, 10), 90})
        pen = [0] + [rnd.choice([0, 2, 9]) for _ in pos[1:]]
        window, powers = 16, [8, 4]
        cost = [0] + [math.inf] * (len(pos) - 1)
        for j in range(1, len(pos)):
            for i in range(j):
                n = pos[j] - pos[i]
                if n <= window:
                    free = n == window or n in powers
                    cost[j] = min(cost[j], cost[i] + (0 if free else window - n) + pen[j] + 4)
        cuts = packing.choose_cuts(pos, pen, window, powers, 1000)
        got, last = 0, 0
        for c in cuts:
            n = pos[c] - pos[last]
            assert n <= window
            got += (0 if n == window or n in powers else window - n) + pen[c] + 4
            last = c
        assert got == cost[-1]


def test_packing_edges(spark):
    docs = edge_docs(spark)
    got = [r.asDict() for r in packing.pack(docs.coalesce(1), TOKENIZER, chunk=1 << 12).collect()]
    assert check_pieces(got, list(zip([r[0] for r in edge_rows()], tokens([r[1] for r in edge_rows()])))) < 0.02
    assert packing.pack(empty_docs(spark), TOKENIZER).collect() == []


def uniform(*parts):
    return (int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def test_mixing_matches_plain_inversion(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    r = {x["source"]: x["rate"] for x in mixing.rates(docs).collect()}
    got = {}
    for x in mixing.replicate(docs, mixing.rates(docs)).collect():
        got[x["doc"]["doc_id"]] = got.get(x["doc"]["doc_id"], 0) + 1
    for d in docs.collect():
        u = uniform("42", str(d["doc_id"]), hashlib.md5(d["text"].encode()).hexdigest(), "0")
        n, p = 0, math.exp(-r[d["source"]])
        cum = p
        while cum <= u:
            n += 1
            p *= r[d["source"]] / n
            cum += p
        assert got.get(d["doc_id"], 0) == n


def test_mix_reaches_its_weights(spark):
    df = spark.createDataFrame([(i, f"t{i:06}", "a" if i % 10 else "b") for i in range(20_000)], "doc_id long, text string, source string")
    got = {r["source"]: r["count"] for r in mixing.mix(df, weights={"a": 1, "b": 3}).groupBy("source").count().collect()}
    assert abs(got["a"] - 5000) < 300 and abs(got["b"] - 15000) < 500
    assert {r["source"] for r in mixing.mix(df, weights={"b": 1}).select("source").distinct().collect()} == {"b"}
    one = df.where("doc_id in (1, 10)")
    high = mixing.mix(one, weights={"a": 1, "b": 1}, epochs=500.0).groupBy("source").count().collect()
    assert all(abs(r["count"] - 500) < 120 for r in high)  # rates far over one chunk's


def test_mixing_edges(spark):
    docs = edge_docs(spark)
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    assert got.count() == mixing.mix(docs).count()
    assert {r["source"] for r in mixing.rates(docs).collect()} == {"a", "b", "c", None}
    assert mixing.mix(empty_docs(spark)).collect() == []


def plain_base(text):
    text = text or ""
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]

    def luhn(d):
        t = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return sum(x - 9 if x > 9 else x for x in t) % 10 == 0

    out += [(2, m.start(), m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(re.sub("[^0-9]", "", m.group())) <= 19 and luhn(re.sub("[^0-9]", "", m.group()))]
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_base_spans_match_the_expressions():
    rnd = random.Random(7)
    bits = ["a", "Z", "7", "42", "@", ".", "-", "_", "+", " ", "(", ")", "255", "256", "0", "4111 1111 1111 1111", "x@y.co", "é", "%", "\n", "1.2.3.4", "+1 (555) 010-2345"]
    for _ in range(6000):
        t = "".join(rnd.choice(bits) for _ in range(rnd.randrange(1, 30)))
        assert pii.base_spans(t) == plain_base(t), t
    assert pii.base_spans("1" * 50_000 + "@" + "b" * 50_000 + "." * 50_000) == []
    assert pii.base_spans("@" * 20_000 + "+1" + "(" * 20_000) == []


def test_personal_data_of_the_table(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = pii.KINDS
    for r in pii.find(docs).collect():
        base = plain_base(text[r["doc_id"]])
        joined = ",".join(f"{names[k]}:{s}:{e}" for k, s, e in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{n}"] for n in names] == [sum(b[0] == k for b in base) for k in range(4)]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(filter(None, joined.split(","))) <= set(spans) and len(spans) == len(base) + r["n_found"]
        assert spans == sorted(spans, key=lambda x: (names.index(x.split(":")[0]), int(x.split(":")[1])))


def test_patterns_discover_unseen_identifiers(spark):
    docs = [(i, f"please call me at +1 (555) 010-{1000 + i} today and rest", None) for i in range(12)]
    docs += [(20, "you can call me at 555 010 7788 today or not", None), (21, "a number 555 010 7799 is no phone here", None),
             (22, "write to mail john(at)example.com now", None)]
    docs += [(30 + i, f"send it to mail user{i}@example.com now please", None) for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string, x string")
    got = {r["doc_id"]: r for r in pii.find(df).collect()}
    assert got[20]["spans"] == "phone:19:31" and got[20]["n_found"] == 1 and got[20]["n_phone"] == 0
    assert got[21]["spans"] == "" and got[22]["spans"].startswith("email:14:")
    assert all(got[i]["n_phone"] == 1 and got[i]["n_found"] == 0 for i in range(12))


def test_personal_data_edges(spark):
    got = pii.find(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    assert pii.find(empty_docs(spark)).collect() == []
