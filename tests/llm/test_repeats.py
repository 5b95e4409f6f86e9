"""Line dedup and repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from paritylake.llm import linededup, suffixdedup
from tests.llm.helpers import edge_docs, edge_rows, empty_docs


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_line_dedup(docs, tau, min_chars):
    """docs: (id, text) with distinct ids; returns id -> (copies, nears, links, kept)."""
    occ = [(i, n, line) for i, t in sorted(docs) for n, line in enumerate((t or "").split("\n")) if len(line) >= min_chars]
    first = {}
    for i, n, line in occ:
        first.setdefault(line, (i, n))
    kinds = list(first)
    links = Counter()
    near = set()
    for x in range(len(kinds)):
        for y in range(x):
            if abs(len(kinds[x]) - len(kinds[y])) <= tau and edits(kinds[x], kinds[y]) <= tau:
                links[kinds[x]] += 1
                links[kinds[y]] += 1
                near.add(max(kinds[x], kinds[y], key=first.get))
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        copies = [len(s) >= min_chars and first[s] != (i, n) for n, s in enumerate(lines)]
        nears = [len(s) >= min_chars and s in near for s in lines]
        kept = [s for s, c, x in zip(lines, copies, nears) if not (c or x)]
        out[i] = (sum(copies), sum(x and not c for c, x in zip(copies, nears)),
                  sum(links[s] for s in lines if len(s) >= min_chars), "\n".join(kept), len(kept))
    return out


def line_fixture():
    rnd = random.Random(8)
    base = ["".join(rnd.choice("abcdé \U0001f600z") for _ in range(rnd.randrange(18, 40))) for _ in range(25)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randrange(0, 7)):
            s = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 2, 3])):
                at = rnd.randrange(len(s))
                kind = rnd.randrange(3)
                if kind == 0:
                    s[at] = rnd.choice("abcxy")
                elif kind == 1:
                    del s[at]
                else:
                    s.insert(at, rnd.choice("abcxy"))
            lines.append("".join(s))
        docs.append((i, "\n".join(lines)))
    return docs


def test_edit_distance_check_is_exact(spark):
    rnd = random.Random(2)
    pairs = []
    for _ in range(1500):
        a = "".join(rnd.choice("abé") for _ in range(rnd.randrange(0, 9)))
        b = list(a)
        for _ in range(rnd.randrange(4)):
            at = rnd.randrange(len(b) + 1)
            b[at:at + rnd.randrange(2)] = rnd.choice(["", "a", "b", "é"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for tau in (1, 2, 3):
        got = df.select("a", "b", linededup.within(F.col("a"), F.col("b"), tau).alias("w")).collect()
        assert all(r["w"] == (edits(r["a"], r["b"]) <= tau) for r in got)


def test_line_dedup_matches_brute_force(spark):
    docs = line_fixture()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for tau in (1, 2):
        want = plain_line_dedup(docs, tau, 20)
        for r in linededup.summarise(df, tau).collect():
            c, n, links, kept, _ = want[r["doc_id"]]
            assert (r["n_copies"], r["n_near"], r["n_links"]) == (c, n, links)
            assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        got = {r["doc_id"]: r["text"] for r in linededup.dedup(df, tau).collect()}
        assert got == {i: want[i][3] for i, _ in docs if want[i][4]}


def within_edits(a, b, tau):
    """Are the strings within tau edits? Only the band is filled, and a row beyond tau ends it."""
    if abs(len(a) - len(b)) > tau:
        return False
    row = {j: j for j in range(min(tau, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        new = {}
        for j in range(max(0, i - tau), min(len(b), i + tau) + 1):
            new[j] = min(row.get(j, 99) + 1, new.get(j - 1, 99) + 1, row.get(j - 1, 99) + (j == 0 or x != b[j - 1]))
        row = new
        if min(row.values()) > tau:
            return False
    return row[len(b)] <= tau


def plain_steps_dedup(docs, steps, min_chars):
    """id -> (copies, nears, links, kept, kept lines): every line with a letter or digit, edits by the shorter line's length."""
    docs, most = [(i, t or "") for i, t in docs], max(t for _, t in steps)
    part = lambda s: len(s) >= min_chars or any(c.isalnum() for c in s)
    first = {}
    for i, t in sorted(docs):
        for n, s in enumerate(t.split("\n")):
            if part(s):
                first.setdefault(s, (i, n))
    kinds, links, near = list(first), Counter(), set()
    for x, a in enumerate(kinds):
        for b in kinds[:x]:
            if abs(len(a) - len(b)) > most:
                continue
            tau = max((t for least, t in steps if min(len(a), len(b)) >= least), default=0)
            if within_edits(a, b, tau):
                links[a] += 1
                links[b] += 1
                near.add(max(a, b, key=first.get))
    out = {}
    for i, t in docs:
        lines = t.split("\n")
        copies = [part(s) and first[s] != (i, n) for n, s in enumerate(lines)]
        kept = [s for s, c in zip(lines, copies) if not (c or s in near)]
        out[i] = (sum(copies), sum(s in near and not c for s, c in zip(lines, copies)), sum(links[s] for s in lines), "\n".join(kept), len(kept))
    return out


def test_short_lines_and_edits_by_length(spark):
    rnd = random.Random(9)
    steps = ((8, 1), (20, 2), (40, 3), (60, 4))  # near each border, with short lines so that brute force is quick
    base = ["".join(rnd.choice("abcdé z") for _ in range(n)) for n in (4, 7, 8, 9, 12, 19, 20, 21, 22, 39, 40, 42, 59, 60, 61, 64, 70)]
    lines = ["Read more", "阅读全文，分享到朋友圈", "----", "", "Posted 2024-01-15"]
    for s in base:
        for much in (0, 0, 1, 1, 2, 3, 4, 5):
            t = list(s)
            for _ in range(much):
                at = rnd.randrange(len(t))
                t[at:at + rnd.randrange(2)] = rnd.choice(["", "x", "y"])
            lines.append("".join(t))
    docs = [(i, "\n".join(rnd.choices(lines, k=7) + ["Read more", "----"])) for i in range(45)]
    want = plain_steps_dedup(docs, steps, 20)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for r in linededup.summarise(df, steps, short=True).collect():
        c, n, links, kept, _ = want[r["doc_id"]]
        assert (r["n_copies"], r["n_near"], r["n_links"]) == (c, n, links)
        assert r["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_many_near_copies_in_several_tiles(spark, monkeypatch):
    """Every line of a cluster is linked with every other, though a key's lines lie in many tiles; of a chain, the first stays."""
    monkeypatch.setattr(linededup, "_TILE_LINES", 16)
    monkeypatch.setattr(linededup, "_OFTEN", 10)
    base = "".join(random.Random(4).choice("abcdefgh ") for _ in range(110))
    docs = [(i, f"{base[:i]}#{base[i + 1:]}\n{base[:i]}{base[i + 1:]}\nthe same line everywhere") for i in range(60)]
    want = plain_steps_dedup(docs, linededup.EDITS, 20)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = linededup.summarise(df, linededup.EDITS, short=True).collect()
    assert {r["doc_id"]: (r["n_copies"], r["n_near"], r["n_links"]) for r in rows} == {i: w[:3] for i, w in want.items()}
    kept = {r["doc_id"]: r["text"] for r in linededup.dedup(df, linededup.EDITS, short=True).collect()}
    assert kept == {i: w[3] for i, w in want.items() if w[4]}


def edited(rnd, text, much):
    out = list(text)
    for _ in range(much):
        at = rnd.randrange(len(out) + 1)
        out[at:at + rnd.randrange(2)] = rnd.choice(["", "x", "é"])
    return "".join(out)


def test_lines_have_few_keys_and_near_ones_share_one(spark):
    """Lengths around the classes' borders; a line of 4 edits had 49 keys, of 2 edits 12."""
    rnd = random.Random(12)
    pairs = []
    for n in [8, 9, 12, 19, 20, 21, 22, 23, 24, 97, 98, 99, 100, 101, 102, 103, 115, 116, 117, 118, 119, 198, 199, 200, 201, 203, 204, 232, 233, 234, 236, 237, 300] * 4:
        a = "".join(rnd.choice("abcdefé gh") for _ in range(n))
        b = edited(rnd, a, linededup.edits_at(n, linededup.EDITS))
        if len(b) >= 8 and within_edits(a, b, linededup.edits_at(min(len(a), len(b)), linededup.EDITS)):
            pairs.append((a, b))
    lines = spark.createDataFrame([(2 * i + k, 0, s) for i, p in enumerate(pairs) for k, s in enumerate(p)], "h long, g long, line string")
    own, every, rows = {}, {}, Counter()
    for r in linededup.segment_rows(lines, linededup.EDITS).collect():
        rows[r["h"]] += 1
        every.setdefault(r["h"], set()).add(r["key"])
        if r["is_index"]:
            own.setdefault(r["h"], set()).add(r["key"])
    assert len(pairs) > 60
    for i, (a, b) in enumerate(pairs):
        short, long = (2 * i, 2 * i + 1) if len(a) <= len(b) else (2 * i + 1, 2 * i)
        assert own[short] & every[long], (a, b)
    most = {0: 4, 20: 10, 100: 16, 200: 26}
    size = {2 * i + k: len(s) for i, p in enumerate(pairs) for k, s in enumerate(p)}
    assert all(n <= most[max(m for m in most if size[h] >= m)] for h, n in rows.items())
    assert sum(n for h, n in rows.items() if size[h] >= 200) < 20 * sum(m >= 200 for m in size.values())


def test_distance_is_the_same_without_common_ends(spark, monkeypatch):
    rnd = random.Random(13)
    pairs = [("", ""), ("aaaa", "aaaaa"), ("ab" * 30, "ab" * 31), ("é" * 9, "é" * 8 + "è")]
    for _ in range(150):
        a = "".join(rnd.choice("ab" + rnd.choice(["", "é\U0001f600"])) for _ in range(rnd.randrange(1, 70)))
        pairs.append((a, edited(rnd, a, rnd.randrange(4))))
    df = spark.createDataFrame([(a, b, tau) for a, b in pairs for tau in (1, 2)], "a string, b string, tau int").repartition(2).cache()
    for long in (linededup._LONG, 0):  # the second time by the bit-parallel distance alone
        monkeypatch.setattr(linededup, "_LONG", long)
        got = df.select("*", linededup.within_steps(F.col("a"), F.col("b"), F.col("tau"), ((8, 1), (20, 2))).alias("w")).collect()
        assert all(r["w"] == within_edits(r["a"], r["b"], r["tau"]) for r in got)


def test_line_query_takes_short_lines_and_dates_in_long_ones(spark, tmp_path):
    from paritylake.llm.queries import QUERIES
    long = "".join(random.Random(3).choice("abcdefgh ") for _ in range(290))
    spark.createDataFrame([(1, f"Read more\n{long}2024-01-15"), (2, f"Read more\n{long}2023-02-25\n--")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_copies"], r["n_near"]) for r in QUERIES["op1_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {1: (0, 0), 2: (1, 1)}


def test_line_dedup_runs_no_python(spark, sf0001):
    plan = linededup.summarise(spark.read.parquet(f"{sf0001}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_line_dedup_edges(spark):
    docs = edge_docs(spark)
    got = linededup.summarise(docs).collect()
    assert len(got) == len(edge_rows())
    # the copies of the 30 lines: those of the null id come first and stay, with their own last line
    assert {r["n_copies"] for r in got if r["doc_id"] in (1, 2)} == {30}
    out = linededup.dedup(docs)
    assert out.columns == docs.columns
    assert linededup.summarise(empty_docs(spark)).collect() == [] == linededup.dedup(empty_docs(spark)).collect()


def plain_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_array_is_right():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 5, 7, 30, 31, 32, 333):
        for letters in (1, 2, 5):
            x = rng.integers(1, letters + 1, n)
            assert suffixdedup.suffix_array(x).tolist() == sorted(range(n), key=lambda i: x[i:].tolist())


def test_least_places():
    h = np.random.default_rng(2).integers(0, 6, 300).astype(np.uint64)
    for w in (1, 2, 5, 137, 300):
        assert suffixdedup._leftmost_least(h, w).tolist() == [i + int(np.argmin(h[i:i + w])) for i in range(len(h) - w + 1)]


def repeat_fixture():
    rnd = random.Random(6)

    def words(n):
        return " ".join("".join(rnd.choice("abcdefgé") for _ in range(rnd.randrange(2, 9))) for _ in range(n))

    passage, other = words(60), words(45)
    texts = [words(rnd.randrange(5, 120)) for _ in range(25)]
    texts += [words(20) + passage + words(20) for _ in range(6)] + [passage, passage, other, words(9) + other[:230]]
    long = words(150)
    for _ in range(8):
        s = list(long)
        for _ in range(3):
            s[rnd.randrange(len(s))] = rnd.choice("xyz")
        texts.append("".join(s))
    texts += ["a" * 500, "ab" * 300, "a" * 199, "a" * 200, "b" * 200, "", None, texts[0], long[:400] + long[:400]]
    return texts


def test_repeats_match_brute_force(spark, monkeypatch):
    texts = repeat_fixture()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain_repeats(texts, 200)
    for most in (4096, 1):  # 1: every anchor of several units is split by start
        found = suffixdedup.repeats(df, most_units=most)
        monkeypatch.setattr(suffixdedup, "repeats", lambda *a, **k: found)
        got = {r["doc_id"]: tuple(r)[1:5] for r in suffixdedup.remove_repeats(df).collect()}
        monkeypatch.undo()
        assert [got[i] for i in range(len(texts))] == want


def test_copies_of_one_passage_do_not_meet_in_one_task(spark, monkeypatch):
    rnd = random.Random(12)
    noise = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = noise(280)
    texts = [noise(rnd.randrange(40, 90)) + passage + noise(rnd.randrange(40, 90)) for _ in range(60)]
    texts += [noise(300), texts[0], passage[:230] + noise(50), None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    dealt, plain = [], type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, *a: dealt.append(self) or plain(self, *a))
    found = suffixdedup.repeats(df, most_units=20)
    monkeypatch.setattr(suffixdedup, "repeats", lambda *a, **k: found)
    got = {r["doc_id"]: tuple(r)[1:5] for r in suffixdedup.remove_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == plain_repeats(texts, 200)
    # a part must not hold a row for every copy of the passage
    assert len(dealt) == 1 and (dealt[0].groupBy("part").count().agg(F.max("count")).first()[0] or 0) <= 20


def test_repeats_in_small_strips_and_chunks(monkeypatch):
    texts = [t for t in repeat_fixture() if t]
    monkeypatch.setattr(suffixdedup, "_STRIP", 64)
    for t in texts[:12]:
        raw = t.encode()
        parts = list(suffixdedup.stretches(raw, 200, 64))
        assert sum(int(n.sum()) for _, _, n in parts) == max(0, len(raw) - 199)


def test_repeats_edges(spark):
    got = suffixdedup.remove_repeats(edge_docs(spark)).collect()
    assert len(got) == len(edge_rows())
    rows = edge_rows()
    want = Counter(zip([r[0] for r in rows], plain_repeats([r[1] for r in rows], 200)))
    assert Counter((r["doc_id"], tuple(r)[1:5]) for r in got) == want
    assert suffixdedup.remove_repeats(empty_docs(spark)).collect() == []


def test_repeats_on_the_table(spark, sf0001):
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = dict(zip([r["doc_id"] for r in rows], plain_repeats([r["text"] for r in rows], 200)))
    assert {r["doc_id"]: tuple(r)[1:5] for r in suffixdedup.remove_repeats(docs, with_kept=False).collect()} == want
