"""Prefix trie of conversations against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paritylake.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_order(r):
    whole = f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}"
    return (r[1] is not None, r[1] or 0, (r[2] or "").encode(), hashlib.sha256(whole.encode()).hexdigest())


def plain_trie(table):
    convs = defaultdict(list)
    for r in sorted((r for r in table if r[0] is not None), key=lambda r: (r[0], turn_order(r))):
        convs[r[0]].append((r[2] or "", r[3] or ""))
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        of = c - int(np.fmod(c, 100))
        whole[c] = tuple(convs.get(of, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, s in sorted(whole.items()):
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    sums = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        sums[p] = (sum(sums[k][0] for k in kids[p]) if kids[p] else 1, own + sum(sums[k][1] for k in kids[p]))
    return sorted(((m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), *sums[p],
                    hashlib.sha256(",".join(str(c) for c in m if whole[c] == p).encode()).hexdigest()) for p, m in members.items()), key=str)


def trie(df, **kw):
    return sorted((tuple(r) for r in prefixtrie.conversation_trie(df, **kw).collect()), key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_table_matches_brute_force(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet")
    assert trie(df) == plain_trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def edge_table():
    rnd = random.Random(7)
    rows = []
    for c in [*range(-30, 260, 3), 300, 400, 417, 1000]:
        if c % 100 == 0 and c in (100,):
            continue  # a lender that is not there
        same = rnd.random() < 0.5
        for t in range(rnd.choice([1, 2, 3, 5, 9, 23])):
            rows.append((c, t, "user" if t % 2 == 0 else "bot", f"common {t}" if same else rnd.choice(["a", "b", "", None, "été \U0001f600"])))
    rows += [(5, None, None, None), (5, None, "x", "y"), (5, 1, "user", "tie b"), (5, 1, "user", "tie a"), (5, 1, "bot", "tie a"), (5, 1, "bot", "tie a")]
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None), (417, 3, "user", "long " * 100_000)]
    rows += [(700 + c, t, "user", f"deep {t}") for c in (0, 1, 2) for t in range(150)] + [(701, 150, "user", "end")]  # nearly equal long ones
    return rows


def test_edges_with_small_segments_and_parts(spark):
    rows = edge_table()
    want = plain_trie(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as place", "'x' as _gid", "2.5 as depth").repartition(6)
    assert trie(df) == want
    assert trie(df, segment=4, part_turns=16) == want
    assert trie(df, segment=1, part_turns=50) == want


def test_empty_and_turnless(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []
    lone = [c for c in range(201, 240) if zlib.crc32(str(c).encode()) % 6 > 1][:2]
    rows = [(c, 0, "user", "taken off") for c in lone]  # nothing of these is left
    assert trie(spark.createDataFrame(rows, SCHEMA)) == plain_trie(rows)
    assert len(plain_trie(rows)) == 1


def test_double_array_finds_what_it_packed():
    rnd = random.Random(1)
    seqs = {tuple(rnd.randrange(1, 30) for _ in range(rnd.randrange(0, 7))) for _ in range(400)}
    frame = pd.DataFrame([{"seg": 0, "sa": 0, "sb": 0, "n": len(s), "weight": 1 + i % 3, "conv_id": i, "ta": [7 * x for x in s], "tb": [x % 5 for x in s],
                           "la": [hash((k, x)) % 2**60 for k, x in enumerate(s)], "lb": [hash((x, k, 1)) % 2**60 for k, x in enumerate(s)],
                           "chars": list(s)} for i, s in enumerate(sorted(seqs))])
    got = prefixtrie.pack(frame)
    state = np.frombuffer(got["state"], np.int32)
    n_ends = dict(zip(state.tolist(), np.frombuffer(got["n_ends"], np.int64).tolist()))
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    digests = lambda s: [(7 * x, x % 5) for x in s]
    places = {s: prefixtrie.find(got, digests(s)) for s in prefixes}
    assert len(set(places.values())) == len(prefixes) == len(state) and -1 not in places.values()
    assert all(n_ends[places[s]] == (1 + i % 3) for i, s in enumerate(sorted(seqs)))
    assert prefixtrie.find(got, [(1, 1)]) == -1
    assert all(prefixtrie.find(got, digests((*s, 29))) == -1 for s in prefixes if (*s, 29) not in prefixes)
    # the arrays are packed: most places are taken
    assert len(state) > 0.8 * (len(np.frombuffer(got["check"], np.int32)) - 1)


def test_hot_shards_are_split(spark):
    rows = [(c, t, "u", "hello" if t == 0 else f"{c}-{t}") for c in range(300) for t in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert trie(df, part_turns=60) == plain_trie(rows)
    numbered = prefixtrie.turns(df)
    convs, turned = prefixtrie.rebuilt(numbered)
    parts = prefixtrie.with_parts(prefixtrie.sequences(prefixtrie.segments(convs, turned)), 60)
    assert parts.groupBy("part").agg(F.sum("n")).agg(F.max("sum(n)")).first()[0] < 400
