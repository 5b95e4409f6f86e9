"""Hard-negative mining against plain Python."""

import math
import random

import numpy as np
import pytest

from paritylake.llm import hardneg


def plain_mine(rows, every=50, positives=5, negatives=3):
    """rows: (id, label, integer vector); equal anchor rows are one anchor."""
    width = max((len(q) for _, _, q in rows), default=0)
    rows = [(i, lab, list(q) + [0] * (width - len(q))) for i, lab, q in rows]
    out = []
    for i, lab, q in sorted({(i, lab, tuple(q)) for i, lab, q in rows if i % every == 0}):
        scored = [(sum(a * b for a, b in zip(q, w)), j, m) for j, m, w in rows if j != i]
        for p, j in sorted(((s, j) for s, j, m in scored if m == lab), key=lambda x: (-x[0], x[1]))[:positives]:
            inside = sorted(((s, n) for s, n, m in scored if m != lab and 50 * p <= 100 * s <= 95 * p), key=lambda x: (-x[0], x[1]))
            out += [(i, j, r, n, p, s) for r, (s, n) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def prepared(rows):
    """What takes part of (id, label, vector), with components as the table's floats."""
    ok = [(i, lab, v) for i, lab, v in rows if i is not None and lab is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    return [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lab, v in ok]


def mined(df, **kw):
    return sorted(tuple(r) for r in hardneg.mine(hardneg.relabelled(hardneg.integer_rows(df)), **kw).collect())


def test_whole_table_matches_brute_force(spark, sf0001):
    df = spark.read.parquet(f"{sf0001}/embeddings.parquet")
    want = plain_mine(prepared([(r["vec_id"], r["label"], r["embedding"]) for r in df.collect()]))
    assert want and mined(df) == want


def test_edges_over_many_blocks(spark):
    rnd = random.Random(3)
    centres = [[rnd.gauss(0, 1) for _ in range(70)] for _ in range(4)]
    rows = [(i, i % 3, [c + rnd.gauss(0, 0.4) for c in centres[i % 4]]) for i in range(260)]
    rows[60:75] = [(i, i % 2, rows[0][2]) for i in range(60, 75)]  # ties
    rows += [(300, 1, None), (350, None, rows[0][2]), (None, 1, rows[0][2]), (400, 1, [None] * 70), (450, 1, [float("nan")] * 70),
             (401, 1, [float("inf")] * 70), (500, 1, []), (550, 2, [0.25]), (600, 9, rows[1][2])]
    rows += [rows[0], rows[0], (0, 0, rows[5][2]), (100, rows[100][1], rows[100][2]), rows[7], (7, 1, rows[9][2])]  # repeated ids
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    df = df.selectExpr("*", "1 as q", "'x' as block", "2 as anchor_key", "3 as rank")
    want = plain_mine(prepared(rows))
    assert mined(df) == want
    assert mined(df, block_rows=40, least_rows=40, anchor_rows=2) == want
    assert mined(df.where("vec_id < 0")) == []
    assert mined(df.where("vec_id in (0, 3)")) == plain_mine(prepared([r for r in rows if r[0] in (0, 3)]))


def test_negative_and_zero_scores(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [-1.0, 0.0]), (2, 2, [-0.7, 0.1]), (3, 2, [0.0, 1.0]), (4, 1, [0.0, 2.0]), (50, 5, [3.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert mined(df) == plain_mine(prepared(rows))


def test_intervals_hold_the_scores_and_narrow():
    rng = np.random.default_rng(5)
    for scale, dims in ((1.0, 64), (30.0, 200), (1e6, 3)):
        width = hardneg.padded_width(dims)
        x = np.zeros((300, width), np.int64)
        x[:, :dims] = np.floor(rng.normal(0, scale, (300, dims)))
        codes, along, rest = hardneg.encode(x, 6)
        assert (rest[1:] <= rest[:-1] + 1e-9).all()
        ids = np.arange(300)
        import pandas as pd
        block = hardneg.Block(pd.Series({
            "n_rows": 300, "width": width, "levels": 6, "kind": "int64", "ids": ids.tobytes(), "labels": ids.tobytes(), "codes": codes.tobytes(),
            "along": along.tobytes(), "rest": rest.tobytes(), "norm": np.sqrt((x.astype(float) ** 2).sum(axis=1)).tobytes(), "x": x.tobytes()}))
        widths = []
        for q, anchor in zip(x[:5], hardneg.anchors_of(x[:5], 6)):
            scores = x @ q

            def holds(low, high):
                assert (low <= scores).all() and (scores <= high).all()
                widths.append((high - low).mean())
                return np.ones(len(low), bool)

            assert len(block.survivors(anchor, np.arange(300), holds)) == 300
        assert widths[5] < widths[0] / 5


def test_rotation_keeps_products():
    x = np.random.default_rng(2).normal(size=(20, 128))
    assert np.allclose(hardneg.rotated(x) @ hardneg.rotated(x).T, x @ x.T)


def test_scores_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(0, 1, [1e10] * 4), (50, 1, [1e10] * 4)], "vec_id long, label int, embedding array<double>")
    with pytest.raises(OverflowError):
        mined(df)
