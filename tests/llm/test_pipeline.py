"""The five stages against plain Python, one after the other."""

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from paritylake.llm import linededup, quality
from tests.llm.helpers import edge_docs, empty_docs
from tests.llm.test_repeats import plain_steps_dedup
from tests.llm.test_search_pack_mix import check_pieces
from tests.llm.test_simhash import plain_components, plain_fingerprint

NAMES = ["quality rules", "line dedup", "simhash near-dedup", "mixing", "packing"]


def test_stages_and_registration():
    assert [n for n, _ in C.STAGES] == NAMES
    assert E.queries()["pipeline"] is C.run and "pipeline" not in E.oracle_sql()
    assert {int(k[2:].split("_")[0]) for k in E.queries() if k.startswith("op")} == set(range(1, 14))


@pytest.fixture(scope="module")
def stages(spark, sf0001):
    """Rows after each stage, each stage on its written predecessor."""
    from paritylake.llm.common import written
    docs = spark.read.parquet(f"{sf0001}/documents.parquet")
    out = [docs]
    for name, f in C.STAGES:
        out.append(written(f(spark, out[-1], sf0001), "test-" + name.replace(" ", "-")))
    return out


def by_id(df):
    rows = df.collect()
    return {r["doc_id"]: r for r in rows}


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_quality_stage(stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    assert set(after) == {i for i, r in before.items() if quality.measure(r["text"])[6]}
    assert all(after[i] == before[i] for i in after)


def test_line_stage(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    want = plain_steps_dedup([(i, r["text"]) for i, r in before.items()], linededup.EDITS, 20)
    assert {i: r["text"] for i, r in after.items()} == {i: w[3] for i, w in want.items() if w[4]}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_near_duplicate_stage(stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    ids = sorted(before)
    roots = plain_components([plain_fingerprint(before[i]["text"]) for i in ids])
    assert set(after) == {i for n, i in enumerate(ids) if roots[n] == n}


def test_mixing_and_packing_stages(stages):
    before, mixed, packed = stages[3], stages[4].collect(), [r.asDict() for r in stages[5].collect()]
    assert {r["doc_id"] for r in mixed} <= set(by_id(before))
    ids = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode_batch([r["text"] for r in mixed], add_special_tokens=False)
    assert check_pieces(packed, list(zip([r["doc_id"] for r in mixed], [e.ids + [1] for e in ids]))) < 0.05
    assert all(np.array(p["ids"]).size == p["length"] for p in packed)


def test_stages_take_edge_rows_and_empty_tables(spark, sf0001):
    for docs in (edge_docs(spark), empty_docs(spark)):
        for name, f in C.STAGES:
            out = f(spark, docs, sf0001)
            assert out.count() >= 0
            if name != "packing":
                assert set(docs.columns) <= set(out.columns)
