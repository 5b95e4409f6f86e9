"""Randomised perturbation: localisation returns exactly the perturbed keys."""

from hypothesis import given, settings, strategies as st

from paritylake.operators import parity as P

ROW = st.tuples(st.integers(0, 40), st.one_of(st.none(), st.text(alphabet="ab,-:", max_size=3)),
                st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False)))


@settings(max_examples=6, deadline=None)
@given(rows=st.lists(ROW, min_size=1, max_size=30, unique_by=lambda r: r[0]),
       drop=st.sets(st.integers(0, 40), max_size=5), dup=st.sets(st.integers(0, 40), max_size=5),
       change=st.sets(st.integers(0, 40), max_size=5))
def test_localize_exact(spark, rows, drop, dup, change):
    tgt = []
    want = {}
    for k, s, x in rows:
        if k in drop:
            want[k] = "missing"
            continue
        if k in change:
            s2 = (s or "") + "z"
            tgt.append((k, s2, x))
            want[k] = "changed"
        else:
            tgt.append((k, s, x))
        if k in dup:
            tgt.append(tgt[-1])
            want[k] = "duplicated"
    schema = "k long, s string, x double"
    a = spark.createDataFrame(rows, schema)
    b = spark.createDataFrame(tgt, schema)
    got = {r["k"]: r["kind"] for r in P.localize(a, b, ["k", "s", "x"], "k", 8).collect()}
    assert got == want
