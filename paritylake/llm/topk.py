"""Exact top-k inner products over an impact-ordered, score-at-a-time index.

Components are quantised to integers. The index cuts the vectors into blocks;
within a block, every component is a posting (dimension, row, value) and the
postings are kept in segments by quantised impact, that is by the power of two
their absolute value reaches. A search adds the segments of a block to all
queries' accumulators in descending impact. After each segment, what a row may
still gain or lose is at most (sum of the query's absolute components) times
(the largest impact not yet processed); a row is a possible member while its
upper bound reaches the k-th best lower bound. Processing ends only when the
possible members of every query are few, which the bounds then prove, or when no
segment is left. Possible members are rescored exactly from their own components.

Blocks and query blocks meet in pairs of bounded size (65,536 rows and 4,096
queries at most, worked off 256 queries at a time); the best k of each block are
merged per query. Large blocks keep the copies few: a block is sent once for each
query block, a query once for each block.

Defined cases: null vectors and vectors with a null or non-finite component take
no part; a component missing in a shorter vector counts as 0; ties go to the
smaller id; rows with equal ids are separate candidates but never their own
query's; fewer candidates than k give fewer rows; an empty table gives none.
Quantised components are longs; an inner product that can pass 64 bits is an error.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from paritylake.llm.common import written

_SEGMENT = "block long, impact int, rows binary, dims binary, vals binary, n_rows int, n_dims int, ids binary"


def usable(vec: str) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    v = F.col(vec)
    return v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def quantised(vec: str, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component, computed as a double."""
    return F.transform(F.col(vec), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def _dense(vectors: pd.Series) -> np.ndarray:
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def build_index(vectors: DataFrame, block_rows: int = 65_536, least_rows: int = 8192) -> DataFrame:
    """Posting segments of ``(vec_id, q)`` rows: one row per block and impact level.

    Blocks have up to ``block_rows`` rows; a small table is cut further, down to ``least_rows``, to occupy the cluster.
    """
    n = vectors.count()
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(1, -(-n // block_rows), min(tasks, -(-n // least_rows)))
    blocked = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "q"), F.lit(n_blocks)))

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id", kind="stable")
        x = _dense(frame["q"])
        rows, dims = np.nonzero(x)
        vals = x[rows, dims]
        impact = np.frexp(np.abs(vals).astype(np.float64))[1]  # 2^(impact - 1) <= |value| < 2^impact
        out = []
        ids = frame["vec_id"].to_numpy(np.int64).tobytes()
        for level in sorted(set(impact.tolist()) | {0}, reverse=True):
            at = np.flatnonzero(impact == level)
            at = at[np.lexsort((rows[at], dims[at]))]
            out.append((int(key[0]), level, rows[at].astype(np.int32).tobytes(), dims[at].astype(np.int32).tobytes(),
                        vals[at].astype(np.int32 if level <= 31 else np.int64).tobytes(), len(x), x.shape[1], ids if level == 0 else b""))
        return pd.DataFrame(out, columns=[c.split(" ")[0] for c in _SEGMENT.split(", ")])

    return blocked.groupBy("block").applyInPandas(build, _SEGMENT)


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    keep = ids != own
    scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return list(zip(ids[order].tolist(), scores[order].tolist()))


def search_block(segments: pd.DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int, few: int, slice_rows: int = 256) -> list[tuple[int, int, int]]:
    """Best ``k`` rows of one block for each query: ``(query_id, vec_id, score)``."""
    segments = segments.sort_values("impact", ascending=False)
    return [x for at in range(0, len(queries), slice_rows)
            for x in _search_slice(segments, query_ids[at:at + slice_rows], queries[at:at + slice_rows], k, few)]


def _search_slice(segments: pd.DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int, few: int) -> list[tuple[int, int, int]]:
    n, width = int(segments["n_rows"].iloc[0]), int(segments["n_dims"].iloc[0])
    ids = np.frombuffer(b"".join(segments["ids"]), np.int64)
    q = np.zeros((len(queries), width), np.int64)
    q[:, :min(width, queries.shape[1])] = queries[:, :width]
    reach = np.abs(q.astype(np.float64)).sum(axis=1)
    acc = np.zeros((len(q), n))
    # a row with the query's own id is no candidate: it must not raise the k-th best bound, however often the id occurs
    acc[np.nonzero(query_ids[:, None] == ids[None, :])] = -np.inf
    whole = np.zeros((n, width), np.int64)
    levels = segments["impact"].tolist()
    # the levels bound the components: 2^level is above each
    most = reach.max(initial=0.0) * 2.0 ** max([*levels, 0])
    if most >= 2.0**63:
        raise OverflowError("an inner product of the quantised components can pass 64 bits")
    exact = most < 2.0**52
    members = [np.arange(n)] * len(q)
    stopped = False
    for place, seg in enumerate(segments.itertuples()):
        rows, dims = np.frombuffer(seg.rows, np.int32), np.frombuffer(seg.dims, np.int32)
        vals = np.frombuffer(seg.vals, np.int32 if len(seg.vals) == len(seg.rows) else np.int64)
        whole[rows, dims] = vals
        if stopped or not len(vals):
            continue  # accumulators are final; the postings are still needed to rescore
        part = np.zeros((n, width))
        part[rows, dims] = vals
        acc += q.astype(np.float64) @ part.T
        rest = reach * max([2.0**level - 1 for level in levels[place + 1:] if level > 0], default=0.0)
        slack = 0.0 if exact else most * 2.0**-40
        if n > k:
            kth = np.partition(acc, n - k, axis=1)[:, n - k] - rest - slack
            members = [np.flatnonzero(a >= t) for a, t in zip(acc, kth - rest - slack)]
            stopped = max(map(len, members)) <= few
    out = []
    for i, qid in enumerate(query_ids.tolist()):
        at = members[i]
        scores = whole[at] @ q[i]
        out += [(qid, v, s) for v, s in _best(scores, ids[at], qid, k)]
    return out


def search(index: DataFrame, queries: DataFrame, k: int = 5, query_rows: int = 4096, few: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score`` from a built index and ``(vec_id, q)`` query rows."""
    n_blocks = max(1, -(-queries.count() // query_rows))
    asked = queries.select("vec_id", "q", F.pmod(F.xxhash64("vec_id", "q"), F.lit(n_blocks)).alias("part"))
    last = index.agg(F.max("block")).first()[0]
    last = 0 if last is None else last
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    # the stated query set, in blocks, against every index block
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))))

    def run(segments: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        if not len(segments) or not len(frame):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)
        frame = frame.sort_values("vec_id", kind="stable")
        got = search_block(segments, frame["vec_id"].to_numpy(np.int64), _dense(frame["q"]), k, few)
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"]).astype(np.int64)

    found = (left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
             .applyInPandas(run, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def top_k(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 50, k: int = 5) -> DataFrame:
    """The ``k`` best other rows for every row whose id is divisible by ``every``."""
    rows = df.where(usable(vec_col) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), quantised(vec_col).alias("q"))
    index = written(build_index(rows), "impact-index")
    return search(index, rows.where(F.col("vec_id") % every == 0), k)


#: The query's rows in DuckDB.
ORACLE = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM ok a JOIN ok b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
