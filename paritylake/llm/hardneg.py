"""Hard-negative mining over rotated one-bit codes with stored alignments.

Vectors are rotated (seeded signs and a Walsh-Hadamard transform, three times; lengths and products stay) and coded by
the signs of their components, one bit each. With a code goes its alignment: the length of the vector along the unit
code vector. What the code does not express is the residual, orthogonal to the code vector, whose length is stored too; it
is rotated and coded in turn, for ``levels`` codes in all, each with its own alignment.

An anchor is rotated in the same way and its components are rounded to 8 bits, so that its product with a code
vector is a sum of popcounts, one for each bit plane. Alignment times that product is the estimate of the score;
Cauchy-Schwarz bounds the rest without any chance: the part of the anchor off the code vector times the residual's length,
plus the rounding error times the vector's length. A candidate stays while its interval can still reach the window
and the k-th best score proven so far; after the last code the survivors' integer products decide.

Anchors (a stated set) meet all rows in pairs of bounded blocks: at most 65,536 rows and 4,096 anchors. A block returns its
own best few for each anchor, from which the best of all blocks are taken. Positives are searched first; then the
negatives of each (anchor, positive), inside the window that the positive's score sets.

Defined cases: vectors that are null or hold a null or non-finite component, and rows with a null id or label, take no
part; a component missing in a shorter vector counts as 0; ties go to the smaller id; rows with equal ids are separate
candidates but never their own anchor's; anchor rows equal in id, label and components are one anchor, others with that id
are anchors of their own; an anchor without positives, or a positive without negatives, gives no rows; an empty table
gives none. Products are 64-bit integers; a hundredfold score that can pass 64 bits is an error.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from paritylake.llm.common import written
from paritylake.llm.topk import quantised, usable

_PLANES = 8
_ANCHOR = "anchor_id long, anchor_key long"
_POSITIVE = f"{_ANCHOR}, positive_id long, positive_score long"
_NEGATIVE = f"{_ANCHOR}, positive_rank int, negative_id long, negative_score long"


@functools.cache
def _signs(width: int, turn: int) -> np.ndarray:
    """Signs of one turn of the rotation, the same on every machine."""
    return 1.0 - 2.0 * np.random.Generator(np.random.PCG64(1000 + turn)).integers(0, 2, width)


def rotated(x: np.ndarray, first: int = 0) -> np.ndarray:
    """Rows of ``x`` (a power of two wide), rotated."""
    n, width = x.shape
    for turn in range(first, first + 3):
        x = x * _signs(width, turn)
        step = 1
        while step < width:
            pairs = x.reshape(n, width // (2 * step), 2, step)
            x = np.empty_like(pairs)
            np.add(pairs[:, :, 0], pairs[:, :, 1], out=x[:, :, 0])
            np.subtract(pairs[:, :, 0], pairs[:, :, 1], out=x[:, :, 1])
            step *= 2
        x = x.reshape(n, width) / np.sqrt(width)
    return x


def padded_width(dims: int) -> int:
    """The power of two, 64 at least, that holds ``dims`` components."""
    return max(64, 1 << max(0, dims - 1).bit_length())


def dense(vectors, width: int) -> np.ndarray:
    """Integer vectors as rows of equal width; missing components are 0."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def encode(x: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (levels, rows, words), alignments and residual lengths (levels, rows) of integer vectors."""
    width, codes, along, left = x.shape[1], [], [], []
    rest = x.astype(np.float64)
    for level in range(levels):
        rest = rotated(rest, 3 * level)
        bits = rest >= 0
        a = np.abs(rest).sum(axis=1) / np.sqrt(width)
        rest = rest - np.where(bits, a[:, None], -a[:, None]) / np.sqrt(width)
        codes.append(_packed(bits))
        along.append(a)
        left.append(np.sqrt((rest**2).sum(axis=1)))
    return np.stack(codes), np.stack(along), np.stack(left)


def anchors_of(q: np.ndarray, levels: int) -> list[Anchor]:
    """Anchors of integer vectors, turned and rounded together."""
    turned, out = q.astype(np.float64), [Anchor(x) for x in q]
    for level in range(levels):
        turned = rotated(turned, 3 * level)
        low = turned.min(axis=1, initial=np.inf)
        step = np.maximum((turned.max(axis=1, initial=-np.inf) - low) / (2**_PLANES - 1), 1e-300)
        u = np.clip(np.rint((turned - low[:, None]) / step[:, None]), 0, 2**_PLANES - 1).astype(np.uint8)
        off = np.sqrt(((turned - (low[:, None] + step[:, None] * u)) ** 2).sum(axis=1))
        planes = _packed(np.unpackbits(u[:, :, None], axis=2, bitorder="little").transpose(0, 2, 1).copy())
        totals = u.sum(axis=1, dtype=np.int64)
        for i, anchor in enumerate(out):
            anchor.levels.append((planes[i], float(low[i]), float(step[i]), int(totals[i]), float(off[i])))
    return out


class Anchor:
    """One anchor's integers, and its bit planes and rounding at every level of the codes."""

    def __init__(self, q: np.ndarray):
        self.q, self.norm, self.levels = q, float(np.sqrt((q.astype(np.float64) ** 2).sum())), []

    def along(self, level: int, words: list[np.ndarray], ones: np.ndarray) -> tuple[np.ndarray, float]:
        """The anchor's length along each code vector by popcounts, and the most that rounding can change it.

        ``words``: the codes word by word; ``ones``: how many of a code's bits are set.
        """
        planes, low, step, total, off = self.levels[level]
        width = 64 * len(words)
        hits = np.zeros(len(ones), np.int32)
        for j, plane in enumerate(planes):
            for word, bits in zip(words, plane):
                hits += np.left_shift(np.bitwise_count(word & bits), j, dtype=np.int32)
        return (2.0 * low * ones + 2.0 * step * hits - (low * width + step * total)) / np.sqrt(width), off


class Block:
    """Rows of the index in one block: codes and what proves the bounds, and the integers for the final products."""

    def __init__(self, index: pd.Series):
        n, width, levels = int(index["n_rows"]), int(index["width"]), int(index["levels"])
        as_rows = lambda name, kind: np.frombuffer(index[name], kind)
        self.ids, self.labels = as_rows("ids", np.int64), as_rows("labels", np.int64)
        codes = as_rows("codes", np.uint64).reshape(levels, n, width // 64)
        self.words = [[np.ascontiguousarray(codes[level, :, w]) for w in range(width // 64)] for level in range(levels)]
        self.ones = np.bitwise_count(codes).sum(axis=2, dtype=np.int32)
        self.along, self.left = as_rows("along", np.float64).reshape(levels, n), as_rows("rest", np.float64).reshape(levels, n)
        self.norm, self.x = as_rows("norm", np.float64), as_rows("x", np.dtype(index["kind"])).reshape(n, width)

    def survivors(self, anchor: Anchor, rows: np.ndarray, narrowed) -> np.ndarray:
        """``rows`` that stay after each level's intervals; ``narrowed(low, high)`` says which intervals stay."""
        known, slip = np.zeros(len(rows)), np.zeros(len(rows))
        blur = 1e-9 * anchor.norm * self.norm[rows] + 1e-6  # of the floating-point arithmetic itself
        for level in range(len(self.words)):
            if not len(rows):
                break
            beta, off = anchor.along(level, [w[rows] for w in self.words[level]], self.ones[level, rows])
            a = self.along[level, rows]
            known += a * beta
            slip += a * off  # rounding of the anchor, level by level
            # the residual is orthogonal to its code vector: only the anchor's part off that vector meets it
            beside = np.sqrt(np.maximum(anchor.norm**2 - np.maximum(np.abs(beta) - off, 0.0) ** 2, 0.0))
            width = beside * self.left[level, rows] + slip + blur
            keep = narrowed(known - width, known + width)
            if not keep.all():
                rows, known, slip, blur = rows[keep], known[keep], slip[keep], blur[keep]
        return rows

    def scores(self, anchor: Anchor, rows: np.ndarray) -> np.ndarray:
        return self.x[rows].astype(np.int64) @ anchor.q


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def best_positives(block: Block, anchor_id: int, label: int, anchor: Anchor, k: int) -> list[tuple[int, int]]:
    """The block's first ``k`` rows of the anchor's label: ``(vec_id, score)``."""
    rows = np.flatnonzero((block.labels == label) & (block.ids != anchor_id))
    rows = block.survivors(anchor, rows, lambda low, high: high >= _kth(low, k))
    scores = block.scores(anchor, rows)
    top = _first(block.ids[rows], scores, k)
    return list(zip(block.ids[rows][top].tolist(), scores[top].tolist()))


def best_negatives(block: Block, label: int, anchor: Anchor, wanted: list[tuple[int, int]], least: int, most: int, k: int) -> list[tuple[int, int, int]]:
    """For each ``(rank, positive_score)`` the block's first ``k`` rows of other labels inside the window."""
    windows = [(p * least / 100.0, p * most / 100.0) for _, p in wanted]
    lowest, highest, n = min(a for a, _ in windows) - 1e-6, max(b for _, b in windows) + 1e-6, len(block.ids)

    def narrowed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = (high >= lowest) & (low <= highest)
        if 4 * np.count_nonzero(keep) > n:
            return keep  # the proof by the best few costs more than it saves while the intervals are wide
        at = np.flatnonzero(keep)
        low, high, stays = low[at], high[at], np.zeros(len(at), bool)
        for a, b in windows:
            sure = (low >= a + 1e-6) & (high <= b - 1e-6)
            stays |= (high >= max(a - 1e-6, _kth(low[sure], k))) & (low <= b + 1e-6)
        keep[at] = stays
        return keep

    rows = block.survivors(anchor, np.flatnonzero(block.labels != label), narrowed)
    scores, out = block.scores(anchor, rows), []
    for rank, p in wanted:
        inside = np.flatnonzero((least * p <= 100 * scores) & (100 * scores <= most * p))
        top = inside[_first(block.ids[rows][inside], scores[inside], k)]
        out += [(rank, i, s) for i, s in zip(block.ids[rows][top].tolist(), scores[top].tolist())]
    return out


def build_index(rows: DataFrame, levels: int = 6, block_rows: int = 65_536, least_rows: int = 8192) -> DataFrame:
    """One index row per block of ``(vec_id, label, q)`` rows."""
    n, dims, largest = rows.agg(F.count("*"), F.max(F.size("q")), F.max(F.array_max(F.transform("q", F.abs)))).first()
    width = padded_width(dims or 0)
    if (largest or 0) ** 2 * max(1, dims or 0) * 100 >= 2**63:
        raise OverflowError("a hundredfold inner product of the integer components can pass 64 bits")
    kind = next(k for k, top in (("int16", 2**15), ("int32", 2**31), ("int64", 2**63)) if (largest or 0) < top)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = max(1, -(-n // block_rows), min(tasks, -(-n // least_rows)))
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "q"), F.lit(n_blocks)))

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        x = dense(frame["q"], width)
        codes, along, rest = encode(x, levels)
        return pd.DataFrame([{
            "block": int(key[0]), "n_rows": len(x), "width": width, "levels": levels, "kind": kind,
            "ids": frame["vec_id"].to_numpy(np.int64).tobytes(), "labels": frame["label"].to_numpy(np.int64).tobytes(),
            "codes": codes.tobytes(), "along": along.tobytes(), "rest": rest.tobytes(),
            "norm": np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)).tobytes(), "x": x.astype(kind).tobytes()}])

    return blocked.groupBy("block").applyInPandas(
        build, "block long, n_rows long, width int, levels int, kind string, ids binary, labels binary, codes binary, "
               "along binary, rest binary, norm binary, x binary")


def _against_blocks(index: DataFrame, anchors: DataFrame, anchor_rows: int, search, schema: str) -> DataFrame:
    """Every anchor part against every index block, by cogroup; ``search(block, anchors frame)`` returns rows of ``schema``."""
    n_parts = max(1, -(-anchors.count() // anchor_rows))
    n_blocks = (index.agg(F.max("block")).first()[0] or 0) + 1
    names = [c.split(" ")[0] for c in schema.split(", ")]
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_parts - 1).cast("long"))))
    # the stated anchors, in parts, against every index block
    right = (anchors.withColumn("part", F.pmod("anchor_key", F.lit(n_parts)))
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))))

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        got = []
        if len(rows) and len(asked):
            block = Block(rows.iloc[0])
            levels, width = len(block.words), block.x.shape[1]
            asked = asked.reset_index(drop=True)
            for at in range(0, len(asked), 256):
                some = asked.iloc[at:at + 256]
                for a, anchor in zip(some.itertuples(), anchors_of(dense(some["q"], width), levels)):
                    got += [(a.anchor_id, a.anchor_key, *r) for r in search(block, a, anchor)]
        return pd.DataFrame(got, columns=names).astype(np.int64)

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(run, schema)


def mine(rows: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
         levels: int = 6, anchor_rows: int = 4096, block_rows: int = 65_536, least_rows: int = 8192) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``(vec_id, label, q)`` integer rows.

    A negative's score lies between ``least`` and ``most`` per cent of the positive's.
    """
    index = written(build_index(rows, levels, block_rows, least_rows), "code-index")
    anchors = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("anchor_id"), F.xxhash64("vec_id", "label", "q").alias("anchor_key"), "label", "q").distinct()

    found = _against_blocks(index, anchors, anchor_rows,
                            lambda block, a, anchor: best_positives(block, a.anchor_id, a.label, anchor, positives), _POSITIVE)
    by_anchor = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("positive_score"), "positive_id")
    near = written(found.withColumn("positive_rank", F.row_number().over(by_anchor)).where(F.col("positive_rank") <= positives), "positives")

    asked = near.groupBy("anchor_id", "anchor_key").agg(
        F.sort_array(F.collect_list(F.struct("positive_rank", "positive_score"))).alias("wanted"))  # ``positives`` at most
    asked = anchors.join(asked, ["anchor_id", "anchor_key"]).select(
        "anchor_id", "anchor_key", "label", "q", F.col("wanted.positive_rank").alias("ranks"), F.col("wanted.positive_score").alias("scores"))
    found = _against_blocks(index, asked, anchor_rows,
                            lambda block, a, anchor: best_negatives(block, a.label, anchor, list(zip(map(int, a.ranks), map(int, a.scores))), least, most, negatives),
                            _NEGATIVE)
    by_positive = Window.partitionBy("anchor_id", "anchor_key", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(by_positive)).where(F.col("rank") <= negatives)
    return found.join(near, ["anchor_id", "anchor_key", "positive_rank"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def integer_rows(df: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """``vec_id, label, q`` of the rows that take part."""
    ok = usable(vec_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    return df.where(ok).select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                               quantised(vec_col, scale).alias("q"))


def relabelled(rows: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Rows whose id is divisible by ``every`` move on to the next of ``labels`` labels."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.withColumn("label", moved)


#: The query's rows in DuckDB.
ORACLE = """
WITH ok AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM ok a JOIN ok b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
         ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS n
  FROM scored WHERE same),
ranked AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
         ROW_NUMBER() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
  WHERE p.n <= 5)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
