"""SimHash near-duplicates by anchor-point covering.

A text's fingerprint has 64 bits: bit b is 1 if it is set in over half of the
XXH64 hashes (seed 42) of the text's word shingles.

Linking. If two fingerprints differ in at most d bits, one of their two 32-bit
halves differs in at most t = d // 2 bits. Each half is covered by an anchor
code: the perfect Golay code on 23 bits (every word lies within 3 of exactly one
code word) times all words on the other 9 bits, 2^21 anchors in all. A
half-fingerprint has one home anchor, at most the covering radius 3 away. A
partner within t bits of it is within radius + t of that anchor, where the excess
over the radius on the Golay bits plus the differences on the other bits is at
most t. So every fingerprint is replicated to all such anchors, and each anchor
compares its home fingerprints with everything that reached it: no pair is lost.
About 14 anchors a half for d = 2 or 3, against 2^21 anchors to divide the work.

Only distinct fingerprints are compared. Anchors with very many fingerprints
are cut into tiles, each tile pair being one unit of work; a tile returns a
spanning forest of its links and never all pairs.

Defined cases: null and empty texts have no shingle and fingerprint zero, which
links like any other; a text of fewer words than a shingle is one shingle;
equal rows share a fingerprint and hence a component; a null id counts as no
name (the component's id is the smallest id that is not null).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from paritylake.llm.common import texts, written
from paritylake.llm.components import components

#: Generator polynomial of the binary Golay code of length 23 (a fixed value).
_GOLAY = 0b101011100011
_GOLAY_BITS, _GOLAY_RADIUS = 23, 3
#: Texts are hashed in pieces of this many shingles, so that a very long text needs bounded memory.
_PIECE = 1 << 16


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only; blanks 09-0D and 20
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    ends = (ends[shingle - 1:] if len(words) >= shingle else ends[-1:]).tolist()
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _PIECE):
        h = np.fromiter((digest(line[s:e], seed) for s, e in zip(starts[at:at + _PIECE], ends[at:at + _PIECE])), np.uint64)
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fp)`` of every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["doc_id", "text_hash", "fp"])

    slim = texts(df, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return slim.mapInArrow(run, slim.drop("text").schema.add("fp", "long"))


def _remainders(x: np.ndarray) -> np.ndarray:
    """Syndromes: remainders of 23-bit words by the generator polynomial."""
    x = x.copy()
    for bit in range(_GOLAY_BITS - 1, 10, -1):
        x ^= np.where((x >> bit) & 1, _GOLAY << (bit - 11), 0)
    return x


@lru_cache(maxsize=1)
def _leaders() -> np.ndarray:
    """Error pattern of weight 3 or less for each of the 2048 syndromes."""
    table = np.zeros(1 << 11, np.int64)
    for weight in range(_GOLAY_RADIUS + 1):
        for bits in combinations(range(_GOLAY_BITS), weight):
            e = sum(1 << b for b in bits)
            table[_remainders(np.array([e]))[0]] = e
    return table


@lru_cache(maxsize=4)
def _flips(threshold: int) -> np.ndarray:
    """All words of 32 bits of weight ``threshold`` or less: what a partner may differ by in its half."""
    return np.array([sum(1 << b for b in bits) for w in range(threshold + 1) for bits in combinations(range(32), w)], np.int64)


def home(half: np.ndarray) -> np.ndarray:
    """The one anchor within the covering radius of each 32-bit half (Golay bits low, free bits high)."""
    low = half & ((1 << _GOLAY_BITS) - 1)
    return half ^ _leaders()[_remainders(low)]


def _anchor_rows(batches: Iterator[pa.RecordBatch], threshold: int) -> Iterator[pa.RecordBatch]:
    """``(anchor, fp, is_home)``: the home anchor of each half, and the anchors within the radius plus the threshold
    that are some possible partner's home."""
    for b in batches:
        fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for at in range(0, len(fp), 4096):
            f = fp[at:at + 4096]
            for side in (0, 1):
                half = (f >> (32 * side)) & 0xFFFFFFFF
                reached = home((half[:, None] ^ _flips(threshold)[None, :]).ravel()).reshape(len(f), -1)
                own = reached[:, 0].copy()  # the first flip is none
                rows = np.unique(np.column_stack([np.repeat(np.arange(len(f)), reached.shape[1]), reached.ravel()]), axis=0)
                who, anchor = rows[:, 0], rows[:, 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor | (side << 32)), pa.array(f[who]), pa.array(anchor == own[who])],
                    names=["anchor", "fp", "is_home"])


def _spanning(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Smallest connected index for each of n nodes under the given links."""
    root = np.arange(n)
    while len(left):
        a, b = root[left], root[right]
        live = a != b
        if not live.any():
            break
        left, right, a, b = left[live], right[live], a[live], b[live]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
    return root


def _tile_links(key: np.ndarray, fp: np.ndarray, is_home: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links within equal keys (rows sorted by key): each row is compared with the next, the second next, ..."""
    n = len(key)
    root, at, step = np.arange(n), np.arange(n), 1
    while True:
        at = at[at < n - step]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        near = (np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= distance) & (is_home[at] | is_home[at + step])
        left, right = at[near], at[near] + step
        live = root[left] != root[right]
        if live.any():
            joined = _spanning(root[left[live]], root[right[live]], n)
            root = joined[root]
        step += 1
    moved = np.flatnonzero(root != np.arange(n))
    return fp[moved], fp[root[moved]]


def links(fps: DataFrame, distance: int = 3, tile: int = 2048) -> DataFrame:
    """Spanning links ``(u, v)`` of the graph that joins distinct fingerprints differing in ``distance`` bits or fewer.

    ``fps`` has one long column ``fp`` without repeats. An anchor with over ``tile`` fingerprints is worked off as
    pairs of tiles, so that neither a task nor a row group grows with it.
    """
    t = distance // 2
    rows = fps.select("fp").mapInArrow(lambda it: _anchor_rows(it, t), "anchor long, fp long, is_home boolean")
    hot = (rows.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > tile)
           .select("anchor", F.ceil(F.col("n") / tile).cast("int").alias("tiles")))
    tiled = rows.join(hot, "anchor", "left").withColumn("k", F.coalesce("tiles", F.lit(1)))
    tiled = tiled.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    work = (tiled.withColumn("other", other)
            .select("anchor", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp", "is_home"))
    parts = work.repartition("anchor", "a", "b").sortWithinPartitions("anchor", "a", "b")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def done(whole: pd.DataFrame) -> pd.DataFrame:
            key = whole[["anchor", "a", "b"]].to_numpy()
            first = np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])
            u, v = _tile_links(np.cumsum(first), whole["fp"].to_numpy(), whole["is_home"].to_numpy(), distance)
            return pd.DataFrame({"u": u, "v": v})

        for frame in frames:
            if not len(frame):
                continue
            # whole units of work only: the last one of a frame may go on in the next
            last = (frame[["anchor", "a", "b"]] == frame[["anchor", "a", "b"]].iloc[-1]).all(axis=1).to_numpy()
            if last.all():
                if held and not (held[-1][["anchor", "a", "b"]].iloc[-1] == frame[["anchor", "a", "b"]].iloc[0]).all():
                    yield done(pd.concat(held))
                    held = []
                held.append(frame)
                continue
            yield done(pd.concat([*held, frame[~last]]))
            held = [frame[last]]
        if held:
            yield done(pd.concat(held))

    return parts.mapInPandas(run, "u long, v long").distinct()


def labelled(df: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` for every row; ``component_id`` is the smallest id reachable over links."""
    docs = written(fingerprints(df, shingle, id_col, text_col), "fingerprints")
    by_fp = docs.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(by_fp, distance))
    named = by_fp.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    label = named.select("fp", "root").join(names, "root").select("fp", "root", "component_id")
    return docs.join(label, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(df: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` for every row."""
    return labelled(df, shingle, distance, id_col, text_col).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, shingle: int = 3, distance: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, all columns unchanged: the smallest id, then the smallest text hash, then the
    smallest row hash. Rows with a null id come after all others. Rows equal in every column count as one."""
    found = labelled(df, shingle, distance, id_col, text_col)
    # two plain minima rather than one over a struct: both combine before the shuffle in a hash aggregate
    ids = found.groupBy("root").agg(F.min("doc_id").alias("keep_id"))
    chosen = (found.join(ids, "root").where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
              .groupBy("root").agg(F.first("keep_id").alias("_keep_id"), F.min("text_hash").alias("_keep_text"))
              .select("_keep_id", "_keep_text"))
    doc = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    rows = df.select(doc.alias("_doc"), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text"))
    kept = rows.join(chosen, F.col("_id").eqNullSafe(F.col("_keep_id")) & (F.col("_text") == F.col("_keep_text")), "left_semi")
    return kept.groupBy("_id", "_text").agg(F.min_by("_doc", F.xxhash64("_doc")).alias("_doc")).select("_doc.*")
