"""Removal of byte strings that repeat, by a distributed difference-cover suffix array.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else in the corpus (the same document included) is removed; strings are judged on
the input.

Distribution. A string's key anchor is the least hash among its ``gram``-byte
windows (the leftmost of equals), so equal strings have equal anchors at equal
places. The starts of a document fall into stretches, one for each anchor that
is the key of some start. A stretch with the bytes its strings reach is a unit;
strings of units with different anchors cannot be equal, which divides the
corpus's suffixes over tasks without losing a match. Units with the same bytes
are one unit with a weight. Where an anchor has one unit left, its weight
decides; anchors of several different units go to the suffix sort.

Suffix sort. A task lays its units end to end and builds their suffix array by
the difference cover {1, 2} modulo 3: sort the sampled triples, recurse on their
names until all differ, sort the remaining third by first symbol and the rank
after it, merge. Adjacent suffixes that start a string are then compared over
``length`` bytes: equal neighbours are repeats.

Anchors with very many different units do not go there: a passage with other
text around every copy gives a different unit each time. Their starts become rows
with a 128-bit hash of the string; hashes are counted with partial aggregation,
and those met twice are repeats. Nothing is left to tell apart among the others,
and no task grows with one passage.

Defined cases: null texts are empty; texts below ``length`` bytes lose nothing;
rows with equal texts are separate documents whose strings repeat each other;
equal or null ids do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from paritylake.llm.common import cut, written

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Up to so many rows (one or two longs each, at most 64 MB) a list of keys is broadcast; beyond, it is joined by a shuffle.
_BROADCAST_ROWS = 4_000_000
#: Bytes of units that a task sorts at once; whole anchors only.
_CHUNK = 1 << 21
#: Bytes of a text hashed at once.
_STRIP = 1 << 20
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, _U), np.full(n - 1, _U(b), dtype=_U)])) for b in (_BASE, _INVERSE)]
    return _POWERS[0][:n], _POWERS[1][:n]


def gram_hashes(x: np.ndarray, gram: int) -> np.ndarray:
    """Mixed polynomial hash of each window of ``gram`` bytes."""
    n = len(x)
    up, down = _powers(n)
    sums = np.zeros(n + 1, _U)
    np.cumsum((x.astype(_U) + _U(1)) * up, out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[:n - gram + 1]
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(32))


def _leftmost_least(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value (the leftmost of equals) in each window of ``width``."""
    n = len(h)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, _U)
    padded[:n] = h
    b = padded.reshape(rows, width)
    place = np.arange(rows * width).reshape(rows, width)
    # prefix minima keep the first place of a value, suffix minima the last seen from the right, that is the leftmost
    low = np.minimum.accumulate(b, axis=1)
    new = np.concatenate([np.ones((rows, 1), bool), b[:, 1:] < low[:, :-1]], axis=1)
    low_at = np.maximum.accumulate(np.where(new, place, 0), axis=1).ravel()
    back = b[:, ::-1]
    high = np.minimum.accumulate(back, axis=1)
    new = np.concatenate([np.ones((rows, 1), bool), back[:, 1:] <= high[:, :-1]], axis=1)
    turn = np.maximum.accumulate(np.where(new, np.arange(width)[None, :], 0), axis=1)
    high_at = (place[:, :1] + width - 1 - turn)[:, ::-1].ravel()
    left, right = high_at[:n - width + 1], low_at[width - 1:n]
    return np.where(padded[right] < padded[left], right, left)


def stretches(raw: bytes | memoryview, length: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(anchor hash, first start, number of starts)`` of a text's stretches, strip by strip."""
    starts = len(raw) - length + 1
    x = np.frombuffer(raw, np.uint8)
    for at in range(0, max(0, starts), _STRIP):
        part = x[at:min(len(raw), at + _STRIP + length - 1)]
        h = gram_hashes(part, gram)
        key = _leftmost_least(h, length - gram + 1)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        yield h[key[first]], first + at, np.diff(np.append(first, len(key)))


def _unit_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """``(anchor, unit, doc_id, text_hash, first, n)`` of every stretch of every text."""
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            b, out = whole.slice(at, 256), []
            for row in range(b.num_rows):
                raw = memoryview(b.column(0)[row].as_buffer())
                # a stretch that a strip cuts in two has other bytes than the whole one: equal strings still share the anchor
                for anchor, first, n in stretches(raw, length, gram):
                    unit = np.fromiter((xxhash.xxh64_intdigest(raw[s:s + c + length - 1]) for s, c in zip(first.tolist(), n.tolist())), _U, len(n))
                    out.append((anchor, unit, first, n, np.full(len(n), row)))
            if not out:
                continue
            anchor, unit, first, n, row = map(np.concatenate, zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(unit.view(np.int64)), b.column(1).take(pa.array(row)), b.column(2).take(pa.array(row)),
                 pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["anchor", "unit", "doc_id", "text_hash", "first", "n"])


def _start_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """``(doc_id, text_hash, first, weight, lo, hi)`` of every start of the asked units: ``lo`` and ``hi`` hash its string."""
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            b = whole.slice(at, 64)
            row, first, weight, digests = [], [], [], []
            for i in range(b.num_rows):
                raw = memoryview(b.column(0)[i].as_buffer())
                for u in b.column(3)[i].as_py():
                    places = range(u["first"], u["first"] + u["n"])
                    row += [i] * u["n"]
                    first += places
                    weight += [u["total"]] * u["n"]
                    digests += [xxhash.xxh3_128_digest(raw[p:p + length]) for p in places]
            both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(1).take(take), b.column(2).take(take), pa.array(first, pa.int64()), pa.array(weight, pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())],
                names=["doc_id", "text_hash", "first", "weight", "lo", "hi"])


# ---- suffix array of one task's units -------------------------------------------------------------------------


def _names(*keys: np.ndarray) -> np.ndarray:
    """Ranks from 1 (equal keys equal ranks) of tuples of non-negative keys, the first the most significant."""
    code = keys[0].astype(np.int64)
    for k in keys[1:]:
        span = int(k.max(initial=0)) + 1
        if (int(code.max(initial=0)) + 1) * span >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
        code = code * span + k
    order = np.argsort(code)
    ordered = code[order]
    names = np.empty(len(code), np.int64)
    names[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]]))
    return names


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix array of positive symbols by the difference cover modulo 3."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    t = np.concatenate([s.astype(np.int64), np.zeros(3, np.int64)])
    # a dummy sample at n keeps the two classes apart if n % 3 == 1
    ones, twos = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([ones, twos])
    names = _names(t[sample], t[sample + 1], t[sample + 2])
    if names.max() < len(sample):
        order = suffix_array(names)
    else:
        order = np.empty(len(sample), np.int64)
        order[names - 1] = np.arange(len(sample))
    rank = np.zeros(n + 3, np.int64)
    sa12 = sample[order]
    rank[sa12] = np.arange(1, len(sample) + 1)
    sa12 = sa12[sa12 < n]
    zeros = np.arange(0, n, 3)
    big = len(sample) + 1
    # one key for each comparison, packed or named so that it fits 63 bits
    sa0 = zeros[np.argsort(t[zeros] * big + rank[zeros + 1])]
    one, two = sa12[sa12 % 3 == 1], sa12[sa12 % 3 == 2]
    before1 = np.searchsorted(t[one] * big + rank[one + 1], t[sa0] * big + rank[sa0 + 1])
    both = np.concatenate([sa0, two])
    pair = _names(t[both], t[both + 1]) * big + rank[both + 2]
    before2 = np.searchsorted(pair[len(sa0):], pair[:len(sa0)])
    out = np.full(n, -1, np.int64)
    at = np.arange(len(sa0)) + before1 + before2
    out[at] = sa0
    free = np.ones(n, bool)
    free[at] = False
    out[free] = sa12
    return out


def repeated_starts(text: np.ndarray, is_start: np.ndarray, length: int) -> np.ndarray:
    """Which starts' strings of ``length`` bytes equal a neighbour's in the suffix array."""
    sa = suffix_array(text.astype(np.int64) + 1)
    sa = sa[is_start[sa]]
    same = np.arange(len(sa) - 1)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    eight = np.ascontiguousarray(words).view(_U).ravel()
    steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    for step in steps:
        same = same[eight[sa[same] + step] == eight[sa[same + 1] + step]]
    marked = np.zeros(len(text), bool)
    marked[sa[same]] = True
    marked[sa[same + 1]] = True
    return marked


def _sorted_units(units: pa.Table, length: int) -> pa.RecordBatch:
    """Runs of repeated starts ``(doc_id, text_hash, first, n)`` in units of weight 1."""
    pieces = units.column("bytes").to_pylist()
    raw = b"".join(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.cumsum(sizes)
    begin = ends - sizes
    edge = np.zeros(len(raw) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, ends - length + 1, -1)
    marked = repeated_starts(np.frombuffer(raw, np.uint8), np.cumsum(edge[:-1]) > 0, length)
    step = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    run, stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    # two units' runs are never one: the last length - 1 bytes of a unit start nothing
    which = np.searchsorted(ends, run, side="right")
    one = units.column("weight").to_numpy()[which] == 1
    run, stop, which = run[one], stop[one], which[one]
    first = units.column("first").to_numpy()[which] + run - begin[which]
    keys = units.select(["doc_id", "text_hash"]).take(pa.array(which)).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [*(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in keys.columns), pa.array(first), pa.array(stop - run)],
        names=["doc_id", "text_hash", "first", "n"])


def _chunks(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.Table]:
    """Whole groups of equal ``part`` (rows come sorted by it) of about ``chunk`` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.column("bytes").nbytes
        if size >= chunk:
            whole = pa.Table.from_batches(held)
            part = whole.column("part").to_numpy()
            cut_at = int(np.searchsorted(part, part[-1]))  # the last group may go on
            if cut_at:
                yield whole.slice(0, cut_at)
                rest = whole.slice(cut_at).combine_chunks()
                held, size = rest.to_batches(), rest.column("bytes").nbytes
    if held:
        yield pa.Table.from_batches(held)


def repeats(df: DataFrame, length: int = 200, gram: int = 64, id_col: str = "doc_id", text_col: str = "text", most_units: int = 4096) -> DataFrame:
    """``(doc_id, text_hash, runs)``: for each text with a repeat its runs ``(first, n)`` of repeated starts, in bytes.

    ``most_units``: an anchor with more different units than this is decided start by start.
    """
    docs = df.select(F.col(text_col).cast("binary").alias("text"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"))
    docs = docs.where(F.octet_length("text") >= length)
    keys = docs.select("doc_id", "text_hash").schema
    units = written(docs.mapInArrow(lambda it: _unit_rows(it, length, gram), StructType(
        [*StructType.fromDDL("anchor long, unit long"), *keys, *StructType.fromDDL("first int, n int")])), "units")
    met = cut(units.groupBy("anchor").agg(F.count("*").alias("rows")).where("rows > 1").select("anchor"))
    some = units.join(_small(met), "anchor", "left_semi")
    # the different units, how often each occurs, and one of its places
    kinds = written(some.groupBy("anchor", "unit").agg(
        F.count("*").alias("total"), *(F.first(c).alias(c) for c in ("doc_id", "text_hash", "first", "n"))), "unit-kinds")
    # units that occur twice repeat from end to end
    twice = kinds.where("total > 1").select("anchor", "unit")
    whole = some.join(twice, ["anchor", "unit"], "left_semi").select("doc_id", "text_hash", F.col("first").cast("long").alias("first"), F.col("n").cast("long").alias("n"))
    several = cut(kinds.groupBy("anchor").agg(F.count("*").alias("units"), F.min("total").alias("least"))
                  .where("units > 1 and least = 1").select("anchor", "units"))

    def bodies(anchors: DataFrame) -> DataFrame:
        """The texts with units of these anchors, and those units."""
        asked = cut(kinds.join(_small(anchors.select("anchor")), "anchor").groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).agg(
            F.collect_list(F.struct("anchor", "total", "first", "n")).alias("asked")))
        same_doc = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash"))
        # few documents hold such units: the others go before the texts are shuffled
        return docs.join(_small(asked.select("id", "hash")), same_doc, "left_semi").join(asked, same_doc).select("text", "doc_id", "text_hash", "asked")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                rows: list[tuple] = []
                for i in range(b.num_rows):
                    raw, doc_id, text_hash = (b.column(c)[i].as_py() for c in range(3))
                    for u in b.column(3)[i].as_py():
                        s, n = u["first"], u["n"]
                        rows.append((doc_id, u["anchor"], text_hash, s, u["total"], raw[s:s + n + length - 1]))
                cols = list(zip(*rows)) or [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], b.column(1).type), *(pa.array(c, pa.int64()) for c in cols[1:5]), pa.array(cols[5], pa.binary())],
                    names=["doc_id", "part", "text_hash", "first", "weight", "bytes"])

    fetched = (bodies(several.where(F.col("units") <= most_units)).mapInArrow(fetch, StructType(
        [keys["doc_id"], *StructType.fromDDL("part long, text_hash long, first long, weight long, bytes binary")]))
        .repartition("part").sortWithinPartitions("part"))
    out = StructType([*keys, *StructType.fromDDL("first long, n long")])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, _CHUNK):
            yield _sorted_units(chunk, length)

    within = fetched.mapInArrow(sort, out)
    found = whole.union(within)
    many = several.where(F.col("units") > most_units)
    if not many.isEmpty():
        starts = written(bodies(many).mapInArrow(lambda it: _start_rows(it, length), StructType(
            [*keys, *StructType.fromDDL("first long, weight long, lo long, hi long")])), "starts")
        met = cut(starts.groupBy("lo", "hi").agg(F.count("*").alias("rows")).where("rows > 1").select("lo", "hi"))
        # units of a greater weight are marked as a whole
        found = found.union(starts.where("weight = 1").join(_small(met), ["lo", "hi"], "left_semi").select("doc_id", "text_hash", "first", F.lit(1).cast("long").alias("n")))
    return found.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "n")).alias("runs"))


def _small(keys: DataFrame) -> DataFrame:
    """The list for a join: broadcast if its counted size allows it."""
    return F.broadcast(keys) if keys.count() <= _BROADCAST_ROWS else keys


def _apply(raw: bytes, runs: list[dict] | None, length: int) -> tuple[int, int, bytes]:
    """Removed bytes, maximal removed runs, and what is left."""
    if not runs:
        return 0, 0, raw
    edge = np.zeros(len(raw) + 1, np.int64)
    first = np.fromiter((r["first"] for r in runs), np.int64, len(runs))
    n = np.fromiter((r["n"] for r in runs), np.int64, len(runs))
    np.add.at(edge, first, 1)
    np.add.at(edge, first + n + length - 1, -1)
    gone = np.cumsum(edge[:-1]) > 0
    spans = int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum())
    return int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()


def _with_runs(df: DataFrame, length: int, gram: int, id_col: str, text_col: str) -> DataFrame:
    found = repeats(df, length, gram, id_col, text_col).withColumnsRenamed({"doc_id": "id", "text_hash": "hash"})
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), F.xxhash64(text_col).alias("text_hash"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left").select("doc_id", "text", "runs")


def remove_repeats(df: DataFrame, length: int = 200, gram: int = 64, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = True) -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, the remaining bytes ``kept``."""
    rows = _with_runs(df, length, gram, id_col, text_col)
    schema = rows.select("doc_id").schema.add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
    schema = schema.add("kept", "binary") if with_kept else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, out = b.slice(at, 256), []
                for raw, runs in zip(part.column(1), part.column(2)):
                    raw = raw.as_py()
                    removed, spans, kept = _apply(raw, runs.as_py(), length)
                    out.append((len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
                cols = list(zip(*out))
                arrays = [part.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays + ([pa.array(cols[4], pa.binary())] if with_kept else []), names=schema.names)

    return rows.mapInArrow(run, schema)
