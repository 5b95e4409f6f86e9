"""Prefix trie of conversations over double arrays.

Conversations are ordered, rebuilt (see ``rebuilt``) and cut into segments of ``SEGMENT`` turns, so that a conversation of any
length is rows of bounded size. A prefix is known everywhere by its depth and two 64-bit lanes: the exclusive-or of
hashes of (place, turn) over its turns, which segments of one conversation can add up apart. Equal segments after equal
prefixes are one sequence with a weight before anything is gathered.

Sequences go to shards by prefix: what stands before the segment, and its first turn. A shard with more than
``PART_TURNS`` turns is split by its sequences' hash, small ones share a part, so a part is of bounded size. Each part numbers
its turns densely and packs its sequences into a double array: the child of state s by turn id c is t = BASE[s] + c where
CHECK[t] = s. Walking the sequences over the arrays gives the part's nodes with members and smallest conversation. Nodes
that several parts share (the upper ones, above all) are merged globally by prefix; one part owns each, so that what is
summed over subtrees counts it once. Subtree sums are taken within parts from the deepest state up, merged globally for
shared nodes, and passed from the segments' tries to the ones above by pointer doubling.

Defined cases: rows with a null conversation id take no part; null role or text is empty; turns sort nulls first, rows with
equal turn numbers by role, then by the hash of their text; repeated rows are turns of their own; texts of any length
count whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from paritylake.llm.common import cut, written
from paritylake.operators.splitters import range_groups

#: Turns of a segment; turns (and sequences) of a part; conversation ids in one piece of a node's list.
SEGMENT, PART_TURNS, PIECE = 256, 65_536, 1_024
_BROADCAST_SHARDS = 100_000
_NODE = ["depth", "a", "b"]

_TRIE = ("part long, base binary, check binary, turn_a binary, turn_b binary, state binary, parent binary, root binary, depth binary, "
         "a binary, b binary, n_convs binary, n_ends binary, conv_id binary, chars binary")
_KINDS = {"state": np.int32, "parent": np.int32, "root": np.int32, "depth": np.int64, "a": np.int64, "b": np.int64,
          "n_convs": np.int64, "n_ends": np.int64, "conv_id": np.int64, "chars": np.int64}


def _halves(text: Column) -> tuple[Column, Column]:
    """Two 60-bit numbers of the SHA-256 of a text."""
    sha = F.sha2(text, 256)
    return tuple(F.conv(F.substring(sha, at, 15), 16, 10).cast("long") for at in (1, 16))


def turns(df: DataFrame) -> DataFrame:
    """``conv_id, place`` (from 0) ``, ta, tb`` (the turn's digest) ``, chars`` of every turn, by groups of equally many rows.

    The text itself is left behind here.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    ta, tb = _halves(whole)
    slim = df.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"),
                                                  ta.alias("ta"), tb.alias("tb"), F.length(text).cast("long").alias("chars"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("ta"), F.col("tb")]
    grouped = range_groups(slim, [F.col("conv_id"), *order])
    local = F.row_number().over(Window.partitionBy("_gid", "conv_id").orderBy(*order)) - 1
    sizes = grouped.groupBy("_gid", "conv_id").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_gid").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_gid", "conv_id", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    return grouped.withColumn("_local", local).join(shifts, ["_gid", "conv_id"]).select(
        "conv_id", (F.col("_shift") + F.col("_local")).alias("place"), "ta", "tb", "chars", "_gid")


def rebuilt(numbered: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: ``(conversations, rows)``; rows are ``conv_id, place, ta, tb, chars``.

    Conversation c starts with the first h turns of conversation c - c % ``group`` (h: CRC-32 of its decimal id, modulo
    ``most``) and goes on with its own turns after its first h.
    """
    own_sizes = numbered.groupBy("_gid", "conv_id").agg(F.count("*").alias("_n"))
    convs = own_sizes.groupBy("conv_id").agg(F.sum("_n").alias("n_turns"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).withColumn(
        "of", F.col("conv_id") - F.col("conv_id") % group)
    lent = convs.where(F.col("conv_id") == F.col("of")).select(F.col("of"), F.col("n_turns").alias("_there"))
    convs = convs.join(lent, "of", "left").select(
        "conv_id", "of", "h", "n_turns", F.least("h", F.coalesce("_there", F.lit(0))).alias("lent"))

    # one row per (group, conversation) tells a group's rows where they go, so a long conversation is no single join group
    moves = own_sizes.select("_gid", "conv_id").join(convs, "conv_id").select("_gid", "conv_id", "h", (F.col("lent") - F.col("h")).alias("_move"))
    own = numbered.join(moves, ["_gid", "conv_id"]).where("place >= h").select(
        "conv_id", (F.col("place") + F.col("_move")).alias("place"), "ta", "tb", "chars")
    firsts = numbered.where((F.col("place") < most) & (F.col("conv_id") % group == 0)).select(
        F.col("conv_id").alias("of"), "place", "ta", "tb", "chars")
    taken = convs.where("lent > 0").join(firsts, "of").where("place < h").select("conv_id", "place", "ta", "tb", "chars")
    return convs.select("conv_id"), own.unionByName(taken)


def segments(convs: DataFrame, rows: DataFrame, length: int = SEGMENT) -> DataFrame:
    """``conv_id, seg, sa, sb`` (the prefix before the segment) ``, xa, xb`` (of the segment) ``, n`` and the turns as arrays."""
    hashed = rows.select(
        "conv_id", "place", "ta", "tb", "chars", F.floor(F.col("place") / length).alias("seg"),
        F.xxhash64("place", "ta", "tb").alias("la"), F.xxhash64(F.lit("b"), "tb", "ta", "place").alias("lb"))
    # a segment has ``length`` turns at most
    cuts = hashed.groupBy("conv_id", "seg").agg(
        F.sort_array(F.collect_list(F.struct("place", "ta", "tb", "la", "lb", "chars"))).alias("t"),
        F.bit_xor("la").alias("xa"), F.bit_xor("lb").alias("xb"), F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    cuts = cuts.select("conv_id", "seg", *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(s) for x, s in (("xa", "sa"), ("xb", "sb"))],
                       "xa", "xb", "n", *[F.col(f"t.{c}").alias(c) for c in ("ta", "tb", "la", "lb", "chars")])
    zero, none = F.lit(0).cast("long"), F.array().cast("array<long>")
    bare = convs.join(cuts.where("seg = 0").select("conv_id"), "conv_id", "left_anti").select(
        "conv_id", zero.alias("seg"), *[zero.alias(c) for c in ("sa", "sb", "xa", "xb", "n")], *[none.alias(c) for c in ("ta", "tb", "la", "lb", "chars")])
    return cuts.unionByName(bare)


def sequences(segs: DataFrame) -> DataFrame:
    """Equal segments after equal prefixes as one row: ``weight`` conversations, the smallest of them, and those that end here."""
    names = ["ta", "tb", "la", "lb", "chars"]
    seqs = segs.groupBy("seg", "sa", "sb", "xa", "xb", "n").agg(
        F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"), F.first(F.struct(*names)).alias("t"))
    return seqs.select("seg", "sa", "sb", "xa", "xb", "n", "weight", "conv_id", *[f"t.{c}" for c in names])


def with_parts(seqs: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Sequences with the part that packs them: shards by prefix, large ones split, small ones together."""
    first = lambda c: F.coalesce(F.try_element_at(c, F.lit(1)), F.lit(0))
    sharded = seqs.withColumn("shard", F.xxhash64("seg", "sa", "sb", first(F.col("la")), first(F.col("lb"))))
    sizes = cut(sharded.groupBy("shard").agg(F.sum(F.col("n") + 1).alias("size")))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    tasks = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_parts = max(1, -(-total // part_turns), min(tasks, -(-total // 4096)))
    large = sizes.where(F.col("size") > part_turns).select("shard", F.ceil(F.col("size") / part_turns).cast("long").alias("pieces"))
    if large.count() <= _BROADCAST_SHARDS:
        large = F.broadcast(large)
    piece = F.pmod(F.xxhash64("xa", "xb", "n"), F.col("pieces"))
    part = F.when(F.col("pieces").isNull(), F.pmod("shard", F.lit(n_parts))).otherwise(F.xxhash64("shard", piece))
    return sharded.join(large, "shard", "left").withColumn("part", part).drop("shard", "pieces")


class DoubleArray:
    """BASE and CHECK over small turn ids (from 1). State 0 stands above all; a state's children are placed together."""

    def __init__(self, size: int = 1024):
        self.base, self.check, self.free_from, self.top = np.zeros(size, np.int32), np.full(size, -1, np.int32), 1, 0
        self.check[0] = 0

    def _room(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def place(self, state: int, codes: np.ndarray) -> np.ndarray:
        """Give a state its children, one for each code (ascending), and return their states."""
        first = int(codes[0])
        reach = int(codes[-1]) - first
        at = max(self.free_from, first + 1)  # BASE is 1 at least
        self._room(self.top + reach + first + 2)
        spots = at + np.flatnonzero(self.check[at:at + 1024] < 0)
        # the first few free places are tried; the end of the arrays always fits
        fit = next((s for s in spots.tolist() if s + reach < len(self.check) and (self.check[s + (codes - first)] < 0).all()), max(self.top + 1, at))
        slots = fit + (codes - first)
        self._room(int(slots[-1]) + 1)
        self.base[state], self.check[slots], self.top = fit - first, state, max(self.top, int(slots[-1]))
        while self.free_from < len(self.check) and self.check[self.free_from] >= 0:
            self.free_from += 1
        return slots

    def child(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states that the codes lead to; -1 where there is none."""
        t = self.base[states].astype(np.int64) + codes
        there = (self.base[states] > 0) & (t < len(self.check))
        t = np.where(there, t, 0)
        return np.where(there & (self.check[t] == states) & (t > 0), t, -1)


def _dense(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids from 1 for pairs of numbers, and the pairs in the order of their ids."""
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    ids = np.empty(len(a), np.int64)
    ids[order] = np.cumsum(new)
    return ids, a[order][new], b[order][new]


def pack(frame: pd.DataFrame, segment: int = SEGMENT) -> dict:
    """The double array of one part's sequences and its states' aggregates, as the arrays of a ``_TRIE`` row."""
    n = frame["n"].to_numpy(np.int64)
    flat = {c: np.concatenate([np.asarray(v, np.int64) for v in frame[c]]) if n.sum() else np.zeros(0, np.int64)
            for c in ("ta", "tb", "la", "lb", "chars")}
    code, turn_a, turn_b = _dense(flat["ta"], flat["tb"])
    # each prefix that a segment follows is a child of state 0
    seg, sa, sb = (frame[c].to_numpy(np.int64) for c in ("seg", "sa", "sb"))
    order = np.lexsort((sb, sa, seg))
    new = np.ones(len(n), bool)
    new[1:] = (np.diff(seg[order]) != 0) | (np.diff(sa[order]) != 0) | (np.diff(sb[order]) != 0)
    root_code = np.empty(len(n), np.int64)
    root_code[order] = np.cumsum(new)

    trie, start = DoubleArray(), np.cumsum(n) - n
    trie.place(0, np.unique(root_code))
    at = trie.child(np.zeros(len(n), np.int64), root_code)
    live, d = np.flatnonzero(n > 0), 0
    while len(live):  # packing, level by level
        by = code[start[live] + d]
        pairs = np.unique(np.stack([at[live], by], axis=1), axis=0)
        cuts = np.flatnonzero(np.diff(pairs[:, 0], prepend=-1))
        for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(pairs)]):
            trie.place(int(pairs[lo, 0]), pairs[lo:hi, 1])
        at[live] = trie.child(at[live], by)
        d += 1
        live = live[n[live] > d]

    size = trie.top + 1
    out = {c: np.zeros(size, np.int64) for c in ("depth", "a", "b", "n_convs", "n_ends", "chars")}
    out["conv_id"], out["root"] = np.full(size, np.iinfo(np.int64).max), np.zeros(size, np.int64)
    weight, conv = frame["weight"].to_numpy(np.int64), frame["conv_id"].to_numpy(np.int64)
    at = trie.child(np.zeros(len(n), np.int64), root_code)
    roots, a, b, live, d = at.copy(), sa.copy(), sb.copy(), np.arange(len(n)), 0
    while len(live):  # walking
        s = at[live]
        np.add.at(out["n_convs"], s, weight[live])
        np.minimum.at(out["conv_id"], s, conv[live])
        np.add.at(out["n_ends"], s, np.where(n[live] == d, weight[live], 0))
        out["depth"][s], out["a"][s], out["b"][s], out["root"][s] = segment * seg[live] + d, a[live], b[live], roots[live]
        if d:
            out["chars"][s] = flat["chars"][start[live] + d - 1]
        live = live[n[live] > d]
        i = start[live] + d
        at[live] = trie.child(at[live], code[i])
        a[live] ^= flat["la"][i]
        b[live] ^= flat["lb"][i]
        d += 1
    used = np.flatnonzero(out["n_convs"])
    out["state"], out["parent"] = np.arange(size), trie.check[:size]
    row = {c: out[c][used].astype(kind).tobytes() for c, kind in _KINDS.items()}
    return row | {"base": trie.base[:size].tobytes(), "check": trie.check[:size].tobytes(), "turn_a": turn_a.tobytes(), "turn_b": turn_b.tobytes()}


def build_tries(parts: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per part: BASE and CHECK, the digests of its turns by dense id, and its states' aggregates."""
    names = [c.split(" ")[0] for c in _TRIE.split(", ")]

    def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([pack(frame, segment) | {"part": int(key[0])}])[names]

    return parts.groupBy("part").applyInPandas(build, _TRIE)


def states(tries: DataFrame) -> DataFrame:
    """One row per state of every trie: its place, prefix, parent's prefix and aggregates."""
    schema = ("part long, state int, parent int, depth long, a long, b long, pa long, pb long, ra long, rb long, rdepth long, "
              "n_convs long, n_ends long, conv_id long, chars long")

    def unpack(frames):
        for frame in frames:
            for r in frame.to_dict("records"):
                x = {c: np.frombuffer(r[c], kind) for c, kind in _KINDS.items()}
                up, top = np.searchsorted(x["state"], x["parent"]), np.searchsorted(x["state"], x["root"])
                up = np.where(x["state"] == x["root"], np.arange(len(up)), up)
                yield pd.DataFrame({
                    "part": r["part"], "state": x["state"], "parent": x["parent"], "depth": x["depth"], "a": x["a"], "b": x["b"],
                    "pa": x["a"][up], "pb": x["b"][up], "ra": x["a"][top], "rb": x["b"][top], "rdepth": x["depth"][top],
                    "n_convs": x["n_convs"], "n_ends": x["n_ends"], "conv_id": x["conv_id"], "chars": x["chars"]})

    return tries.select("part", *_KINDS).mapInPandas(unpack, schema)


def find(trie: dict, segment_digests: list[tuple[int, int]], root_code: int = 1) -> int:
    """The state that a sequence of turn digests leads to in a packed part, or -1."""
    base, check = np.frombuffer(trie["base"], np.int32), np.frombuffer(trie["check"], np.int32)
    codes = {p: i for i, p in enumerate(zip(np.frombuffer(trie["turn_a"], np.int64).tolist(), np.frombuffer(trie["turn_b"], np.int64).tolist()), 1)}
    s = 0
    for c in [root_code, *(codes.get(p, 0) for p in segment_digests)]:
        t = int(base[s]) + c
        if not c or not base[s] or t >= len(check) or check[t] != s:
            return -1
        s = t
    return s


def _nested_totals(totals: DataFrame, edges: DataFrame, rounds: int) -> DataFrame:
    """Sums over each shard and all shards below it: ``totals`` (shard, leaves, saved), ``edges`` (shard, up); by doubling."""
    acc = totals.join(edges, "shard", "left").select("shard", "up", "leaves", "saved")
    for _ in range(rounds):
        acc = cut(acc)
        given = acc.where("up IS NOT NULL").groupBy(F.col("up").alias("shard")).agg(F.sum("leaves").alias("_l"), F.sum("saved").alias("_s"))
        jumps = acc.select(F.col("shard").alias("up"), F.col("up").alias("_up"))
        acc = (acc.join(given, "shard", "left").join(jumps, "up", "left")
               .select("shard", F.col("_up").alias("up"), (F.col("leaves") + F.coalesce("_l", F.lit(0))).alias("leaves"),
                       (F.col("saved") + F.coalesce("_s", F.lit(0))).alias("saved")))
    return acc.select("shard", "leaves", "saved")


def _subtree_sums(rows: DataFrame) -> DataFrame:
    """Per part: sums over the states below each state, itself included, and its parent's conversation."""
    schema = "depth long, a long, b long, inner boolean, parent_conv_id long, leaves long, saved long"

    def add_up(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("state", kind="stable")
        state, depth, is_root = (frame[c].to_numpy() for c in ("state", "depth", "is_root"))
        up = np.searchsorted(state, frame["parent"].to_numpy())
        sums = {c: frame[c].to_numpy(np.int64, copy=True) for c in ("leaves", "saved")}
        order = np.argsort(-depth, kind="stable")
        order = order[~is_root[order]]
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []:
            for v in sums.values():
                np.add.at(v, up[level], v[level])
        conv = frame["conv_id"].to_numpy(np.int64)
        parent = pd.array(np.where(is_root, 0, conv[np.where(is_root, 0, up)]), dtype="Int64")
        parent[is_root] = pd.NA
        return pd.DataFrame({"depth": depth, "a": frame["a"], "b": frame["b"], "inner": ~(is_root & (depth > 0)),
                             "parent_conv_id": parent, "leaves": sums["leaves"], "saved": sums["saved"]})

    return rows.groupBy("part").applyInPandas(add_up, schema)


def ends_digests(segs: DataFrame) -> DataFrame:
    """``depth, a, b, ends_sha256`` of the nodes where conversations end: SHA-256 of their ascending ids, comma-joined.

    Ids are joined in ordered pieces of at most ``PIECE`` by range; only pieces of a node then meet, streaming through the hash,
    which is sequential by its nature.
    """
    last = segs.groupBy("conv_id").agg(F.sum("n").alias("depth"), F.bit_xor("xa").alias("a"), F.bit_xor("xb").alias("b"))
    ranged = range_groups(last, [*map(F.col, _NODE), F.col("conv_id")], out="_gid").drop("_gid")

    def join_ids(frames):
        key, ids = None, []
        for frame in frames:
            rows = list(zip(*(frame[c].tolist() for c in (*_NODE, "conv_id"))))
            out = []
            for *k, c in rows:
                if k != key or len(ids) == PIECE:
                    if ids:
                        out.append((*key, ids[0], ",".join(map(str, ids))))
                    key, ids = k, []
                ids.append(c)
            yield pd.DataFrame(out, columns=[*_NODE, "first", "ids"])
        if ids:
            yield pd.DataFrame([(*key, ids[0], ",".join(map(str, ids)))], columns=[*_NODE, "first", "ids"])

    def hash_pieces(frames):
        key, sha = None, None
        for frame in frames:
            out = []
            for *k, _, ids in zip(*(frame[c].tolist() for c in (*_NODE, "first", "ids"))):
                if k != key:
                    if key:
                        out.append((*key, sha.hexdigest()))
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            yield pd.DataFrame(out, columns=[*_NODE, "ends_sha256"])
        if key:
            yield pd.DataFrame([(*key, sha.hexdigest())], columns=[*_NODE, "ends_sha256"])

    pieces = ranged.sortWithinPartitions(*_NODE, "conv_id").mapInPandas(join_ids, "depth long, a long, b long, first long, ids string")
    return (pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "first")
            .mapInPandas(hash_pieces, "depth long, a long, b long, ends_sha256 string"))


def nodes(convs: DataFrame, rows: DataFrame, segment: int = SEGMENT, part_turns: int = PART_TURNS) -> DataFrame:
    """Every node of the prefix trie of ``rows`` (``conv_id, place, ta, tb, chars``): ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``."""
    segs = written(segments(convs, rows, segment), "segments")
    tries = written(build_tries(with_parts(sequences(segs), part_turns), segment), "tries")
    local = states(tries).withColumn("is_root", (F.col("depth") == F.col("rdepth")))
    local = written(local, "states")

    # a segment's first state stands for the last node of the trie above: only the topmost trie counts it
    counted = local.where("NOT is_root OR depth = 0")
    merged = counted.groupBy(*_NODE).agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
                                         F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("part").alias("owner"))
    merged = written(merged, "nodes")
    children = merged.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")).agg(
        F.count("*").alias("n_children"))
    whole = merged.join(children, _NODE, "left").select(*_NODE, "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "chars", "owner")
    whole = written(whole, "whole-nodes")

    known = whole.select(*_NODE, F.col("conv_id").alias("_conv"), "owner", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
                         ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    mine = (F.col("owner") == F.col("part")) & (~F.col("is_root") | (F.col("depth") == 0))
    weighed = local.join(known, _NODE).select(
        "part", "state", "parent", "is_root", *_NODE, "ra", "rb", "rdepth", F.col("_conv").alias("conv_id"), mine.alias("mine"),
        *[F.when(mine, F.col(c)).otherwise(F.lit(0)).alias(c) for c in ("leaves", "saved")])

    deepest = merged.agg(F.max("depth")).first()[0] or 0
    if deepest > segment:  # conversations of several segments: what hangs below a segment's last node
        weighed = written(weighed, "weighed")
        key = lambda d, a, b: F.struct(F.col(d).alias("depth"), F.col(a).alias("a"), F.col(b).alias("b"))
        totals = weighed.where("rdepth > 0").groupBy(key("rdepth", "ra", "rb").alias("shard")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        edges = weighed.where((F.col("depth") % segment == 0) & F.col("mine") & (F.col("rdepth") > 0)).select(
            key("depth", "a", "b").alias("shard"), key("rdepth", "ra", "rb").alias("up"))
        rounds = max(1, -(-deepest // segment)).bit_length()
        below = _nested_totals(totals, edges, rounds).select(F.col("shard.depth").alias("depth"), F.col("shard.a").alias("a"), F.col("shard.b").alias("b"),
                                                             F.col("leaves").alias("_l"), F.col("saved").alias("_s"))
        weighed = weighed.join(below, _NODE, "left")
        for c, more in (("leaves", "_l"), ("saved", "_s")):
            weighed = weighed.withColumn(c, F.col(c) + F.when(F.col("mine"), F.coalesce(more, F.lit(0))).otherwise(F.lit(0)))
    sums = _subtree_sums(weighed.select("part", "state", "parent", "is_root", *_NODE, "conv_id", "leaves", "saved"))
    # a segment's first state tells its children's parent, but its own sums are those of the node above
    sums = sums.where("inner").groupBy(*_NODE).agg(F.min("parent_conv_id").alias("parent_conv_id"), F.sum("leaves").alias("n_leaves"),
                                                   F.sum("saved").alias("saved_tokens"))
    empty = hashlib.sha256(b"").hexdigest()
    return (whole.join(sums, _NODE).join(ends_digests(segs), _NODE, "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256")))


def conversation_trie(df: DataFrame, segment: int = SEGMENT, part_turns: int = PART_TURNS) -> DataFrame:
    """The nodes of the rebuilt conversations of ``(conv_id, turn, role, text)`` rows."""
    numbered = written(turns(df), "turns")
    convs, rows = rebuilt(numbered)
    return nodes(convs, rows, segment, part_turns)


#: The query's rows in DuckDB; the CRC-32 of the decimal id is worked off bit by bit.
ORACLE = """
WITH t AS (
  SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
         ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), sha256(COALESCE(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT conv_id, conv_id::VARCHAR AS word FROM t),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS lender,
         xor(4294967295, list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(word, ''), lambda x: ascii(x)::BIGINT)),
           lambda acc, x: list_reduce(list_concat([xor(acc, x)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                      lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) % 6 AS h
  FROM ids),
r AS (
  SELECT c.conv_id, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.lender AND t.place < c.h
  UNION ALL SELECT c.conv_id, t.place, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.place >= c.h),
s AS (SELECT conv_id, LIST({'role': role, 'text': text} ORDER BY place) AS turns, COUNT(*) AS n FROM r GROUP BY conv_id),
p AS (
  SELECT conv_id, n, 0 AS depth, [] AS prefix, 0 AS chars FROM (SELECT c.conv_id, COALESCE(s.n, 0) AS n FROM c LEFT JOIN s ON s.conv_id = c.conv_id)
  UNION ALL
  SELECT conv_id, n, depth, turns[1:depth], length(turns[depth].text) FROM (SELECT *, UNNEST(range(1, n + 1)) AS depth FROM s)),
nodes AS (
  SELECT depth, prefix, MIN(conv_id) AS node, COUNT(*) AS n_convs, MAX(chars) AS chars,
         sha256(COALESCE(STRING_AGG(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends
  FROM p GROUP BY depth, prefix),
paths AS (SELECT p.conv_id, p.depth, nodes.node FROM p JOIN nodes ON nodes.depth = p.depth AND nodes.prefix = p.prefix),
up AS (
  SELECT n.depth, n.node, n.n_convs, n.chars, n.ends, a.node AS parent
  FROM nodes n LEFT JOIN paths a ON a.conv_id = n.node AND a.depth = n.depth - 1),
kids AS (SELECT depth - 1 AS depth, parent AS node, COUNT(*) AS n FROM up WHERE parent IS NOT NULL GROUP BY ALL),
full_nodes AS (SELECT up.*, COALESCE(kids.n, 0) AS n_children FROM up LEFT JOIN kids ON kids.depth = up.depth AND kids.node = up.node),
sums AS (
  SELECT a.depth, a.node, SUM((f.n_children = 0)::INT)::BIGINT AS n_leaves, SUM((f.n_convs - 1) * f.chars)::BIGINT AS saved_tokens
  FROM full_nodes f JOIN paths a ON a.conv_id = f.node AND a.depth <= f.depth GROUP BY a.depth, a.node)
SELECT f.node AS conv_id, f.depth::BIGINT AS depth, f.parent AS parent_conv_id, f.n_convs, f.n_children, sums.n_leaves, sums.saved_tokens,
       f.ends AS ends_sha256
FROM full_nodes f JOIN sums ON sums.depth = f.depth AND sums.node = f.node
"""
