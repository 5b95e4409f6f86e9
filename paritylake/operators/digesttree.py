"""Digest trees: localisation of differing keys with stored, descendable digests.

A key's place is the hash of its canonical text, 60 bits. The leaves of a tree are prefixes of that hash, ``FAN_BITS``
bits a level, and the depth follows from the counted rows, so a leaf holds about the same number of rows at any size.
Below the leaves lies the key level: one digest (rows, two lane sums) per key. Every node's digest is the sum of its
children's, whatever the order.

A stored side is hashed once. The key level is written clustered by leaf, the levels above it as a table of nodes. Two
stored trees are compared from the root down, reading only children of nodes that differ; of the key level only differing
leaves are read. A later run against a stored tree therefore never scans the side that did not change. Two sides without a
stored tree have nothing to descend: one aggregate compares all leaves, and rows of differing leaves are hashed again by key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paritylake.functions.canon import LANE_HEX_DIGITS, canon_col, with_row_hash
from paritylake.session import scratch_dir

#: Bits of a key's hash; bits a level (16 children a node); rows a leaf aims at; rows a file of the key level aims at;
#: nodes that one step of a descent names in its filter, beyond which it joins them.
HASH_BITS, FAN_BITS, LEAF_ROWS, FILE_ROWS, NAMED_NODES = 60, 4, 64, 4_000_000, 2_000
#: Node of NULL keys, at every level.
NULL_NODE = -1
_DIGEST = ["n", "s1", "s2"]
_SHAPE = "key string, cols array<string>, coerce_numeric boolean, depth int, rows long"


@dataclass(frozen=True)
class Shape:
    """What two trees must share to be compared."""

    key: str
    cols: tuple[str, ...]
    coerce_numeric: bool
    depth: int


def depth_for(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Levels below the root for ``rows`` rows: the fewest whose leaves hold ``leaf_rows`` rows or fewer on average."""
    depth = 1
    while leaf_rows << (FAN_BITS * depth) < rows and FAN_BITS * (depth + 1) <= HASH_BITS:
        depth += 1
    return depth


def _zero() -> Column:
    return F.lit(0).cast("decimal(38,0)")


def _up(levels: int) -> Column:
    return F.shiftright("node", FAN_BITS * levels) if levels else F.col("node")


def row_digests(df: DataFrame, shape: Shape, as_text: bool = False, leaves: DataFrame | None = None) -> DataFrame:
    """``node, _key, h1, h2`` of the rows of one side; with a table of ``leaves``, of those in them alone: of other rows no more than
    the key is hashed."""
    names = list(dict.fromkeys([*shape.cols, shape.key]))
    text = canon_col(df, shape.key, coerce_numeric=shape.coerce_numeric)
    place = F.conv(F.substring(F.md5(text), 1, LANE_HEX_DIGITS), 16, 10).cast("bigint")
    rows = df.select(*names, (text if as_text else F.col(shape.key)).alias("_key"),
                     F.coalesce(F.shiftright(place, HASH_BITS - FAN_BITS * shape.depth), F.lit(NULL_NODE).cast("bigint")).alias("node"))
    if leaves is not None:
        rows = rows.join(leaves, "node", "left_semi")
    return with_row_hash(rows, list(shape.cols), keep=["node", "_key"], coerce_numeric=shape.coerce_numeric)


def _folded(hashed: DataFrame, *groups: str) -> DataFrame:
    return hashed.groupBy(*groups).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), *[F.sum(F.col(h).cast("decimal(38,0)")).alias(s) for h, s in (("h1", "s1"), ("h2", "s2"))])


def _summed(nodes: DataFrame, *groups) -> DataFrame:
    return nodes.groupBy(*groups).agg(F.sum("n").cast("bigint").alias("n"), *[F.sum(s).cast("decimal(38,0)").alias(s) for s in ("s1", "s2")])


@dataclass(frozen=True)
class DigestTree:
    """A stored tree: ``level=0 .. depth`` of nodes, and the key level."""

    spark: SparkSession
    path: str
    shape: Shape
    rows: int

    def level(self, level: int, below: list[int] | DataFrame | None = None) -> DataFrame:
        """``node, n, s1, s2`` of a level; ``below``: only children of these nodes of the level above."""
        nodes = self.spark.read.parquet(f"{self.path}/nodes/level={level}")
        return _only(nodes, "parent", below).select("node", *_DIGEST)

    def keys(self, leaves: list[int] | DataFrame | None = None) -> DataFrame:
        """``node, _key, n, s1, s2`` of the keys, or of those in some leaves."""
        return _only(self.spark.read.parquet(f"{self.path}/keys"), "node", leaves)


def _only(rows: DataFrame, col: str, among: list[int] | DataFrame | None) -> DataFrame:
    if among is None:
        return rows
    if isinstance(among, list):  # named in the filter: reaches the scan, whose files are sorted by node
        return rows.where(F.col(col).isin(among))
    return rows.join(among.select(F.col("node").alias(col)), col, "left_semi")


def store_tree(df: DataFrame, cols: list[str], key: str, path: str, coerce_numeric: bool = False,
               shape: Shape | None = None, leaf_rows: int = LEAF_ROWS) -> DigestTree:
    """Hash ``df`` once and write its tree to ``path``; ``shape``: that of the tree it is to be compared with.

    The shape is written last: a tree without one is incomplete and not opened.
    """
    spark, rows = df.sparkSession, df.count()
    shape = shape or Shape(key, tuple(cols), coerce_numeric, depth_for(rows, leaf_rows))
    per_key = _folded(row_digests(df, shape), "node", "_key")
    files = max(1, -(-rows // FILE_ROWS))
    clustered = per_key.repartitionByRange(files, "node") if files > 1 else per_key.coalesce(1)
    clustered.sortWithinPartitions("node").write.parquet(f"{path}/keys")
    leaves = _summed(spark.read.parquet(f"{path}/keys"), "node")
    placed = leaves.select("node", _up(1).alias("parent"), *_DIGEST)
    (placed.repartitionByRange(files, "node") if files > 1 else placed.coalesce(1)).sortWithinPartitions("node").write.parquet(
        f"{path}/nodes/level={shape.depth}")
    below = spark.read.parquet(f"{path}/nodes/level={shape.depth}")
    for up in range(shape.depth - 1, -1, -1):  # each level is a sixteenth of the one below
        level = _summed(below, _up(1).alias("node")).select("node", _up(1).alias("parent"), *_DIGEST)
        level.coalesce(max(1, files >> (FAN_BITS * (shape.depth - up)))).sortWithinPartitions("node").write.parquet(f"{path}/nodes/level={up}")
        below = spark.read.parquet(f"{path}/nodes/level={up}")
    spark.createDataFrame([(shape.key, list(shape.cols), shape.coerce_numeric, shape.depth, rows)], _SHAPE).coalesce(1).write.parquet(f"{path}/shape")
    return DigestTree(spark, path, shape, rows)


def open_tree(spark: SparkSession, path: str) -> DigestTree:
    """A stored tree; an error if its writing never ended."""
    s = spark.read.schema(_SHAPE).parquet(f"{path}/shape").first()
    return DigestTree(spark, path, Shape(s["key"], tuple(s["cols"]), s["coerce_numeric"], s["depth"]), s["rows"])


def _compared(a: DataFrame, b: DataFrame, *groups: str) -> DataFrame:
    """Digests of both sides by group, in one aggregate: ``src_*, tgt_*``."""
    both = a.withColumn("side", F.lit(1)).unionByName(b.withColumn("side", F.lit(2)))
    return _by_side(both, *groups)


def _by_side(both: DataFrame, *groups: str) -> DataFrame:
    """``src_n, src_s1, ...`` of rows that carry ``side`` 1 or 2."""
    of = lambda s, c, none: F.coalesce(F.sum(F.when(F.col("side") == s, F.col(c))), none)
    return both.groupBy(*groups).agg(*[of(s, c, F.lit(0) if c == "n" else _zero()).cast("bigint" if c == "n" else "decimal(38,0)").alias(f"{p}_{c}")
                                       for s, p in ((1, "src"), (2, "tgt")) for c in _DIGEST])


def _differs() -> Column:
    return F.expr(" OR ".join(f"src_{c} <> tgt_{c}" for c in _DIGEST))


def differing_nodes(a: DigestTree, b: DigestTree) -> tuple[list[int] | DataFrame, list[tuple[int, int]]]:
    """Leaves whose digests differ, found from the root down, and per level (nodes read, nodes that differ).

    A step names the differing nodes in the filter of the next scan while they are few; more stay a table.
    """
    below, seen = None, []
    for level in range(a.shape.depth + 1):
        found = _compared(a.level(level, below), b.level(level, below), "node")
        if level == a.shape.depth and isinstance(below, DataFrame):
            return found.where(_differs()).select("node"), seen
        met, bad = found.agg(F.count(F.lit(1)), F.count_if(_differs())).first()
        seen.append((met, bad))
        nodes = found.where(_differs()).select("node")
        below = [r[0] for r in nodes.collect()] if bad <= NAMED_NODES else nodes
        if not bad:
            return [], seen
    return below, seen


def changes(per_key: DataFrame, key: str) -> DataFrame:
    """``key, kind, src_n, tgt_n`` of the keys whose digests differ; ``per_key`` has both sides' rows, told by ``side``."""
    kind = (F.when(F.col("tgt_n") == 0, "missing").when(F.col("src_n") == 0, "extra").when(F.col("tgt_n") > F.col("src_n"), "duplicated")
            .when(F.col("tgt_n") < F.col("src_n"), "under_count").otherwise("changed"))
    return _by_side(per_key, "_key").where(_differs()).select(F.col("_key").alias(key), kind.alias("kind"), "src_n", "tgt_n")


def localize_trees(a: DigestTree, b: DigestTree) -> DataFrame:
    """Differing keys of two stored trees of one shape."""
    if a.shape != b.shape:
        raise ValueError(f"trees of different shapes: {a.shape} and {b.shape}")
    leaves, _ = differing_nodes(a, b)
    sides = [t.keys(leaves).withColumn("side", F.lit(s)) for s, t in ((1, a), (2, b))]
    if sides[0].schema["_key"].dataType != sides[1].schema["_key"].dataType:  # compared, and returned, as canonical text
        sides = [s.withColumn("_key", canon_col(s, "_key", coerce_numeric=a.shape.coerce_numeric)) for s in sides]
    return changes(sides[0].unionByName(sides[1]), a.shape.key)


def localize_against(stored: DigestTree, tgt: DataFrame, path: str | None = None) -> DataFrame:
    """Differing keys of a stored source and a target, of which alone rows are read and hashed."""
    shape, path = stored.shape, path or scratch_dir(tgt.sparkSession, "digest-tree")
    return localize_trees(stored, store_tree(tgt, list(shape.cols), shape.key, path, shape.coerce_numeric, shape))


def localize(src: DataFrame, tgt: DataFrame, cols: list[str], key: str, leaf_rows: int = LEAF_ROWS, coerce_numeric: bool = False) -> DataFrame:
    """Keys whose row multiset differs, of two sides without stored trees: ``key, kind, src_n, tgt_n``.

    One aggregate compares all leaves; rows of differing leaves alone are hashed again, by key. Keys of different types are
    compared (and returned) as their canonical text.
    """
    as_text = src.schema[key].dataType != tgt.schema[key].dataType
    tagged = src.select(F.lit(1).alias("side")).unionByName(tgt.select(F.lit(2).alias("side")))
    rows = tagged.groupBy("side").count().agg(F.max("count")).first()[0] or 0
    shape = Shape(key, tuple(cols), coerce_numeric, depth_for(rows, leaf_rows))

    def both(leaves: DataFrame | None = None) -> DataFrame:
        sides = [row_digests(df, shape, as_text, leaves).withColumn("side", F.lit(s)) for s, df in ((1, src), (2, tgt))]
        return sides[0].unionByName(sides[1])

    differing = _by_side(_folded(both(), "side", "node"), "node").where(_differs()).select("node")
    return changes(_folded(both(differing), "side", "_key"), key)
