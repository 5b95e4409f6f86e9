"""Parent-child tables (J9, Q1) by pointer doubling: log2(depth) joins.

Every row points at the nearest ancestor it has not taken in yet. A round replaces the pointer by that ancestor's own, so the
stretch a row knows doubles; a row is done when its stretch ends in a root (NULL parent). Rows that no root reaches
are reported: ``orphan`` (the parent is not in the table), ``below an orphan``, or ``cycle`` (in or below one). Rounds end when none
finishes another row, which a cycle cannot prolong. Paths are put together afterwards, by the same doubling, over the
reached rows alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paritylake.session import materialize

#: What keeps a row from every root.
ORPHAN, BELOW_ORPHAN, CYCLE = "orphan", "below an orphan", "cycle"


def climbed(nodes: DataFrame, key: str, parent: str) -> tuple[DataFrame, int]:
    """``_key, _parent, _up, _steps, _root, _lost`` of every row, and the number of rounds. ``_steps``: rows from the row up to, not
    counting, ``_up``; ``_up`` NULL: it ends in ``_root``, or is lost."""
    links = nodes.select(F.col(key).alias("_key"), F.col(parent).alias("_parent"))
    top = F.col("_parent").isNull()
    state = materialize(links.select("_key", "_parent", F.col("_parent").alias("_up"), F.lit(1).cast("bigint").alias("_steps"),
                                     F.when(top, F.col("_key")).alias("_root"), F.lit(None).cast("string").alias("_lost")))
    open_rows, rounds = state.where("_up IS NOT NULL").count(), 0
    while open_rows:
        above = state.select(F.col("_key").alias("_at"), F.col("_up").alias("_next"), F.col("_steps").alias("_more"),
                             F.col("_root").alias("_top"), F.col("_lost").alias("_far"))
        met = state.where("_up IS NOT NULL").join(above, F.col("_up") == F.col("_at"), "left")
        missing = F.col("_at").isNull()
        lost = F.when(missing, F.when(F.col("_up") == F.col("_parent"), ORPHAN).otherwise(BELOW_ORPHAN)).when(F.col("_far").isNotNull(), BELOW_ORPHAN)
        moved = met.select("_key", "_parent", F.when(~missing, F.col("_next")).alias("_up"), (F.col("_steps") + F.coalesce("_more", F.lit(0))).alias("_steps"),
                           F.col("_top").alias("_root"), lost.alias("_lost"))
        state = materialize(state.where("_up IS NULL").unionByName(moved))
        left, rounds = state.where("_up IS NOT NULL").count(), rounds + 1
        if left == open_rows:  # depths have no gaps: what is still open hangs on a cycle
            break
        open_rows = left
    return state, rounds


def unreached(nodes: DataFrame, key: str, parent: str) -> DataFrame:
    """``key, reason`` of the rows that no root reaches."""
    state, _ = climbed(nodes, key, parent)
    reason = F.coalesce(F.col("_lost"), F.when(F.col("_up").isNotNull(), CYCLE))
    return state.select(F.col("_key").alias(key), reason.alias("reason")).where("reason IS NOT NULL")


def walk(nodes: DataFrame, key: str, parent: str, name: str, max_depth: int | None = None, sep: str = " > ", with_path: bool = True) -> DataFrame:
    """``key, root, depth, path`` of every row that a root reaches.

    ``max_depth``: deepest level to keep; without it the walk goes on to the leaves. ``with_path=False`` leaves the paths out, whose
    total length is the sum of all depths.
    """
    state, _ = climbed(nodes, key, parent)
    reached = state.where("_up IS NULL AND _lost IS NULL").select("_key", "_parent", "_root", (F.col("_steps") - 1).cast("int").alias("_depth"))
    if max_depth is not None:
        reached = reached.where(F.col("_depth") <= max_depth)
    if not with_path:
        return reached.select(F.col("_key").alias(key), F.col("_root").alias("root"), F.col("_depth").alias("depth"))
    names = nodes.select(F.col(key).alias("_key"), F.col(name).alias("_path"))
    paths = materialize(reached.join(names, "_key").select("_key", "_root", "_depth", "_path", F.col("_parent").alias("_up")))
    deepest = paths.agg(F.max("_depth")).first()[0] or 0
    for _ in range(deepest.bit_length()):  # a path of 2^k names grows to 2^(k + 1)
        above = paths.select(F.col("_key").alias("_at"), F.col("_path").alias("_above"), F.col("_up").alias("_next"))
        grown = paths.where("_up IS NOT NULL").join(above, F.col("_up") == F.col("_at")).select(
            "_key", "_root", "_depth", F.concat("_above", F.lit(sep), "_path").alias("_path"), F.col("_next").alias("_up"))
        paths = materialize(paths.where("_up IS NULL").unionByName(grown))
    return paths.select(F.col("_key").alias(key), F.col("_root").alias("root"), F.col("_depth").alias("depth"), F.col("_path").alias("path"))
