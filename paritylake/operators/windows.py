"""Ordered windows whose work does not depend on how rows spread over keys.

One path for every key: the rows of a key are cut into order-preserving groups. A fixed cut of the first order column (a day
of time, a stretch of numbers, the first letters of a string) does for most; a piece of it that holds more than a task's
rows is cut again by a sample of its order tuples, inside the plan (``splitters.split_heavy``), so a busy key's one day,
or one value that many rows share, is many groups. The window runs per (key, group), and a table of one row per (key, group)
carries what crosses a group's edge: the previous and next rows for LAG / LEAD, the totals for running sums and ranks.
Totals of a whole table go up and down a tree of stretches of stretches, so that no task sees more than ``FAN_OUT`` of them.
NULL keys and NULL order values are groups too (the group is a struct, in which NULLs equal). Nothing is
collected; LAG, LEAD and running sums run no job while a plan is built, ranks keep their distinct values or their sorted rows once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from paritylake.operators.splitters import split_heavy
from paritylake.session import materialize

# fixed widths of the buckets: seconds, integers, steps a doubling of a number, letters
DAY_SECONDS, INTEGER_STRETCH, STEPS_PER_DOUBLING, LETTERS = 86_400, 4_096, 256, 3
#: Groups, or stretches of groups, that a step of the tree of totals brings together.
FAN_OUT = 4_096
_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_REALS = (T.FloatType, T.DoubleType, T.DecimalType)


def bucket_of_order(df: DataFrame, col: str) -> Column:
    """Order-preserving bucket of a column by its type; other types are one bucket."""
    c, dt = F.col(col), df.schema[col].dataType
    if isinstance(dt, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(DAY_SECONDS * 1_000_000))
    if isinstance(dt, _INTS):
        return F.floor(c / F.lit(INTEGER_STRETCH))
    if isinstance(dt, _REALS):
        d = c.cast("double")
        steps = F.least(F.floor(F.log2(F.abs(d) + 1) * STEPS_PER_DOUBLING), F.lit(2**61))
        return F.when(F.isnan(d), F.lit(2**62)).when(d < 0, -steps - 1).when(d >= 0, steps)
    if isinstance(dt, T.StringType):
        return F.substring(c, 1, LETTERS)
    return F.when(c.isNotNull(), F.lit(0))


def _ordering(order: list[tuple[str, str]]) -> list[Column]:
    return [F.col(c).asc_nulls_first() if way == "asc" else F.col(c).desc_nulls_last() for c, way in order]


def _grouped(df: DataFrame, keys: list[str], order: list[str], bucket: Column | None, **kw) -> DataFrame:
    """``df`` with the struct ``_grp`` of the keys and the group's place in their order."""
    rows = df.withColumn("_d1", bucket if bucket is not None else bucket_of_order(df, order[0]))
    rows = split_heavy(rows, "_d1", order, "_d2", **kw) if bucket is None else rows.withColumn("_d2", F.lit(0))
    return rows.withColumn("_grp", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], "_d1", "_d2")).drop("_d1", "_d2")


def _places(way: str = "asc", of: str = "_grp.") -> list[Column]:
    return [c.asc_nulls_first() if way == "asc" else c.desc_nulls_last() for c in (F.col(f"{of}_d1"), F.col(f"{of}_d2"))]


def _along(keys: list[str], way: str = "asc"):
    """Window over the groups of a key: one row per group."""
    return Window.partitionBy(*[F.col(f"_grp.k{i}") for i in range(len(keys))]).orderBy(*_places(way))


def _before_all(totals: DataFrame, way: str, levels: int = 4) -> DataFrame:
    """``_grp, _shift`` of a whole table's groups (``_grp, _total``, the first place a number): what the groups before add up to.

    Groups are brought together by stretches of ``FAN_OUT`` places, stretches again, and so on; each task orders one stretch.
    """
    ends = lambda w: w.orderBy(*_places(way, "")).rowsBetween(Window.unboundedPreceding, -1)
    level = totals.select("_grp", "_total", F.col("_grp._d1").alias("_d1"), F.col("_grp._d2").alias("_d2"))
    below, steps = level, []
    for _ in range(levels):
        steps.append(below.withColumn("_up", F.floor(F.col("_d1") / FAN_OUT)))
        below = steps[-1].groupBy(F.struct(F.col("_up").alias("u")).alias("_key"), F.col("_up").alias("_d1")).agg(
            F.sum("_total").alias("_total")).withColumn("_d2", F.lit(0))
    shift = below.select("_key", F.coalesce(F.sum("_total").over(ends(Window.partitionBy(F.lit(0)))), F.lit(0)).alias("_over"))
    for n in range(levels - 1, -1, -1):
        here = steps[n].withColumn("_in", F.coalesce(F.sum("_total").over(ends(Window.partitionBy("_up"))), F.lit(0)))
        here = here.drop("_key").withColumn("_key", F.struct(F.col("_up").alias("u"))).join(shift, "_key")
        total = (F.col("_over") + F.col("_in")).alias("_shift" if n == 0 else "_over")
        shift = here.select("_grp", total) if n == 0 else here.select(F.struct(F.col("_d1").alias("u")).alias("_key"), total)
    return shift


def neighbours(df: DataFrame, key: str, order: list[str], prev_cols: dict | None = None,
               next_cols: dict | None = None, bucket: Column | None = None, **kw) -> DataFrame:
    """Add LAG (``prev_cols`` {src: alias}) and LEAD (``next_cols``) per key, ordered ascending, NULLs first.

    ``order`` should be unique per key; ``bucket``: a fixed order-preserving cut of the first order column.
    """
    prev_cols, next_cols = prev_cols or {}, next_cols or {}
    rows = _grouped(df, [key], order, bucket, **kw)
    w = Window.partitionBy("_grp").orderBy(*_ordering([(c, "asc") for c in order]))
    inner = rows.select("*", *[F.lag(F.col(s)).over(w).alias(a) for s, a in prev_cols.items()],
                        *[F.lead(F.col(s)).over(w).alias(a) for s, a in next_cols.items()],
                        F.lag(F.lit(1)).over(w).isNull().alias("_first"), F.lead(F.lit(1)).over(w).isNull().alias("_last"))
    # a group has one first and one last row: what the groups on either side need of it
    tail = F.struct(*[F.col(s).alias(f"p{i}") for i, s in enumerate(prev_cols)], F.lit(1).alias("hit"))
    head = F.struct(*[F.col(s).alias(f"n{i}") for i, s in enumerate(next_cols)], F.lit(1).alias("hit"))
    edges = inner.where("_first or _last").groupBy("_grp").agg(
        F.max(F.when(F.col("_last"), tail)).alias("_tail"), F.max(F.when(F.col("_first"), head)).alias("_head"))
    edges = edges.select("_grp", F.lag("_tail").over(_along([key])).alias("_before"),
                         F.lead("_head").over(_along([key])).alias("_after"))
    out = inner.join(edges, "_grp")
    for i, a in enumerate(prev_cols.values()):
        out = out.withColumn(a, F.when(F.col("_first"), F.col("_before").getField(f"p{i}")).otherwise(F.col(a)))
    for i, a in enumerate(next_cols.values()):
        out = out.withColumn(a, F.when(F.col("_last"), F.col("_after").getField(f"n{i}")).otherwise(F.col(a)))
    return out.drop("_grp", "_first", "_last", "_before", "_after")


def running_sum(df: DataFrame, keys: list[str], order: list[tuple[str, str]], value: Column, out: str,
                bucket: Column | None = None, **kw) -> DataFrame:
    """Cumulative sum of ``value`` per key in ``order`` ((column, "asc" | "desc"); ROWS UNBOUNDED PRECEDING ..
    CURRENT ROW); with value 1 it is ROW_NUMBER. Each (key, group) is summed on its own and shifted by the totals
    of the key's groups before it."""
    # columns of one direction make a group: a column that runs the other way orders rows within it
    ways = [way for _, way in order]
    along = [c for i, (c, _) in enumerate(order) if ways[:i + 1] == ways[:1] * (i + 1)]
    rows = _grouped(df, keys, along, bucket, **kw).withColumn("_val", value)
    w = Window.partitionBy("_grp").orderBy(*_ordering(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy("_grp").agg(F.sum("_val").alias("_total"))
    if not keys and isinstance(df.schema[order[0][0]].dataType, _INTS) and bucket is None:
        shifts = _before_all(totals, order[0][1])  # a number's range, and so its stretches, has no bound
    else:
        before = _along(keys, order[0][1]).rowsBetween(Window.unboundedPreceding, -1)
        shifts = totals.select("_grp", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_shift"))
    return (rows.withColumn("_part", F.sum("_val").over(w)).join(shifts, "_grp")
            .withColumn(out, F.col("_shift") + F.col("_part")).drop("_grp", "_val", "_part", "_shift"))


def _numbered(df: DataFrame, order: list[tuple[str, str]]) -> DataFrame:
    """``_grn``, ``_grank`` and ``_gn`` of ``global_rank`` for an order that tells rows apart.

    The rows are sorted once over the whole table, by Spark's range partitions, and kept; a row's number is its place in its
    partition after the rows of the partitions before. The windows that find where a run of equal first values starts have a
    partition's rows, and Spark leaves them out where ``_grank`` is not read.
    """
    value = F.struct(F.col(order[0][0]).alias("v"))
    kept = materialize(df.orderBy(*_ordering(order)).withColumn("_place", F.monotonically_increasing_id()))
    rows = kept.withColumns({"_part": F.shiftright("_place", 33), "_at": F.col("_place").bitwiseAND(F.lit(2**33 - 1))}).drop("_place")
    inside = Window.partitionBy("_part").orderBy("_at")
    rows = rows.withColumn("_new", F.coalesce(F.lag(value).over(inside) != value, F.lit(True)))
    rows = rows.withColumn("_run", F.max(F.when(F.col("_new"), F.col("_at"))).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # one row per partition: the rows before it, and where the run that goes on into it has started
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min_by(value, "_at").alias("_first"),
                                      F.max_by(value, "_at").alias("_last"), F.max("_run").alias("_run"))
    along = Window.partitionBy(F.lit(0)).orderBy("_part")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", "_run", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_below"), F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_gn"),
                         F.col("_first").eqNullSafe(F.lag("_last").over(along)).alias("_goes_on"))
    started = F.when((F.col("_run") > 0) | ~F.col("_goes_on"), F.col("_below") + F.col("_run"))
    parts = parts.withColumn("_started", started).select(
        "_part", "_below", "_gn", F.when(F.col("_goes_on"), F.last("_started", ignorenulls=True).over(before)).alias("_started"))
    out = rows.join(F.broadcast(parts), "_part")   # as many rows as the sort has partitions
    return (out.withColumn("_grn", F.col("_below") + F.col("_at") + 1)
            .withColumn("_grank", F.when((F.col("_run") == 0) & F.col("_started").isNotNull(), F.col("_started")).otherwise(F.col("_below") + F.col("_run")) + 1)
            .drop("_part", "_at", "_new", "_run", "_below", "_started"))


def global_rank(df: DataFrame, order: list[tuple[str, str]]) -> DataFrame:
    """Add ``_grank`` (rank by the first order column), ``_gn`` (total rows) and, with a second order column that
    tells ties apart, ``_grn`` (row number) without a single-task window.

    One order column: its distinct values are counted and ranked; rows take their value's rank by a join. Two or more: one
    global sort (``_numbered``).
    """
    if len(order) > 1:
        return _numbered(df, order)
    col, way = order[0]
    # kept: the groups' boundaries, their totals and the rows read it, and each reading would count again
    values = materialize(df.groupBy(F.struct(F.col(col).alias("v")).alias("_value"), F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n")))
    ranked = running_sum(values, [], [("_v", way)], F.col("_n"), "_upto")
    counts = values.agg(F.sum("_n").alias("_gn"))
    ranked = ranked.select("_value", (F.col("_upto") - F.col("_n")).alias("_below"))
    out = df.withColumn("_value", F.struct(F.col(col).alias("v")))
    out = out.join(ranked, "_value").select("*", counts.scalar().alias("_gn"))
    return out.withColumn("_grank", (F.col("_below") + 1).cast("bigint")).drop("_value", "_below")


def percent_rank_col() -> Column:
    """PERCENT_RANK from ``global_rank`` columns."""
    return F.when(F.col("_gn") <= 1, F.lit(0.0)).otherwise(
        (F.col("_grank") - 1).cast("double") / (F.col("_gn") - 1).cast("double"))


def ntile_col(k: int) -> Column:
    """NTILE(k) from ``global_rank`` columns: the first N mod k tiles get one extra row."""
    n, g = F.col("_gn"), F.col("_grn")
    q = F.floor(n / k).cast("bigint")
    r = (n % k).cast("bigint")
    big = r * (q + 1)
    return F.when(g <= big, F.floor((g - 1) / (q + 1)) + 1).otherwise(
        r + F.floor((g - big - 1) / F.greatest(q, F.lit(1))) + 1).cast("int")
