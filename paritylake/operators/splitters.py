"""Equi-depth groups: order-preserving groups of about equally many rows, whatever the values.

Two ways to the boundaries:

* ``split_heavy`` keeps a caller's cheap fixed cut where it does (a day, a stretch of numbers) and cuts its heavy pieces
  again inside the plan: a bounded sample of their rows' order values is drawn by hash, so it depends on the data alone
  (every reading of a plan finds the same boundaries, and a lost executor changes nothing). Boundaries are whole order
  tuples, so rows that share a first value are cut by the second.
* ``range_groups`` takes Spark's range partitions and cuts the lineage.

Both spread a key with all its rows on one day, or a value that many rows share, in proportion to rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from paritylake.session import materialize

#: Rows of a group of ``range_groups``; a small table is cut further, down to so many, to occupy the cluster.
GROUP_ROWS, LEAST_ROWS = 65_536, 2_048
#: Most boundaries, rows that a sample aims at, and boundaries of one step of a search.
MOST_GROUPS, SAMPLED, FAN = 4_096, 32_768, 64


def range_groups(df: DataFrame, order: Sequence[Column], out: str = "_gid", rows: int | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``df`` with the group number ``out``; groups ascend in ``order``, and the result is cut from its lineage, so that
    every reader sees the same groups.

    Rows equal in every order column would share a group; a last column from the row's place in the input keeps even those
    apart. ``rows``: the row count, where the caller knows it.
    """
    rows = df.count() if rows is None else rows
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, -(-rows // group_rows), min(tasks, -(-rows // LEAST_ROWS)))
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(groups, *order, "_place") if groups > 1 else placed.coalesce(1)
    return materialize(ranged.drop("_place").withColumn(out, F.spark_partition_id()))


def heavy_pieces(df: DataFrame, piece: str, group_rows: int = GROUP_ROWS, most: int = MOST_GROUPS) -> DataFrame:
    """One row ``(pieces, rows)``: the pieces with more than ``group_rows`` rows and more than a ``most``-th of all (so ``most`` of
    them at most), wrapped in structs so that NULL is one, and how many rows they have."""
    sizes = df.groupBy(F.struct(F.col(piece).alias("p")).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    # listed before the total is known, the largest pieces are at most all rows / group_rows
    large = sizes.agg(F.sum("c").alias("n"), F.collect_list(F.when(F.col("c") > group_rows, F.struct("p", "c"))).alias("large"))
    heavy = F.filter("large", lambda x: x["c"] * most > F.col("n"))
    return large.select(F.transform(heavy, lambda x: x["p"]).alias("pieces"),
                        F.aggregate(heavy, F.lit(0).cast("bigint"), lambda acc, x: acc + x["c"]).alias("rows"))


def boundaries(rows: DataFrame, value: Column, n: Column, group_rows: int = GROUP_ROWS, most: int = MOST_GROUPS, sampled: int = SAMPLED) -> DataFrame:
    """One row ``(steps, all)``: every ``FAN``-th of the sorted boundaries of ``value`` over ``n`` rows, and all of them.

    Rows of equal value are drawn together or not at all; those drawn are counted by value before they meet.
    """
    drawn = rows.select(value.alias("v"), n.cast("double").alias("n")).where(
        F.pmod(F.xxhash64(F.lit("drawn"), "v"), F.lit(2**30)).cast("double") / float(2**30) < F.lit(float(sampled)) / F.col("n"))
    counted = drawn.groupBy("v").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
    # the sample, bounded whatever the table's size, is ordered in one task
    upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    of_sample = F.sum("c").over(upto) / F.least(F.col("n"), F.lit(float(sampled)))
    groups = F.least(F.lit(float(most)), F.ceil(F.col("n") / group_rows))
    cut = counted.select("v", F.floor(of_sample * groups).alias("g")).where("g > 0").groupBy("g").agg(F.min("v").alias("v"))
    lists = cut.agg(F.sort_array(F.collect_list("v")).alias("all"))  # ``most`` at most
    return lists.select(F.filter("all", lambda v, i: i % FAN == 0).alias("steps"), "all")


def split_heavy(df: DataFrame, piece: str, order: Sequence[str], out: str, **kw) -> DataFrame:
    """``df`` with ``out``: 0 in pieces of ordinary size; in heavy ones how many boundaries lie at or below a row's order tuple
    (NULLs first), so that (piece, out) ascends with (piece, order)."""
    value = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    heavy = heavy_pieces(df, piece, **{k: v for k, v in kw.items() if k != "sampled"}).select(F.struct("pieces", "rows")).scalar()
    marked = df.withColumn("_sh_heavy", heavy)
    in_heavy = F.array_contains(F.col("_sh_heavy.pieces"), F.struct(F.col(piece).alias("p")))
    found = boundaries(marked.where(in_heavy), value, F.col("_sh_heavy.rows"), **kw).select(F.struct("steps", "all")).scalar()
    rows = marked.withColumns({"_sh_in": in_heavy, "_sh_found": found, "_sh_value": F.when(in_heavy, value)})
    not_above = lambda b: b <= F.col("_sh_value")
    # the last boundary not above the row: first among every FAN-th, then among the FAN from there on
    start = F.greatest(F.size(F.filter(F.col("_sh_found.steps"), not_above)) - 1, F.lit(0)) * FAN
    rows = rows.withColumn("_sh_at", F.when(F.col("_sh_in"), start))
    within = F.size(F.filter(F.slice("_sh_found.all", F.col("_sh_at") + 1, F.lit(FAN)), not_above))
    return rows.withColumn(out, F.when(F.col("_sh_in"), F.col("_sh_at") + within).otherwise(F.lit(0))).drop(
        "_sh_heavy", "_sh_in", "_sh_found", "_sh_value", "_sh_at")
