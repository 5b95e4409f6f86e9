"""Mixing sources to target weights by Poisson replication.

A source's target weight and its size give the mean number of times each of its
documents should occur. Each document's count is drawn by inverting the Poisson
distribution at a uniform number taken from a hash of seed and document, so it
depends on nothing but the document and the seed: runs, retries and partitions do
not change it. The document is exploded by its count and all copies are shuffled
globally by a hash key.

A mean over ``chunk_rate`` is drawn as the sum of several independent chunks, so
that no distribution table and no single task grows with a rare source's rate.

Defined cases: a null source is a source of its own; null texts count as empty
(size 1, as every text counts its UTF-8 bytes plus 1); rows equal in id and text
draw the same count; sources without a given weight, or weight 0, are left out;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paritylake.llm.common import cut

#: Entries of a chunk's distribution table: the tail beyond is under 1e-40 at a mean of 16.
_TABLE = 100
#: Rates of more sources than this are joined by a shuffle instead of a broadcast.
_BROADCAST_SOURCES = 100_000


def rates(df: DataFrame, source_col: str = "source", text_col: str = "text", weights: dict[str | None, float] | None = None,
          power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """``(source, size, rate)``: mean copies of each document of a source.

    The mix has ``epochs`` times the input's bytes in the mean, divided over the sources by ``weights``; without
    weights by size to the ``power`` (1 keeps the natural mix, 0 makes all sources equal).
    """
    size = (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long")
    sizes = cut(df.select(F.col(source_col).alias("source"), size.alias("size")).groupBy("source").agg(F.sum("size").alias("size")))
    if weights is None:
        weighted = sizes.withColumn("w", F.pow(F.col("size").cast("double"), F.lit(float(power))))
    else:
        given = df.sparkSession.createDataFrame([(k, float(w)) for k, w in weights.items()], "name string, w double")
        weighted = sizes.join(given, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    all_size = sizes.agg(F.sum("size")).first()[0] or 0  # the whole input's bytes, also those of sources without a weight
    all_w = weighted.agg(F.sum("w")).first()[0] or 1.0
    rate = F.lit(float(all_size)) * F.lit(float(epochs)) * F.col("w") / F.lit(float(all_w)) / F.col("size")
    return weighted.where("w > 0").select("source", "size", rate.alias("rate"))


def _uniform(*parts: Column) -> Column:
    """A number in (0, 1) with 52 bits from the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def _distribution(mean: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... as an array."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("cum"), F.array(F.exp(-mean)).alias("all"))

    def more(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k.cast("double")
        return F.struct(p.alias("p"), (acc["cum"] + p).alias("cum"), F.concat(acc["all"], F.array(acc["cum"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_TABLE - 1)), start, more, lambda acc: acc["all"])


def replicate(df: DataFrame, source_rates: DataFrame, source_col: str = "source", id_col: str = "doc_id",
              text_col: str = "text", seed: int = 42, chunk_rate: float = 16.0) -> DataFrame:
    """``doc`` (the row as a struct), ``chunk``, ``copy`` and ``shuffle_key`` for every copy, globally shuffled."""
    small = cut(source_rates.select(
        F.col("source").alias("_source"), F.greatest(F.lit(1), F.ceil(F.col("rate") / chunk_rate)).cast("long").alias("_chunks"),
        F.col("rate").alias("_rate")).withColumn("_cdf", _distribution(F.col("_rate") / F.col("_chunks"))))
    if small.count() <= _BROADCAST_SOURCES:
        small = F.broadcast(small)
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("doc"), F.col(source_col).alias("_of"),
                     F.col(id_col).cast("string").alias("_id"), F.md5(text_col).alias("_text"))
    chunked = (rows.join(small, F.col("_of").eqNullSafe(F.col("_source")))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1))))
    u = _uniform(F.lit(str(seed)), F.col("_id"), F.col("_text"), F.col("chunk").cast("string"))
    drawn = chunked.withColumn("_u", u).withColumn("_n", F.size(F.filter("_cdf", lambda c: c <= F.col("_u"))))
    copies = drawn.where("_n > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    name = F.md5(F.concat_ws(":", F.lit(str(seed)), "_id", "_text", F.col("chunk").cast("string"), F.col("copy").cast("string"), F.lit("order")))
    keyed = copies.select("doc", "chunk", "copy", F.conv(F.substring(name, 1, 15), 16, 10).cast("long").alias("shuffle_key"))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")


def mix(df: DataFrame, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
        weights: dict[str | None, float] | None = None, power: float = 0.5, epochs: float = 1.0, seed: int = 42) -> DataFrame:
    """The columns of ``df``, one row for every copy, in shuffled order."""
    r = rates(df, source_col, text_col, weights, power, epochs)
    return replicate(df, r, source_col, id_col, text_col, seed).select("doc.*")


#: The query's rows in DuckDB: 42 is the seed; shares by the square root of a source's bytes.
ORACLE = f"""
WITH sizes AS (SELECT source, SUM(strlen(COALESCE(text, '')) + 1)::BIGINT AS size FROM documents GROUP BY source),
means AS (
  SELECT source, (SELECT SUM(size)::DOUBLE FROM sizes) * sqrt(size::DOUBLE) / (SELECT SUM(sqrt(size::DOUBLE)) FROM sizes) / size AS rate
  FROM sizes),
cut AS (SELECT source, GREATEST(1, CEIL(rate / 16))::BIGINT AS chunks, rate / GREATEST(1, CEIL(rate / 16)) AS mean FROM means),
terms AS (
  SELECT source, chunks, k, exp(-mean + k * ln(mean) - lgamma(k + 1)) AS p
  FROM cut, range(0, 100) AS ks(k)),
cdf AS (SELECT source, chunks, SUM(p) OVER (PARTITION BY source ORDER BY k) AS cum FROM terms),
tables AS (SELECT source, chunks, LIST(cum) AS cums FROM cdf GROUP BY source, chunks),
parts AS (
  SELECT d.doc_id, d.source, d.text, UNNEST(range(0, t.chunks)) AS chunk, t.cums
  FROM documents d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source),
drawn AS (
  SELECT *, (('0x' || substr(md5(concat_ws(':', '42', doc_id, md5(text), chunk)), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM parts),
counted AS (SELECT doc_id, source, text, chunk, len(list_filter(cums, lambda c: c <= u)) AS n FROM drawn),
copies AS (SELECT *, UNNEST(range(1, n + 1)) AS copy FROM counted WHERE n > 0)
SELECT doc_id, source, text, chunk, copy::INTEGER AS copy,
       ('0x' || substr(md5(concat_ws(':', '42', doc_id, md5(text), chunk, copy, 'order')), 1, 15))::BIGINT AS shuffle_key
FROM copies
"""
