"""Fixtures shared by the corpus operator tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rnd = random.Random(5)
    vocab = ["alpha", "beta", "gamma", "delta", "omega", "Ärger", "été", "x1", "don't"]
    long = " ".join(rnd.choice(vocab) + str(rnd.randrange(900)) for _ in range(40_000))
    lines = "\n".join(" ".join(rnd.choice(vocab) for _ in range(9)) for _ in range(30))
    return [
        (1, lines, "en", "a", 3), (2, lines, "en", "a", 3), (2, lines, "en", "a", 3), (3, "", "fr", "b", 0),
        (4, None, None, None, None), (None, lines + " end", "en", None, 5), (None, None, None, None, None),
        (None, None, None, None, None), (5, " \t\n\x0b\r ", "de", "b", 5), (6, "one", "de", "b", 3),
        (7, long, "en", "c", len(long)), (7, "another text under the same id", None, "c", 1),
        (8, "éè \U0001f600 tiny\x00text", "fr", "c", 9), (-3, lines, "en", "a", 3), (9, "1 2 3 4 . ! ?", "es", "b", 2),
    ]


def edge_docs(spark):
    """The edge rows with further columns whose names operators might use themselves."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    return (df.withColumn("fp", F.lit("mine")).withColumn("line", F.lit(1)).withColumn("h", F.lit(2.5)).withColumn("_id", F.lit(1))
              .withColumn("copy", F.lit(True)).withColumn("key", F.lit("k")).withColumn("n", F.lit(None).cast("int"))
              .withColumn("a.b", F.lit(0)))


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
