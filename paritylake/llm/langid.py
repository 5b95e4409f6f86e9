"""Language identification by rank-order n-gram profiles.

A language's profile is its most frequent letter n-grams (1 to 3) in order of
frequency. A document's own most frequent n-grams are compared with every
profile by out-of-place distance: the sum of the rank differences, with the
profile length for an n-gram the profile lacks. The least distance wins.

Profiles are fitted on at most ``train_docs`` documents a language (those with
the smallest key hashes), a documented bound; prediction reads whole texts.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
so is every text when nothing could be learned; ties go to the first language
by name; null languages and null texts are not learned from; equal rows get
equal answers; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from paritylake.llm.common import utf8_crc32

#: Code points handled at once while counting, so that a very long text needs bounded memory.
_CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.bool_, 0x110000)


def _codes(chars: np.ndarray) -> np.ndarray:
    """Codes of the 1-, 2- and 3-grams of letters; every run of other characters is one boundary (1)."""
    x = np.concatenate([[1], np.where(_letters()[chars], chars, 1), [1]]).astype(np.int64)
    x = x[np.concatenate([[True], (x[1:] != 1) | (x[:-1] != 1)])]
    two = x[:-1] | (x[1:] << 21)
    return np.concatenate([x[x != 1], two, two[:-1] | (x[2:] << 42)])


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of a whole text, ascending, with their counts; empty without a letter."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not _letters()[chars].any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    parts = []
    for at in range(0, len(chars), _CHUNK):
        # the end of a chunk counts as a boundary: no n-gram spans two chunks, none is counted twice
        parts.append(np.unique(_codes(chars[at:at + _CHUNK]), return_counts=True))
    if len(parts) == 1:
        return parts[0]
    codes, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(inv, np.concatenate([p[1] for p in parts])).astype(np.int64)


def most_frequent(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Up to ``size`` codes, the most frequent first, equal counts by code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        some = counts >= least
        codes, counts = codes[some], counts[some]
    return codes[np.lexsort((codes, -counts))][:size]


class Profiles:
    """Ranks of all profile n-grams: row by code, column by language, ``size`` where a profile lacks it."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.size, self.langs = size, sorted(profiles)
        self.codes = np.unique(np.array([c for p in profiles.values() for c in p], np.int64))
        self.ranks = np.full((len(self.codes), len(self.langs)), -1, np.int32)
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, profiles[lang]), j] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes, counts = gram_counts(text or "")
        if not len(codes) or not self.langs:
            return "und", 0.0
        own = most_frequent(codes, counts, self.size)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        ranks = np.where((self.codes[at] == own)[:, None], self.ranks[at], -1)
        off = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(off.argmin())
        return self.langs[best], float(1.0 - off[best] / (self.size * len(own)))


def fit(df: DataFrame, lang_col: str = "lang", text_col: str = "text", key_col: str = "doc_id", size: int = 300,
        train_docs: int = 2000, max_langs: int = 1000) -> Profiles:
    """Learn the profiles from the rows of ``df`` with a language and a text.

    ``train_docs`` rows a language at most (more only where key hashes tie); ``max_langs`` bounds the model, which
    goes to every task: more languages raise an error.
    """
    rows = df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(key_col).alias("h"))
    # the least hashes of each of 64 parts of a language first: no task sees all of a language
    part = F.row_number().over(Window.partitionBy("lang", F.pmod("h", F.lit(64))).orderBy("h"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    last = (rows.select("lang", "h").withColumn("part", part).where(F.col("part") <= train_docs)
            .withColumn("place", place).where(F.col("place") <= train_docs).groupBy("lang").agg(F.max("h").alias("last")))
    bounds = last.limit(max_langs + 1).collect()
    if len(bounds) > max_langs:
        raise ValueError(f"more than {max_langs} languages to learn")
    if not bounds:
        return Profiles({}, size)
    some = rows.join(F.broadcast(df.sparkSession.createDataFrame([tuple(b) for b in bounds], "lang string, last long")), "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column(0).to_pylist()
            for lang in sorted(set(langs)):
                got = [gram_counts(b.column(1)[i].as_py()) for i, x in enumerate(langs) if x == lang]
                codes, inv = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
                n = np.bincount(inv, np.concatenate([g[1] for g in got]), len(codes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)],
                                                 names=["lang", "gram", "n"])

    grams = (some.where("h <= last").select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = grams.withColumn("rank", rank).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for r in sorted(top.select("lang", "rank", "gram").collect()):  # languages x size rows at most
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(profiles, size)


def predict(df: DataFrame, model: Profiles, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id``, the columns of ``extra``, ``lang_pred`` and ``score`` for every row."""
    extra = extra or {}
    frame = df.select(F.col(text_col).alias("_text"), F.col(id_col).alias("doc_id"), *(c.alias(k) for k, c in extra.items()))
    shared = df.sparkSession.sparkContext.broadcast(model)  # languages x size ranks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [shared.value.predict(t.as_py()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[1:], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=[*b.schema.names[1:], "lang_pred", "score"])

    kinds = frame.drop("_text").schema.add("lang_pred", "string").add("score", "double")
    return frame.mapInArrow(run, kinds)


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Is the row kept out of training: CRC-32 of the id as text, modulo ``folds``."""
    return utf8_crc32(F.col(id_col)) % folds == fold


def identify(df: DataFrame, size: int = 300, train_docs: int = 2000) -> DataFrame:
    """Fit on the rows that are not held out, predict every row."""
    out = held_out()
    model = fit(df.where(~out), size=size, train_docs=train_docs)
    return predict(df, model, extra={"held_out": out}).select("doc_id", "held_out", "lang_pred", "score")
