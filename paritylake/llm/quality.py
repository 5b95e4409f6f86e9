"""Quality rules by repetition coverage.

Every text is measured whole: words become exact per-text numbers, rolling
64-bit hashes of several n-gram lengths mark the words inside n-grams that
occurred before in the text, and the characters of those words (and of repeated
lines) are set against all word characters. The first occurrence of an n-gram or
a line is no repetition: one sentence said twice covers its length once.

Defined cases: null and empty texts have no words, fail the base check
(fewer than 50 words) and are not kept; equal rows get equal verdicts; an empty
table gives an empty result; other columns are passed through or ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paritylake.llm.common import texts

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "base_failed boolean, kept boolean, dup_line_frac double, top_gram_frac double, dup_gram_frac double")


@dataclass(frozen=True)
class Rules:
    """Largest shares of word characters a kept text may have: in its most frequent n-gram (by length),
    in n-grams that occurred before (by length) and in lines that did. Published fixed values for web text."""

    top: dict[int, float] = field(default_factory=lambda: {2: 0.20, 3: 0.18, 4: 0.16})
    dup: dict[int, float] = field(default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10})
    lines: float = 0.20
    min_words: int = 50
    repeat_percent: int = 50


def _mixed(ids: np.ndarray) -> np.ndarray:
    z = (ids.astype(np.uint64) + np.uint64(1)) * _BASE
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _repeated(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window: has its code occurred before; and its number of occurrences."""
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    counts = np.diff(np.append(starts, len(codes)))
    n = np.empty(len(codes), np.int64)
    n[order] = np.repeat(counts, counts)
    again = np.ones(len(codes), bool)
    again[order[starts]] = False  # the sort is stable: each code's first window
    return again, n


def _covered(marked: np.ndarray, width: int, n_words: int) -> np.ndarray:
    """Words inside any marked window of ``width`` words."""
    edge = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(marked)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(text: str | None, rules: Rules = Rules()) -> tuple:
    """The measured values and verdicts of one text, in the order of the result columns after doc_id."""
    text = text or ""
    words = _WORD.findall(text)
    n_words = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n_words)
    chars = int(sizes.sum())
    n_symbols = sum(map(text.count, _SYMBOLS))
    seen: set[str] = set()
    n_dup_lines = dup_line_chars = 0
    for line in text.split("\n"):
        if line in seen:
            n_dup_lines += 1
            dup_line_chars += sum(map(len, _WORD.findall(line)))
        elif _WORD.search(line):
            seen.add(line)
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n_words)
    n_repeat = 0
    if n_words >= 3:
        # exact: pair numbers first, then (pair, word) numbers, each below n_words
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        triples = pairs[:-1] * len(number) + ids[2:]
        n_repeat = int(_covered(_repeated(triples)[1] > 1, 3, n_words).sum())
    base_failed = n_words < rules.min_words or 100 * n_repeat > rules.repeat_percent * n_words
    line_frac = dup_line_chars / chars if chars else 0.0
    top_frac = dup_frac = 0.0
    good = line_frac <= rules.lines
    rolling, mixed = _mixed(ids), _mixed(ids)
    widest = max([*rules.top, *rules.dup])
    for n in range(2, min(widest, n_words) + 1):
        rolling = rolling[:-1] * _BASE + mixed[n - 1:]
        if n not in rules.top and n not in rules.dup:
            continue
        marked, count = _repeated(rolling)
        if not marked.any():
            break  # a duplicated longer n-gram would hold a duplicated shorter one
        if n in rules.top:
            spans = np.convolve(sizes, np.ones(n, np.int64), "valid")
            share = float((count * spans)[count == count.max()].max()) / chars
            top_frac = max(top_frac, share)
            good &= share <= rules.top[n]
        if n in rules.dup:
            share = float(sizes[_covered(marked, n, n_words)].sum()) / chars
            dup_frac = max(dup_frac, share)
            good &= share <= rules.dup[n]
    return (n_words, chars, n_symbols, n_dup_lines, n_repeat, base_failed, bool(good and not base_failed),
            line_frac, top_frac, dup_frac)


def score(df: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the measured values and both verdicts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [measure(t.as_py(), rules) for t in b.column(1)]
            cols = list(zip(*rows)) if rows else [()] * 10
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=[x.strip().split(" ")[0] for x in _SCHEMA.split(",")])

    return texts(df, id_col, text_col).mapInArrow(run, _SCHEMA)


def keep_good(df: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows, all columns unchanged, whose text passes the base check and the repetition rules."""

    @F.pandas_udf("boolean")
    def good(text: pd.Series) -> pd.Series:
        return pd.Series([measure(t, rules)[6] for t in text], dtype=bool)

    return df.where(good(F.col(text_col)))
