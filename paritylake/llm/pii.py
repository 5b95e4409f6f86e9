"""Personal data by bootstrapped contextual extraction.

Seeds are the strict matches of four kinds (email, ip, card, phone). The words
around a seed are its lexical patterns. Mentions that only look like a kind
(loose shapes outside all seeds) are the unseen candidates. Spark scores the
graph of patterns and instances in rounds: a pattern's confidence is the share of
its mentions that are believed, an instance's belief follows from its patterns.
Patterns of high confidence, met by enough different instances, turn the
candidates they surround into findings.

Seeds are always kept; the method adds spans and never moves or drops one.

Defined cases: null and empty texts have no span; repeated rows get equal
answers; ties between patterns do not matter, as any confident one suffices; an
empty table gives an empty result; texts of any length are read whole, each
expression in time linear in the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from paritylake.llm.common import cut, texts, written

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
#: What an identifier may look like without passing the strict rules.
_LOOSE = (
    ("email", re.compile(r"(?<![^\s<>()\[\]])[^\s@<>()\[\]]{1,64}(?:@|\(at\)|\[at\])[^\s@<>()\[\]]{1,255}")),
    ("ip", re.compile(r"(?<![0-9A-Za-z.:])(?:[0-9]+(?:\.[0-9]+){3,}|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7})(?![0-9A-Za-z:])")),
    ("number", re.compile(r"(?<![0-9])\(?[0-9](?:[\x20().-]{0,2}[0-9])++")),
)
_SPAN = "array<struct<kind:int,start:int,end:int>>"
_MENTION = "array<struct<kind:int,start:int,end:int,seed:boolean,value:string,patterns:array<string>>>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, @ and dotted domain, found from each @ outwards."""
    found, low = [], 0
    at = text.find("@")
    while at >= 0:
        start = low + len(text[low:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        low = at + 1  # an @ is in no local part
        if m:
            found.append((start, m.end()))
            low = m.end()
        at = text.find("@", low)
    return found


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the strict matches, by kind and then start; code points, end exclusive."""
    if not text:
        return []
    spans = [(0, s, e) for s, e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        spans += [(1, m.start(), m.end()) for m in _IP.finditer(text)
                  if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
        spans += [(2, m.start(), m.end()) for m in _CARD.finditer(text)
                  if 16 <= len(d := _digits(m.group())) <= 19 and _luhn(d)]
        if "+" in text:
            spans += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return spans


def _loose_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Loose matches that overlap neither a strict match nor each other."""
    used = sorted((s, e) for _, s, e in taken)
    out = []
    for name, shape in _LOOSE:
        if name == "email" and not ("@" in text or "(at)" in text or "[at]" in text):
            continue
        at, new = 0, []
        for m in shape.finditer(text):
            s, e = m.span()
            while at < len(used) and used[at][1] <= s:
                at += 1
            if at < len(used) and used[at][0] < e:
                continue
            if name == "number":
                n = len(_digits(m.group()))
                if not 7 <= n <= 19:
                    continue
                kind = 2 if n >= 13 else 3
            else:
                kind = KINDS.index(name)
            new.append((kind, s, e))
        out += new
        used = sorted(used + [(s, e) for _, s, e in new])
    return out


def _context(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a span: the two words before it; the word on either side."""
    before = text[max(0, start - 80):start].lower().split()[-2:]
    after = text[end:end + 40].lower().split()[:1]
    before = [re.sub(r"[0-9]", "0", w.strip(".,;:!?()[]<>\"'")) for w in before]
    after = [re.sub(r"[0-9]", "0", w.strip(".,;:!?()[]<>\"'")) for w in after]
    found = []
    if len(before) == 2 and all(before):
        found.append(f"{before[0]} {before[1]} _")
    if before and before[-1] and after and after[0]:
        found.append(f"{before[-1]} _ {after[0]}")
    return found


def mentions(text: str | None) -> tuple[list, list]:
    """Strict spans; and every strict or loose mention with value and patterns."""
    spans = base_spans(text)
    rows = []
    if text and (spans or "@" in text or "(at)" in text or "[at]" in text or _DIGIT.search(text)):
        for seed, found in ((True, spans), (False, _loose_spans(text, spans))):
            for kind, s, e in found:
                value = hashlib.md5(re.sub(r"[\s().-]", "", text[s:e]).lower().encode("utf-8", "surrogatepass")).hexdigest()
                rows.append({"kind": kind, "start": s, "end": e, "seed": seed, "value": value, "patterns": _context(text, s, e)})
    return [{"kind": k, "start": s, "end": e} for k, s, e in spans], rows


def extract(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One pass over the texts: ``doc_id, text_hash, spans, mentions`` for every row."""
    slim = texts(df, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    schema = StructType([*slim.drop("text").schema, *StructType.fromDDL(f"spans {_SPAN}, mentions {_MENTION}")])
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    mention = pa.struct([*span, pa.field("seed", pa.bool_()), pa.field("value", pa.string()), pa.field("patterns", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [mentions(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([g[0] for g in got], pa.list_(span)), pa.array([g[1] for g in got], pa.list_(mention))],
                names=["doc_id", "text_hash", "spans", "mentions"])

    return slim.mapInArrow(run, schema)


def confident_patterns(found: DataFrame, rounds: int = 3, least: float = 0.8, support: int = 3) -> DataFrame:
    """``(kind, pattern, confidence, believed)`` of the patterns that pass, from the rows of ``extract``.

    A pattern passes with ``support`` different believed instances and ``least`` of its mentions (plus one doubt) believed.
    """
    m = found.select(F.explode("mentions").alias("m")).select("m.*")
    edges = cut(m.select("kind", "value", "seed", F.explode("patterns").alias("pattern"))
                .groupBy("kind", "pattern", "value", "seed").agg(F.count("*").alias("n")))
    # patterns without any seed can never pass in the first round, nor be believed later without shared instances
    met = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    belief = edges.select("kind", "value", "seed").distinct().withColumn("belief", F.col("seed").cast("double"))
    scores = None
    for _ in range(rounds):
        weighed = edges.join(belief, ["kind", "value", "seed"])
        scores = cut(weighed.groupBy("kind", "pattern").agg(
            F.sum(F.col("n") * F.col("belief")).alias("good"),
            F.sum((F.col("belief") >= least).cast("long")).alias("believed")).where("believed > 0")
            .join(met, "pattern").select("kind", "pattern", "believed", (F.col("good") / (F.col("total") + 1)).alias("confidence")))
        strong = scores.where(F.col("believed") >= support).select("kind", "pattern", "confidence")
        heard = (edges.where("not seed").join(strong, ["kind", "pattern"])
                 .groupBy("kind", "value", "seed").agg((1 - F.exp(F.sum(F.log1p(-F.least("confidence", F.lit(0.999)))))).alias("belief")))
        belief = edges.where("seed").select("kind", "value", "seed").distinct().withColumn("belief", F.lit(1.0)).union(
            heard.select("kind", "value", "seed", "belief"))
    return scores.where((F.col("confidence") >= least) & (F.col("believed") >= support))


def discovered(found: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, kind, start, end)`` of candidates that a confident pattern of their kind surrounds."""
    m = found.select("doc_id", "text_hash", F.explode("mentions").alias("m")).select("doc_id", "text_hash", "m.*").where("not seed")
    named = m.select("doc_id", "text_hash", "kind", "start", "end", F.explode("patterns").alias("pattern"))
    return named.join(patterns.select("kind", "pattern"), ["kind", "pattern"]).select("doc_id", "text_hash", "kind", "start", "end").distinct()


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, least: float = 0.8, support: int = 3) -> DataFrame:
    """Counts and spans of every row: ``n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found``."""
    found = written(extract(df, id_col, text_col), "mentions")
    new = discovered(found, confident_patterns(found, rounds, least, support))
    more = new.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    rows = found.select("doc_id", "text_hash", "spans").join(
        more.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "more"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    more_or_none = F.coalesce("more", F.array().cast(_SPAN))

    def count(kind: int, name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{name}")

    counts = [count(k, name) for k, name in enumerate(KINDS)]
    return rows.select("doc_id", *counts, F.sha2(_joined(F.col("spans")).cast("binary"), 256).alias("base_sha256"),
                       _joined(F.concat("spans", more_or_none)).alias("spans"), F.size(more_or_none).cast("long").alias("n_found"))
