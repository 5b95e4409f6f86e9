"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Lines are the parts of a text between newlines; lines of at least ``min_chars``
characters take part, and with ``short`` also every shorter line with a letter or
digit. A line is dropped if an equal line, or a different line within ``tau``
edits, occurs earlier (by document id, then text hash, then line number). ``tau``
is one number for all lines of ``min_chars`` or more, or steps (least length,
edits) as in ``EDITS``: then the shorter line of a pair sets the edits, and lines
below the first step have equal copies only. The rule looks at the input lines alone, so the answer does not depend
on an order of work.

The join. Lengths are grouped in classes; a line is cut into tau + 1 segments, as long as its class allows, the first
ones placed from its start, the others from its end. If two lines are within tau edits, one of the shorter line's
segments occurs unchanged in the longer one, near its place from that end: every line probes, for its own class and
those a shorter partner may be in, only the starts that the remaining edits allow (13 for 4 edits in one class). Lines
under a key (class, segment number, segment text) that two lines meet lie in tiles of bounded size, earliest first; a line
is held against whole tiles, so no pairs are built. A partner is verified by a banded edit distance over what is left without
the common beginning and end: Spark's own, or for long strings a bit-parallel one, where tau + 1 words of 2 tau + 1 bits
hold which diagonals are reachable with 0, 1, ... edits.

Keys are those of different lines, each once, so a line repeated in a third of all
documents has one row a key. Texts of lines are fetched only for candidates;
documents are shuffled once, to take the lines out.

Defined cases: null texts count as empty; an empty or short line is never
dropped (with ``short``: one without letter or digit); null ids come first in the order; rows equal in id and text share one
answer; a very long line is a line like any other (its tiles hold fewer lines); an empty table gives an empty result. Other
columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from paritylake.llm.common import cut, written

#: Up to so many keys (two longs each) a list of keys is broadcast; beyond, it is joined by a shuffle.
_BROADCAST_KEYS = 2_000_000
#: Edits within which two lines are near copies, by the least length of the shorter one.
EDITS = ((8, 1), (20, 2), (100, 3), (200, 4))

#: About so many lines, or characters, lie in a tile of lines under one key.
_TILE_LINES, _TILE_CHARS = 1024, 1 << 20
#: Lines that differ over more characters are compared by the bit-parallel distance, whose time is in proportion to the length.
_LONG = 1024
#: From so many occurrences on, a line's rows are looked up apart from the others'.
_OFTEN = 4096

Steps = tuple[tuple[int, int], ...]


def _here() -> Column:
    """A line's place; the least one is its first occurrence."""
    return F.struct("doc_id", "text_hash", "line_no")


def as_steps(tau: int | Steps, min_chars: int) -> Steps:
    return ((min_chars, tau),) if isinstance(tau, int) else tau


def edits_at(n: int, steps: Steps) -> int:
    """Edits allowed if the shorter line has ``n`` characters."""
    return max((tau for least, tau in steps if n >= least), default=0)


def edits_of(n: Column, steps: Steps) -> Column:
    return F.greatest(F.lit(0), *(F.when(n >= least, tau) for least, tau in steps))


def occurrences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, short: bool = False) -> DataFrame:
    """``(doc_id, text_hash, line_no, line, h, g)`` of every line that takes part."""
    # hash and split first: beside the generator they would be done for every line of a text
    split = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                      F.split(F.coalesce(F.col(text_col), F.lit("")), "\n").alias("lines"))
    return (split.select("doc_id", "text_hash", F.posexplode("lines").alias("line_no", "line"))
            .where((F.length("line") >= min_chars) | (F.lit(short) & F.col("line").rlike(r"[\p{L}\p{N}]")))
            .withColumn("h", F.xxhash64("line")).withColumn("g", F.xxhash64(F.lit(1), "line")))


def _small(keys: DataFrame) -> DataFrame:
    """The list for a join: broadcast if its counted size allows it."""
    return F.broadcast(keys) if keys.count() <= _BROADCAST_KEYS else keys


def class_of(n: int, steps: Steps) -> tuple[int, int]:
    """``(least length, edits)`` of the lengths that are cut alike with ``n``; (0, 0) below the first step."""
    least = max((least for least, _ in steps if n >= least), default=0)
    wide = _class_width(least)
    return (least + (n - least) // wide * wide, edits_at(n, steps)) if least else (0, 0)


def _class_width(least: int) -> int:
    return max(1, least // 6)


def classes(n: int, steps: Steps) -> list[tuple[int, int, int]]:
    """``(least length, edits, shorter)`` of the classes a partner not longer than ``n`` may be in, which is then at least
    ``shorter`` characters shorter; the line's own class first."""
    found, top = [], n
    while (c := class_of(top, steps))[1] and n - top <= c[1]:
        found.append((*c, n - top))
        top = c[0] - 1
    return found


def probes(tau: int) -> list[tuple[int, bool, int]]:
    """``(segment, from_end, shift)``: where a line looks for segment i of a partner not longer than itself, shift 0 first.

    Of the segments of a pair, one is unchanged with at most i edits left of it and tau - i right of it: take the first up to whose
    end there are no more than i. So its place moves by i at most, counted from the start, and by tau - i, counted from the end.
    """
    return [(i, i > tau - i, x) for i in range(tau + 1) for x in sorted(range(-min(i, tau - i), min(i, tau - i) + 1), key=abs)]


def segment_rows(lines: DataFrame, steps: Steps) -> DataFrame:
    """``(h, g, key, is_index)`` of every line's keys; ``is_index``: one of its own segments."""
    n = F.length("line")

    def in_step(value, of: Column) -> Column:
        out = F.lit(0)
        for least, _ in sorted(steps):
            out = F.when(of >= least, value(least)).otherwise(out)
        return out

    # the classes one below the other, as in ``classes``
    far = max(steps)[0] + 2 * (max(_class_width(least) for least, _ in steps) + max(tau for _, tau in steps))
    found, top = [], F.col("n")
    for _ in range(max(len(classes(k, steps)) for k in range(far))):
        base = in_step(lambda least: least + F.call_function("div", top - least, F.lit(_class_width(least))).cast("int") * _class_width(least), top)
        found.append(F.struct(base.alias("base"), edits_of(top, steps).alias("tau"), (F.col("n") - top).alias("shorter")))
        top = base - 1
    lines = lines.select("h", "g", "line", n.alias("n"), F.when(F.octet_length("line") == n, F.col("line").cast("binary")).alias("bytes"))
    rows = lines.select("*", F.inline(F.array(*found))).where("tau > 0 and shorter <= tau")
    table = F.lit(None)
    for tau in sorted({tau for _, tau in steps}):
        entries = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(e).alias("from_end"), F.lit(x).alias("shift")) for i, e, x in probes(tau)))
        table = F.when(F.col("tau") == tau, entries).otherwise(table)
    rows = rows.select("*", F.inline(table)).withColumn("size", F.call_function("div", F.col("base"), F.col("tau") + 1).cast("int"))
    i, x, size, tau = F.col("i"), F.col("shift"), F.col("size"), F.col("tau")
    rows = rows.withColumn("start", F.when(F.col("from_end"), F.col("n") - (tau + 1 - i) * size + x).otherwise(i * size + x))
    # of a partner that is shorter by so much, the other end has moved as well
    fits = F.when(F.col("from_end"), x <= i - F.col("shorter")).otherwise(x >= F.col("shorter") - (tau - i))
    rows = rows.where(fits & (F.col("start") >= 0) & (F.col("start") + size <= F.col("n")))
    # in texts of single bytes a place is found without walking there
    piece = F.when(F.col("bytes").isNotNull(), F.substring("bytes", F.col("start") + 1, size)).otherwise(
        F.substring("line", F.col("start") + 1, size).cast("binary"))
    # 48 bits: a chance meeting adds a candidate, no more, and the key takes less room
    key = F.call_function("shiftrightunsigned", F.xxhash64("base", "i", piece), F.lit(16))
    return rows.select("h", "g", key.alias("key"), ((F.col("shorter") == 0) & (x == 0)).alias("is_index"))


def within(a: Column, b: Column, tau: int) -> Column:
    """Are the strings within ``tau`` edits? Banded and bit-parallel; their lengths may differ by ``tau`` at most.

    Column j of the table is b's j-th character; bit k of a word stands for a's prefix of length j - tau + k.
    """
    width = 2 * tau + 1
    full = (1 << width) - 1

    def equal(p: Column, j: Column) -> Column:
        c = F.get(p["b"], j)
        bits = (F.when(F.get(p["a"], j - tau + k).eqNullSafe(c) & (j + k >= tau), 1 << k).otherwise(0) for k in range(width))
        return reduce(lambda x, y: x.bitwiseOR(y), bits)

    def step(acc: Column, eq: Column) -> Column:
        words, before = [], None
        for d in range(tau + 1):
            r = acc[f"r{d}"].bitwiseAND(eq)
            if d:
                less = acc[f"r{d - 1}"]
                r = r.bitwiseOR(less).bitwiseOR(F.shiftright(less, 1)).bitwiseOR(F.shiftleft(before, 1).bitwiseAND(F.lit(full)))
            before = r
            words.append(r.alias(f"r{d}"))
        return F.struct(*words)

    start = F.struct(*(F.lit(((1 << (d + 1)) - 1) << tau).bitwiseAND(F.lit(full)).alias(f"r{d}") for d in range(tau + 1)))
    last = F.length(a) - F.length(b) + tau

    def end(p: Column) -> Column:
        columns = F.when(F.length(b) > 0, F.transform(F.sequence(F.lit(0), F.length(b) - 1), lambda j: equal(p, j)))
        return F.aggregate(F.coalesce(columns, F.array().cast("array<int>")), start, step, lambda acc: acc[f"r{tau}"])

    # the characters are bound to a lambda variable: inside the loops they would be split anew at every step
    chars = F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b"))
    reached = F.get(F.transform(F.array(chars), end), F.lit(0))
    return F.when(F.abs(F.length(a) - F.length(b)) > tau, F.lit(False)).otherwise(
        F.call_function("shiftright", reached, last).bitwiseAND(F.lit(1)) == 1)


def _bound(value: Column, use) -> Column:
    """``use(value)``, the value worked out once: bound to a lambda variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def trimmed(a: Column, b: Column) -> Column:
    """``(a, b)`` without their common beginning and end, found by halving steps; their distance stays the same."""
    steps = F.array(*(F.lit(1 << k) for k in range(12, -1, -1)))

    def same(p: Column, part) -> Column:
        least = F.least(F.length(p["a"]), F.length(p["b"]))
        return F.aggregate(steps, F.lit(0), lambda done, w: F.when(
            (done + w <= least) & (part(p["a"], done, w) == part(p["b"], done, w)), done + w).otherwise(done))

    def middle(p: Column) -> Column:
        at_start = same(p, lambda c, done, w: F.substring(c, done + 1, w))
        rest = _bound(at_start, lambda k: F.struct(*(F.substring(p[c], k + 1, F.length(p[c])).alias(c) for c in ("a", "b"))))
        return _bound(rest, lambda q: _bound(same(q, lambda c, done, w: F.substring(c, F.length(c) - done - w + 1, w)),
                                             lambda k: F.struct(*(F.substring(q[c], F.lit(1), F.length(q[c]) - k).cast("string").alias(c) for c in ("a", "b")))))

    # in texts of single bytes a place is found without walking there
    single = (F.octet_length(a) == F.length(a)) & (F.octet_length(b) == F.length(b))
    return F.when(single, _bound(F.struct(a.cast("binary").alias("a"), b.cast("binary").alias("b")), middle)).otherwise(
        _bound(F.struct(a.alias("a"), b.alias("b")), middle))


def within_steps(a: Column, b: Column, edits: Column, steps: Steps) -> Column:
    """Are the strings within ``edits``, one of the steps' numbers? Spark's own banded distance is compiled, but walks to the band
    anew for every character, so long strings take the bit-parallel one."""
    def check(p: Column) -> Column:
        near = lambda tau: F.when(F.length(p["a"]) <= _LONG, F.levenshtein(p["a"], p["b"], tau) >= 0).otherwise(within(p["a"], p["b"], tau))
        return reduce(lambda rest, tau: F.when(edits == tau, near(tau)).otherwise(rest), sorted({tau for _, tau in steps}), F.lit(False))

    return _bound(trimmed(a, b), check)


def letter_parity(line: Column) -> Column:
    """64 bits: the parity of the number of characters whose code point ends in 0, 1, ... 63. An edit changes two at most."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(c).bitwiseAND(F.lit(63)))
    return F.aggregate(F.split(line, ""), F.lit(0).cast("long"), lambda acc, c: acc.bitwiseXOR(bit(c)))


def distinct_keys(lines: DataFrame, repeats: DataFrame, steps: Steps) -> DataFrame:
    """``segment_rows`` of the different lines, written once: of the lines that repeat, the first occurrence."""
    once = lines.join(_small(repeats.select("h", "g", "first")), ["h", "g"], "left").where(F.col("first").isNull() | (F.col("first") == _here()))
    # hashes: a dictionary of them is built in vain
    return written(segment_rows(once, steps), "line-keys", **{"parquet.enable.dictionary": "false"})


def candidates(lines: DataFrame, rows: DataFrame, steps: Steps) -> tuple[DataFrame, DataFrame]:
    """Rows ``(key, h, g, is_index)`` of the segment keys that two lines meet, and their lines
    ``(h, g, line, first, n, parity, edits, own, keys)``, with the keys among those."""
    # one of the two has the key as its own segment
    met = cut(rows.groupBy("key").agg(F.count("*").alias("n"), F.max("is_index").alias("is_index")).where("n > 1 and is_index").select("key"))
    again = cut(rows.join(_small(met), "key", "left_semi").groupBy("key", "h", "g").agg(F.max("is_index").alias("is_index")))
    keys = again.groupBy("h", "g").agg(F.collect_list("key").alias("keys"), F.collect_list(F.when(F.col("is_index"), F.col("key"))).alias("own"))
    asked = cut(again.select("h", "g").distinct())
    known = (lines.join(_small(asked), ["h", "g"], "left_semi").groupBy("h", "g")
             .agg(F.min("line").alias("line"), F.min(_here()).alias("first")))
    known = (known.withColumn("n", F.length("line")).withColumn("parity", letter_parity(F.col("line")))
             .withColumn("edits", edits_of(F.col("n"), steps)))
    return again, cut(known.join(keys, ["h", "g"]))


def _met(again: DataFrame, known: DataFrame, steps: Steps, links: bool) -> DataFrame:
    """``(h, g, is_near, links)`` of the lines with a partner under the same key, which is a segment of the shorter one's own;
    the later line of a pair looks for the earlier one. Without ``links`` only the lines that have an earlier partner.

    Lines under a key lie in tiles of bounded size, earliest first, so a row leaves the join for a line and a tile, not
    for a pair. A pair that meets under several keys is counted under the least of them.
    """
    size = F.ceil(F.greatest(F.count("*") / _TILE_LINES, F.sum("n") / _TILE_CHARS)).cast("int")
    facts = known.select("h", "g", "first", "n", "parity", "edits")
    rows = cut(again.join(facts, ["h", "g"]))
    sized = _small(cut(rows.groupBy("key").agg(size.alias("tiles")).where("tiles > 1")))
    rows = rows.join(sized, "key", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    held = rows.withColumn("tile", F.pmod(F.xxhash64("h", "g"), "tiles").cast("int")).drop("tiles")
    seek = rows.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).drop("tiles")

    def tiled(rows: DataFrame, *fields: str) -> DataFrame:
        return rows.groupBy("key", "tile").agg(F.sort_array(F.collect_list(F.struct("first", "h", "g", "n", "parity", "edits", "is_index", *fields))).alias("held"))

    def alike(p: Column) -> Column:
        # partners within the shorter line's edits differ in twice as many parities at most: most lines that merely share a segment end here
        edits = F.least(p["edits"], "edits")
        close = (F.abs(p["n"] - F.col("n")) <= edits) & (F.bit_count(p["parity"].bitwiseXOR(F.col("parity"))) <= 2 * edits)
        close &= F.when(p["n"] <= F.col("n"), p["is_index"]).otherwise(F.col("is_index"))
        return (p["first"] < F.col("first")) & close

    hits = cut(seek.join(tiled(held), ["key", "tile"]).where(F.exists("held", alike)).select("key", "tile", "h", "g", "is_index"))
    held = held.join(hits.select("key", "tile").distinct(), ["key", "tile"], "left_semi")
    before = lambda keys: F.filter(keys, lambda k: k < F.col("key"))
    seekers = hits.join(known, ["h", "g"]).withColumn("keys", before("keys")).withColumn("own", before("own"))
    both = seekers.join(tiled(held.join(known.select("h", "g", "line", "keys", "own"), ["h", "g"]), "line", "keys", "own"), ["key", "tile"])

    def near(p: Column) -> Column:
        met = F.when(p["n"] <= F.col("n"), F.arrays_overlap(p["own"], "keys")).otherwise(F.arrays_overlap(p["keys"], "own"))
        a, b, edits = p["line"], F.col("line"), F.least(p["edits"], "edits")
        return alike(p) & ~met & within_steps(a, b, edits, steps)

    if not links:
        return both.where(F.exists("held", near)).select("h", "g", F.lit(True).alias("is_near"), F.lit(0).alias("links"))
    found = both.select("h", "g", F.transform(F.filter("held", near), lambda p: F.struct(p["h"], p["g"], F.lit(False).alias("is_near"), F.lit(1).alias("links"))).alias("found"))
    own = F.struct("h", "g", F.lit(True).alias("is_near"), F.size("found").alias("links"))
    # summed up before the shuffle that follows, so that no pairs go there
    return found.where(F.size("found") > 0).select(F.inline(F.array_append("found", own)))


def near_lines(lines: DataFrame, rows: DataFrame, steps: Steps, links: bool = True) -> DataFrame:
    """``(h, g, is_near, links)``: has the line an earlier different line within the steps' edits, and how many such lines in all
    (0 where not asked for); lines without any are left out. From ``occurrences`` and their ``distinct_keys``."""
    again, known = candidates(lines, rows, steps)
    return cut(_met(again, known, steps, links).groupBy("h", "g").agg(F.max("is_near").alias("is_near"), F.sum("links").alias("links")))


def line_verdicts(df: DataFrame, tau: int | Steps = 2, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, short: bool = False,
                  links: bool = True) -> DataFrame:
    """``(doc_id, text_hash, line_no, is_copy, is_near, links)`` of the lines with an earlier equal line or with links; without
    ``links`` these are not counted, and a search ends at the first earlier partner."""
    steps = as_steps(tau, min_chars)
    lines = occurrences(df, id_col, text_col, min_chars, short)
    occ = written(lines.drop("line"), "line-occurrences")
    # places are compared (in sorted groups) for the lines that repeat only
    times = cut(occ.groupBy("h", "g").agg(F.count("*").alias("times")).where("times > 1"))
    repeats = cut(occ.join(_small(times), ["h", "g"]).groupBy("h", "g").agg(F.min(_here()).alias("first"), F.first("times").alias("times")))
    near = near_lines(lines, distinct_keys(lines, repeats, steps), steps, links)
    facts = cut(repeats.join(near, ["h", "g"], "full"))
    # a line met very often is looked up in a broadcast list of at most rows / _OFTEN lines; its rows are then dealt at random
    often = F.broadcast(facts.where(F.col("times") >= _OFTEN).select("h", "g", F.struct("first", "is_near", "links").alias("much")))
    rest = facts.where(F.coalesce("times", F.lit(1)) < _OFTEN).select("h", "g", F.struct("first", "is_near", "links").alias("some"), F.lit(0).alias("salt"))
    found = occ.join(often, ["h", "g"], "left")
    found = found.withColumn("salt", F.when(F.col("much").isNotNull(), 1 + F.pmod(F.hash("text_hash", "line_no"), F.lit(4096))).otherwise(0))
    found = found.join(_small(rest), ["h", "g", "salt"], "left").withColumn("fact", F.coalesce("much", "some"))
    fact = F.col("fact")
    return (found.select("doc_id", "text_hash", "line_no", F.coalesce(fact["first"] < _here(), F.lit(False)).alias("is_copy"),
                         F.coalesce(fact["is_near"], F.lit(False)).alias("is_near"), F.coalesce(fact["links"], F.lit(0)).alias("links"))
            .where("is_copy or is_near or links > 0"))


def _marked(df: DataFrame, verdicts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_doc`` (the row), ``_lines`` and ``_kept`` (arrays of lines) and ``_v``, the verdicts of its lines by number."""
    v = verdicts.groupBy(F.col("doc_id").alias("_vid"), F.col("text_hash").alias("_vtext")).agg(
        F.sort_array(F.collect_set(F.struct("line_no", "is_copy", "is_near", "links"))).alias("_v"))
    rows = df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_doc"), F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text"))
    both = rows.join(v, F.col("_id").eqNullSafe(F.col("_vid")) & (F.col("_text") == F.col("_vtext")), "left")
    body = F.coalesce(F.col("_doc").getField(text_col), F.lit(""))
    both = both.withColumn("_lines", F.when(F.col("_v").isNotNull(), F.split(body, "\n")))  # a text without verdicts stays whole
    out = F.transform(F.filter("_v", lambda x: x["is_copy"] | x["is_near"]), lambda x: x["line_no"])
    # the stretches between dropped lines
    both = both.withColumn("_edges", F.concat(F.array(F.lit(-1)), out, F.array(F.size("_lines"))))
    kept = F.flatten(F.transform(F.sequence(F.lit(0), F.size("_edges") - 2), lambda t: F.slice(
        "_lines", F.get("_edges", t) + 2, F.get("_edges", t + 1) - F.get("_edges", t) - 1)))
    return both.withColumn("_kept", F.when(F.col("_v").isNotNull(), kept))


def summarise(df: DataFrame, tau: int | Steps = 2, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, short: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_lines, n_copies, n_near, n_links, kept_sha256`` (of the remaining lines joined by newlines)."""
    slim = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = _marked(slim, line_verdicts(slim, tau, min_chars=min_chars, short=short), "doc_id", "text")
    body = F.coalesce(F.col("_doc").getField("text"), F.lit(""))

    def n(which) -> Column:
        return F.coalesce(F.size(F.filter("_v", which)), F.lit(0)).cast("long")

    links = F.coalesce(F.aggregate("_v", F.lit(0).cast("long"), lambda acc, x: acc + x["links"]), F.lit(0)).cast("long")
    n_lines = F.octet_length(body) - F.octet_length(F.replace(body, F.lit("\n"))) + 1
    return both.select(
        F.col("_id").alias("doc_id"), n_lines.cast("long").alias("n_lines"),
        F.when(F.col("_v").isNull(), F.lit(0).cast("long")).otherwise(n(lambda x: x["is_copy"])).alias("n_copies"),
        F.when(F.col("_v").isNull(), F.lit(0).cast("long")).otherwise(n(lambda x: ~x["is_copy"] & x["is_near"])).alias("n_near"),
        links.alias("n_links"),
        F.sha2(F.coalesce(F.array_join("_kept", "\n"), body).cast("binary"), 256).alias("kept_sha256"))


def dedup(df: DataFrame, tau: int | Steps = 2, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, short: bool = False) -> DataFrame:
    """The rows with the dropped lines taken out of their text; other columns unchanged. Rows left without any line go."""
    both = _marked(df, line_verdicts(df, tau, id_col, text_col, min_chars, short, links=False), id_col, text_col)
    whole = F.col("_v").isNull() | (F.size("_kept") == F.size("_lines"))
    body = F.when(whole, F.col("_doc").getField(text_col)).otherwise(F.array_join("_kept", "\n"))
    # the number of kept lines is told from the edges, so that the filter does not build the lines again
    some = F.col("_v").isNull() | (F.size("_lines") > F.size("_edges") - 2)
    return both.where(some).select(F.col("_doc").withField(text_col, body).alias("_doc")).select("_doc.*")
