"""Order-preserving packing of documents into training sequences by dynamic programming.

Documents are read in the order of their input partition, tokenised, ended with
an end token and laid end to end. A dynamic programme chooses the cuts of that
stream into windows of at most ``window`` tokens: it minimises the padding (a
window is padded to ``window`` unless its length is a power of two) plus a
penalty for every cut inside a document, small at a sentence end, larger
elsewhere. The least cost up to a cut needs the minimum over all earlier cuts
within one window of (cost + position), which a monotone queue keeps.

The work stays inside the input's partitions: no shuffle. A task holds one
chunk of ``chunk`` tokens and commits all windows but those near its end, which
go on in the next chunk, so memory does not grow with a document or a partition.

Defined cases: null and empty texts are the end token alone; rows with equal or
null ids are documents of their own; an empty table gives an empty result. A
sentence longer than a window may be cut anywhere, at the larger penalty.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType

from paritylake.llm.common import texts

#: The tokenizer file's pieces (fixed values): contractions, letters, single digits, runs of other signs.
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
#: The same for lower-case texts of the first 256 characters.
_LATIN_PIECE = re.compile("[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|'(?:s|t|re|ve|m|ll|d)|"
                          "[^\x20\x09-\x0d\x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Spelling of bytes in byte-level vocabularies: printable ones as they are, the others from 256 on.
_SPELLING = dict(zip(sorted(set(range(256)) - set(_PLAIN)), range(256, 512)))
#: Cuts inside a gap without a sentence end: one in so many tokens.
_STRIDE = 64


def _is_latin(text: str) -> bool:
    """Only characters below 256: composed already, and lower-cased one by one within that range."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Table(dict):
    """Token ids of pieces met before, as bytes; a new piece is looked up in the model. Full at ``most`` entries."""

    def __init__(self, model, most: int):
        super().__init__()
        self._tokenize, self._most = model.tokenize, most

    def __missing__(self, piece: str) -> bytes:
        spelled = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(_SPELLING)
        ids = array("I", [t.id for t in self._tokenize(spelled)]).tobytes()
        if len(self) < self._most:
            self[piece] = ids
        return ids


class WordTokenizer:
    """A byte-pair tokenizer that lower-cases, drops white space and ends pieces at word ends.

    A text's ids are its pieces' ids in a row, so the pieces are split by the tokenizer file's own pattern and each
    different piece is run through the model once, as long as the table has room.
    """

    def __init__(self, path: str, pieces: int = 1_000_000):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._ids_of = _Table(self._tokenizer.model, pieces).__getitem__
        vocabulary = self._tokenizer.get_vocab()
        ends = [i for t, i in vocabulary.items() if (w := t.removesuffix("</w>")) != t and set(w) <= set(".!?\"')") and set(w) & set(".!?")]
        self.sentence_end = np.zeros(max(vocabulary.values()) + 2, bool)
        self.sentence_end[ends] = True

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, without added special tokens."""
        latin = _is_latin(text)
        # a special token may be spelt, marks may have to be reordered, or a character be newer than this Python's
        # tables: the tokenizer itself
        if "<|" in text or not latin and any(unicodedata.combining(c) or unicodedata.category(c) == "Cn" for c in set(text)):
            return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        if latin:
            pieces = _LATIN_PIECE.findall(text.lower())
        else:
            text = unicodedata.normalize("NFC", text)
            # one character at a time where lower-casing looks at the neighbours
            text = "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()
            pieces = _PIECE.findall(text)
        return np.frombuffer(b"".join(map(self._ids_of, pieces)), np.uint32)


#: Costs lie above, a cut's number below, these bits: the least code names the cut as well. At equal costs a window comes
#: before a power (whose top bit is set) and a later window before an earlier one (numbers run backwards).
_NUMBER_BITS = 24
_NUMBER, _POWER = np.int64((1 << _NUMBER_BITS) - 1), np.int64(1 << _NUMBER_BITS - 1)
_FAR = np.int64(1 << 61)


def _cuts_in_blocks(at: np.ndarray, penalty: np.ndarray, window: int, powers: list[int], end: int) -> tuple[np.ndarray, np.ndarray]:
    """Least cost plus position, and the cut before, of the cuts up to number ``end``.

    A block's cuts lie closer than the smallest power. A window between two of them is worth at most one step: two such
    windows in a row pad more than the one that spans both. So a block needs the costs before it and one running minimum.
    """
    span = min([*powers, window])
    low = np.searchsorted(at, at[:end] - window)
    number = np.arange(end + 1, dtype=np.int64)
    back = np.full((max(1, len(powers)), end), end)
    for row, w in zip(back, powers):
        k = np.searchsorted(at, at[:end] - w)
        row[:] = np.where(at[k] == at[:end] - w, k, end)
    place = at[:end] << _NUMBER_BITS
    pad, extra, own = (window << _NUMBER_BITS) - place, penalty[:end] << _NUMBER_BITS, place + (_POWER - 1 - number[:end])
    step = pad + extra
    code = np.full(end + 1, _FAR)  # cost and own number
    keyed, chosen = np.empty(end, np.int64), np.zeros(end, np.int64)  # cost + position and own number; cost and the cut before
    code[0], keyed[0] = _POWER, own[0]
    scratch = np.empty(int((number[:end] - low).max(initial=0)) + 2, np.int64)
    scratch[0] = _FAR
    ends = np.searchsorted(at[:end], at[:end] + span).tolist()
    s = 1
    while s < end:
        e, first = ends[s], int(low[s])
        # the least cost + position from each cut up to the block: a minimum that runs backwards
        np.minimum.accumulate(keyed[first:s][::-1], out=scratch[1:s - first + 1])
        best = scratch[np.maximum(s - low[s:e], 0)] + pad[s:e]
        best = np.minimum(best, code[back[:, s:e]].min(axis=0)) + extra[s:e]
        running = np.minimum.accumulate((best & ~_NUMBER) + own[s:e])
        best[1:] = np.minimum(best[1:], running[:-1] + step[s + 1:e])
        chosen[s:e] = best
        best &= ~_NUMBER
        code[s:e] = best + (_POWER + number[s:e])
        keyed[s:e] = best + own[s:e]
        s = e
    chosen &= _NUMBER
    return keyed >> _NUMBER_BITS, np.where(chosen >= _POWER, chosen - _POWER, _POWER - 1 - chosen)


def choose_cuts(pos: Sequence[int], penalty: Sequence[int], window: int, powers: list[int], all_powers_from: int, per_window: int = 4) -> list[int]:
    """Indices of the chosen cuts of least total cost among the allowed positions ``pos`` (first and last are taken).

    ``powers`` are lengths that need no padding; from position ``all_powers_from`` on every power of two is tried: there the
    cuts are taken one by one with a monotone queue, before it block by block.
    """
    at, extra = np.asarray(pos, np.int64), np.asarray(penalty, np.int64) + per_window
    late = max(1, int(np.searchsorted(at, all_powers_from)))
    keyed, came = _cuts_in_blocks(at, extra, window, powers, late)
    if late < len(at):
        came = _cuts_one_by_one(at, extra, window, keyed, came)
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(j)
        j = int(came[j])
    return cuts[::-1]


def _cuts_one_by_one(at: np.ndarray, penalty: np.ndarray, window: int, keyed: np.ndarray, came: np.ndarray) -> list[int]:
    """The cut before each cut, where every power of two is tried for the cuts after the ``keyed`` ones."""
    late, from_ = len(keyed), int(np.searchsorted(at, at[len(keyed)] - window))
    pos, extra, keyed, came = at.tolist(), penalty.tolist(), keyed.tolist(), came.tolist()
    every = [1 << k for k in range(window.bit_length() - 1)]
    place = {pos[i]: i for i in range(from_, len(pos))}
    held: deque[int] = deque()  # candidates with cost + position ascending

    def hold(j: int) -> None:
        while held and keyed[held[-1]] >= keyed[j]:
            held.pop()
        held.append(j)

    for j in range(from_, late):
        hold(j)
    for j in range(late, len(pos)):
        p = pos[j]
        while pos[held[0]] < p - window:
            held.popleft()
        i = held[0]
        best = keyed[i] + window - p
        for w in every:
            k = place.get(p - w)
            if k is not None and keyed[k] - pos[k] < best:
                best, i = keyed[k] - pos[k], k
        came.append(i)
        keyed.append(best + extra[j] + p)
        hold(j)
    return came


class _Stream:
    """The token stream of one partition: segments of documents not yet committed, and the sequences so far."""

    def __init__(self, window: int, chunk: int, sentence_end: np.ndarray, sentence: int, inside: int, first_id: int, with_ids: bool):
        self.window, self.chunk, self.sentence_end = window, chunk, sentence_end
        self.sentence, self.inside, self.next_id, self.with_ids = sentence, inside, first_id, with_ids
        self.segments: list[tuple] = []  # (id, start in its document, ids, tokens of the document)
        self.held = 0

    def add(self, doc_id, ids: np.ndarray) -> Iterator[list[tuple]]:
        for at in range(0, len(ids), self.chunk):
            part = ids[at:at + self.chunk]
            self.segments.append((doc_id, at, part, len(ids)))
            self.held += len(part)
            if self.held >= self.chunk:
                yield self.cut(last=False)

    def cut(self, last: bool) -> list[tuple]:
        """Pieces of the committed windows."""
        if not self.held:
            return []
        ids = np.concatenate([s[2] for s in self.segments])
        total = len(ids)
        ends = np.cumsum([len(s[2]) for s in self.segments])
        whole = np.array([s[1] + len(s[2]) == s[3] for s in self.segments])
        at = np.flatnonzero(self.sentence_end[ids]) + 1
        kind = np.full(total + 1, -1, np.int32)
        kind[at] = self.sentence
        kind[0] = kind[total] = 0
        known = np.flatnonzero(kind >= 0)
        gaps = np.flatnonzero(np.diff(known) > 4 * _STRIDE)
        extra = [np.arange(known[g] + _STRIDE, known[g + 1], _STRIDE) for g in gaps.tolist()]
        extra.append(known[known < total - self.window] + self.window)  # a full window after any cut
        if last:  # the end may be cut anywhere, into powers of two
            extra.append(np.arange(max(1, total - self.window), total))
        for e in extra:
            kind[e[kind[e] < 0]] = self.inside
        kind[ends[whole]] = 0
        kind[total] = 0
        pos = np.flatnonzero(kind >= 0)
        powers = [self.window >> k for k in range(1, 4)]
        chosen = choose_cuts(pos, kind[pos], self.window, powers, total - self.window if last else total + 1)
        cuts = pos[chosen]
        if not last:  # windows near the end are chosen again when the stream goes on
            cuts = cuts[cuts <= total - 2 * self.window]
        if not len(cuts):
            return []
        done = int(cuts[-1])
        marks = np.union1d(cuts, ends[ends < done])
        starts = np.concatenate([[0], marks[:-1]])
        doc = np.searchsorted(ends, starts, side="right")
        seq = np.searchsorted(cuts, starts, side="right")
        seq_start = np.concatenate([[0], cuts])[seq]
        seg_start = np.concatenate([[0], ends])[doc]
        out = []
        for s, e, d, q, qs, ds in zip(starts.tolist(), marks.tolist(), doc.tolist(), seq.tolist(), seq_start.tolist(), seg_start.tolist()):
            doc_id, before, _, tokens = self.segments[d]
            raw = ids[s:e].tobytes()
            out.append((doc_id, before + s - ds, e - s, zlib.crc32(raw), tokens, self.next_id + q, s - qs, ids[s:e] if self.with_ids else None))
        self.next_id += len(cuts)
        keep = int(np.searchsorted(ends, done, side="right"))
        rest = self.segments[keep:]
        if rest:
            doc_id, before, part, tokens = rest[0]
            skip = done - (int(ends[keep - 1]) if keep else 0)
            rest[0] = (doc_id, before + skip, part[skip:], tokens)
        self.segments, self.held = rest, total - done
        return out


_TOKENIZERS: dict[str, WordTokenizer] = {}


def pack(df: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048, sentence_penalty: int = 4, inside_penalty: int = 16,
         chunk: int = 1 << 19, with_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked for, their ``ids``.

    ``tokenizer`` is the path of a tokenizer file on every machine. Sequence ids are unique, ascending in a partition.
    """
    slim = texts(df, id_col, text_col)
    schema = slim.select("doc_id").schema
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        schema = schema.add(name, "long")
    kinds = [pa.int64()] * 6
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType()))
        kinds.append(pa.list_(pa.int32()))
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _TOKENIZERS.get(tokenizer) or _TOKENIZERS.setdefault(tokenizer, WordTokenizer(tokenizer))
        stream = _Stream(window, max(chunk, 8 * window), tok.sentence_end, sentence_penalty, inside_penalty,
                         TaskContext.get().partitionId() << 40, with_ids)

        def batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
            cols = list(zip(*rows))
            ids = [pa.array([x.astype(np.int32) for x in cols[7]], kinds[6])] if with_ids else []
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], kind), *(pa.array(c, k) for c, k in zip(cols[1:7], kinds)), *ids], names=schema.names)

        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            for doc_id, text in zip(b.column(0), b.column(1)):
                ids = np.concatenate([tok.encode(text.as_py() or ""), end])
                for rows in stream.add(doc_id.as_py(), ids):
                    if rows:
                        yield batch(rows, kind)
        rows = stream.cut(last=True)
        if rows:
            yield batch(rows, kind)

    return slim.mapInArrow(run, schema)
