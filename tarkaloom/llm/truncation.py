"""Values that lost their end.

1. **Near-copies.** A cut copy is held by its whole one, not similar to it, so banding looks
   for containment.  A value is the sequence of its five-word shingles (hashed; the last
   token, which a cut may have broken, is left out); a text holds it with at least
   ``CONTAINED`` of them.

   * A quote meets the records that it cites (which confirm it): its bands are its least
     hashes, so many that any holder must share one.
   * Texts of records, and quotes that no cited record holds, meet all texts and
     commentaries.  Quotes, which stand word for word or not at all, and texts of few shingles are
     looked up by a key of the whole value (:func:`asked_hits`): texts give the keys of what stands in them
     and how it goes on there, and no pair is made, however many texts hold a stock phrase.
     Other texts meet those that share enough of their rarest shingles (:func:`rare_bands`), so
     that any holder is met, whatever stands between its parts.

   Pairs are aligned: word for word where the value stands in the text as it is, else
   (:func:`alignment`) over the longest chain of common shingles, which must be long
   enough, and the edit distance of the words after it.  The value whose alignment ends early, while the
   other goes on (for quotes: inside the last word), is cut.
2. **Terminality.** What has no copy is scored by its closing words, from 0 (broken
   character or code, a last token that is nowhere a whole word, words that no text
   ends with) to 1; below ``TERMINAL`` it is cut.  For texts the score is the share
   of the sentences beginning with the closing words that end there, a closing formula
   without a stop having a high one.

Quotes of fewer than five words before the last have no shingle; they are looked up as
they stand in the record that they cite.  Only values without a final stop can be cut, so
only these are sought partners for.  An ellipsis is no stop: it marks what was left out.
It is taken off first, so a value is judged by what stands before it ("the ordinary exp…"
is cut, "He came. …" is whole).
"""

from __future__ import annotations

import gc
import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarkaloom.functions.text import WHITE_SPACE, strip_ws
from tarkaloom.operators.hot import salted_join
from tarkaloom.plans.session import stage

SHINGLE, CONTAINED = 5, 0.8
FORMULA_TEXTS, TERMINAL = 2, 0.5

_QUOTES = "\"'”’»"
# An ellipsis: the character, two or more dots, or dots with spaces between, alone or in
# its own brackets.
_DOTS = r"(?:…|\.\.|\s\.(?=\s\.))[….\s]*"
ELLIPSIS = rf"(?:\s*(?:\[\s*{_DOTS}\]|\(\s*{_DOTS}\)|{_DOTS}))"
END_ELLIPSIS = rf"(?U){ELLIPSIS}[\"'”’»\s]*$"
# Ends inside a coded character: replacement sign, open entity, open escape.  No match is
# longer than ``CODE_CHARS``; each begins with one of ``CODE_MARKS``.
BROKEN_CODE = r"(?U)(�|&(#?[xX]?[0-9A-Za-z]{0,8})|\\(u[0-9A-Fa-f]{0,3}|x[0-9A-Fa-f]?)?|%[0-9A-Fa-f]?)$"
CODE_CHARS, CODE_MARKS = 11, "�&\\%"
# What stands after a broken word: a letter, or a joining mark and a letter.
INSIDE = r"[-'’‐]?[\p{L}\p{M}]"
OPEN_END = r"(?U)[\p{L}\p{M}][-'’‐]?$"
LAST_TOKEN = r"(?U)([\p{L}\p{M}]+)$"
_INSIDE = regex.compile(INSIDE)
# Outcomes of an alignment, the surer one larger.
APART, AT_END, WORD_BROKEN, GOES_ON = 0, 1, 2, 3
# The least size of a bitmap that tells which hashes are asked for, and the power of two of the largest.
BITS, MOST_BITS = 1 << 23, 29
# Pieces between the outer ones of a value that is looked up by one key.
RUN = 20
_OTHER_SPACE = regex.compile(r"([^\S ])")
# What may follow a value at the end of a text, which may itself end inside a character.
_REST = regex.compile(rf"{ELLIPSIS}?[\s�]*")


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ b) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class _Words(dict):
    """Hashes of the words that a worker has met."""

    def __missing__(self, w: str) -> int:
        h = self[w] = xxhash.xxh64_intdigest(w)
        return h


class _Numbers(dict):
    """Numbers of the distinct strings that a worker has met."""

    def __init__(self) -> None:
        self.names: list[str] = []

    def __missing__(self, w: str) -> int:
        k = self[w] = len(self.names)
        self.names.append(w)
        return k


def _looked_up(known: dict, each: list[list[str]], kind: type) -> tuple[np.ndarray, np.ndarray]:
    """What ``known`` has for the parts of many texts, and the text of each."""
    n = list(map(len, each))
    return np.fromiter(map(known.__getitem__, chain.from_iterable(each)), kind, sum(n)), np.repeat(np.arange(len(each)), n)


def _shingles(own: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of many texts in order, and the text of each; of the hashes and texts of words."""
    n = max(len(own) - SHINGLE + 1, 0)
    sh = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        sh = _mix(sh, own[k : k + n])
    inside = text[:n] == text[SHINGLE - 1 :]
    return sh[inside], text[:n][inside]


def _shingle_hashes(texts: list[str | None], drop_last: bool, known: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the five-word shingles of many texts in order, and the text of each."""
    words = [(t or "").lower().split() for t in texts]
    if drop_last:
        words = [w[:-1] for w in words]
    if len(known) > 500_000:
        known.clear()
    return _shingles(*_looked_up(known, words, np.uint64))


def _by_text(h: np.ndarray, text: np.ndarray, n: int, null: np.ndarray | None = None) -> pa.ListArray:
    """Hashes as one list per text; ``text`` is sorted.  ``null``: which ones are null."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(n + 1)), pa.int32()), pa.array(h, mask=null))


def _distinct(h: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each text, the least first."""
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], text[new]


def whole_run(n: int) -> int:
    """Of ``n`` shingles with ``CONTAINED`` of them kept: so many in a row are kept for sure.

    A word put in inside breaks ``SHINGLE`` - 1 shingles, a changed or lost one no fewer, so the
    broken ones leave at most broken / (``SHINGLE`` - 1) + 1 runs; changes at the edges
    only shorten the outer runs.
    """
    broken = int(n * (1 - CONTAINED) + 1e-9)
    return max((n - broken) // (broken // (SHINGLE - 1) + 1), 1)


def n_bands(n: int) -> int:
    """How many of ``n`` shingles any holder of ``CONTAINED`` of them must share one of."""
    return n - math.ceil(CONTAINED * n - 1e-9) + 1


def _narrow(h: np.ndarray) -> np.ndarray:
    """The upper halves of hashes, enough to tell the shingles of one record apart."""
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def record_shingles(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    known = _Words()
    for s in texts:
        h, text = _shingle_hashes(s.to_pylist(), False, known)
        yield _by_text(_narrow(h), text, len(s))


@F.arrow_udf(T.ArrayType(T.IntegerType()))
def quote_bands(quotes: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The least hashes of each quote's shingles; none if it has no shingle.

    The first shingle isn't taken where the quote may be held from inside a word and there are others;
    where it is the only one, a null stands beside it: the quote may be held without it.
    """
    known = _Words()
    for s in quotes:
        h, text = _shingle_hashes(s.to_pylist(), True, known)
        n = np.bincount(text, minlength=len(s))
        # from five shingles on there is a second band
        first = np.ones(len(text), bool)
        first[1:] = text[1:] != text[:-1]
        inner = ~first | (n[text] == 1) | (n[text] >= SHINGLE)
        lone = np.flatnonzero(n == 1)
        most = np.array([n_bands(k) for k in range(n.max(initial=0) + 1)])[n]
        h, text = _distinct(h[inner], text[inner])
        n = np.bincount(text, minlength=len(s))
        kept = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n) < most[text]
        h, text = h[kept], text[kept]
        after = np.searchsorted(text, lone, side="right")
        null = np.insert(np.zeros(len(h), bool), after, True)
        yield _by_text(np.insert(_narrow(h), after, 0), np.insert(text, after, lone), len(s), null)


@F.arrow_udf(T.ArrayType(T.LongType()))
def value_bands(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """The shingles of values in order.  A value that is held word for word may begin inside a word,
    so its first shingle is left out where there is another one."""
    known = _Words()
    for texts, exact in batches:
        h, text = _shingle_hashes(texts.to_pylist(), True, known)
        first = np.ones(len(text), bool)
        first[1:] = text[1:] != text[:-1]
        last = np.append(first[1:], True)[: len(text)]
        kept = ~first | last | ~np.array(exact.to_pylist(), bool)[text]
        yield _by_text(h[kept].view(np.int64), text[kept], len(texts))


def _pieces(text: str) -> list[str]:
    """What stands between single spaces; other white space ends a piece and belongs to it."""
    words = text.split()
    if words and " ".join(words) == text:  # no other white space
        return words
    return (_OTHER_SPACE.sub(r"\1 ", text) if _OTHER_SPACE.search(text) else text).split(" ")


def _starts(piece: str) -> np.ndarray:
    """A hash of each beginning of a piece, the shortest first."""
    h, out = 0, []
    for c in piece:
        h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
        h ^= h >> 29
        out.append(h)
    return np.array(out, np.uint64)


class _Pieces:
    """The distinct pieces that a worker has met, by number, with the hashes of their parts."""

    def __init__(self) -> None:
        self.ids = _Numbers()
        self.names = self.ids.names
        # hash, last and first character of each piece, and how many words it has (mostly one)
        self.table = np.empty((0, 3), np.uint64)
        self.n_words = np.empty(0, np.int64)
        # the hashes of the words of all pieces
        self.words = np.empty(0, np.uint64)
        self.parts: dict[tuple[int, bool], np.ndarray] = {}
        self.after: dict[int, np.ndarray] = {}

    def number(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of texts as numbers, and the text of each."""
        if len(self.names) > 500_000:
            self.__init__()
        out = _looked_up(self.ids, [_pieces(t) for t in texts], np.int64)
        if new := self.names[len(self.table) :]:
            rows = [(xxhash.xxh64_intdigest(p), ord(p[-1:] or " "), ord(p[:1] or " ")) for p in new]
            words = [p.lower().split() for p in new]
            self.table = np.concatenate([self.table, np.array(rows, np.uint64)])
            self.n_words = np.concatenate([self.n_words, np.array(list(map(len, words)), np.int64)])
            self.words = np.concatenate([self.words, np.array([xxhash.xxh64_intdigest(w) for ws in words for w in ws], np.uint64)])
        return out

    def word_hashes(self, ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the words of pieces, and the text of each."""
        n, begin = self.n_words[ids], (np.cumsum(self.n_words) - self.n_words)[ids]
        if (n == 1).all():
            return self.words[begin], text
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.words[np.repeat(begin, n) + at], np.repeat(text, n)

    def runs(self, ids: np.ndarray, text: np.ndarray, bitmap: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Of all runs of ``SHINGLE`` - 1 to ``RUN`` pieces between two others: pieces, places, hashes, and hashes with
        the last character before and the first one after.  ``bitmap``: only those whose least beginning is asked for."""
        size = len(ids) - SHINGLE
        if size <= 0:
            return
        own, end, start = self.table[ids].T
        h = np.zeros(size, np.uint64)
        for n in range(1, SHINGLE):
            h = _mix(h, own[n : n + size])
        is_in = text[:size] == text[SHINGLE:]
        at = np.flatnonzero(is_in if bitmap is None else is_in & _asked(bitmap, h))
        h = h[at]
        for n in range(SHINGLE - 1, RUN + 1):
            yield n, at, h, _mix(_mix(h, end[at]), start[at + n + 1] + np.uint64(n << 32))
            at, h = at[more := at + n + 2 < len(ids)], h[more]
            at, h = at[more := text[at] == text[at + n + 2]], h[more]
            h = _mix(h, own[at + n + 1])

    def ends(self, ids: np.ndarray, back: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of all beginnings (``back``: ends) of pieces: their number each, lengths, hashes."""
        each = []
        for k in ids.tolist():
            got = self.parts.get((k, back))
            if got is None:
                got = self.parts[k, back] = _starts(self.names[k][::-1] if back else self.names[k])
            each.append(got)
        n = np.array([len(x) for x in each], np.int64)
        every = np.concatenate([np.empty(0, np.uint64), *each])
        return n, np.arange(len(every)) - np.repeat(np.cumsum(n) - n, n) + 1, every

    def outcome(self, k: int) -> np.ndarray:
        """By the length of a beginning of a piece: how a value ends that ends there (``AT_END`` where the
        words that follow decide)."""
        got = self.after.get(k)
        if got is None:
            w = self.names[k]
            got = self.after[k] = np.array([WORD_BROKEN if _INSIDE.match(w, q) else AT_END if _REST.fullmatch(w, q) else GOES_ON for q in range(len(w) + 1)], np.int8)
        return got


STEPS = ("begin", "first", "part", "whole")


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in STEPS]))
def run_keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Keys of values of few pieces: of the beginning of the run between the outer ones, of the whole run, of it
    with the first one, and of the whole value.  Null for longer values."""
    known = _Pieces()
    for s in batches:
        ids, text = known.number(s.to_pylist())
        size = np.bincount(text, minlength=len(s))
        keys: list[list[int | None]] = [[None] * len(s) for _ in STEPS]
        begins: dict[int, int] = {}
        for n, at, run, h in known.runs(ids, text):
            if not begins:
                begins = dict(zip(at.tolist(), run.view(np.int64).tolist(), strict=True))
            whole = size[text[at]] == n + 2
            for i, first in zip(at[whole].tolist(), h[whole].reshape(-1, 1), strict=True):
                k = text[i]
                before, after = known.names[ids[i]], known.names[ids[i + n + 1]]
                if before and after:
                    part = _mix(first, _starts(before[::-1])[-1:])
                    keys[0][k] = begins[i]
                    for c, x in zip(keys[1:], (first, part, _mix(part, _starts(after)[-1:])), strict=True):
                        c[k] = int(x.view(np.int64)[0])
        yield pa.StructArray.from_arrays([pa.array(k, pa.int64()) for k in keys], names=list(STEPS))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """A bitmap of the ``h`` in it, made by Spark: ``BITS`` bits at least, and eight for each hash."""
    bits = 1 << min(max(hashes.count() * 8 - 1, BITS - 1).bit_length(), MOST_BITS)
    # numbers of a bitmap run from 1
    bit = (F.col("h").bitwiseAND(F.lit(bits - 1)) + 1).alias("bit")
    maps = hashes.select(bit).distinct().groupBy(F.bitmap_bucket_number("bit").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(bits >> 3, np.uint8)
    for r in maps.toLocalIterator():
        out[(r.k - 1) << 12 : r.k << 12] = np.frombuffer(r.bits, np.uint8)
    return out


def _asked(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h & np.uint64(len(bitmap) * 8 - 1)
    return bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


def _stands(known: _Pieces, ids: np.ndarray, text: np.ndarray, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole keys of the values that stand in texts of given pieces, and how they end there: a run that is asked
    for is tried with all ends of the piece before it and all beginnings of the one after it."""
    keys, states = [np.empty(0, np.uint64)], [np.empty(0, np.int8)]
    for n, at, _, h in known.runs(ids, text, bitmap):
        is_in = _asked(bitmap, h)
        at, h = at[is_in], h[is_in]
        size, _, part = known.ends(ids[at], True)
        at, h = np.repeat(at, size), _mix(np.repeat(h, size), part)
        is_in = _asked(bitmap, h)
        at, h = at[is_in] + n + 1, h[is_in]
        size, length, part = known.ends(ids[at], False)
        at, h = np.repeat(at, size), _mix(np.repeat(h, size), part)
        is_in = _asked(bitmap, h)
        at, h, length = at[is_in], h[is_in], length[is_in]
        state = np.array([known.outcome(k)[q] for k, q in zip(ids[at].tolist(), length.tolist(), strict=True)], np.int8)
        more = np.append(text, -1)[at + 1] == text[at]
        keys.append(h)
        states.append(np.where((state == AT_END) & more, GOES_ON, state).astype(np.int8))
    return np.concatenate(keys), np.concatenate(states)


def asked_hits(bodies: DataFrame, bands: DataFrame, runs: DataFrame) -> DataFrame:
    """``h, b, state``: the shingles of texts ``b`` that are likely among ``bands`` (no state), and the keys
    likely among ``runs`` with the surest state of each in some texts (no ``b``).

    What is sent to the executors are two bitmaps.
    """
    sc = bodies.sparkSession.sparkContext
    shared = sc.broadcast((_bitmap(bands), _bitmap(runs)))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces()
        in_bands, in_runs = shared.value
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("text_key").to_numpy()
            ids, text = pieces.number(texts)
            h, t = _shingles(*pieces.word_hashes(ids, text))
            is_in = _asked(in_bands, h)
            h, t = _distinct(h[is_in], t[is_in])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(keys[t]), pa.nulls(len(h), pa.int8())], names=["h", "b", "state"])
            k, state = _stands(pieces, ids, text, in_runs)
            order = np.lexsort((-state, k))
            k, state = k[order], state[order]
            new = np.ones(len(k), bool)
            new[1:] = k[1:] != k[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(k[new].view(np.int64)), pa.nulls(int(new.sum()), pa.int64()), pa.array(state[new])], names=["h", "b", "state"])

    return bodies.select("text_key", "text").mapInArrow(hits, "h long, b long, state byte")


def _chain(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """The longest chain of common shingles (start in ``a``, start in ``b``)."""
    places: dict[tuple[str, ...], list[int]] = {}
    for j in range(len(b) - SHINGLE + 1):
        places.setdefault(tuple(b[j : j + SHINGLE]), []).append(j)
    ends: list[int] = []
    links: list[tuple[int, int, int]] = []
    last: list[int] = []
    for i in range(len(a) - SHINGLE + 1):
        for j in reversed(places.get(tuple(a[i : i + SHINGLE]), ())):
            k = bisect_left(ends, j)
            links.append((i, j, last[k - 1] if k else -1))
            if k == len(ends):
                ends.append(j)
                last.append(len(links) - 1)
            else:
                ends[k] = j
                last[k] = len(links) - 1
    out, at = [], last[-1] if last else -1
    while at >= 0:
        i, j, at = links[at]
        out.append((i, j))
    return out[::-1]


def _place(rest: list[str], last: str, after: list[str]) -> int:
    """The place in ``after`` of the word that ``last`` begins, where the words ``rest`` before it
    align best (edit distance); -1 if there is none."""
    row = list(range(len(after) + 1))
    for i, x in enumerate(rest, 1):
        new = [i]
        for j, y in enumerate(after, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    at = [j for j, y in enumerate(after) if y.startswith(last)]
    return min(at, key=lambda j: (row[j], abs(j - len(rest))), default=-1)


def alignment(value: str, text: str) -> int:
    """How the alignment of a value with a text that holds it ends.

    The common shingles are chained; the words after the chain are placed by edit
    distance, and the last token where they lead: ``WORD_BROKEN`` if the text goes on
    inside it, ``GOES_ON`` if it is whole and words follow, ``AT_END`` if the text ends
    with it, ``APART`` if the two don't agree there.
    """
    a, b = value.lower().split(), text.lower().split()
    chain = _chain(a[:-1], b)
    if not chain or len(chain) < CONTAINED * (len(a) - SHINGLE):
        return APART
    i, j = chain[-1]
    rest, last = a[i + SHINGLE : -1], a[-1].rstrip("�")
    after = b[j + SHINGLE : j + SHINGLE + 2 * len(rest) + 1]
    place = _place(rest, last, after)
    if place < 0:
        return APART
    here, more = after[place], j + SHINGLE + place + 1 < len(b)
    if here == last:
        return GOES_ON if more else AT_END
    return WORD_BROKEN if _INSIDE.match(here, len(last)) else GOES_ON if more or last == "" else AT_END


@F.pandas_udf(T.IntegerType())
def _aligned(values: pd.Series, texts: pd.Series) -> pd.Series:
    return pd.Series([alignment(a, b) for a, b in zip(values, texts, strict=True)], dtype="int32")


def _stopped(c: Column) -> Column:
    """Whole by its last mark: a stop, a verse number between bars or a closed bracket, with
    closing marks.  Nothing but an ellipsis holds no sentence to break."""
    bare = F.rtrim(c, F.lit(_QUOTES + ")]" + WHITE_SPACE))
    closed = F.substring(c, F.length(bare) + 1, F.length(c)).rlike(r"[)\]]")
    return F.right(bare, F.lit(1)).isin(*".?!।॥|") | closed | (c == "")


def without_ellipsis(c: Column) -> Column:
    """The text before a final ellipsis and its closing quotes; other texts as they are."""
    # the pattern would be tried from every place of a text, so it is run only where the
    # last marks leave it a chance
    last = F.right(c, F.lit(1))
    bare = F.when(last.isin(*_QUOTES, *WHITE_SPACE), F.rtrim(c, F.lit(_QUOTES + WHITE_SPACE))).otherwise(c)
    chance = F.right(bare, F.lit(1)).isin("…", ")", "]") | F.right(bare, F.lit(2)).rlike(r"(?U)[.…\s]\.$")
    return F.when(last.isin(*_QUOTES, *WHITE_SPACE, *".…)]") & chance, F.regexp_replace(c, END_ELLIPSIS, "")).otherwise(c)


def _broken_code(c: Column) -> Column:
    return F.right(c, F.lit(CODE_CHARS)).rlike(BROKEN_CODE)


def _last_token(c: Column) -> Column:
    """The letters at the very end, in lower case; '' if there are none."""
    piece = F.element_at(F.split(c, " "), -1)
    return F.lower(F.regexp_extract(piece, LAST_TOKEN, 1))


def _verbatim(value: str, text: str) -> Column:
    """The outcome where a value stands in a text word for word: its places are marked and
    looked at."""
    marked = F.replace(F.col(text), F.col(value), F.lit("\u0002"))
    whole = marked.rlike(rf"(?U)\u0002(?!{INSIDE}|{ELLIPSIS}?(?:\u0001|$))")
    # mostly a look behind the first place is enough
    after = F.substring(F.col(text), F.expr(f"locate({value}, {text})") + F.length(value), F.lit(2))
    return F.when(after.rlike(r"(?U)^(?:\s[\p{L}\p{N}]|[,;:!?।॥])"), GOES_ON).when(whole, GOES_ON).when(marked.rlike(rf"(?U)\u0002{INSIDE}"), WORD_BROKEN).otherwise(AT_END)


def rare_bands(values: DataFrame) -> DataFrame:
    """``text_key, h, need``: the shingles of each value that the fewest values have, and how many of
    them every holder shares.

    Of ``n`` shingles a holder may miss ``n_bands(n) - 1``, and the first one where it holds the value
    word for word from inside a word (which those that are ``short`` are looked up for by their keys); so it
    has all but as many of whatever ones are taken.  The
    more of them, the fewer pairs are compared in vain.
    """
    n = F.size("bands")
    lost = F.when(F.col("exact") | F.col("short") | (n < 2), 0).otherwise(F.greatest(F.floor(n * (1 - CONTAINED) + 1e-9).cast("int"), F.lit(1)))
    v = values.select("text_key", lost.alias("lost"), F.greatest(F.floor(n / 8).cast("int") + 1, F.lit(2)).alias("more"), F.array_distinct("bands").alias("bands"))
    each = v.select("text_key", "lost", "more", F.explode("bands").alias("h"))
    counted = each.join(each.groupBy("h").agg(F.count("*").alias("n")), "h")
    ranked = counted.groupBy("text_key").agg(F.max("lost").alias("lost"), F.max("more").alias("more"), F.sort_array(F.collect_list(F.struct("n", "h"))).alias("all"))
    taken = F.slice("all", F.lit(1), F.col("lost") + F.col("more"))
    need = F.greatest(F.size("taken") - F.col("lost"), F.lit(1))
    return ranked.withColumn("taken", taken).select("text_key", need.alias("need"), F.explode("taken.h").alias("h"))


def cut_copies(values: DataFrame, bodies: DataFrame) -> DataFrame:
    """``text_key, state`` of values that some other text holds.

    ``values``: distinct ``text_key, text, exact`` that may be cut (``exact``: held word for word
    or not at all).  ``bodies``: distinct ``text_key, text`` that may hold them.  What stands word
    for word in a text and goes on there is settled by its key; each pair of other values with enough
    common bands is aligned; a value that stands in the text as it is needs no more than that.
    ``state`` is the surest outcome of all; values without a shingle or a holder give no row, nor do
    those looked up by their key only that just stand at the ends of texts.
    """
    # a text may end inside a character, which no holder has
    ends = F.when(F.col("exact"), F.col("text")).otherwise(F.rtrim(F.col("text"), F.lit("�")))
    v = values.withColumns({"bands": value_bands("text", "exact"), "run": run_keys(ends)}).where(F.size("bands") > 0)
    v = stage(v.withColumn("short", F.col("run.whole").isNotNull() & (F.col("exact") | (F.size("bands") < SHINGLE))), "values")
    keys = v.where("short").select("text_key", F.col("run.whole").alias("h"), "run")
    # a value that its key settles word for word needs no pairs
    bands = stage(rare_bands(v.where("not (short and exact)")), "bands")
    steps = F.explode(F.array(*[f"run.{c}" for c in STEPS])).alias("h")
    hits = stage(asked_hits(bodies, bands.select("h"), keys.select(steps)), "hits")
    stood = stage(keys.select("text_key", "h").join(hits.where("state is not null").groupBy("h").agg(F.max("state").cast("int").alias("state")), "h").where(F.col("state") > AT_END).select("text_key", "state"), "stood")
    open_bands = bands.join(stood, "text_key", "left_anti")
    shared = open_bands.join(hits.where("state is null").select("h", "b"), "h").where("b <> text_key").groupBy("text_key", "b").agg(F.count("*").alias("n"), F.first("need").alias("need"))
    pairs = shared.where("n >= need").select("text_key", "b")
    both = pairs.join(v.select("text_key", "text", "exact"), "text_key").join(bodies.select(F.col("text_key").alias("b"), F.col("text").alias("body")), "b")
    here = F.col("body").contains(F.col("text"))
    state = F.when(here, _verbatim("text", "body")).when(F.col("exact"), APART).alias("state")
    both = both.where(here | ~F.col("exact"))
    loose = ~here & ~F.col("exact")
    some = stage(both.select("text_key", state, *[F.when(loose, F.col(c)).alias(c) for c in ("text", "body")]), "aligned")
    more = some.where("state is null").select("text_key", _aligned("text", "body").alias("state"))
    states = some.where("state is not null").select("text_key", "state").unionByName(more).unionByName(stood)
    return states.where(F.col("state") > APART).groupBy("text_key").agg(F.max("state").alias("state"))


def whole_words(texts: DataFrame) -> DataFrame:
    """``token`` of every word that stands before another one in some text.

    Pieces between spaces are made distinct first (by each task), so the pattern that cuts
    words out of them runs over distinct pieces, not over all texts.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[str] = set()
        for batch in batches:
            for t in batch.column("text").to_pylist():
                seen.update(t.lower().split()[:-1])
            if len(seen) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string())], names=["piece"])
                seen.clear()
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.string())], names=["piece"])

    piece = texts.select("text").mapInArrow(pieces, "piece string").distinct()
    return piece.select(F.explode(F.split("piece", r"(?U)[^\p{L}\p{M}]+")).alias("token")).where("token <> ''").distinct()


def terminality(texts: DataFrame, known: DataFrame) -> DataFrame:
    """``text_key, score`` of distinct unstopped texts by their closing words.

    An ending is split into its first words (``lead``) and its last one.  The score is
    the share, of all sentences beginning so (the last word possibly going on), that end
    there; or, for formulas with a changing last word that is known and never longer,
    the same share for the first words alone, if there are more than two of them.  Endings of
    fewer than ``FORMULA_TEXTS`` different texts score 0.
    """
    lead = lambda ws, k: F.array_join(F.slice(ws, F.lit(1), k), " ")
    head = lambda ws, k: F.array_join(F.slice(ws, F.lit(1), F.least(k, F.lit(2))), " ")
    ended = texts.where("not stopped").select("text_key", F.split(ending(F.col("text")), " ").alias("ws")).where(F.size("ws") > 1)
    n = F.size("ws") - 1
    ended = stage(ended.select("text_key", lead(F.col("ws"), n).alias("lead"), head(F.col("ws"), n).alias("head"), F.element_at("ws", -1).alias("last"), n.alias("n")), "endings")
    leads = ended.groupBy("lead").agg(F.count("*").alias("n_lead"), F.max("n").alias("n"), F.max("head").alias("head")).where(F.col("n_lead") >= FORMULA_TEXTS)
    leads = stage(leads, "leads")
    # sentences that begin as some lead does, cut at the lengths of those leads
    heads = leads.groupBy("head").agg(F.collect_set("n").alias("lengths"))
    sentence = F.explode(F.split(plain(F.col("text")), r"(?U)(?<=[.?!।॥|])\s+")).alias("s")
    s = texts.select(sentence).where(F.col("s").contains(" "))
    one, two = F.substring_index("s", " ", 1), F.substring_index("s", " ", 2)
    keyed = s.select("s", F.explode(F.array(one, F.when(F.col("s") != two, two))).alias("head")).where("head is not null").join(heads, "head")
    steps = keyed.select(F.split("s", " ").alias("ws"), F.explode("lengths").alias("k")).where(F.col("k") < F.size("ws"))
    begun = steps.select(lead(F.col("ws"), F.col("k")).alias("lead"), F.element_at("ws", F.col("k") + 1).alias("next")).join(leads.select("lead"), "lead", "left_semi")
    begun = stage(begun.groupBy("lead", "next").agg(F.count("*").alias("n_next")), "begun")
    pairs = ended.groupBy("lead", "last").agg(F.count("*").alias("n_end")).join(leads.drop("head"), "lead").join(begun, "lead")
    goes_on = F.col("next").startswith(F.col("last"))
    sums = pairs.groupBy("lead", "last", "n_end", "n_lead", "n").agg(F.sum(F.when(goes_on, F.col("n_next")).otherwise(0)).alias("n_begin"), F.sum(F.when(goes_on & (F.col("next") != F.col("last")), F.col("n_next")).otherwise(0)).alias("n_longer"), F.sum("n_next").alias("n_all"))
    same = F.when(F.col("n_end") >= FORMULA_TEXTS, F.col("n_end") / F.col("n_begin")).otherwise(0.0)
    sums = sums.withColumn("token", F.lower(F.regexp_extract("last", LAST_TOKEN, 1))).join(known.withColumn("known", F.lit(True)), "token", "left")
    slot = F.when((F.col("n") > 2) & F.col("known") & (F.col("n_longer") == 0), F.col("n_lead") / F.col("n_all")).otherwise(0.0)
    scores = sums.select("lead", "last", F.least(F.greatest(same, slot), F.lit(1.0)).alias("score"))
    return ended.join(scores, ["lead", "last"]).select("text_key", "score")


def plain(c: Column) -> Column:
    """Numbers made equal, white space single."""
    return F.regexp_replace(F.regexp_replace(strip_ws(c), r"(?U)\d+", "0"), r"(?U)\s+", " ")


def ending(c: Column) -> Column:
    """The words after the last stop."""
    return F.element_at(F.split(plain(c), r"(?U)(?<=[.?!।॥|])\s+"), -1)


def _filled(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).rlike(r"(?U)\S"))


def _settled(df: DataFrame, c: str) -> DataFrame:
    """``df`` with ``c`` as the output of a generator: a filter on it is not moved below, where Spark would
    put the whole expression of ``c`` into it, once for each mention of the columns that it is made of."""
    return df.select(*[x for x in df.columns if x != c], F.explode(F.array(c)).alias(c))


def record_texts(records: DataFrame) -> DataFrame:
    """``row_key, source, text, text_key, stopped`` of filled texts, without a final ellipsis."""
    texts = _filled(records, "text").select(F.col("rec_no").cast("string").alias("row_key"), "source", without_ellipsis(strip_ws(F.col("text"))).alias("text"))
    return _settled(texts.withColumns({"text_key": F.xxhash64("text"), "stopped": _stopped(F.col("text"))}), "stopped")


def edge_quotes(edges: DataFrame) -> DataFrame:
    """``edge_id, source, ref, quote, end`` of filled quotes, without a final ellipsis.  ``end``: ``code`` inside a
    coded character, else ``open`` after a letter, else empty."""
    quotes = _filled(edges, "evidence_quote").select("edge_id", F.col("source_text").alias("source"), _ref("source_record_id").alias("ref"), without_ellipsis(strip_ws(F.col("evidence_quote"))).alias("quote"))
    end = F.when(_broken_code(F.col("quote")), "code").when(F.right("quote", F.lit(2)).rlike(OPEN_END), "open").otherwise("")
    return _settled(quotes.withColumn("end", end), "end")


def record_bodies(records: DataFrame) -> DataFrame:
    """All texts of records and their commentaries, without a final ellipsis: ``text``."""
    own = records.select("text")
    every = own.unionByName(records.select(F.explode("commentaries.text").alias("text")))
    return _filled(every, "text").select(without_ellipsis(strip_ws(F.col("text"))).alias("text"))


def _ref(c: str) -> Column:
    return F.nullif(strip_ws(F.lower(c)), F.lit(""))


def cited_states(quotes: DataFrame, records: DataFrame, refs: DataFrame) -> DataFrame:
    """``edge_id, source, quote, state``: how each quote's alignment with the records that it
    cites ends (``APART`` if none holds it).

    ``quotes``: ``edge_id, source, ref, quote``; ``refs``: their ``ref`` alone, to count.  A quote
    and a record of one reference are aligned if a band of the quote is among the record's
    shingles; quotes without a shingle are looked up as they stand.  Only quotes that their
    record doesn't show to be whole keep their text.
    """
    bodies = F.array_join(F.filter(F.concat(F.array("text"), F.coalesce(F.col("commentaries.text"), F.array().cast("array<string>"))), lambda t: t.isNotNull()), "\u0001")
    held = records.select(F.array_distinct(F.array(_ref("id"), _ref("_original_id"))).alias("refs"), bodies.alias("body"))
    # one sketch per record: the end of one text and the start of the next share no shingle
    held = held.withColumn("held", record_shingles(F.replace("body", F.lit("\u0001"), F.lit(" \u0001 "))))
    held = held.select(F.explode("refs").alias("ref"), "body", "held").where("ref is not null")
    q = quotes.withColumn("bands", quote_bands("quote")).withColumn("short", F.size("bands") == 0)
    j = salted_join(q, held, "ref", "edge_id", "left", keys=refs)
    short = F.col("short")
    stands = F.col("body").contains(F.col("quote"))
    # (a null band leaves it to the text)
    pair = F.coalesce(F.col("body").isNotNull() & short | F.coalesce(F.arrays_overlap("bands", "held"), stands), F.lit(False))
    state = F.when(~pair, APART).when(stands, _verbatim("quote", "body")).when(short, APART)
    j = j.select("edge_id", "source", "quote", F.col("body").alias("_body"), state.alias("state"))
    # (null) pairs that differ somewhere: aligned in full
    loose = F.when(F.col("state").isNull(), F.col("_body"))
    kept = lambda c: F.when(F.coalesce(F.col("state") < GOES_ON, F.lit(True)), F.col(c)).alias(c)
    j = stage(j.select("edge_id", kept("source"), kept("quote"), loose.alias("loose"), "state"), "cited")
    more = j.where("state is null").select("edge_id", "source", "quote", _aligned("quote", "loose").alias("state"))
    every = j.where("state is not null").drop("loose").unionByName(more)
    return every.groupBy("edge_id").agg(F.max("source").alias("source"), F.max("quote").alias("quote"), F.max("state").alias("state"))


def cut_values(records: DataFrame, edges: DataFrame) -> DataFrame:
    """``tbl, row_key, source, reason, score`` of every value without its end.

    Null and blank values are no cases.  ``reason``: ``copy`` (a copy or the cited
    record goes on), ``code`` (inside a coded character), ``word`` (inside a word) or
    ``sentence``; the last three with the score of their end, null for copies.  A
    repeated record row is reported each time, an edge once per id.
    """
    recs = records.select("rec_no", "source", "text", "commentaries", "id", "_original_id")
    texts = record_texts(recs)
    open_texts = stage(texts.where("not stopped"), "open_texts")
    bodies = stage(record_bodies(recs).distinct().withColumn("text_key", F.xxhash64("text")), "texts")

    # (a look for marks is cheaper than a second pass over all quotes)
    marked = reduce(Column.__or__, [F.contains("evidence_quote", F.lit(m)) for m in CODE_MARKS])
    coded = edge_quotes(edges.where(marked)).where("end = 'code'").select("edge_id", "source", F.lit("code").alias("reason"), F.lit(0.0).alias("score"))
    refs = _settled(edges.select(_ref("source_record_id").alias("ref")), "ref")
    cited = stage(cited_states(edge_quotes(edges).where("end = 'open'").drop("end"), recs, refs).where(F.col("state") < GOES_ON), "quotes")
    # the files of finished shuffles are deleted when the driver collects its garbage
    gc.collect()
    records.sparkSession.sparkContext._jvm.System.gc()
    unmatched = cited.where(F.col("state") < WORD_BROKEN).select("edge_id", "source", "quote", F.xxhash64("quote").alias("text_key"))

    values = open_texts.select("text_key", "text", F.lit(False).alias("exact")).unionByName(unmatched.select("text_key", F.col("quote").alias("text"), F.lit(True).alias("exact")))
    values = values.groupBy("text_key").agg(F.first("text").alias("text"), F.min("exact").alias("exact"))
    copies = stage(cut_copies(values, bodies), "copies")
    tails = open_texts.select("text").unionByName(unmatched.select(F.col("quote").alias("text")))
    asked = tails.select(_last_token(F.col("text")).alias("token")).where("token <> ''").distinct()
    known = stage(asked.join(whole_words(bodies), "token", "left_semi"), "known")
    once = stage(texts.select("text_key", "text", "stopped").distinct(), "distinct_texts")
    closers = stage(terminality(once, known), "terminality")

    t = open_texts.withColumn("token", _last_token(F.col("text")))
    t = t.join(copies, "text_key", "left").join(closers, "text_key", "left").join(known.withColumn("known", F.lit(True)), "token", "left")
    unknown = (F.col("token") != "") & F.col("known").isNull()
    score = F.when(_broken_code(F.col("text")), 0.0).otherwise(F.coalesce("score", F.lit(0.0)))
    copy = F.col("state").isin(WORD_BROKEN, GOES_ON)
    reason = F.when(copy, "copy").when(_broken_code(F.col("text")), "code").when(score >= TERMINAL, None).when(unknown, "word").otherwise("sentence")
    of_texts = t.select(F.lit("corpus_record").alias("tbl"), "row_key", "source", reason.alias("reason"), F.when(copy, None).otherwise(score).alias("score")).where("reason is not null")

    none = F.lit(None).cast("double").alias("score")
    sure = coded.unionByName(cited.where(F.col("state") == WORD_BROKEN).select("edge_id", "source", F.lit("copy").alias("reason"), none))
    # quotes that no cited record settles: by their copies elsewhere, else by the last word
    left = unmatched.withColumn("token", _last_token(F.col("quote"))).join(copies, "text_key", "left").join(known.withColumn("known", F.lit(True)), "token", "left")
    broken, whole = F.col("state") == WORD_BROKEN, F.col("state") >= GOES_ON
    why = F.when(broken, "copy").when(F.coalesce(whole, F.lit(False)) | F.col("known").isNotNull() | (F.col("token") == ""), None).otherwise("word")
    scored = left.select("edge_id", "source", why.alias("reason"), F.when(broken, None).otherwise(0.0).alias("score")).where("reason is not null")
    of_quotes = sure.unionByName(scored).select(F.lit("graph_edge").alias("tbl"), F.col("edge_id").alias("row_key"), "source", "reason", "score")
    return of_texts.unionByName(of_quotes)


def cut_rates(found: DataFrame, records: DataFrame, edges: DataFrame) -> DataFrame:
    """Values, cut values and their rate per table and source."""
    totals = _filled(records, "text").select(F.lit("corpus_record").alias("tbl"), "source").unionByName(_filled(edges, "evidence_quote").select(F.lit("graph_edge").alias("tbl"), F.col("source_text").alias("source")))
    n = totals.groupBy("tbl", F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n_values"))
    c = found.groupBy("tbl", F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    cut = F.coalesce("n", F.lit(0))
    return n.join(c, ["tbl", "source"], "left").select("tbl", "source", "n_values", cut.alias("n_cut"), F.round(cut / F.col("n_values"), 6).alias("rate"))
