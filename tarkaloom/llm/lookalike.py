"""One consistent form for text that looks alike.

1. compatibility normalization of full-width and half-width forms, ligatures and
   kinds of space; deletion of ignorable characters; canonical decomposition;
2. every token becomes a lattice: at each place stand all letters of the look-alike
   class of the letter found there, so tokens that look alike have the same lattice;
3. Viterbi finds the best path under character-bigram scores counted over the whole
   corpus, with a penalty for each change of script inside a token;
4. composition (NFC).

As the lattice doesn't depend on which of the look-alikes was written, texts that
look alike get the same form, and letter case, accents and punctuation stay.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarkaloom.plans.session import stage

# Look-alike letters (Latin letter, then its twins in other scripts).
LOOKALIKES = {
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һ", "i": "іıι", "j": "јϳ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ",
    "q": "ԛ", "s": "ѕ", "u": "υս", "v": "νѵ", "w": "ԝ", "x": "хχ", "y": "уγ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "F": "Ϝ", "G": "Ԍ", "H": "НΗ", "I": "ІΙӀ", "J": "ЈͿ", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟՕ",
    "P": "РΡ", "Q": "Ԛ", "S": "Ѕ", "T": "ТΤ", "V": "Ѵ", "W": "Ԝ", "X": "ХΧ", "Y": "УΥҮ", "Z": "Ζ",
}

_CLASS = {c: k + v for k, v in LOOKALIKES.items() for c in k + v}
_FIRST = {ord(c): k for k, v in LOOKALIKES.items() for c in v}
_TOKEN = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_IGNORABLE = regex.compile(r"\p{Default_Ignorable_Code_Point}|[\p{Cf}--[؀-؅۝܏]]", regex.V1)
SWITCH = 6.0


class _Compat(dict):
    """Translation table filled as characters turn up."""

    def __missing__(self, code: int):
        ch = chr(code)
        tag, _, rest = unicodedata.decomposition(ch).partition(" ")
        if code in (10, 13):
            out = ch
        elif _IGNORABLE.match(ch):
            out = None
        elif unicodedata.category(ch) == "Zs":
            out = " "
        elif tag in ("<wide>", "<narrow>", "<noBreak>") or 0xFB00 <= code <= 0xFB4F and tag == "<compat>":
            out = unicodedata.normalize("NFKC", ch)
        else:
            out = ch
        self[code] = out
        return out


_COMPAT = _Compat()


def base_form(text: str) -> str:
    """Compatibility forms, spaces and ignorables settled; canonical decomposition."""
    return unicodedata.normalize("NFD", text.translate(_COMPAT))


class _Letters(dict):
    """Per character: first letter of its look-alike class in lower case; a space for
    what is no letter; nothing for marks."""

    def __missing__(self, code: int):
        ch = chr(code)
        kind = unicodedata.category(ch)[0]
        out = None if kind == "M" else _FIRST.get(code, ch) if kind == "L" else " "
        self[code] = out
        return out


_LETTERS = _Letters()


def plain_words(text: str) -> list[str]:
    """Words as runs of letters, without case, accents or choice of look-alikes."""
    t = base_form(text).translate(_LETTERS).lower()
    return base_form(t).translate(_LETTERS).split()


def script(ch: str) -> str:
    o = ord(ch)
    return "G" if 0x370 <= o < 0x400 else "C" if 0x400 <= o < 0x530 else "A" if 0x530 <= o < 0x590 else "L" if o < 0x250 or 0x1E00 <= o < 0x1F00 else "O" if ch.isalpha() else ""


class Lattice:
    """Viterbi over look-alike lattices; results are kept for repeated tokens."""

    def __init__(self, bigrams: dict[tuple[str, str], int], keep: int = 200_000) -> None:
        totals: dict[str, int] = {}
        for (a, _), n in bigrams.items():
            totals[a] = totals.get(a, 0) + n
        self._log = {ab: math.log((n + 0.1) / (totals[ab[0]] + 100)) for ab, n in bigrams.items()}
        self._unseen = {a: math.log(0.1 / (n + 100)) for a, n in totals.items()}
        self._kept: dict[str, str] = {}
        self._keep = keep

    def _score(self, a: str, b: str) -> float:
        s = self._log.get((a, b))
        if s is None:
            s = self._unseen.get(a, -6.9)
        x, y = script(a), script(b)
        return s - (SWITCH if x and y and x != y else 0.0)

    def token(self, token: str) -> str:
        got = self._kept.get(token)
        if got is None:
            if len(self._kept) >= self._keep:
                self._kept.clear()
            got = self._kept[token] = self._best(token)
        return got

    def _best(self, token: str) -> str:
        letters = [(i, c) for i, c in enumerate(token) if not unicodedata.category(c).startswith("M")]
        paths = [(0.0, "", "^")]
        for _, c in letters:
            nxt = []
            for o in _CLASS.get(c, c):
                # ties go to the earlier letter of the class, whatever was written
                s, out, _ = max(((p + self._score(last, o), out, last) for p, out, last in paths), key=lambda x: x[0])
                nxt.append((s, out + o, o))
            paths = nxt
        s, out, _ = max(((p + self._score(last, "$"), out, last) for p, out, last in paths), key=lambda x: x[0])
        chars = list(token)
        for (i, _), o in zip(letters, out, strict=True):
            chars[i] = o
        return "".join(chars)

    def text(self, text: str) -> str:
        return unicodedata.normalize("NFC", _TOKEN.sub(lambda m: self.token(m[0]), base_form(text)))


_PAIRS = T.ArrayType(T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("n", T.LongType())]))


@F.pandas_udf(_PAIRS)
def _bigrams(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Bigram counts per batch (in its first row) of places where a look-alike stands."""
    for s in texts:
        seen: dict[tuple[str, str], int] = {}
        words: dict[str, int] = {}
        for t in s:
            for w in _TOKEN.findall(base_form(t)) if t else ():
                words[w] = words.get(w, 0) + 1
        for w, n in words.items():
            w = "^" + "".join(c for c in w if not unicodedata.category(c).startswith("M")) + "$"
            for a, b in zip(w, w[1:], strict=False):
                if a in _CLASS or b in _CLASS:
                    seen[a, b] = seen.get((a, b), 0) + n
        yield pd.Series([[{"a": a, "b": b, "n": n} for (a, b), n in seen.items()], *([None] * (len(s) - 1))][: len(s)])


def bigram_scores(docs: DataFrame, text: str = "text") -> Lattice:
    """Bigrams counted over all texts.  Only pairs with a letter of ``LOOKALIKES`` are
    kept, so the table that reaches the driver is bounded by that many letters times
    the letters of all alphabets, at any corpus size."""
    rows = docs.select(F.inline(_bigrams(text))).groupBy("a", "b").agg(F.sum("n").alias("n")).collect()
    return Lattice({(r.a, r.b): r.n for r in rows})


def consistent(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text, form, form_key, text_key`` for every document with a text.

    Null texts give no row; an empty text has an empty form; repeated rows stay.
    """
    lattice = bigram_scores(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(lattice)

    @F.pandas_udf(T.StringType())
    def form(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        path = shared.value
        for s in texts:
            yield s.map(lambda t: path.text(t), na_action="ignore")

    d = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    d = d.withColumn("form", form("text"))
    return d.withColumns({"form_key": F.md5("form"), "text_key": F.md5("text")})


def alike_pairs(forms: DataFrame) -> DataFrame:
    """Pairs of documents of one form but different texts, ``doc_id_a < doc_id_b``.

    Groups whose texts are all equal, however large, end at the first aggregation,
    which is combined map-side; only mixed groups are joined, and AQE splits a
    group that is too large for one task.
    """
    keys = stage(forms.select("doc_id", "form_key", "text_key").distinct(), "forms")
    mixed = keys.groupBy("form_key").agg(F.min("text_key").alias("lo"), F.max("text_key").alias("hi")).where("lo <> hi").select("form_key")
    rows = stage(keys.join(mixed, "form_key", "left_semi"), "mixed")
    a = rows.select(F.col("doc_id").alias("doc_id_a"), "form_key", F.col("text_key").alias("ta"))
    b = rows.select(F.col("doc_id").alias("doc_id_b"), "form_key", F.col("text_key").alias("tb"))
    return a.join(b, "form_key").where("doc_id_a < doc_id_b and ta <> tb").select("doc_id_a", "doc_id_b")
