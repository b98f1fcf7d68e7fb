"""Languages of commentaries and of the segments of mixed ones.

The script of a word narrows its candidate languages; every word has a score per
candidate (smoothed word frequency, backed off to character trigrams), and Viterbi
with a switching penalty labels the spans of a text.  Sentences take the language
that holds most of their words' path; single foreign words don't make a sentence.

The scores are fitted on labelled documents: at most ``sample_per_lang`` of each
language, chosen by a hash of the id.  Counting is a Spark aggregation; only the
fitted tables (bounded by that sample) go to the driver.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarkaloom.llm.concept_match import latin

SAMPLE_PER_LANG = 1_500
SWITCH = 9.0
MIN_WORDS = 3

# Which of the languages a script admits.
SCRIPTS = {"latin": ("en", "de", "fr", "hi", "sa", "pi"), "devanagari": ("hi", "sa", "pi")}
# Ways to name each language (codes of two and three letters, names).
NAMES = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "hi": ("hi", "hin", "hindi", "हिन्दी", "हिंदी"),
    "sa": ("sa", "san", "sanskrit", "संस्कृतम्", "संस्कृत"),
    "pi": ("pi", "pli", "pali", "pāli", "पालि"),
}
_BY_NAME = {n: code for code, names in NAMES.items() for n in names}

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}'’]*")
_SENTENCE = regex.compile(r"[^.?!।॥|\n]+(?:[.?!।॥|]+[\"'”’»)\]]*|\n|$)")
_QUOTE = regex.compile(r"[“”„«»\"]")


def label_code(label: str | None) -> str | None:
    """The language a label names: codes with region or script, names, any case."""
    if label is None:
        return None
    t = unicodedata.normalize("NFC", label).strip().lower()
    return _BY_NAME.get(t) or _BY_NAME.get(regex.split(r"[-_ (]", t)[0])


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(unicodedata.normalize("NFC", text))]


@F.pandas_udf(T.ArrayType(T.StringType()))
def _words(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: words_of(t) if t else [])


def _script(word: str) -> str:
    c = word[0]
    return "devanagari" if "ऀ" <= c <= "ॿ" else "latin"


# Informal spellings of one sound in romanised text.
_INFORMAL = (("chh", "c"), ("ch", "c"), ("sh", "s"), ("aa", "a"), ("ee", "i"), ("oo", "u"), ("w", "v"))


def sound(word: str) -> str:
    """A word of either script as plain Latin letters, informal spellings settled."""
    t = latin(word.replace("़", "").replace("ं", "न्").replace("ँ", "न्"))
    t = "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))
    for a, b in _INFORMAL:
        t = t.replace(a, b)
    return t


def romanised(lang: str, word: str) -> set[str]:
    """Sounds of a Devanagari word; modern Hindi drops the final short vowel."""
    t = sound(word)
    return {t, t[:-1]} if lang == "hi" and t.endswith("a") and "ऀ" <= word[-1] <= "ह" and len(t) > 2 else {t}


class WordScores:
    """Log scores per word and language.

    Words unknown as written are looked up by their sound, so that text of an Indian
    language is known in both scripts even if only one was labelled.
    """

    def __init__(self, words: dict[tuple[str, str], int]) -> None:
        self.langs = sorted({lang for lang, _ in words})
        self._n: dict[str, list[float]] = {}
        tri: dict[str, list[float]] = {}
        k = len(self.langs)
        self._total, tri_total = [0.0] * k, [0.0] * k
        for (lang, w), n in words.items():
            i = self.langs.index(lang)
            self._n.setdefault(w, [0.0] * k)[i] += n
            self._total[i] += n
            p = f"^{w}$"
            for j in range(len(p) - 2):
                tri.setdefault(p[j : j + 3], [0.0] * k)[i] += math.sqrt(n)
                tri_total[i] += math.sqrt(n)
        self._sound: dict[str, list[float]] = {}
        for (lang, w), n in words.items():
            if _script(w) == "devanagari":
                i = self.langs.index(lang)
                for t in romanised(lang, w):
                    self._sound.setdefault(t, [0.0] * k)[i] += n
                    p = f"^{t}$"
                    for j in range(len(p) - 2):
                        tri.setdefault(p[j : j + 3], [0.0] * k)[i] += math.sqrt(n)
        self._tri = {g: [math.log((c + 0.2) / (tri_total[i] + 500)) for i, c in enumerate(cs)] for g, cs in tri.items()}
        self._tri_none = [math.log(0.2 / (t + 500)) for t in tri_total]
        self._kept: dict[str, list[float]] = {}

    def score(self, word: str) -> list[float]:
        got = self._kept.get(word)
        if got is None:
            if len(self._kept) > 200_000:
                self._kept.clear()
            got = self._kept[word] = self._score(word)
        return got

    def _score(self, word: str) -> list[float]:
        p = f"^{word}$"
        grams = [p[j : j + 3] for j in range(len(p) - 2)]
        known = self._n.get(word) or self._sound.get(sound(word))
        allowed = SCRIPTS[_script(word)]
        out = []
        for i, lang in enumerate(self.langs):
            if lang not in allowed:
                out.append(-60.0)
                continue
            chars = sum(self._tri.get(g, self._tri_none)[i] for g in grams) / max(len(grams), 1)
            if known and sum(known) >= 2:
                # share of the language's words, smoothed over all languages: words that
                # every language has (names) say little
                s = math.log((known[i] + 0.5) / (self._total[i] + 1000))
                out.append(max(s, -14.0))
            else:
                out.append(1.5 * chars)
        top = max(out)
        return [max(s - top, -8.0) if s > -59 else -40.0 for s in out]

    def path(self, words: list[str], switch: float = SWITCH, breaks: frozenset[int] = frozenset()) -> list[int]:
        """Viterbi: language of each word; a change costs ``switch``, half at a break."""
        k = len(self.langs)
        best, back = [0.0] * k, []
        for t, w in enumerate(words):
            s = self.score(w)
            top = max(range(k), key=best.__getitem__)
            enter = best[top] - (switch / 2 if t in breaks else switch)
            step, new = [], []
            for i in range(k):
                if best[i] >= enter:
                    step.append(i)
                    new.append(best[i] + s[i])
                else:
                    step.append(top)
                    new.append(enter + s[i])
            back.append(step)
            best = new
        i = max(range(k), key=best.__getitem__)
        out = []
        for step in reversed(back):
            out.append(i)
            i = step[i]
        return out[::-1]

    def segments(self, text: str) -> list[dict]:
        """Spans of whole sentences with language, confidence and place (code points of the
        text as given; only its words are normalised)."""
        parts = []
        for m in _SENTENCE.finditer(_QUOTE.sub("|", text)):
            w = words_of(m[0])
            if w:
                parts.append((m.start(), m.end(), w))
        words, breaks = [], set()
        for _, _, w in parts:
            breaks.add(len(words))
            words += w
        path = self.path(words, breaks=frozenset(breaks))
        out: list[dict] = []
        at = 0
        for start, end, w in parts:
            mine = path[at : at + len(w)]
            at += len(w)
            scores = [sum(self.score(x)[i] for x in w) for i in range(len(self.langs))]
            lang = max(set(mine), key=lambda i: (mine.count(i), scores[i]))
            odds = sum(math.exp(max(s - scores[lang], -50)) for s in scores)
            piece = {"lang": self.langs[lang], "confidence": min(1.0, 1.0 / odds), "start": start, "end": end, "words": len(w)}
            if out and (out[-1]["lang"] == piece["lang"] or len(w) < MIN_WORDS):
                last = out[-1]
                n = last["words"] + piece["words"]
                if last["lang"] == piece["lang"]:
                    last["confidence"] = (last["confidence"] * last["words"] + piece["confidence"] * piece["words"]) / n
                last["end"], last["words"] = end, n
            elif out and len(out) == 1 and out[0]["words"] < MIN_WORDS:
                out[0] = piece | {"start": out[0]["start"], "words": out[0]["words"] + piece["words"]}
            else:
                out.append(piece)
        return out


def fit_scores(labelled: DataFrame, key: str = "doc_id", sample_per_lang: int = SAMPLE_PER_LANG) -> WordScores:
    """Word counts per language of at most ``sample_per_lang`` labelled texts each.

    Rows are counted per language first, so that a hash of the id thins them where they
    are read and only about the sample itself is ever moved.
    """
    langs = list(NAMES)
    d = labelled.where(F.col("lang").isin(langs) & F.col("text").isNotNull())
    n = {r.lang: r["count"] for r in d.groupBy("lang").count().collect()}
    part = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(False)
    for lang, c in n.items():
        keep = keep | ((F.col("lang") == lang) & (part < 1.1 * sample_per_lang / c))
    w = Window.partitionBy("lang").orderBy(F.xxhash64(key), key)
    d = d.where(keep).select(key, "lang", "text").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= sample_per_lang)
    counts = d.select("lang", F.explode(_words("text")).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    return WordScores({(r.lang, r.word): r.n for r in counts.collect()})


_SEGMENT = T.StructType([T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("words", T.LongType())])


def label_segments(rows: DataFrame, scores: WordScores, text: str = "text") -> DataFrame:
    """Add ``segments``; null for null texts, empty for texts without a word."""
    shared = rows.sparkSession.sparkContext.broadcast(scores)

    @F.pandas_udf(T.ArrayType(_SEGMENT))
    def segments(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield s.map(lambda t: shared.value.segments(t), na_action="ignore")

    return rows.withColumn("segments", segments(text))


def commentaries(records: DataFrame) -> DataFrame:
    """``rec_no, com_pos, label, text`` of commentaries with a non-blank text."""
    c = records.select(F.col("rec_no").cast("bigint").alias("rec_no"), F.posexplode("commentaries").alias("com_pos", "c"))
    c = c.select("rec_no", F.col("com_pos").cast("bigint").alias("com_pos"), F.col("c.lang").alias("label"), F.col("c.text").alias("text"))
    return c.where(F.col("text").isNotNull() & (F.regexp_replace("text", r"(?U)\s+", "") != ""))


@F.pandas_udf(T.StringType())
def _label_code(labels: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in labels:
        yield s.map(label_code)


def commentary_languages(records: DataFrame, labelled: DataFrame) -> DataFrame:
    """``rec_no, com_pos, label, label_code, segments, langs, lang, confidence`` of every commentary.

    ``lang`` is the language of most of its words (ties: the first by code), ``confidence`` the
    mean confidence of that language's segments times its share of the words; both are null
    for texts without a word.  Null arrays, null and blank texts give no row; repeated
    records repeat.
    """
    c = label_segments(commentaries(records), fit_scores(labelled))
    c = c.withColumns({"label_code": _label_code("label"), "langs": F.array_sort(F.array_distinct(F.transform("segments", lambda s: s["lang"])))})
    total = lambda of, what: F.aggregate(of, F.lit(0.0), lambda acc, s: acc + what(s))
    mine = lambda lang: F.filter("segments", lambda s: s["lang"] == lang)
    words = lambda s: s["words"].cast("double")
    sums = F.transform("langs", lambda x: F.struct(total(mine(x), words).alias("n"), x.alias("lang"), total(mine(x), lambda s: s["confidence"] * words(s)).alias("sure")))
    most = F.try_element_at(F.filter(sums, lambda x: x["n"] == F.array_max(F.transform(sums, lambda y: y["n"]))), F.lit(1))
    return c.withColumn("main", most).withColumns({"lang": F.col("main.lang"), "confidence": F.col("main.sure") / F.nullif(total(F.col("segments"), words), F.lit(0.0))}).drop("main")


def doubtful(languages: DataFrame) -> DataFrame:
    """``rec_no, com_pos, lang_code``: label missing or wrong, or several languages."""
    wrong = (F.size("langs") > 1) | F.col("label_code").isNull() | ~F.array_contains("langs", F.col("label_code"))
    return languages.where(F.coalesce(wrong, F.lit(True))).select("rec_no", "com_pos", F.explode("langs").alias("lang_code"))
