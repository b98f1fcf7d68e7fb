"""Freely typed values mapped to the entries of a reference list.

Token-level repair, then soft TF-IDF over whole entries:

1. values are folded (script, accents, common transliterations) and cut into
   tokens; the letters of all tokens together are a second reading, for names that
   were split by a space or hyphen;
2. every distinct token is joined to the reference vocabulary (words of names and
   glosses) within an edit distance of 1 (under 6 letters) or 2, a swap counting as
   one edit, over shared deletion variants, so no token meets the whole vocabulary; all
   words in reach are kept;
3. a value is compared to the three forms of an entry (name, gloss, both) by the
   cosine of TF-IDF weights, each token with the closest word of the entry, weighted by
   their similarity; the best entry counts from ``least`` on, otherwise the value means none (-1).

Document frequencies are those of all distinct values.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarkaloom.plans.session import stage

GENERIC = ("the", "a", "an", "concept")
LEAST = 0.75
SHORT, MIN_LETTERS = 6, 3

# Devanagari letters and signs in Latin script.
CONSONANTS = dict(zip("कखगघङचछजझञटठडढणतथदधनपफबभमयरलवशषसह", "k kh g gh n c ch j jh n t th d dh n t th d dh n p ph b bh m y r l v s s s h".split(), strict=True))
SIGNS = dict(zip("ािीुूृेैोौ", "a i i u u r e ai o au".split(), strict=True))
VOWELS = dict(zip("अआइईउऊऋएऐओऔ", "a a i i u u r e ai o au".split(), strict=True)) | {"ं": "m", "ः": "h", "ँ": "m"}
# Spellings that stand for one sound in common transliterations.
SOUNDS = (("w", "v"), ("sh", "s"), ("ee", "i"), ("oo", "u"), ("ch", "c"), ("ri", "r"))
_DOUBLE = regex.compile(r"(.)\1+")


def latin(text: str) -> str:
    """Devanagari as Latin letters; everything else as it is."""
    out, open_a = [], False
    for ch in text:
        if ch in SIGNS or ch == "्":
            out.append(SIGNS.get(ch, ""))
            open_a = False
            continue
        out.append("a" if open_a else "")
        open_a = ch in CONSONANTS
        out.append(CONSONANTS.get(ch) or VOWELS.get(ch, ch))
    return "".join(out) + ("a" if open_a else "")


def fold(text: str) -> list[str]:
    """Tokens of a value, folded."""
    t = latin(unicodedata.normalize("NFKC", text)).lower()
    t = "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))
    for a, b in SOUNDS:
        t = t.replace(a, b)
    return regex.findall(r"\p{L}+", _DOUBLE.sub(r"\1", t))


def readings(text: str) -> list[list[str]]:
    """The tokens without generic words, and their letters as one token."""
    generic = {t for g in GENERIC for t in fold(g)}
    tokens = [t for t in fold(text) if t not in generic]
    return [tokens] + ([["".join(tokens)]] if len(tokens) > 1 else []) if tokens else []


def deletions(token: str, most: int) -> set[str]:
    out = last = {token}
    for _ in range(most):
        last = {t[:i] + t[i + 1 :] for t in last for i in range(len(t))}
        out = out | last
    return out


def reach(token: str) -> int:
    """Edits allowed for a token: none for very short ones."""
    return 0 if len(token) < MIN_LETTERS else 1 if len(token) < SHORT else 2


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def _readings(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in values:
        yield s.map(lambda v: readings(v or ""))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _probes(tokens: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in tokens:
        yield s.map(lambda t: sorted(deletions(t, reach(t))))


def reference_forms(ref: DataFrame) -> DataFrame:
    """``concept_id, form, token`` for the forms name, gloss and both."""
    r = ref.select("concept_id", _readings("name").alias("n"), _readings(F.coalesce("gloss", F.lit(""))).alias("g"))
    first = lambda c: F.coalesce(F.try_element_at(c, F.lit(1)), F.array().cast("array<string>"))
    forms = F.array(*[F.struct(F.lit(k).alias("form"), F.array_distinct(t).alias("tokens")) for k, t in (("name", first("n")), ("gloss", first("g")), ("both", F.concat(first("n"), first("g"))))])
    return r.select("concept_id", F.inline(forms)).where(F.size("tokens") > 0)


def repair(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``token, ref_token, sim, nearest``: all reference words within reach of each token;
    ``nearest`` marks those of the fewest edits.

    ``tokens`` and ``vocabulary`` have one distinct column ``token``.
    """
    a = tokens.select("token", F.explode(_probes("token")).alias("probe"))
    b = vocabulary.select(F.col("token").alias("ref_token"), F.explode(_probes("token")).alias("probe"))
    d = F.levenshtein("token", "ref_token")
    same_letters = F.array_sort(F.split("token", "")) == F.array_sort(F.split("ref_token", ""))
    longer, shorter = F.greatest(F.length("token"), F.length("ref_token")), F.least(F.length("token"), F.length("ref_token"))
    most = F.when(longer <= MIN_LETTERS, 0).when(shorter < SHORT, 1).otherwise(2)
    pairs = a.join(b, "probe").select("token", "ref_token").distinct().withColumn("d", d)
    pairs = pairs.withColumn("d", F.when((F.col("d") == 2) & same_letters, 1).otherwise(F.col("d"))).where(F.col("d") <= most)
    # the words in reach of one token are bounded by the reference vocabulary
    near = pairs.withColumn("least", F.min("d").over(Window.partitionBy("token")))
    sim = 1 - 0.5 * F.col("d") / F.greatest(F.length("token"), F.length("ref_token"))
    return near.select("token", "ref_token", sim.alias("sim"), (F.col("d") == F.col("least")).alias("nearest"))


def match_values(values: DataFrame, ref: DataFrame, least: float = LEAST) -> DataFrame:
    """``value, concept_id, score`` for each of the distinct ``value``s (-1: none).

    Values without a letter mean none.  Ties go to the smallest id.  An empty
    reference list leaves every value unmatched.
    """
    read = stage(values.select("value", F.posexplode(_readings("value")).alias("reading", "tokens")), "readings")
    long = read.select("value", "reading", F.explode(F.array_distinct("tokens")).alias("token"))
    forms = stage(reference_forms(ref), "forms")
    form_tokens = forms.select("concept_id", "form", F.explode("tokens").alias("ref_token"))
    vocabulary = form_tokens.select(F.col("ref_token").alias("token")).distinct()
    freq = stage(long.groupBy("token").agg(F.countDistinct("value").alias("df")), "tokens")
    near = stage(repair(freq.select("token"), vocabulary), "repairs")
    total = max(values.count(), 1)
    # a repaired token counts with the frequency of the nearest word
    nearest = near.where("nearest")
    ref_df = nearest.join(freq, "token").groupBy("ref_token").agg(F.sum("df").alias("ref_df"))
    weight = lambda c: F.log(1 + F.lit(float(total)) / F.greatest(c, F.lit(1)))
    ref_w = form_tokens.join(ref_df, "ref_token", "left").withColumn("rw", weight(F.coalesce("ref_df", F.lit(1))))
    form_norm = ref_w.groupBy("concept_id", "form").agg(F.sqrt(F.sum(F.col("rw") * F.col("rw"))).alias("fn"))
    token_w = freq.join(nearest.groupBy("token").agg(F.min("ref_token").alias("ref_token")), "token", "left").join(ref_df, "ref_token", "left").select("token", weight(F.coalesce("ref_df", "df")).alias("tw"))
    weighted = long.join(token_w, "token")
    value_norm = weighted.groupBy("value", "reading").agg(F.sqrt(F.sum(F.col("tw") * F.col("tw"))).alias("vn"))
    # of the words of an entry a token meets the one that gives it most; settled once per distinct token
    close = near.join(ref_w, "ref_token").groupBy("token", "concept_id", "form").agg(F.max(F.col("rw") * F.col("sim")).alias("w"))
    hits = weighted.join(close, "token")
    score = hits.groupBy("value", "reading", "concept_id", "form").agg(F.sum(F.col("tw") * F.col("w")).alias("dot"))
    score = score.join(form_norm, ["concept_id", "form"]).join(value_norm, ["value", "reading"]).withColumn("score", F.col("dot") / (F.col("fn") * F.col("vn")))
    best = score.groupBy("value").agg(F.max(F.struct("score", (-F.col("concept_id")).alias("neg"))).alias("b"))
    fits = F.coalesce(F.col("b.score") >= least, F.lit(False))
    return values.join(best, "value", "left").select("value", F.when(fits, -F.col("b.neg")).otherwise(-1).cast("bigint").alias("concept_id"), F.col("b.score").alias("score"))


def typed_values(edges: DataFrame, ref: DataFrame, key: str = "edge_id") -> DataFrame:
    """``edge_id, side, value`` of every non-blank value that is no name of the list as it stands."""
    sides = F.explode(F.array(F.struct(F.lit("a").alias("side"), F.col("concept_a").alias("value")), F.struct(F.lit("b").alias("side"), F.col("concept_b").alias("value"))))
    long = edges.select(F.col(key).alias("edge_id"), sides.alias("s")).select("edge_id", "s.side", "s.value")
    long = long.where(F.col("value").isNotNull() & (F.regexp_replace("value", r"(?U)\s+", "") != ""))
    return long.join(ref.select(F.col("name").alias("value")), "value", "left_anti").select("edge_id", "side", "value")


def match_edges(edges: DataFrame, ref: DataFrame, least: float = LEAST, key: str = "edge_id") -> DataFrame:
    """``edge_id, side, value, concept_id, score`` for every typed value."""
    long = typed_values(edges, ref, key)
    values = stage(long.select("value").distinct(), "values")
    matched = stage(match_values(values, ref, least), "matched")
    return long.join(matched, "value").select("edge_id", "side", "value", "concept_id", "score")
