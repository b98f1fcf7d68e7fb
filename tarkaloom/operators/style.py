"""Style of groups of passages, in one scan and one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarkaloom.functions import text as X


def any_marker(c: Column, patterns: list[str]) -> Column:
    return c.rlike("(?i)(" + "|".join(patterns) + ")")


def profile(passages: DataFrame, group: str, markers: dict[str, list[str]], min_passages: int = 1) -> DataFrame:
    """Per group: passages, length, words per sentence, vocabulary, marker rates.

    Null texts count as passages without content; groups without a sentence or with
    fewer than ``min_passages`` are left out.  The vocabulary is counted by two-level
    aggregation, never gathered.
    """
    p = passages.select(F.col(group).alias("g"), "text")
    flags = [F.count_if(any_marker(F.col("text"), pats)).alias(f"n_{k}") for k, pats in markers.items()]
    t = p.withColumns({"s": F.size(X.sentences(F.col("text"))), "raw": F.size(F.split("text", r"[.!?]+\s+"))})
    sums = t.groupBy("g").agg(
        F.count("*").alias("n_passages"),
        F.sum(F.length("text")).alias("n_chars"),
        F.sum(F.when(F.col("text").isNotNull(), F.col("s"))).alias("n_sentences"),
        F.count_if(F.col("raw") < 2).alias("n_fallback"),
        *flags,
    )
    words = p.select("g", F.explode(X.words_ascii(F.col("text"))).alias("w")).groupBy("g", "w").agg(F.count("*").alias("n"))
    vocab = words.groupBy("g").agg(F.sum("n").alias("n_words"), F.count("*").alias("n_vocabulary"))
    j = sums.join(vocab, "g", "left").where((F.col("n_passages") >= min_passages) & (F.col("n_sentences") > 0))
    n = F.col("n_passages")
    pct = lambda k: F.round(100 * F.col(f"n_{k}") / n, 6).alias(f"pct_{k}")
    return j.select(
        F.col("g").alias(group),
        "n_passages",
        F.round(F.col("n_chars") / n, 6).alias("avg_chars"),
        F.round(F.coalesce("n_words", F.lit(0)) / F.col("n_sentences"), 6).alias("words_per_sentence"),
        F.round(F.coalesce("n_vocabulary", F.lit(0)) / F.greatest(F.coalesce("n_words", F.lit(0)), F.lit(1)), 6).alias("vocabulary_diversity"),
        *[pct(k) for k in markers],
        pct("fallback"),
    )


def marker_correlation(profiles: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation of two rates over groups."""
    return profiles.agg(F.round(F.corr(a, b), 6).alias("r"), F.count("*").alias("n_groups"))


def term_by_group(passages: DataFrame, group: str, terms: list[str]) -> DataFrame:
    """How many passages of each group hold each term; groups without any are left out."""
    low = F.lower("text")
    hits = F.filter(F.transform(F.array(*map(F.lit, terms)), lambda t: F.when(low.contains(t), t)), lambda t: t.isNotNull())
    n = passages.groupBy(group).agg(F.count("*").alias("n_passages"))
    h = passages.select(group, F.explode(hits).alias("term")).groupBy(group, "term").agg(F.count("*").alias("n_hits"))
    return h.join(n, group).select(group, "term", "n_hits", F.round(100 * F.col("n_hits") / F.col("n_passages"), 6).alias("pct"))


def passages_dual(records: DataFrame, source_school: DataFrame) -> DataFrame:
    """Passages by school: commentaries under their own school, and top texts under the
    school their source is mapped to (unmapped sources drop out)."""
    nested = records.select("rec_no", F.inline("commentaries")).select("rec_no", F.lit("commentary").alias("kind"), "school", "text")
    top = records.select("rec_no", "source", "text").join(source_school, "source").select("rec_no", F.lit("text").alias("kind"), "school", "text")
    return nested.unionByName(top).where("text is not null and text <> '' and school is not null and school <> ''")
