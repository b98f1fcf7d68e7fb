"""Passages around concepts that go by several names, and numbers found in text lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarkaloom.functions.text import rx, strip_ws


def any_term(terms: list[str]) -> str:
    """One pattern for all names of a concept, without word boundaries and case."""
    return "(?iu)(" + "|".join(re.escape(t) for t in terms) + ")"


def passage(c: Column, terms: list[str], window: int = 400, least: int = 30) -> Column:
    """Half a window of text before and after the first name; null without one, or where the
    stripped passage isn't longer than ``least``."""
    pattern = F.lit(any_term(terms))
    at = F.regexp_instr(c, pattern) - 1
    start = F.greatest(at - window // 2, F.lit(0))
    end = at + F.length(F.regexp_extract(c, any_term(terms), 1)) + window // 2
    cut = strip_ws(F.substring(c, start + 1, end - start))
    return F.when((at >= 0) & (F.length(cut) > least), cut)


def concept_passages(records: DataFrame, concepts: dict[str, list[str]], group: str = "school", source_school: DataFrame | None = None, window: int = 400) -> DataFrame:
    """``concept, group, kind, rec_no, com_pos, passage``: where each concept is spoken of.

    Commentaries are grouped by their own ``school`` (without ``general``) or ``commentator``.
    Grouped by school, the text of a record counts for the school that
    ``source_school`` (``source, school``) gives its source (``com_pos`` -1).  Missing
    groups, texts and commentaries give no row.
    """
    c = records.select("rec_no", F.posexplode("commentaries").alias("com_pos", "c"))
    group_by = F.nullif(F.col(f"c.{group}"), F.lit(""))
    every = c.select("rec_no", F.col("com_pos").cast("bigint").alias("com_pos"), F.lit("commentary").alias("kind"), group_by.alias("group"), F.col("c.text").alias("text"))
    if group == "school":
        every = every.where("`group` <> 'general'")
        if source_school is not None:
            top = records.select("rec_no", "source", "text").join(source_school.select("source", F.col("school").alias("group")), "source")
            every = every.unionByName(top.select("rec_no", F.lit(-1).cast("bigint").alias("com_pos"), F.lit("text").alias("kind"), "group", "text"))
    named = F.array(*[F.struct(F.lit(name).alias("concept"), passage(F.col("text"), terms, window).alias("passage")) for name, terms in concepts.items()])
    found = every.where("`group` is not null and text is not null").select("group", "kind", "rec_no", "com_pos", F.inline(named))
    return found.where("passage is not null").select("concept", "group", "kind", "rec_no", "com_pos", "passage")


# How a line names its verse.
VERSE_PATTERNS = (r"^\s*([0-9]+)\.\s+[A-Z\"‘’]", r"Mantra\s+([0-9]+)", r"Text\s+([0-9]+)", r"^([0-9]+)\s*$")


def line_numbers(c: Column, patterns: tuple[str, ...] = VERSE_PATTERNS) -> Column:
    """Sorted distinct numbers that the lines of a text name, by the first match of each
    pattern in each line; numbers over 18 digits are left out.  Null for a null text."""
    lines = F.split(c, "\n", -1)
    of = lambda p: F.transform(lines, lambda x: F.regexp_extract(x, rx(p), 1))
    found = F.flatten(F.array(*map(of, patterns)))
    numbers = F.transform(F.filter(found, lambda n: n != ""), lambda n: n.try_cast("bigint"))
    return F.array_sort(F.array_distinct(F.filter(numbers, lambda n: n.isNotNull())))


def nest_by_record(records: DataFrame, parts: DataFrame, kinds: dict[str, str], key: str = "rec_no", order: str = "com_pos") -> DataFrame:
    """Records with one array of structs per kind of ``parts`` (``key, order, type, ...``), in order;
    empty where a record has none.

    ``kinds``: name of the array -> value of ``type``.  The parts of one record are bounded
    by the record; they are gathered map-side first.
    """
    body = F.struct(order, *[c for c in parts.columns if c not in (key, order, "type")])
    gathered = parts.groupBy(key).agg(*[F.array_sort(F.collect_list(F.when(F.col("type") == value, body))).alias(name) for name, value in kinds.items()])
    j = records.join(gathered, key, "left")
    for name in kinds:
        j = j.withColumn(name, F.coalesce(name, F.array().cast(gathered.schema[name].dataType)))
    return j
