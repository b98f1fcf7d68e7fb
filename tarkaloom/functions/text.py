"""Column helpers for text, with one regular-expression dialect throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rx(pattern: str, ignore_case: bool = False) -> str:
    """Unicode classes and ``\\n``-only line ends, as Python's ``re`` has them."""
    return ("(?iu)" if ignore_case else "") + "(?U)(?d)" + pattern


# All characters with the property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip_ws(c: Column) -> Column:
    """Remove outer white space of any kind (``trim`` alone removes spaces only).

    Trimming a set of characters is dear, so it is done only where there are some.
    """
    outer = F.left(c, F.lit(1)).isin(*WHITE_SPACE) | F.right(c, F.lit(1)).isin(*WHITE_SPACE)
    return F.when(outer, F.trim(c, F.lit(WHITE_SPACE))).otherwise(c)


def squash_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def first_match(c: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Ordered classifier: the label of the first substring that occurs."""
    low = F.lower(c)
    out = None
    for needle, label in rules:
        out = F.when(low.contains(needle), label) if out is None else out.when(low.contains(needle), label)
    return out.otherwise(default) if out is not None else F.lit(default)


def contains_any(c: Column, needles: list[str]) -> Column:
    return F.exists(F.array(*map(F.lit, needles)), lambda n: c.contains(n))


def starts_any(c: Column, starts: list[str]) -> Column:
    """Does the text begin with one of them, whatever its case?  They are given in lower case."""
    return F.exists(F.array(*map(F.lit, starts)), lambda n: F.lower(c).startswith(n))


def matches_any(c: Column, patterns: list[str]) -> Column:
    return c.rlike("(" + "|".join(map(rx, patterns)) + ")")


def slug(c: Column, length: int = 40) -> Column:
    return F.left(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit(length))


def words_ascii(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("([a-z']+)"), F.lit(1))


def script_share(c: Column, cls: str, spaces: bool = True) -> Column:
    """Share of characters that match a class, over all or over non-space ones."""
    base = c if spaces else F.regexp_replace(c, r"\s", "")
    return F.regexp_count(base, F.lit(cls)) / F.greatest(F.length(base), F.lit(1))


def kwic(c: Column, needle: str, window: int = 200, least: int = 30) -> Column:
    """Text around the first occurrence, stripped; null unless longer than ``least``."""
    pos = F.locate(needle, F.lower(c))
    start = F.greatest(pos - window, F.lit(1))
    end = F.least(pos + len(needle) + window, F.length(c) + 1)
    cut = strip_ws(F.substring(c, start, end - start))
    return F.when((pos > 0) & (F.length(cut) > least), cut)


def sentences(c: Column) -> Column:
    """Split after runs of ``.!?``; texts without breaks give pieces of 20 words.

    A text with fewer than two parts becomes pseudo-sentences of 20 words, and one
    of under five words stays whole; blank texts give none.
    """
    parts = F.filter(F.split(c, r"[.!?]+\s+"), lambda s: F.trim(s) != "")
    words = F.filter(F.split(strip_ws(c), r"\s+"), lambda w: w != "")
    n = F.size(words)
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(n / 20).cast("int") - 1, F.lit(0))), lambda i: F.array_join(F.slice(words, i * 20 + 1, F.lit(20)), " "))
    return F.when(F.size(parts) >= 2, parts).when(n == 0, F.array().cast("array<string>")).when(n < 5, F.array(c)).otherwise(pieces)


# Number words and roman digits.
NUMBER_WORDS = {"first": 1, "second": 2, "third": 3, "fourth": 4, "fifth": 5, "sixth": 6, "seventh": 7, "eighth": 8, "ninth": 9, "tenth": 10}
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}


def _lookup(c: Column, values: dict[str, int]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), c)


def number_word(c: Column) -> Column:
    """The number an ordinal names, null for other words."""
    return _lookup(F.lower(F.trim(c)), NUMBER_WORDS)


def roman(c: Column) -> Column:
    """A roman numeral as a number: a digit before a larger one is taken away.

    Null for null, empty and other strings.
    """
    digits = F.transform(F.split(F.upper(c), ""), lambda d: F.coalesce(_lookup(d, ROMAN), F.lit(0)))
    signed = F.transform(digits, lambda v, i: F.when(v < F.coalesce(F.try_element_at(digits, i + 2), F.lit(0)), -v).otherwise(v))
    return F.when(F.upper(c).rlike("^[IVXLCDM]+$"), F.aggregate(signed, F.lit(0), lambda a, v: a + v))


def is_front_matter(c: Column) -> Column:
    """A page of front matter: a roman page mark ('p. xii') in its first 50 characters, or
    contents or introduction named at its head and no number before its first word."""
    head = F.left(c, F.lit(200))
    roman_page = F.left(c, F.lit(50)).rlike(rx(r"\bp\.\s*[ivxlcdm]+\b", ignore_case=True))
    return roman_page | (head.contains("CONTENTS") | F.upper(head).contains("INTRODUCTION")) & ~c.rlike(r"^\s*\d+[.]")
