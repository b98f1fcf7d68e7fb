"""HTML to text with JVM-side expressions, tolerant of malformed pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def without(html: Column, tags: list[str]) -> Column:
    """Elements removed with what they hold."""
    names = "|".join(tags)
    return F.regexp_replace(F.regexp_replace(html, r"(?s)<!--.*?-->", ""), rf"(?is)<({names})\b[^>]*>.*?</\1\s*>|<({names})\b[^>]*/?>", " ")


def unescape(c: Column) -> Column:
    for a, b in _ENTITIES:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def to_text(html: Column, separator: str = "\n") -> Column:
    plain = F.regexp_replace(without(html, ["script", "style", "head"]), r"(?s)<[^>]*>", separator)
    return F.trim(F.regexp_replace(F.regexp_replace(unescape(plain), r"[ \t]+", " "), r"\s*\n\s*", "\n"))


def title(html: Column, tag: str = "h1") -> Column:
    inner = F.regexp_extract(without(html, ["script", "style"]), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)
    return F.trim(unescape(F.regexp_replace(inner, r"(?s)<[^>]*>", "")))


def paragraphs(html: Column) -> Column:
    found = F.regexp_extract_all(without(html, ["script", "style"]), F.lit(r"(?is)<p\b[^>]*>(.*?)(?=</p\s*>|<p\b|</body|$)"), F.lit(1))
    return F.filter(F.transform(found, lambda p: F.trim(unescape(F.regexp_replace(p, r"(?s)<[^>]*>", "")))), lambda p: p != "")


def links(html: Column, pattern: str = ".*") -> Column:
    """Targets in order of appearance."""
    found = F.regexp_extract_all(without(html, ["script", "style"]), F.lit(r"(?is)<a\b[^>]*\bhref\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1))
    return F.filter(found, lambda u: u.rlike(pattern))


def links_first_seen(html: Column, pattern: str = ".*") -> Column:
    """Each target once, where it appears first."""
    return F.array_distinct(links(html, pattern))


def sections(html: Column, level: str = "h[1-3]") -> Column:
    """``array<struct<header, text>>``: each header with the text up to the next header or rule; text
    before the first header has an empty one, and a section without text an empty text."""
    body = without(html, ["script", "style", "head"])
    marked = F.regexp_replace(F.regexp_replace(body, r"(?is)<hr\b[^>]*>", "\u0001\u0002"), rf"(?is)<({level})\b[^>]*>(.*?)</\1\s*>", "\u0001$2\u0002")
    inner = lambda c: F.trim(F.regexp_replace(unescape(F.regexp_replace(c, r"(?s)<[^>]*>", " ")), r"\s+", " "))
    parts = F.split(F.concat(F.lit("\u0002"), marked), "\u0001", -1)
    cut = F.transform(parts, lambda p: F.struct(inner(F.substring_index(p, "\u0002", 1)).alias("header"), inner(F.substring_index(p, "\u0002", -1)).alias("text")))
    return F.filter(cut, lambda s: (s["header"] != "") | (s["text"] != ""))


def page_record(html: Column, least: int = 50) -> Column:
    """``struct<title, text, sections>`` of a page; null where its running text is shorter than ``least``."""
    text = F.array_join(paragraphs(html), "\n")
    return F.when(F.length(text) >= least, F.struct(title(html).alias("title"), text.alias("text"), sections(html).alias("sections")))


def contains_fragment(html: Column, fragment: str) -> Column:
    return F.lower(html).contains(fragment.lower())
