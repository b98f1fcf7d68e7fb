"""Line-by-line parsers as windows: what a line is depends on the lines before it.

A parser that walks over lines with variables becomes three steps: events (a line that
opens something), islands (the number of events so far) and values carried on from
the last event.  All windows run inside one text, whose own size bounds them; the lines are
exchanged once, by text.  Lines come as ``by, line_no, line``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarkaloom.functions.text import rx, strip_ws
from tarkaloom.operators.ordered import BLOCK, counter, forward_fill, section_with_reset


def text_lines(texts: DataFrame, by: str, text: str = "text") -> DataFrame:
    """``by, line_no, line``: the stripped lines of each text that aren't blank."""
    d = texts.select(by, F.posexplode(F.split(text, "\n", -1)).alias("line_no", "line"))
    return d.select(by, "line_no", strip_ws(F.col("line")).alias("line")).where("line <> ''")


def _event(pattern: str) -> Column:
    return F.nullif(F.regexp_extract("line", rx(pattern), 1), F.lit(""))


def _until_here(*by: str) -> Window:
    return Window.partitionBy(*by).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)


def _items(lines: DataFrame, by: str, chapter: str, item: str) -> DataFrame:
    """Lines from the first item on, with ``island, item, chapter`` and ``place`` (0: the line
    that names the item).  A line that names a chapter ends the item before it."""
    w = _until_here(by)
    d = lines.withColumns({"_item": _event(item), "_chapter": _event(chapter)})
    d = d.withColumn("_begun", F.count("_item").over(w) > 0).where("_begun or _chapter is not null")
    d = d.withColumns({"island": F.count(F.coalesce("_item", "_chapter")).over(w), "chapter": F.last("_chapter", ignorenulls=True).over(w)})
    first = Window.partitionBy(by, "island").orderBy("line_no")
    d = d.withColumns({"item": F.first("_item").over(first), "place": F.row_number().over(first) - 1})
    return d.where("item is not null").drop("_begun", "_item", "_chapter")


def _joined(lines: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(lines), lambda x: x["line"]), " ")


def head_and_body(lines: DataFrame, by: str, chapter: str, item: str, head_lines: int = 3) -> DataFrame:
    """``by, island, chapter, item, n_head, head, n_body, body`` of every numbered item.

    ``chapter`` and ``item`` are patterns with one group.  The head of an item is its first
    lines, ``head_lines`` at most, until one begins in lower case; all lines after are its body.
    Lines before the first item belong to none; an item without lines has empty texts.
    """
    d = _items(lines, by, chapter, item)
    ends = (F.col("place") > head_lines) | F.col("line").rlike(r"^\p{Ll}")
    d = d.withColumn("in_body", F.max((F.col("place") > 0) & ends).over(_until_here(by, "island")))
    one = F.struct("line_no", "line")
    # the lines of an item are bounded by its text
    g = d.groupBy(by, "island", "chapter", "item").agg(
        F.collect_list(F.when((F.col("place") > 0) & ~F.col("in_body"), one)).alias("h"),
        F.collect_list(F.when((F.col("place") > 0) & F.col("in_body"), one)).alias("b"),
    )
    size = lambda c, name: F.size(c).cast("bigint").alias(name)
    return g.select(by, "island", "chapter", "item", size("h", "n_head"), _joined(F.col("h")).alias("head"), size("b", "n_body"), _joined(F.col("b")).alias("body"))


def typed_lines(lines: DataFrame, by: str, chapter: str, item: str, markers: dict[str, str], opening: list[tuple[str, Column]], rest: str) -> DataFrame:
    """``by, island, chapter, item, line_no, line, kind``: the state of every line inside an item.

    An item begins with the states of ``opening``: each lasts while its condition on the line
    holds, then the next begins, ``rest`` at the end.  A line that matches a pattern of
    ``markers`` sets its state from the next line on (and is no line itself).
    """
    d = _items(lines, by, chapter, item).where("place > 0")
    w = _until_here(by, "island")
    mark = F.coalesce(*[F.when(F.col("line").rlike(rx(p)), F.lit(k)) for k, p in markers.items()], F.lit(None).cast("string"))
    d = d.withColumn("_mark", mark).withColumn("_set", F.last("_mark", ignorenulls=True).over(w))
    past, kind = F.lit(True), None
    for k, (name, holds) in enumerate(opening):
        d = d.withColumn(f"_past{k}", F.max(past & ~holds).over(w))
        past = F.col(f"_past{k}")
        kind = F.when(~past, F.lit(name)) if kind is None else kind.when(~past, F.lit(name))
    kind = F.lit(rest) if kind is None else kind.otherwise(rest)
    return d.where("_mark is null").select(by, "island", "chapter", "item", "line_no", "line", F.coalesce("_set", kind).alias("kind"))


def carried_label(pages: DataFrame, by: str, order: str, skip: Column, label: Column, out: str, block: int = BLOCK) -> DataFrame:
    """Pages that aren't skipped, with the last label that one of them gave (null before any).
    Skipped pages give none."""
    kept = pages.where(~F.coalesce(skip, F.lit(False)))
    return forward_fill(kept, [by], [order], label, out, block)


def renumbered(rows: DataFrame, by: str, order: str, chapter: str, section: Column, number: str, block: int = BLOCK) -> DataFrame:
    """Add ``section_no`` and ``number_no``: the section is carried on and begins again at 1 with a new
    chapter; numbers that are missing go on from the one before.  Rows before the first
    number of a group are left out."""
    d = section_with_reset(rows, [by], [order], chapter, section, "section_no", block)
    d = forward_fill(d, [by], [order], number, "_begun", block).where("_begun is not null").drop("_begun")
    return counter(d, [by], [order], number, "number_no", block)
