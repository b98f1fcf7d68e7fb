"""Directories of segment dictionaries with parallel files.

A tree ``root/texts/<collection>/<folder>/.../name<mark>.json`` has a parallel tree in another
language whose paths differ by their top and by the mark in the file name.  Both are read
by Spark as one table each and joined on the path that they have in common.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.functions.text import strip_ws
from tarkaloom.sources.io import content_segments


def read_tree(spark: SparkSession, root: str, pattern: str = "*.json") -> DataFrame:
    """``path, value``: every file below ``root``, by its path from there."""
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(root, wholetext=True)
    top = re.escape(root.rstrip("/"))
    return raw.select(F.regexp_extract(F.col("_metadata.file_path"), f"{top}/(.*)$", 1).alias("path"), "value")


def tree_segments(files: DataFrame, mark: str) -> DataFrame:
    """``stem, key, pos, text`` of every segment; ``stem`` is the path without ``mark``.

    The last of repeated keys wins, as in JSON; files that are no dictionary of strings
    give none.
    """
    stem = F.replace("path", F.lit(mark), F.lit(""))
    e = files.select(stem.alias("stem"), F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("pos", "e"))
    return e.groupBy("stem", F.col("e.key").alias("key")).agg(F.max(F.struct("pos", "e.value")).alias("x")).select("stem", "key", "x.pos", F.col("x.value").alias("text"))


def folder(level: int) -> Column:
    """The folder at a level of ``stem`` (0: the first), '' where the path isn't that deep."""
    parts = F.split("stem", "/")
    return F.when(F.size(parts) > level + 1, F.get(parts, F.lit(level))).otherwise("")


def parallel_segments(texts: DataFrame, others: DataFrame, themes: dict[str, str] | None = None, least: int = 10) -> DataFrame:
    """``stem, collection, folder, theme, head, place, key, pos, text, other`` of each segment of
    running text.

    ``other`` is the parallel segment, '' without one; ``head`` and ``place`` are what stands
    before and after the first colon of the key; ``theme`` is that of the folder, null for others.
    """
    d = content_segments(texts, least).join(others.select("stem", "key", F.col("text").alias("other")), ["stem", "key"], "left")
    names = F.create_map(*[F.lit(x) for kv in (themes or {}).items() for x in kv]) if themes else F.create_map().cast("map<string,string>")
    d = d.withColumns({"collection": folder(0), "folder": folder(1)}).withColumn("theme", F.try_element_at(names, F.col("folder")))
    split = F.split("key", ":", 2)
    return d.select("stem", "collection", "folder", "theme", split[0].alias("head"), F.coalesce(F.get(split, F.lit(1)), F.lit("")).alias("place"), "key", "pos", strip_ws(F.col("text")).alias("text"), strip_ws(F.coalesce("other", F.lit(""))).alias("other"))
