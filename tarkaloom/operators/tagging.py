"""Tagging of records with concepts: the words join, and a pluggable tagger."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = r"([\p{L}\p{M}]+)"
TAGS = "record_id string, concepts array<struct<name:string,category:string>>, error string"


def mentions(records: DataFrame, concepts: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``rec_no, concept_id, n`` and columns to ``carry``: how often each record's text has each
    concept name.

    Words are counted per record first; the equi-join on the word replaces a search of
    every name in every text.
    """
    w = records.select("rec_no", *carry, F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORDS), F.lit(1))).alias("word")).groupBy("rec_no", *carry, "word").agg(F.count("*").alias("n"))
    c = concepts.select("concept_id", F.lower("name").alias("word"))
    return w.join(c, "word").select("rec_no", *carry, "concept_id", "n")


def tag_with(records: DataFrame, tagger: Callable[[str], list[tuple[str, str]]]) -> DataFrame:
    """Call a tagger for each record's text, batch by batch; a failed call is a row with
    ``error``, so that one bad record fails no task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, text in zip(pdf["id"], pdf["text"], strict=True):
                try:
                    rows.append((key, [{"name": n, "category": c} for n, c in tagger(text or "")], None))
                except Exception as e:
                    rows.append((key, [], type(e).__name__))
            yield pd.DataFrame(rows, columns=["record_id", "concepts", "error"])

    return records.select("id", "text").mapInPandas(run, TAGS)
