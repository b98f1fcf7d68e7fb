"""Evaluation passages in training text, by Wu–Manber multi-pattern search.

The patterns are all runs of ``WORDS`` consecutive words of the test items, as
letters without spaces, so that line breaks and hyphens inside words don't matter.
Tasks cut the items into runs; runs that several items share are one pattern.
Patterns are dealt into blocks of about ``LETTERS`` letters by a hash, however long or many
the items are, and only the letters of one block are sent to the executors, which
build the tables themselves, one pair for each class of lengths (a doubling), so that a
pattern of short words doesn't shorten the jumps for all others.

Over the first ``m`` letters (``m`` = length of the shortest pattern of a class) a shift table
tells for every block of ``BLOCK`` letters how far the search may jump; blocks that
occur in no pattern jump farthest.  Where the shift is 0, the patterns in the
bucket of that block are compared directly.  The corpus is scanned in place: no
shuffle but for the matches, whose runs are joined with the items that hold them.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarkaloom.llm.lookalike import plain_words
from tarkaloom.plans.session import stage

WORDS, BLOCK = 12, 7
# letters of the patterns that are sent at once; tables in a task take some 50 bytes a letter
LETTERS = 2_000_000
# runs of a long item that are handed on together
SLICE = 5_000


def item_runs(items: DataFrame, words: int = WORDS, key: str = "item_id") -> DataFrame:
    """``item_id, run``: every run of ``words`` words of each item, as letters; a run once per item
    and slice."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for item, text in zip(pdf["item_id"], pdf["text"], strict=True):
                w = plain_words(text)
                for at in range(0, len(w) - words + 1, SLICE):
                    runs = {"".join(w[i : i + words]) for i in range(at, min(at + SLICE, len(w) - words + 1))}
                    yield pd.DataFrame({"item_id": item, "run": sorted(runs)})

    rows = items.select(F.col(key).cast("bigint").alias("item_id"), F.col("text").alias("text")).where("item_id is not null and text is not null")
    return rows.mapInPandas(cut, "item_id bigint, run string")


class _Class:
    """Shift table and suffix buckets of patterns of similar length."""

    def __init__(self, patterns: list[str]) -> None:
        self.m = min(map(len, patterns))
        self.b = min(BLOCK, self.m)
        self.shift: dict[str, int] = {}
        self.buckets: dict[str, list[str]] = {}
        for p in patterns:
            for j in range(self.b, self.m + 1):
                block = p[j - self.b : j]
                self.shift[block] = min(self.shift.get(block, self.m), self.m - j)
            self.buckets.setdefault(p[self.m - self.b : self.m], []).append(p)

    def search(self, stream: str, edges: set[int], found: set[str]) -> None:
        m, b, n = self.m, self.b, len(stream)
        shift, far, pos = self.shift, m - b + 1, m
        while pos <= n:
            block = stream[pos - b : pos]
            jump = shift.get(block, far)
            if jump:
                pos += jump
                continue
            start = pos - m
            if start in edges:
                for p in self.buckets.get(block, ()):
                    if stream.startswith(p, start) and start + len(p) in edges:
                        found.add(p)
            pos += 1


class WuManber:
    """The patterns of one block.  Only the patterns are sent; each worker builds its tables."""

    def __init__(self, patterns: list[str]) -> None:
        self.patterns = patterns
        self.classes: list[_Class] | None = None

    def __getstate__(self) -> list[str]:
        return self.patterns

    def __setstate__(self, patterns: list[str]) -> None:
        self.__init__(patterns)

    def search(self, text: str) -> set[str]:
        """Patterns that stand in the text from the start of a word to the end of one."""
        if self.classes is None:
            by_length: dict[int, list[str]] = {}
            for p in self.patterns:
                by_length.setdefault(len(p).bit_length(), []).append(p)
            self.classes = [_Class(ps) for _, ps in sorted(by_length.items())]
        words = plain_words(text)
        edges = {0, *itertools.accumulate(map(len, words))}
        found: set[str] = set()
        stream = "".join(words)
        for c in self.classes:
            c.search(stream, edges, found)
        return found


def leaked(items: DataFrame, docs: DataFrame, words: int = WORDS, item_key: str = "item_id", doc_key: str = "doc_id", letters: int = LETTERS) -> DataFrame:
    """``item_id, doc_id`` of every test item of which a document holds at least
    ``words`` consecutive words.

    Null, empty and shorter texts and null ids match nothing; repeated items and
    documents count once.  The corpus is read once for each block of patterns.
    """
    spark = docs.sparkSession
    runs = stage(item_runs(items, words, item_key), "runs")
    patterns = stage(runs.select("run").distinct(), "patterns")
    blocks = max(1, -(-(patterns.agg(F.sum(F.length("run"))).first()[0] or 0) // letters))
    out = None
    d = docs.select(F.col(doc_key).cast("bigint").alias("doc_id"), F.col("text").alias("text")).where("doc_id is not null and text is not null")
    for k in range(blocks):
        part = patterns.where(F.pmod(F.xxhash64("run"), F.lit(blocks)) == k).collect()
        shared = spark.sparkContext.broadcast(WuManber(sorted(r[0] for r in part)))

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            search = shared.value.search
            for pdf in batches:
                hits = [(run, doc) for doc, t in zip(pdf["doc_id"], pdf["text"], strict=True) for run in search(t)]
                yield pd.DataFrame(hits, columns=["run", "doc_id"]).astype({"doc_id": "int64"})

        got = d.mapInPandas(scan, "run string, doc_id bigint")
        out = got if out is None else out.unionByName(got)
    return out.join(runs.distinct(), "run").select("item_id", "doc_id").distinct()
