"""Lines repeated across the documents of one source.

Texts are reduced to a stream of lower-case letters (with their marks) and cut
by content, not by newlines: a rolling hash runs over every ``GRAM`` letters, and
a cut is set wherever the hash is the least of some ``WINDOW`` consecutive ones.
Two cuts that both come from windows inside a run of letters are the same in
every document holding this run, and a run of at least
``GRAM + 2 * WINDOW - 1`` = 12 letters always has two of them.  (It holds two windows
without a common gram, whose least grams are two cuts.  A window across an edge of the
run can't add a cut between these: it would hold the nearer cut, or all grams up to
it, and pick a smaller gram, which the cut's own window would have picked too.)  So
every line of 12 letters or more that is repeated has chunks that are repeated at least as
often, whatever stands around it, and no repeated line is lost by looking only
at lines whose chunks are repeated.

1. chunks of each text (distinct per document) -> documents per source and chunk
   (counted map-side first);
2. keep chunks at or over the share: at most ``chunks per document / share`` per
   source, so small; joined by Catalyst, which sees the staged size;
3. lines whose longest chunk is among them are candidates and are counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarkaloom.plans.session import stage

GRAM, WINDOW = 5, 4
_LINES = T.ArrayType(T.StructType([T.StructField("line_no", T.LongType()), T.StructField("line_key", T.StringType()), T.StructField("chunk", T.LongType())]))
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(1_000_003)
_DROP = regex.compile(r"[^\p{L}\p{M}\n]+")
# texts whose letters are hashed together
SLICE = 256


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _MULT
    return x ^ (x >> np.uint64(31))


def _letters(texts: list[str | None], per_line: bool) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """Letters of many texts at once: per text the letters of its lines, all their codes in
    one array, and the number of the text (or of the line) that each code stands in."""
    keys = [_DROP.sub("", t.lower()).split("\n") if t else [] for t in texts]
    flat = [k for ks in keys for k in ks]
    codes = np.frombuffer("".join(flat).encode("utf-32-le"), np.uint32)
    group = np.repeat(np.arange(len(flat)), [len(k) for k in flat]) if per_line else np.repeat(np.arange(len(keys)), [sum(map(len, ks)) for ks in keys])
    return keys, codes, group


def cuts(codes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of cuts: grams that are least (the last of equals) in some window that
    lies in one group."""
    span = WINDOW + GRAM - 1
    n, w = len(codes) - GRAM + 1, len(codes) - span + 1
    if w < 1:
        return np.empty(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(GRAM):
        h = h * _BASE + codes[k : k + n].astype(np.uint64)
    h = _mix(h)
    best, at = h[:w], np.arange(w)
    for k in range(1, WINDOW):
        take = h[k : k + w] <= best
        best = np.where(take, h[k : k + w], best)
        at = np.where(take, np.arange(k, k + w), at)
    chosen = np.zeros(n, bool)
    chosen[at[group[:w] == group[span - 1 :]]] = True
    return np.flatnonzero(chosen)


def chunk_hashes(codes: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, length and group of each chunk between two neighbouring cuts of a group."""
    at = cuts(codes, group)
    at = (at[:-1], at[1:])
    inside = group[at[0]] == group[at[1]]
    start, end = at[0][inside], at[1][inside] + GRAM
    powers = np.cumprod(np.full(len(codes) + 1, _BASE, np.uint64))
    run = np.concatenate([[np.uint64(0)], np.cumsum(_mix(codes.astype(np.uint64) + np.uint64(7)) * powers[: len(codes)], dtype=np.uint64)])
    # hash of codes[start:end], moved to a common power so that place doesn't matter
    inv = np.cumprod(np.full(len(codes) + 1, np.uint64(pow(int(_BASE), -1, 2**64)), np.uint64))
    h = _mix((run[end] - run[start]) * inv[start]) ^ (end - start).astype(np.uint64)
    return h.view(np.int64), end - start, group[start]


@F.pandas_udf(T.ArrayType(T.LongType()))
def text_chunks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Distinct chunk hashes of each text's letter stream."""
    for s in texts:
        out: list[np.ndarray] = []
        for i in range(0, len(s), SLICE):
            part = s.iloc[i : i + SLICE].tolist()
            h, _, g = chunk_hashes(*_letters(part, per_line=False)[1:])
            order = np.lexsort((h, g))
            h, g = h[order], g[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            h, g = h[new], g[new]
            out += np.split(h, np.searchsorted(g, np.arange(1, len(part))))
        yield pd.Series(out, dtype=object)


@F.pandas_udf(_LINES)
def line_chunks(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Per line of at least two cuts: its letters and its longest chunk (the least hash of
    those), which is the same in every document."""
    for s in texts:
        out = []
        for i in range(0, len(s), SLICE):
            keys, codes, group = _letters(s.iloc[i : i + SLICE].tolist(), per_line=True)
            h, n, g = chunk_hashes(codes, group)
            order = np.lexsort((h, -n, g))
            h, g = h[order], g[order]
            first = np.ones(len(g), bool)
            first[1:] = g[1:] != g[:-1]
            best = dict(zip(g[first].tolist(), h[first].tolist(), strict=True))
            line = 0
            for ks in keys:
                out.append([{"line_no": k, "line_key": key, "chunk": best[line + k]} for k, key in enumerate(ks) if line + k in best])
                line += len(ks)
        yield pd.Series(out, dtype=object)


def repeated_lines(docs: DataFrame, min_chars: int = 12, min_docs: int = 3, min_share: float = 0.08, key: str = "doc_id") -> DataFrame:
    """``source, doc_id, line_no, line_key, n_docs, source_docs`` of every over-repeated line.

    ``min_chars`` must be at least ``GRAM + 2 * WINDOW - 1``.  Null and empty texts
    have no lines but count as documents of their source; a null source is a source
    of its own; a line twice in a document counts once there, and both are rows;
    repeated document rows are one document.
    """
    assert min_chars >= GRAM + 2 * WINDOW - 1
    d = docs.select(F.coalesce("source", F.lit("")).alias("source"), F.col(key).alias("doc_id"), "text")
    totals = stage(d.groupBy("source").agg(F.countDistinct("doc_id").alias("source_docs")), "source_docs")
    # exact: 14 of 175 documents are 8 %, which binary fractions miss
    need = F.greatest(F.lit(min_docs).cast("decimal(26,6)"), (F.col("source_docs").cast("decimal(19,0)") * F.lit(Decimal(str(min_share)).quantize(Decimal("0.000001")))).cast("decimal(26,6)"))
    chunked = d.select("source", F.explode(text_chunks("text")).alias("chunk"))
    # a document is one row here; repeated rows are sorted out by the exact count below
    frequent = chunked.groupBy("source", "chunk").agg(F.count("*").alias("n")).join(totals, "source").where(F.col("n") >= need).select("source", "chunk")
    frequent = stage(frequent, "chunks")
    lines = d.select("source", "doc_id", F.inline(line_chunks("text"))).where(F.length("line_key") >= min_chars)
    candidates = stage(lines.join(frequent, ["source", "chunk"], "left_semi").select("source", "doc_id", "line_no", "line_key"), "lines")
    counted = candidates.select("source", "line_key", "doc_id").distinct().groupBy("source", "line_key").agg(F.count("*").alias("n_docs"))
    kept = stage(counted.join(totals, "source").where(F.col("n_docs") >= need), "repeated")
    return candidates.distinct().join(kept, ["source", "line_key"]).select("source", "doc_id", "line_no", "line_key", "n_docs", "source_docs")


def without_lines(docs: DataFrame, found: DataFrame, key: str = "doc_id") -> DataFrame:
    """All documents, their found lines taken out: ``doc_id, text, n_removed``.  Null texts stay null."""
    # at most as many numbers per document as it has lines
    gone = found.groupBy("doc_id").agg(F.collect_set("line_no").alias("gone"))
    j = docs.select(F.col(key).alias("doc_id"), "text").join(gone, "doc_id", "left")
    lines = F.split("text", "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.coalesce(F.array_contains("gone", i.cast("bigint")), F.lit(False))), "\n")
    return j.select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias("n_removed"))
