"""Mixing sources to target weights by cube-method balanced sampling.

Every document of a source starts with the same expected number of copies (the
source's target tokens over its tokens); whole copies are certain, the fraction is
sampled.  The flight phase moves the fractions of a block of documents along the
null space of the balancing constraints (number of documents, number of tokens), so
both totals stay exactly as expected while documents are settled at 0 or 1; only two
per block stay open.  These go into the next, smaller round, until one block per
source is left; its last two documents (the landing problem) take the outcome that misses the
token total least.

Blocks are hashes of the ids of at most about ``BLOCK`` documents, so a source of
any size is spread over many tasks.  A handful of numbers per source (the targets
table bounds them) is all that reaches the driver.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarkaloom.plans.session import stage

BLOCK = 2_000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern that belongs to that public vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_EPS = 1e-9


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, pattern: str = PATTERN, text: str = "text") -> DataFrame:
    """Add ``n_tokens`` by a public byte-level vocabulary; null and empty texts have 0.

    The vocabulary file is read on the driver's machine and sent to the executors.
    """
    docs.sparkSession.sparkContext.addFile(tokenizer)
    name = tokenizer.rsplit("/", 1)[-1]

    @F.pandas_udf(T.LongType())
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        with open(SparkFiles.get(name), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for s in texts:
            yield s.map(lambda t: len(enc.encode_ordinary(t)) if t else 0).astype("int64")

    return docs.withColumn("n_tokens", count(text))


def flight(p: np.ndarray, x: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Settle inclusion probabilities ``p`` balanced on their number and on ``x``.

    Leaves at most two open; with ``land`` those are settled as well.
    """
    p = p.astype(float).copy()
    todo = [int(i) for i in rng.permutation(len(p)) if _EPS < p[i] < 1 - _EPS]
    todo.reverse()
    held: list[int] = []
    while True:
        while len(held) < 3 and todo:
            held.append(todo.pop())
        if len(held) == 3:
            a, b, c = held
            # null space of the rows (1, 1, 1) and (x_a, x_b, x_c)
            u = (x[b] - x[c], x[c] - x[a], x[a] - x[b])
            if not any(u):
                u = (1.0, -1.0, 0.0)
        else:
            break
        up = min((((1 - p[i]) / v) if v > 0 else (p[i] / -v)) for i, v in zip(held, u, strict=True) if v)
        down = min(((p[i] / v) if v > 0 else ((1 - p[i]) / -v)) for i, v in zip(held, u, strict=True) if v)
        step = up if rng.random() * (up + down) < down else -down
        for i, v in zip(held, u, strict=True):
            p[i] = min(1.0, max(0.0, p[i] + step * v))
        held = [i for i in held if _EPS < p[i] < 1 - _EPS]
    if land and held:
        # the landing problem: of the few outcomes the one that misses the tokens least
        outcomes = itertools.product((0.0, 1.0), repeat=len(held))
        best = min(outcomes, key=lambda o: abs(sum(x[i] * (s - p[i]) for i, s in zip(held, o, strict=True))))
        p[held] = best
    p[p < _EPS] = 0.0
    p[p > 1 - _EPS] = 1.0
    return p


def plan(sizes: DataFrame, targets: DataFrame, total_tokens: float | None = None, of_corpus: float | None = None) -> list[dict]:
    """Per listed source with documents: share, tokens, wanted copies per document.

    Without ``total_tokens`` the mix is the largest at which every source reaches its
    share within its cap.  Shares of sources without documents go to the others in
    proportion.  With a total that is too large, sources stop at their caps.  ``of_corpus``
    states the total as a multiple of the tokens of those sources.
    """
    have = sizes.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    rows = [r.asDict() for r in targets.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).join(have, "source", "left").collect()]
    live = [r for r in rows if r["tokens"] and r["target_share"] and r["target_share"] > 0 and (r["max_repeats"] or 0) > 0]
    share = sum(r["target_share"] for r in live)
    for r in live:
        r["share"] = r["target_share"] / share
    if of_corpus is not None:
        total_tokens = of_corpus * sum(r["tokens"] for r in live)
    if total_tokens is None:
        total_tokens = min((r["tokens"] * r["max_repeats"] / r["share"] for r in live), default=0.0)
    for r in live:
        r["copies"] = min(float(r["max_repeats"]), r["share"] * total_tokens / r["tokens"])
    return live


def _settle(seed: int, level: int, land: bool) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """The flight phase of one block; its random numbers depend on the block alone."""

    def settle(block: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "n_tokens"]).reset_index(drop=True)
        rng = np.random.default_rng([seed, level, xxhash.xxh32_intdigest(block[0]), int(block[1])])
        pdf["p"] = flight(pdf["p"].to_numpy(), pdf["n_tokens"].to_numpy(dtype=float), rng, land)
        return pdf[["doc_id", "source", "n_tokens", "p"]]

    return settle


def mixed(docs: DataFrame, targets: DataFrame, total_tokens: float | None = None, seed: int = 42, key: str = "doc_id", tokenizer: str = TOKENIZER, of_corpus: float | None = None) -> DataFrame:
    """``doc_id, source, n_tokens, copies`` of every document in the mix (copies > 0).

    Documents of a null or unlisted source and texts without a token are not mixed;
    a repeated row is a document of its own.  The same seed gives the same mix.
    """
    spark = docs.sparkSession
    sizes = stage(token_counts(docs, tokenizer).where("source is not null and n_tokens > 0").select(F.col(key).cast("bigint").alias("doc_id"), "source", "n_tokens"), "sizes")
    rows = plan(sizes, targets, total_tokens, of_corpus)
    schema = "source string, whole bigint, part double, docs bigint"
    frac = lambda c: 0.0 if c - int(c) < _EPS or int(c) + 1 - c < _EPS else c - int(c)
    per = spark.createDataFrame([(r["source"], int(round(r["copies"]) if not frac(r["copies"]) else int(r["copies"])), frac(r["copies"]), r["docs"]) for r in rows], schema)
    units = sizes.join(F.broadcast(per), "source")  # one row per listed source
    open_, done, n = units.where("part > 0").select("doc_id", "source", "n_tokens", F.col("part").alias("p"), "docs"), [units.where("part = 0").select("doc_id", "source", "n_tokens", F.lit(0).cast("bigint").alias("extra"))], max((r["docs"] for r in rows), default=0)
    level = 0
    while True:
        last = n <= BLOCK
        blocks = F.lit(1) if last else F.ceil(F.col("docs") / BLOCK)
        placed = open_.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(seed + level)), blocks.cast("bigint")))
        out = stage(placed.groupBy("source", "block").applyInPandas(_settle(seed, level, last), "doc_id bigint, source string, n_tokens bigint, p double"), f"flight{level}")
        done.append(out.where("p in (0.0, 1.0)").select("doc_id", "source", "n_tokens", F.col("p").cast("bigint").alias("extra")))
        if last:
            break
        left = out.where("p > 0 and p < 1")
        counts = left.groupBy("source").agg(F.count("*").alias("docs"))
        open_ = left.join(F.broadcast(counts), "source").select("doc_id", "source", "n_tokens", "p", "docs")
        n = counts.agg(F.max("docs")).first()[0] or 0
        level += 1
    settled = done[0]
    for d in done[1:]:
        settled = settled.unionByName(d)
    return settled.join(F.broadcast(per.select("source", "whole")), "source").select("doc_id", "source", "n_tokens", (F.col("whole") + F.col("extra")).alias("copies")).where("copies > 0")


def shares(mix: DataFrame, targets: DataFrame) -> DataFrame:
    """Target and reached share per listed source, and the most copies of a document."""
    got = mix.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.sum("copies").alias("documents"), F.max("copies").alias("most_copies"))
    total = got.agg(F.sum("tokens")).first()[0] or 1
    j = targets.join(got, "source", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return j.select("source", "target_share", "max_repeats", zero("documents"), zero("tokens"), zero("most_copies"), F.round(F.coalesce("tokens", F.lit(0)) / float(total), 6).alias("reached_share"))
