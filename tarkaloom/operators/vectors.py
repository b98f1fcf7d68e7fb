"""Centroids of groups of vectors and the distances between them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def centroids(vectors: DataFrame, group: str, key: str, vector: str, first: int | None = None, least: int = 2) -> DataFrame:
    """``group, i, x``: mean vector per group in long form, over the ``first`` vectors by
    key where asked; groups of fewer than ``least`` are left out.

    Sums are combined map-side per dimension; no group is gathered.
    """
    v = vectors.where(F.col(group).isNotNull() & F.col(vector).isNotNull())
    if first:
        v = v.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(key))).where(F.col("rank") <= first)
    n = v.groupBy(group).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    long = v.select(group, F.posexplode(vector).alias("i", "x"))
    means = long.groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.join(n.select(group), group, "left_semi")


def centroid_pairs(cent: DataFrame, group: str) -> DataFrame:
    """Cosine distance of each unordered pair of groups, from per-dimension products.

    The number of groups bounds the pairs; the join is an equi-join on the dimension.
    """
    a = cent.select(F.col(group).alias("group_a"), "i", F.col("x").alias("xa"))
    b = cent.select(F.col(group).alias("group_b"), "i", F.col("x").alias("xb"))
    norm = F.sqrt(F.sum(F.col("xa") * F.col("xa")) * F.sum(F.col("xb") * F.col("xb")))
    j = a.join(b, "i").where("group_a < group_b").groupBy("group_a", "group_b").agg((1 - F.sum(F.col("xa") * F.col("xb")) / norm).alias("d"))
    return j.select("group_a", "group_b", F.round("d", 6).alias("distance"))


def sparse_pairs(counts: DataFrame, by: str, group: str, dim: str, x: str) -> DataFrame:
    """``by, group_a, group_b, distance``: cosine distance of each unordered pair of groups of one
    ``by``, from counts in long form; 1 where two groups share no dimension.

    Groups are few (names); a dimension is joined only within its ``by``.
    """
    c = counts.select(by, F.col(group).alias("g"), F.col(dim).alias("i"), F.col(x).cast("double").alias("x"))
    norms = c.groupBy(by, "g").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    side = lambda d, s: d.select(by, *[F.col(n).alias(f"{'group' if n == 'g' else n}_{s}" if n != "i" else "i") for n in d.columns if n != by])
    dots = side(c, "a").join(side(c, "b"), [by, "i"]).where("group_a < group_b").groupBy(by, "group_a", "group_b").agg(F.sum(F.col("x_a") * F.col("x_b")).alias("dot"))
    pairs = side(norms, "a").join(side(norms, "b"), by).where("group_a < group_b").join(dots, [by, "group_a", "group_b"], "left")
    return pairs.select(by, "group_a", "group_b", F.round(1 - F.coalesce("dot", F.lit(0.0)) / (F.col("norm_a") * F.col("norm_b")), 6).alias("distance"))


def rank_disagreement(pairs: DataFrame) -> DataFrame:
    """Per group: mean distance to the others, and the farthest one (ties: the larger)."""
    both = pairs.select(F.inline(F.array(F.struct(F.col("group_a").alias("g"), F.col("group_b").alias("o"), "distance"), F.struct(F.col("group_b").alias("g"), F.col("group_a").alias("o"), "distance"))))
    return both.groupBy("g").agg(F.round(F.avg("distance"), 6).alias("mean_distance"), F.max(F.struct("distance", "o")).alias("m")).select("g", "mean_distance", F.col("m.o").alias("farthest"), F.col("m.distance").alias("max_distance"))


def isolation(pairs: DataFrame, member: Callable[[Column], Column]) -> DataFrame:
    """Mean distance of groups of a class to each other (within) and to the groups outside
    it (across), and their ratio; pairs of two groups outside count nowhere."""
    a, b = member(F.col("group_a")), member(F.col("group_b"))
    g = pairs.agg(F.avg(F.when(a & b, F.col("distance"))).alias("a"), F.avg(F.when(a != b, F.col("distance"))).alias("b"))
    return g.select(F.round("a", 6).alias("within"), F.round("b", 6).alias("across"), F.round(F.col("b") / F.col("a"), 6).alias("ratio"))
