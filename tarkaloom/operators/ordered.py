"""State carried along an order, in blocks.

A window over one group is one task, however long the group.  Here a group is cut
into blocks of the order key; windows run inside blocks, and only one row per block
(its size, its last value) is carried from block to block.  The first order column
must be a number; rows with equal values share a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# rows of a block where the key counts rows without gaps; give another one for sparse keys
BLOCK = 20_000


def _blocked(df: DataFrame, order: list[str], block: int) -> DataFrame:
    return df.withColumn("_b", F.floor(F.col(order[0]) / F.lit(block)))


def _inside(by: list[str], order: list[str]) -> Window:
    return Window.partitionBy(*by, "_b").orderBy(*order)


def _with_carry(d: DataFrame, summary: DataFrame, by: list[str]) -> DataFrame:
    """Join what earlier blocks hand on; null groups join too."""
    s = summary.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_b").alias("_kb"), "_carry")
    on = d["_b"] == s["_kb"]
    for c in by:
        on = on & d[c].eqNullSafe(s[f"_k_{c}"])
    return d.join(s, on, "left").drop("_kb", *[f"_k_{c}" for c in by])


def number_rows(df: DataFrame, by: list[str], order: list[str], out: str, block: int = BLOCK) -> DataFrame:
    """1, 2, ... along the order within each group."""
    d = _blocked(df, order, block)
    sizes = d.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_carry", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    d = _with_carry(d.withColumn("_r", F.row_number().over(_inside(by, order))), offsets, by)
    return d.withColumn(out, F.col("_r") + F.col("_carry")).drop("_r", "_b", "_carry")


def forward_fill(df: DataFrame, by: list[str], order: list[str], value: str | Column, out: str, block: int = BLOCK) -> DataFrame:
    """The last non-null value so far within each group (null before any)."""
    d = _blocked(df, order, block).withColumn("_v", F.col(value) if isinstance(value, str) else value)
    last = d.where("_v is not null").groupBy(*by, "_b").agg(F.max_by("_v", F.struct(*order)).alias("_last"))
    every = d.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    on = every["_b"] == last["_b"]
    for c in by:
        on = on & every[c].eqNullSafe(last[c])
    held = every.join(last, on, "left").select(*[every[c] for c in by], every["_b"], "_last")
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("_carry", F.last("_last", ignorenulls=True).over(before))
    here = F.last("_v", ignorenulls=True).over(_inside(by, order).rowsBetween(Window.unboundedPreceding, 0))
    d = _with_carry(d.withColumn("_h", here), held, by)
    return d.withColumn(out, F.coalesce("_h", "_carry")).drop("_v", "_h", "_b", "_carry")


def previous(df: DataFrame, by: list[str], order: list[str], value: str, out: str, block: int = BLOCK) -> DataFrame:
    """``struct(value)`` of the row before, null for the first row of a group."""
    d = _blocked(df, order, block).withColumn("_v", F.struct(F.col(value).alias("value")))
    last = d.groupBy(*by, "_b").agg(F.max_by("_v", F.struct(*order)).alias("_last"))
    held = last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(*by).orderBy("_b")))
    d = _with_carry(d.withColumn("_h", F.lag("_v").over(_inside(by, order))), held, by)
    return d.withColumn(out, F.coalesce("_h", "_carry")).drop("_v", "_h", "_b", "_carry")


def section_with_reset(df: DataFrame, by: list[str], order: list[str], chapter: str, section: Column, out: str, block: int = BLOCK) -> DataFrame:
    """Carried section number: a new chapter resets it to 1 unless the same row names one."""
    d = previous(df, by, order, chapter, "_prev", block)
    fresh = F.col(chapter).isNotNull() & (F.col("_prev").isNull() | ~F.col("_prev.value").eqNullSafe(F.col(chapter)))
    return forward_fill(d, by, order, F.when(section.isNotNull(), section).when(fresh, 1), out, block).drop("_prev")


def counter(df: DataFrame, by: list[str], order: list[str], number: str, out: str, block: int = BLOCK) -> DataFrame:
    """The number if given, else the previous one plus 1 (before any: 1, 2, ...)."""
    d = number_rows(df, by, order, "_at", block)
    seen = F.when(F.col(number).isNotNull(), F.struct(F.col(number).alias("n"), F.col("_at").alias("at")))
    d = forward_fill(d, by, order, seen, "_seen", block)
    return d.withColumn(out, F.coalesce(F.col("_seen.n") + F.col("_at") - F.col("_seen.at"), F.col("_at"))).drop("_seen", "_at")
