"""Following next-links: position in the chain and its head, by pointer doubling.

A chain of n records needs about log2(n) joins instead of n steps; cycles end when
the rounds are over and are reported as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarkaloom.plans.session import stage


def chain_positions(links: DataFrame, node: str, previous: str) -> DataFrame:
    """``node, head, position`` (0 at the head); nodes of a cycle have no head.

    A previous node that isn't in the table counts as no previous node.
    """
    n = links.select(F.col(node).alias("node"), F.col(previous).alias("up")).dropDuplicates(["node"])
    known = n.select(F.col("node").alias("up"))
    cur = n.join(known, "up", "left_semi").select("node", "up", F.lit(1).cast("bigint").alias("hops")).unionByName(n.join(known, "up", "left_anti").select("node", F.lit(None).cast(n.schema["up"].dataType).alias("up"), F.lit(0).cast("bigint").alias("hops")))
    cur = stage(cur.withColumn("head", F.when(F.col("up").isNull(), F.col("node"))), "chain")
    # a chain of n rows is settled after about log2(n) rounds; what is open then is a cycle
    for _ in range(max(cur.count(), 1).bit_length() + 1):
        if cur.where("head is null").isEmpty():
            break
        jump = cur.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("hops").alias("hops2"), F.col("head").alias("head2"))
        settled, open_ = cur.where("head is not null"), cur.where("head is null")
        moved = open_.join(jump, "up").select("node", F.col("up2").alias("up"), (F.col("hops") + F.col("hops2")).alias("hops"), F.col("head2").alias("head"))
        cur = stage(settled.select("node", "up", "hops", "head").unionByName(moved), "chain")
    return cur.select(F.col("node").alias(node), "head", F.when(F.col("head").isNotNull(), F.col("hops")).alias("position"))
