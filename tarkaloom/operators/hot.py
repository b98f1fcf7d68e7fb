"""Joins on keys of which a few may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarkaloom.plans.session import stage

# rows of one key that are left in one task
ROWS = 100_000
# keys that are sent to all executors at once
MOST_SENT = 50_000


def hot_keys(rows: DataFrame, key: str, most: int = ROWS) -> DataFrame:
    """``key, parts`` of keys with more than ``most`` rows (counted map-side first).

    There are at most rows / ``most`` of them.
    """
    n = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most)
    return n.select(key, F.ceil(F.col("n") / most).cast("int").alias("parts"))


def salted_join(rows: DataFrame, side: DataFrame, key: str, row_id: str, how: str = "inner", most: int = ROWS, keys: DataFrame | None = None) -> DataFrame:
    """``rows`` joined with ``side`` on ``key`` (inner or left): the rows of hot keys are dealt
    over several tasks by a hash of ``row_id``, and only the sides of those keys are copied.

    Null keys match nothing.  ``keys``: the key column of ``rows`` (or of more rows) where it is
    cheaper to count alone.
    """
    hot = stage(hot_keys(rows if keys is None else keys, key, most), "hot_keys")
    n_hot = hot.count()
    if not n_hot:
        return rows.join(side, key, how)
    # small enough to be sent whole, or joined by shuffle like any table
    hot = F.broadcast(hot) if n_hot <= MOST_SENT else hot
    dealt = rows.join(hot, key, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(row_id), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1))
    copied = side.where(F.col(key).isNotNull()).join(hot, key, "left").withColumn("_salt", copies).drop("parts")
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")
