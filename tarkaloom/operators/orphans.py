"""References to records that do not exist, were withdrawn, or came later.

Parent and child keys are brought into one tagged long form and grouped by
key.  The group keeps only a few bounded values (is there a parent, its first
arrival, the first arrival of a version that still stands, first and last
citation), so a key that holds a third of all rows is combined map-side and
never gathered.  Keys without any doubt end there; the rows of doubtful keys
are joined back with salt.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarkaloom.functions.text import strip_ws

CHILD_COLUMNS = ["ref_table", "row_key", "ref_key", "cited_at"]


def ref_key(c: Column) -> Column:
    """Key form: lower case, outer spaces removed, blank as null."""
    return F.nullif(strip_ws(F.lower(c)), F.lit(""))


def parent_keys(records: DataFrame, id_cols: list[str], loaded: str = "loaded_at", withdrawn: str = "withdrawn_at") -> DataFrame:
    """One row per record and id it answers to; null and blank ids give none."""
    ids = F.array_distinct(F.array(*[ref_key(F.col(c)) for c in id_cols]))
    return records.select(F.explode(ids).alias("ref_key"), F.col(loaded).alias("loaded"), F.col(withdrawn).alias("withdrawn")).where("ref_key is not null")


def child_keys(rows: DataFrame, ref_table: str, key: str, ref: str, at: str) -> DataFrame:
    """The citing rows in long form; null and blank references are no references."""
    return rows.select(F.lit(ref_table).alias("ref_table"), F.col(key).cast("string").alias("row_key"), ref_key(F.col(ref)).alias("ref_key"), F.col(at).alias("cited_at")).where("ref_key is not null")


def doubtful_keys(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Group parents and children by key and keep keys that may have orphans."""
    ts = "timestamp_ntz"
    long = parents.select(
        "ref_key",
        F.lit(1).alias("is_parent"),
        "loaded",
        F.when(F.col("withdrawn").isNull(), F.col("loaded")).alias("standing"),
        F.lit(None).cast(ts).alias("cited_at"),
    ).unionByName(children.select("ref_key", F.lit(0).alias("is_parent"), F.lit(None).cast(ts).alias("loaded"), F.lit(None).cast(ts).alias("standing"), "cited_at"))
    g = long.groupBy("ref_key").agg(
        F.max("is_parent").alias("has_parent"),
        F.min("loaded").alias("first_loaded"),
        F.min("standing").alias("standing_from"),
        F.min("cited_at").alias("first_cited"),
        F.count_if(F.col("is_parent") == 0).alias("n_refs"),
    )
    safe = (F.col("has_parent") == 1) & F.col("standing_from").isNotNull() & (F.col("standing_from") <= F.col("first_cited"))
    return g.where((F.col("n_refs") > 0) & ~F.coalesce(safe, F.lit(False)))


def orphans(parents: DataFrame, children: DataFrame, salts: int = 16) -> DataFrame:
    """``ref_table, row_key, reason, period`` of every orphan reference.

    ``missing``: no parent has the key.  ``late``: every parent was loaded after
    the citation.  ``withdrawn``: parents were loaded at or before the citation
    and all of those were withdrawn at or before it.  A citation without a time
    can only be ``missing`` (period null).  Empty tables give an empty result;
    repeated rows are reported as often as they occur.
    """
    keys = doubtful_keys(parents, children).select("ref_key", "has_parent", "first_loaded", "standing_from", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    rows = children.withColumn("salt", F.pmod(F.xxhash64("row_key"), F.lit(salts)).cast("int"))
    j = rows.join(keys, ["ref_key", "salt"])
    none = F.col("has_parent") == 0
    late = F.col("first_loaded") > F.col("cited_at")
    stands = F.col("standing_from") <= F.col("cited_at")
    j = j.withColumn("state", F.when(none, "missing").when(late, "late").when(F.coalesce(stands, F.lit(False)) | F.col("cited_at").isNull(), "ok").otherwise("open"))
    period = F.date_format("cited_at", "yyyy-MM")
    out = ["ref_table", "row_key", "reason", "period"]
    sure = j.where("state in ('missing','late')").select("ref_table", "row_key", F.col("state").alias("reason"), period.alias("period"))
    # Rows whose key has only withdrawn versions so far: is one of them in force at
    # the citation? Equi-join on key and month keeps long histories spread out.
    month = lambda c: F.year(c) * 12 + F.month(c)
    held = parents.where("withdrawn is not null and withdrawn > loaded").select(
        F.col("ref_key").alias("k"), "loaded", "withdrawn", F.explode(F.sequence(month(F.col("loaded")), month(F.col("withdrawn")))).alias("m")
    )
    open_rows = j.where("state = 'open'").withColumn("month_no", month(F.col("cited_at")))
    gone = open_rows.join(held, (F.col("ref_key") == F.col("k")) & (F.col("month_no") == F.col("m")) & (F.col("loaded") <= F.col("cited_at")) & (F.col("withdrawn") > F.col("cited_at")), "left_anti")
    return sure.unionByName(gone.select("ref_table", "row_key", F.lit("withdrawn").alias("reason"), period.alias("period"))).select(*out)


def orphan_report(found: DataFrame) -> DataFrame:
    """Orphans per table, month and reason."""
    return found.groupBy("ref_table", "period", "reason").agg(F.count("*").alias("n_orphans"))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
