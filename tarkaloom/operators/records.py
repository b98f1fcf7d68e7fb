"""Operators over corpus records: ids, order, alignment, repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarkaloom.functions.text import strip_ws
from tarkaloom.operators.ordered import number_rows

PREFERRED = ("en", "sa")


def id_uniqueness(df: DataFrame, group: str, key: str) -> DataFrame:
    """Rows and distinct ids per group; a null id counts as one value."""
    g = df.groupBy(group).agg(F.count("*").alias("n_rows"), (F.count_distinct(key) + F.max(F.col(key).isNull().cast("int"))).alias("n_ids"))
    return g.withColumn("is_unique", F.col("n_rows") == F.col("n_ids"))


def repaired_ids(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Ids renumbered within their prefix (the id without a trailing ``_digits``)."""
    prefix = F.when(F.col(key).rlike("_[0-9]+$"), F.regexp_replace(key, "_[0-9]+$", "")).otherwise(F.col(key))
    d = number_rows(df.withColumn("prefix", prefix), ["prefix"], order, "_at")
    return d.withColumn("new_id", F.format_string("%s_%05d", "prefix", "_at")).drop("_at")


def dedupe_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First row of each key; combined map-side, so repeated keys never gather."""
    cols = [c for c in df.columns if c not in order]
    g = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    first = g.select(key, *[F.col(f"_first.{c}").alias(c) for c in order])
    return df.select(*order, *cols).join(first, [key, *order], "left_semi")


def sample_order(key: str, seed: int) -> Column:
    """A reproducible random order: hash of the id and the seed."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def cap_per_group(df: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """A seeded sample of at most ``n`` rows per group, without replacement."""
    w = Window.partitionBy(group).orderBy(sample_order(key, seed), key)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).drop("rank")


def preferred_commentaries(records: DataFrame, n: int = 2) -> Column:
    """The first ``n`` commentaries, those in preferred languages first, order kept."""
    good = lambda c: F.coalesce(c["lang"].isin(*PREFERRED), F.lit(False))
    return F.slice(F.concat(F.filter("commentaries", good), F.filter("commentaries", lambda c: ~good(c))), F.lit(1), F.lit(n))


def prompts(records: DataFrame) -> DataFrame:
    """``rec_no, prompt``: the text (600 characters) and two commentaries (500 each)."""
    r = records.withColumn("sel", F.coalesce(preferred_commentaries(records), F.array().cast("array<struct<commentator:string,school:string,lang:string,type:string,text:string>>")))
    part = lambda c: F.concat(F.lit("["), F.coalesce(c["commentator"], F.lit("unknown")), F.lit(" / "), F.coalesce(c["school"], F.lit("unknown")), F.lit("]: "), F.left(c["text"], F.lit(500)))
    parts = F.array_join(F.transform(F.filter("sel", lambda c: F.coalesce(c["text"], F.lit("")) != ""), part), "\n\n")
    names = F.array_join(F.transform("sel", lambda c: F.coalesce(c["commentator"], F.lit("?"))), ", ")
    filled = lambda c, d: F.when(F.coalesce(c, F.lit("")) == "", d).otherwise(c)
    text = F.concat(
        F.lit("Source: "), F.coalesce("source", F.lit("unknown")), F.lit("\nSystem: "), F.coalesce("darshana", F.lit("unknown")), F.lit("\nCommentators: "), filled(names, "none"),
        F.lit("\nText: "), filled(F.left("text", F.lit(600)), "(no verse text)"), F.lit("\nCommentary: "), filled(parts, "(no commentary)"),
    )
    return r.select("rec_no", text.alias("prompt"))


def priority_pick(records: DataFrame, priority: list[str]) -> DataFrame:
    """Per record the first non-blank commentary by language priority, else the first."""
    c = records.select("rec_no", F.posexplode("commentaries").alias("pos", "c")).where(strip_ws(F.col("c.text")) != "")
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, priority)), F.col("c.lang")), F.lit(0))
    rank = F.when(rank == 0, 999).otherwise(rank)
    return c.groupBy("rec_no").agg(F.min_by(F.struct("c.lang", "c.commentator", "pos"), F.struct(rank, "pos")).alias("p")).select("rec_no", F.col("p.lang").alias("lang"), F.col("p.commentator").alias("commentator"), F.col("p.pos").cast("bigint").alias("com_pos"))


def parallel_texts(records: DataFrame) -> DataFrame:
    """How many records and sources share each (chapter, section, verse)."""
    sec = F.regexp_extract(F.coalesce("section", F.lit("")), "([0-9]+)", 1)
    r = records.where("chapter is not null and verse is not null").select("chapter", sec.alias("section_no"), "verse", "source")
    d = r.groupBy("chapter", "section_no", "verse", "source").agg(F.count("*").alias("n"))
    return d.groupBy("chapter", "section_no", "verse").agg(F.count("*").alias("n_sources"), F.sum("n").alias("n_records"))


def todo(records: DataFrame, done: DataFrame, key: str, done_key: str, retry_failed: bool = True) -> DataFrame:
    """Records that are not done yet; failed ones count as open unless told otherwise."""
    d = done.where("error is null or error = ''") if retry_failed else done
    return records.join(d.select(F.col(done_key).alias(key)).distinct(), key, "left_anti")


def versions(records: DataFrame) -> DataFrame:
    """Deliveries of each id in order, with the previous one and what changed; rows without
    an id are deliveries of nothing."""
    w = Window.partitionBy("id").orderBy("loaded_at", "rec_no")
    d = records.where("id is not null").withColumns({"version": F.row_number().over(w), "previous": F.lag("rec_no").over(w), "old": F.lag("text").over(w)})
    return d.select("id", "rec_no", F.col("version").cast("bigint").alias("version"), "previous", F.col("previous").isNotNull() & ~F.col("old").eqNullSafe(F.col("text")).alias("x")).toDF("id", "rec_no", "version", "previous", "text_changed")


def text_over_first(records: DataFrame, text: str = "text") -> DataFrame:
    """Records whose first commentary has the record's own text; other members and commentaries
    stay as they are, and records without commentaries, too."""
    over = F.transform("commentaries", lambda c, i: F.when(i == 0, c.withField("text", F.col(text))).otherwise(c))
    return records.withColumn("commentaries", F.coalesce(over, F.array().cast(records.schema["commentaries"].dataType)))


def counters_as_map(counts: DataFrame, by: str, value: str, n: str) -> DataFrame:
    """``by, counts``: sums per value as one map, sorted by value; null values aren't counted.

    Sums are combined map-side; a map holds distinct values only.
    """
    sums = counts.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.sum(n).alias("_n"))
    return sums.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(value, "_n")))).alias("counts"))
