"""Queries that run as flows: streams, chains, assembled lines, mentions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarkaloom.operators import records as R
from tarkaloom.operators.chains import chain_positions
from tarkaloom.operators.tagging import mentions
from tarkaloom.plans.session import shared_dir, ship, table
from tarkaloom.streaming import resume


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/flows/{name}-{uuid.uuid4().hex}"


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged records streamed into a table, one row per record id; run twice, the second
    run finds nothing new."""
    ship(spark)
    at = _fresh(spark, "resume")
    for _ in range(2):
        resume.run_available(spark, f"{sf_dir}/tagged_record.parquet", f"{at}/sink", f"{at}/checkpoint", "record_id")
    return spark.read.parquet(f"{at}/sink").select("record_id")


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges per 30-day window of the time they were tagged, by a stateful stream."""
    ship(spark)
    at = _fresh(spark, "windows")
    w = resume.monthly_counts(spark, f"{sf_dir}/graph_edge.parquet", f"{at}/sink", f"{at}/checkpoint", "tagged_at")
    return w.select(F.date_format("start", "yyyy-MM-dd").alias("start"), "n")


def chain_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Head and place of every record in its chain of deliveries."""
    return chain_positions(R.versions(table(spark, sf_dir, "corpus_record")), "rec_no", "previous")


def verse_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document put together under the verse reference they follow; lines
    before the first reference have none."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    ref = F.nullif(F.regexp_extract("line", r"^(Verse [0-9]+[.]|[IVXLC]+[.][0-9]+)$", 1), F.lit(""))
    d = lines.withColumn("ref", ref).withColumns({"island": F.count("ref").over(w), "carried": F.last("ref", ignorenulls=True).over(w)})
    # lines of one document are bounded by its text
    body = d.where("ref is null and line <> ''").groupBy("doc_id", "island", "carried").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("ls"))
    return body.select("doc_id", F.col("island").cast("bigint").alias("island"), F.col("carried").alias("ref"), F.size("ls").cast("bigint").alias("n_lines"), F.md5(F.array_join(F.transform("ls", lambda x: x["line"]), " ")).alias("body_md5"))


def concept_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records of each school have each concept, and how often."""
    r = table(spark, sf_dir, "corpus_record")
    m = mentions(r.where("school is not null"), table(spark, sf_dir, "concept_ref"), carry=("school",))
    return m.groupBy("concept_id", "school").agg(F.count("*").alias("n_records"), F.sum("n").alias("n_mentions"))


QUERIES = {"stream_resume": stream_resume, "stream_windows": stream_windows, "chain_walk": chain_walk, "verse_assemble": verse_assemble, "concept_mentions": concept_mentions}
SQL = {
    "stream_resume": "select distinct record_id from tagged_record",
    "stream_windows": "select strftime(to_timestamp(floor(epoch(tagged_at) / 2592000) * 2592000) at time zone 'UTC', '%Y-%m-%d') as start, count(*) as n from graph_edge where tagged_at is not null group by 1",
    "chain_walk": "select rec_no, first_value(rec_no) over w as head, row_number() over w - 1 as position from corpus_record where id is not null window w as (partition by id order by loaded_at, rec_no)",
    "verse_assemble": """with l as (select doc_id, i - 1 as line_no, p[i] as line, nullif(regexp_extract(p[i], '^(Verse [0-9]+[.]|[IVXLC]+[.][0-9]+)$', 1), '') as ref from (select doc_id, string_split(text, chr(10)) as p from documents), unnest(range(1, len(p) + 1)) as u(i)),
      d as (select *, count(ref) over w as island, last_value(ref ignore nulls) over w as carried from l window w as (partition by doc_id order by line_no rows between unbounded preceding and current row))
      select doc_id, island, carried as ref, count(*) as n_lines, md5(string_agg(line, ' ' order by line_no)) as body_md5 from d where ref is null and line <> '' group by 1, 2, 3""",
    "concept_mentions": """with w as (select rec_no, school, unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{M}]+)')) as word from corpus_record where school is not null)
      select concept_id, school, count(distinct rec_no) as n_records, count(*) as n_mentions from w join concept_ref c on lower(c.name) = word group by 1, 2""",
}
