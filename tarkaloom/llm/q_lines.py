"""Queries of problem 4: lines repeated across one source's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.llm import site_lines
from tarkaloom.plans.session import spread, stage, table


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = site_lines.repeated_lines(spread(table(spark, sf_dir, "documents")))
    return found.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("line_no").cast("bigint").alias("line_no"))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The over-repeated lines of each source."""
    found = site_lines.repeated_lines(spread(table(spark, sf_dir, "documents")))
    return found.groupBy("source", "line_key").agg(F.max("n_docs").alias("n_docs"), F.max("source_docs").alias("source_docs"), F.count("*").alias("n_lines"))


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without those lines."""
    docs = spread(table(spark, sf_dir, "documents"))
    return site_lines.without_lines(docs, stage(site_lines.repeated_lines(docs), "found"))


_SQL = r"""
with lines as (
  select coalesce(source, '') as source, doc_id, i - 1 as line_no, regexp_replace(lower(l[i]), '[^\p{L}\p{M}]+', '', 'g') as line_key
  from (select source, doc_id, string_split(text, chr(10)) as l from documents), unnest(range(1, len(l) + 1)) as u(i)),
totals as (select coalesce(source, '') as source, count(distinct doc_id) as source_docs from documents group by 1),
kept as (
  select source, line_key, n_docs, source_docs from (select source, line_key, count(distinct doc_id) as n_docs from lines where length(line_key) >= 12 group by 1, 2)
  join totals using (source) where n_docs >= 3 and n_docs >= 0.08 * source_docs),
found as (select distinct source, doc_id, line_no, line_key, n_docs, source_docs from lines join kept using (source, line_key))
"""

QUERIES = {"p4_found": p4_found, "p4_report": p4_report, "p4_clean": p4_clean}
SQL = {
    "p4_found": _SQL + "select doc_id, line_no from found",
    "p4_report": _SQL + "select source, line_key, n_docs, source_docs, count(*) as n_lines from found group by all",
    "p4_clean": _SQL
    + """, gone as (select doc_id, list(distinct line_no) as gone from found group by 1)
      select doc_id, case when gone is null then text else array_to_string(list_transform(list_filter(range(len(l)), lambda i: not list_contains(gone, i)), lambda i: l[i + 1]), chr(10)) end as text, coalesce(len(gone), 0) as n_removed
      from (select doc_id, text, string_split(text, chr(10)) as l from documents) left join gone using (doc_id)""",
}
