"""Queries of the general data problems: nested records and orphan references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.operators import nesting, orphans
from tarkaloom.plans.session import table


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every commentary object with its path and its parent's."""
    tree = nesting.commentary_tree(table(spark, sf_dir, "raw_record"))
    return tree.select(F.col("raw_id").cast("bigint").alias("raw_id"), "node_path", "parent_path", "commentator", "school")


def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat parent table."""
    return nesting.record_table(table(spark, sf_dir, "raw_record"))


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = orphans.child_keys(table(spark, sf_dir, "graph_edge"), "graph_edge", "edge_id", "source_record_id", "tagged_at")
    return edges.unionByName(orphans.child_keys(table(spark, sf_dir, "tagged_record"), "tagged_record", "tag_no", "record_id", "tagged_at"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reference without a record at the time it was made."""
    parents = orphans.parent_keys(table(spark, sf_dir, "corpus_record"), ["id", "_original_id"])
    return orphans.orphans(parents, _references(spark, sf_dir))


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per table and month."""
    return orphans.orphan_report(p7_found(spark, sf_dir))


_STRIP = r"regexp_replace(lower({0}), '^[\s\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}]+|[\s\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{3000}}]+$', '', 'g')"
_K = lambda c: f"nullif({_STRIP.format(c)}, '')"
_P7 = f"""
with parents as (
  select {_K('id')} as k, loaded_at, withdrawn_at from corpus_record
  union all select {_K('_original_id')}, loaded_at, withdrawn_at from corpus_record),
refs as (
  select 'graph_edge' as ref_table, edge_id as row_key, {_K('source_record_id')} as k, tagged_at from graph_edge
  union all select 'tagged_record', cast(tag_no as varchar), {_K('record_id')}, tagged_at from tagged_record),
seen as (
  select r.ref_table, r.row_key, r.tagged_at, count(p.k) as n,
    count(*) filter (where p.loaded_at <= r.tagged_at) as early,
    count(*) filter (where p.loaded_at <= r.tagged_at and (p.withdrawn_at is null or p.withdrawn_at > r.tagged_at)) as held
  from refs r left join parents p on p.k = r.k where r.k is not null group by all),
found as (
  select ref_table, row_key, case when n = 0 then 'missing' when early = 0 then 'late' else 'withdrawn' end as reason,
    strftime(tagged_at, '%Y-%m') as period
  from seen where n = 0 or (tagged_at is not null and held = 0))
"""

QUERIES = {"p3_found": p3_found, "p3_records": p3_records, "p7_found": p7_found, "p7_report": p7_report}
_P3_RECORDS = """
with p as (select raw_id, case when json_valid(payload) then json(payload) end as j from raw_record),
a as (select raw_id, case when json_type(j) = 'ARRAY' then from_json(j, '["JSON"]')
    when json_type(j, '$.data.items') = 'ARRAY' then from_json(json_extract(j, '$.data.items'), '["JSON"]')
    else [coalesce(json_extract(j, '$.record'), j)] end as rs from p where j is not null)
select raw_id, i - 1 as rec_pos, rs[i] ->> '$.id' as id, rs[i] ->> '$.source' as source, try_cast(rs[i] ->> '$.ref.chapter' as int) as chapter,
  try_cast(rs[i] ->> '$.ref.verse' as int) as verse, rs[i] ->> '$.text' as text
from a, unnest(range(1, len(rs) + 1)) as u(i) where rs[i] ->> '$.id' is not null
"""
SQL = {
    "p3_records": _P3_RECORDS,
    "p7_found": _P7 + "select * from found",
    "p7_report": _P7 + "select ref_table, period, reason, count(*) as n_orphans from found group by all",
}
