"""Queries of passages by concept, nested commentaries, numbered edges and verse numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.operators import passages as P
from tarkaloom.plans.session import table
from tarkaloom.sources.io import numbered_edges

# Names of a concept across the languages of the test data.
CONCEPTS = {
    "self": ["sense of self", "soi", "selbst"],
    "rope": ["coiled rope", "corde", "seil"],
    "ignorance": ["ignorance", "unwissenheit", "avidyā", "avijjā"],
    "release": ["release", "libération", "befreiung", "mokṣa"],
}
KINDS = {"translations": "translation", "notes": "commentary"}


def _passages(spark: SparkSession, sf_dir: str, group: str) -> DataFrame:
    schools = table(spark, sf_dir, "source_info").where("darshana is not null").select("source", F.col("darshana").alias("school"))
    return P.concept_passages(table(spark, sf_dir, "corpus_record"), CONCEPTS, group, schools)


def passages_by_school(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages on each concept, of commentaries and of texts, by school."""
    return _passages(spark, sf_dir, "school")


def passages_by_commentator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of commentaries, by commentator."""
    return _passages(spark, sf_dir, "commentator")


def commentary_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commentaries taken apart and nested again under their record, one array per kind."""
    r = table(spark, sf_dir, "corpus_record")
    parts = r.select("rec_no", F.posexplode("commentaries").alias("com_pos", "c")).select("rec_no", "com_pos", "c.type", "c.commentator", "c.text")
    n = P.nest_by_record(r.select("rec_no"), parts, KINDS)
    names = lambda c: F.array_join(F.transform(c, lambda x: F.coalesce(x["commentator"], F.lit("?"))), "|").alias(c)
    return n.select("rec_no", names("translations"), names("notes"))


def edges_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges with a number over all files, in the order of files and edges in them."""
    e = table(spark, sf_dir, "graph_edge")
    one = F.array(F.struct("concept_a", "concept_b", "relation"))
    line = F.regexp_extract("edge_id", "([0-9]+)$", 1).cast("bigint")
    tagged = e.select(F.coalesce("tagged_from_file", F.lit("")).alias("file"), line.alias("line_no"), F.col("source_record_id").alias("record_id"), F.col("source_text").alias("source"), one.alias("relationships"))
    return numbered_edges(tagged).select("edge_no", F.col("edge_id").alias("new_id"), "tagged_from_file", "concept_a", "concept_b", "relation")


def verse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verse numbers that the lines of each document name."""
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(P.line_numbers(F.col("text")).cast("array<string>"), ",").alias("verses"))


_STRIPPED = "trim({0}, chr(9) || chr(10) || chr(13) || ' ' || chr(160) || chr(8239) || chr(8197))"
_TERMS = ", ".join(f"('{k}', '{'|'.join(v)}')" for k, v in CONCEPTS.items())
_PASSAGES = f"""
with c as (select rec_no, i - 1 as com_pos, 'commentary' as kind, commentaries[i].{{group}} as g, commentaries[i].text as text from corpus_record, unnest(range(1, len(commentaries) + 1)) as u(i)){{top}},
terms as (select * from (values {_TERMS}) as t(concept, names)),
m as (select *, length(regexp_extract(text, '^(.*?)(' || names || ')', 1, 'si')) as p, length(regexp_extract(text, '(' || names || ')', 1, 'i')) as n
  from every, terms where g <> '' and regexp_matches(text, '(' || names || ')', 'i')),
s as (select concept, g as "group", kind, rec_no, com_pos, substr(text, greatest(p - 200, 0) + 1, p + n + 200 - greatest(p - 200, 0)) as cut from m)
select concept, "group", kind, rec_no, com_pos, {_STRIPPED.format('cut')} as passage from s where length({_STRIPPED.format('cut')}) > 30
"""
_NUMBERS = " || ".join(f"[regexp_extract(x, '{p}', 1)]" for p in (p.replace("'", "''") for p in P.VERSE_PATTERNS))

QUERIES = {"passages_by_school": passages_by_school, "passages_by_commentator": passages_by_commentator, "commentary_kinds": commentary_kinds, "edges_numbered": edges_numbered, "verse_lines": verse_lines}
SQL = {
    "passages_by_school": _PASSAGES.format(
        group="school",
        top=", every as (select * from c where g <> 'general' union all select rec_no, -1, 'text', s.darshana, text from corpus_record r join source_info s on s.source = r.source where s.darshana is not null)",
    ),
    "passages_by_commentator": _PASSAGES.format(group="commentator", top=", every as (select * from c)"),
    "commentary_kinds": "select rec_no, "
    + ", ".join(f"array_to_string(list_transform(list_filter(coalesce(commentaries, []), lambda c: coalesce(c.type = '{t}', false)), lambda c: coalesce(c.commentator, '?')), '|') as {k}" for k, t in KINDS.items())
    + " from corpus_record",
    "edges_numbered": """with n as (select *, row_number() over (order by coalesce(tagged_from_file, ''), cast(regexp_extract(edge_id, '([0-9]+)$', 1) as bigint)) as edge_no from graph_edge)
      select edge_no, format('edge_{:06d}', edge_no) as new_id, coalesce(tagged_from_file, '') as tagged_from_file, concept_a, concept_b, relation from n""",
    "verse_lines": f"""select doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(flatten(list_transform(string_split(text, chr(10)), lambda x: {_NUMBERS})), lambda n: try_cast(nullif(n, '') as bigint)), lambda n: n is not null))), ',') as verses from documents""",
}
