"""Queries over the edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.functions.vocab import RELATIONS, SCHOOLS
from tarkaloom.operators import edges as E
from tarkaloom.operators.ordered import number_rows
from tarkaloom.plans.session import table


# Schools whose shown name isn't their key in capitals.
NAMES = {"achintya_bhedabheda": "Achintya Bhedabheda", "neo_vedanta": "Neo-Vedanta", "jain_common": "Jain (common)"}


def _q(f):
    return lambda spark, sf_dir: f(table(spark, sf_dir, "graph_edge"))


def edge_evidence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.evidence_in_record(table(spark, sf_dir, "graph_edge"), table(spark, sf_dir, "corpus_record"))


def concepts_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested concepts as rows with provenance and a sequence number per source."""
    t = table(spark, sf_dir, "tagged_record").select("tag_no", "record_id", "source", F.posexplode("concepts").alias("pos", "c"))
    t = number_rows(t, ["source"], ["tag_no", "pos"], "seq")
    return t.select(F.format_string("%s_%06d", F.coalesce("source", F.lit("")), "seq").alias("concept_key"), "tag_no", "record_id", F.col("c.name").alias("name"), F.col("c.category").alias("category"))


def tag_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source: tagged records, with concepts, failed, skipped, dropped, and the whole
    per cent of records with concepts (rounded down)."""
    t = table(spark, sf_dir, "tagged_record")
    has = F.coalesce(F.size("concepts") > 0, F.lit(False))
    g = t.groupBy("source").agg(F.count("*").alias("n"), F.count_if(has).alias("n_concepts"), F.count_if(F.col("error") != "").alias("n_errors"), F.count_if(F.col("skipped") != "").alias("n_skipped"), F.coalesce(F.sum("dropped_invalid_relationships"), F.lit(0)).alias("n_dropped"))
    return g.withColumn("pct_concepts", F.expr("(100 * n_concepts) div greatest(n, 1)"))


def release_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by tradition, school and relation in one long table."""
    r, e = table(spark, sf_dir, "corpus_record"), table(spark, sf_dir, "graph_edge")
    part = lambda df, c, kind: df.groupBy(F.coalesce(c, F.lit("")).alias("value")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "value", "n")
    commentators = r.select(F.explode("commentaries.commentator").alias("c")).where("c <> ''").agg(F.count_distinct("c").alias("n")).select(F.lit("commentators").alias("kind"), F.lit("").alias("value"), "n")
    return part(r, "tradition", "tradition").unionByName(part(e, "school", "school")).unionByName(part(e, "relation", "relation")).unionByName(commentators)


_PAIRED = """
with paired as (
  select *, least(concept_a, concept_b) as concept_lo, greatest(concept_a, concept_b) as concept_hi,
    coalesce(school, '(none)') as sch, coalesce(relation, '(none)') as rel
  from graph_edge where concept_a <> '' and concept_b <> '' {general}),
contested as (
  select concept_lo, concept_hi, count(distinct sch) as n_schools, count(distinct rel) as n_relations
  from paired group by 1, 2 having count(distinct sch) >= 2 and count(distinct rel) > 1),
best as (
  select concept_lo, concept_hi, sch as school, edge_id, rel as relation, evidence_quote as quote, n_edges from (
    select *, count(*) over (partition by concept_lo, concept_hi, sch) as n_edges,
      row_number() over (partition by concept_lo, concept_hi, sch order by
        case confidence when 'high' then 2 when 'medium' then 1 else 0 end desc, coalesce(length(evidence_quote), 0) desc, edge_id) as k
    from paired) where k = 1)
"""
_P = _PAIRED.format(general="and (school is null or school <> 'general')")
_IN = lambda xs: ", ".join(f"'{x}'" for x in xs)
_PROFILE = """
with g as (select {by} as grp, count(*) as n_edges from graph_edge where {by} is not null and {by} <> '' {general} group by 1 having count(*) >= 20),
rels as (select unnest([{rels}]) as relation)
select g.grp as {by}, rels.relation, count(e.edge_id) as n, round(100.0 * count(e.edge_id) / g.n_edges, 6) as pct
from g cross join rels left join graph_edge e on e.{by} = g.grp and e.relation = rels.relation group by g.grp, rels.relation, g.n_edges
"""
_VERDICT = f"""
select edge_id, relation, school, case
  when relation is null or relation not in ({_IN(RELATIONS)}) then 'relation'
  when school is null or school not in ({_IN(SCHOOLS)}) then 'school'
  when coalesce(trim(concept_a), '') = '' or coalesce(trim(concept_b), '') = '' then 'empty'
  when lower(trim(concept_a)) = lower(trim(concept_b)) then 'self_loop' else 'valid' end as verdict from graph_edge
"""

QUERIES = {
    "contested_pairs": _q(E.contested_pairs),
    "tension_preview": _q(lambda e: E.contested_pairs(e, 1, exclude_general=False).orderBy(F.desc("n_relations"), F.desc("n_schools"), "concept_lo", "concept_hi").limit(15)),
    "pair_profile": _q(E.pair_profile),
    "first_evidence": _q(E.first_evidence),
    "best_evidence": _q(E.best_evidence),
    "pair_markdown": _q(E.pair_markdown),
    "pair_pages": _q(lambda e: E.pair_pages(e, NAMES)),
    "relation_profile_school": _q(lambda e: E.relation_profile(e, "school", exclude_general=True)),
    "relation_profile_text": _q(lambda e: E.relation_profile(e, "source_text")),
    "small_groups": _q(lambda e: E.small_groups(e, "source_text", 200)),
    "vocab_validate": _q(E.validated),
    "vocab_drop_counts": _q(E.drop_counts),
    "concept_degree": _q(E.concept_degree),
    "two_hop": _q(E.two_hop),
    "freq_topk": _q(lambda e: E.frequency(e.where("concept_a is not null"), "concept_a", 20)),
    "edge_evidence_check": edge_evidence_check,
    "concepts_flatten": concepts_flatten,
    "tag_coverage": tag_coverage,
    "release_summary": release_summary,
}
SQL = {
    "contested_pairs": _P + "select * from contested",
    "tension_preview": _PAIRED.format(general="").replace("having count(distinct sch) >= 2 and", "having") + "select * from contested order by n_relations desc, n_schools desc, concept_lo, concept_hi limit 15",
    "pair_profile": _P + "select concept_lo, concept_hi, sch as school, rel as relation, count(*) as n_edges from paired semi join contested using (concept_lo, concept_hi) group by all",
    "first_evidence": _P + "select concept_lo, concept_hi, sch as school, rel as relation, min(edge_id) as edge_id from paired group by all",
    "best_evidence": _P + "select * from best",
    "pair_markdown": _P
    + """select concept_lo, concept_hi, school, '**' || school || '** (' || n_edges || case when n_edges = 1 then ' passage): ' else ' passages): ' end
      || concept_lo || ' ' || relation || ' ' || concept_hi || '. "' || quote || '"' as line from best semi join contested using (concept_lo, concept_hi) where quote <> ''""",
    "pair_pages": _P
    + f"""select concept_lo, concept_hi, count(*) as n_schools, '### ' || concept_lo || ' and ' || concept_hi || chr(10) || chr(10) || string_agg('**' || case school {" ".join(f"when '{k}' then '{v}'" for k, v in NAMES.items())}
        else array_to_string(list_transform(string_split(school, '_'), lambda w: upper(left(w, 1)) || lower(substr(w, 2))), ' ') end || '** (' || n_edges || case when n_edges = 1 then ' passage): ' else ' passages): ' end
      || concept_lo || ' ' || relation || ' ' || concept_hi || '. "' || quote || '"', chr(10) order by school) as page from best semi join contested using (concept_lo, concept_hi) where quote <> '' group by 1, 2""",
    "relation_profile_school": _PROFILE.format(by="school", general="and school <> 'general'", rels=_IN(RELATIONS)),
    "relation_profile_text": _PROFILE.format(by="source_text", general="", rels=_IN(RELATIONS)),
    "small_groups": "select source_text, count(*) as n_edges from graph_edge group by 1 having count(*) < 200",
    "vocab_validate": f"select edge_id, verdict from ({_VERDICT})",
    "vocab_drop_counts": f"select verdict, coalesce(case when verdict = 'relation' then relation else school end, '') as value, count(*) as n_dropped from ({_VERDICT}) where verdict in ('relation', 'school') group by all",
    "concept_degree": """with ends as (select concept_a as c, concept_b as o from graph_edge where concept_a <> '' and concept_b <> '' and concept_a <> concept_b
      union all select concept_b, concept_a from graph_edge where concept_a <> '' and concept_b <> '' and concept_a <> concept_b)
      select c as concept, count(*) as n_edges, count(distinct o) as n_neighbours from ends group by 1""",
    "two_hop": """with d as (select distinct relation, school, concept_a as a, concept_b as b from graph_edge where relation is not null and school is not null and concept_a <> concept_b),
      p as (select relation, x.school, x.a, y.b as c, count(*) as n_paths from d x join d y using (relation) where x.school = y.school and x.b = y.a and x.a <> y.b group by all)
      select p.relation, p.school, p.a, p.c, n_paths, d.a is not null as confirmed from p left join d on d.relation = p.relation and d.school = p.school and d.a = p.a and d.b = p.c""",
    "freq_topk": "select concept_a, count(*) as n from graph_edge where concept_a is not null group by 1 order by 2 desc, 1 limit 20",
    "edge_evidence_check": """select edge_id, bool_or(contains(array_to_string(list_filter(list_prepend(text, coalesce(list_transform(commentaries, lambda c: c.text), [])), lambda t: t is not null), chr(10)), evidence_quote)) as verbatim
      from graph_edge e join corpus_record r on r.id = e.source_record_id where evidence_quote <> '' group by 1""",
    "concepts_flatten": """select coalesce(source, '') || '_' || lpad(cast(row_number() over (partition by source order by tag_no, pos) as varchar), 6, '0') as concept_key, tag_no, record_id, name, category from (
      select source, tag_no, record_id, pos, concepts[pos].name as name, concepts[pos].category as category from tagged_record, unnest(range(1, len(concepts) + 1)) as u(pos))""",
    "tag_coverage": """select source, count(*) as n, count(*) filter (where len(concepts) > 0) as n_concepts, count(*) filter (where error <> '') as n_errors, count(*) filter (where skipped <> '') as n_skipped,
      cast(coalesce(sum(dropped_invalid_relationships), 0) as bigint) as n_dropped, (100 * count(*) filter (where len(concepts) > 0)) // greatest(count(*), 1) as pct_concepts from tagged_record group by 1""",
    "release_summary": """select 'tradition' as kind, coalesce(tradition, '') as value, count(*) as n from corpus_record group by 2
      union all select 'school', coalesce(school, ''), count(*) from graph_edge group by 2
      union all select 'relation', coalesce(relation, ''), count(*) from graph_edge group by 2
      union all select 'commentators', '', count(distinct c.commentator) from (select unnest(commentaries) as c from corpus_record) where c.commentator <> ''""",
}
