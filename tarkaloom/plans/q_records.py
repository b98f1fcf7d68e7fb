"""Queries over corpus records and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.operators import ordered as O
from tarkaloom.operators import records as R
from tarkaloom.operators import vectors as V
from tarkaloom.plans.session import table


def _r(f):
    return lambda spark, sf_dir: f(table(spark, sf_dir, "corpus_record"))


def _v(f):
    return lambda spark, sf_dir: f(table(spark, sf_dir, "embeddings"))


_SECTION = "try_cast(nullif(regexp_extract(coalesce(section, ''), '([0-9]+)', 1), '') as int)"


def resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "tagged_record")
    return R.todo(table(spark, sf_dir, "corpus_record").select("rec_no", "id", "source"), done, "id", "record_id")


def gap_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed sources against the records that came."""
    n = table(spark, sf_dir, "corpus_record").groupBy("source").agg(F.count("*").alias("n"))
    j = table(spark, sf_dir, "source_info").join(n, "source", "left")
    return j.select("source", F.coalesce("n", F.lit(0)).alias("n_records"), F.when(F.col("n").isNull(), "missing").otherwise("present").alias("status"))


def source_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per tradition and system of their source's entry, with defaults."""
    info = table(spark, sf_dir, "source_info").select("source", F.coalesce("tradition", F.lit("unknown")).alias("info_tradition"), F.coalesce("darshana", F.lit("unknown")).alias("info_darshana"))
    j = table(spark, sf_dir, "corpus_record").select("source").join(info, "source", "left")
    return j.groupBy(F.coalesce("info_tradition", F.lit("unlisted")).alias("tradition"), F.coalesce("info_darshana", F.lit("unlisted")).alias("darshana")).agg(F.count("*").alias("n_records"))


def parallel_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commentary segments set beside the text of their record, '' where there is none."""
    r = table(spark, sf_dir, "corpus_record")
    j = r.select("rec_no", "text", "segment_id", F.posexplode("commentaries.text").alias("com_pos", "other"))
    return j.select("rec_no", F.col("com_pos").cast("bigint").alias("com_pos"), F.coalesce("segment_id", F.lit("")).alias("segment_id"), F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_text"), F.length(F.coalesce("other", F.lit(""))).cast("bigint").alias("n_other"))


def verse_commentary_nest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commentaries of each record counted per kind, in place."""
    c = F.coalesce("commentaries", F.array().cast("array<struct<commentator:string,school:string,lang:string,type:string,text:string>>"))
    schools = F.array_distinct(F.filter(F.transform(c, lambda x: x["school"]), lambda s: s.isNotNull()))
    size = lambda a: F.size(a).cast("bigint")
    return table(spark, sf_dir, "corpus_record").select("rec_no", size(c).alias("n_commentaries"), size(F.filter(c, lambda x: x["type"] == "translation")).alias("n_translations"), size(schools).alias("n_schools"))


def inventory_commentators(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = table(spark, sf_dir, "corpus_record").select("source", F.inline("commentaries"))
    return flat.groupBy(F.coalesce("commentator", F.lit("?")).alias("commentator")).agg(F.count("*").alias("n"), F.count_distinct("source").alias("n_sources"))


def chapter_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "corpus_record").groupBy("source", "chapter").agg(F.count("*").alias("n"), F.count_if(F.col("verse").isNotNull()).alias("n_verses"))


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per file: records, with commentaries, with text, languages, characters."""
    r = table(spark, sf_dir, "corpus_record")
    has = F.coalesce(F.size("commentaries") > 0, F.lit(False))
    base = r.groupBy("_source_file").agg(F.count("*").alias("n"), F.count_if(has).alias("n_commented"), F.count_if(F.col("text") != "").alias("n_text"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars"))
    langs = r.select("_source_file", F.explode("commentaries.lang").alias("lang")).groupBy("_source_file").agg(F.count_distinct("lang").alias("n_langs"))
    return base.join(langs, base["_source_file"].eqNullSafe(langs["_source_file"]), "left").select(base["_source_file"], "n", "n_commented", "n_text", "n_chars", F.coalesce("n_langs", F.lit(0)).alias("n_langs"))


def verse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct verse numbers of each record as text."""
    r = table(spark, sf_dir, "corpus_record").where("verse_nums is not null")
    return r.select("rec_no", F.array_join(F.array_sort(F.array_distinct("verse_nums")).cast("array<string>"), ",").alias("verses"))


def corpus_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and documents under one schema, missing fields null, counted per kind."""
    r = table(spark, sf_dir, "corpus_record").select(F.lit("record").alias("kind"), "source", "text", "tradition")
    d = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), "source", "text", "lang")
    u = r.unionByName(d, allowMissingColumns=True)
    return u.groupBy("kind", "source").agg(F.count("*").alias("n"), F.count("tradition").alias("n_tradition"), F.count("lang").alias("n_lang"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.centroid_pairs(V.centroids(table(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", first=40), "label")


_CENT = """
with ranked as (select *, row_number() over (partition by label order by vec_id) as rk from embeddings where label is not null and embedding is not null),
kept as (select * from ranked where rk <= {first}),
cent as (select label, i - 1 as i, avg(cast(embedding[i] as double)) as x from kept, unnest(range(1, len(embedding) + 1)) as u(i) group by 1, 2),
big as (select label from kept group by 1 having count(*) >= 2),
pairs as (select a.label as group_a, b.label as group_b, round(1 - sum(a.x * b.x) / sqrt(sum(a.x * a.x) * sum(b.x * b.x)), 6) as distance
  from cent a join cent b on a.i = b.i and a.label < b.label where a.label in (select * from big) and b.label in (select * from big) group by 1, 2),
both_ as (select group_a as g, group_b as o, distance from pairs union all select group_b, group_a, distance from pairs)
"""
_C40 = _CENT.format(first=40)
_PREFIX = "case when regexp_matches(id, '_[0-9]+$') then regexp_replace(id, '_[0-9]+$', '') else id end"
_SECNO = "try_cast(nullif(regexp_extract(coalesce(section, ''), '([0-9]+)', 1), '') as int)"

QUERIES = {
    "id_uniqueness": _r(lambda r: R.id_uniqueness(r, "source", "id")),
    "id_repair": _r(lambda r: R.repaired_ids(r, "id", ["rec_no"]).select("rec_no", "id", "new_id")),
    "dedupe_first": _r(lambda r: R.dedupe_first(r.select("id", "loaded_at", "rec_no", "source"), "id", ["loaded_at", "rec_no"]).select("id", "rec_no", "source")),
    "record_versions": _r(R.versions),
    "cap_per_group": _r(lambda r: R.cap_per_group(r.where("theme_tag is not null"), "theme_tag", "rec_no", 30).select("theme_tag", "rec_no")),
    "sample_hash": _r(lambda r: r.select("rec_no").orderBy(R.sample_order("rec_no", 42)).limit(50)),
    "ffill_section": _r(lambda r: O.forward_fill(r.select("source", "rec_no", "section"), ["source"], ["rec_no"], "section", "section_filled").select("rec_no", "section_filled")),
    "ffill_reset": _r(lambda r: O.section_with_reset(r, ["source"], ["rec_no"], "chapter", F.expr(_SECTION), "section_no").select("rec_no", "section_no")),
    "counter_islands": _r(lambda r: O.counter(r, ["source"], ["rec_no"], "verse", "verse_no").select("rec_no", F.col("verse_no").cast("bigint").alias("verse_no"))),
    "prefer_top2": _r(lambda r: r.where("size(commentaries) > 0").select("rec_no", F.array_join(F.transform(R.preferred_commentaries(r), lambda c: F.coalesce(c["lang"], F.lit("?"))), ",").alias("langs"))),
    "prompt_build": _r(R.prompts),
    "priority_pick": _r(lambda r: R.priority_pick(r, ["en", "sa", "hi"])),
    "verse_parallel": _r(R.parallel_texts),
    "resume_anti": resume_anti,
    "gap_check": gap_check,
    "source_default": source_default,
    "parallel_align": parallel_align,
    "verse_commentary_nest": verse_commentary_nest,
    "inventory_commentators": inventory_commentators,
    "chapter_tally": chapter_tally,
    "inventory": inventory,
    "verse_numbers": verse_numbers,
    "corpus_merge": corpus_merge,
    "centroids": _v(lambda v: V.centroids(v, "label", "vec_id", "embedding").select("label", F.col("i").cast("bigint").alias("i"), F.round("x", 6).alias("x"))),
    "centroid_pairs": _pairs,
    "rank_disagreement": lambda s, d: V.rank_disagreement(_pairs(s, d)),
    "group_isolation": lambda s, d: V.isolation(_pairs(s, d), lambda g: g < 5),
}
SQL = {
    "id_uniqueness": "select source, count(*) as n_rows, count(distinct id) + max(cast(id is null as int)) as n_ids, count(*) = count(distinct id) + max(cast(id is null as int)) as is_unique from corpus_record group by 1",
    "id_repair": f"select rec_no, id, p || '_' || lpad(cast(row_number() over (partition by p order by rec_no) as varchar), 5, '0') as new_id from (select rec_no, id, {_PREFIX} as p from corpus_record)",
    "dedupe_first": "select id, rec_no, source from (select *, row_number() over (partition by id order by loaded_at, rec_no) as k from corpus_record where id is not null) where k = 1",
    "record_versions": """select id, rec_no, row_number() over w as version, lag(rec_no) over w as previous,
      lag(rec_no) over w is not null and lag(text) over w is distinct from text as text_changed from corpus_record where id is not null window w as (partition by id order by loaded_at, rec_no)""",
    "cap_per_group": "select theme_tag, rec_no from (select *, row_number() over (partition by theme_tag order by md5(rec_no || ':42'), rec_no) as k from corpus_record where theme_tag is not null) where k <= 30",
    "sample_hash": "select rec_no from corpus_record order by md5(rec_no || ':42') limit 50",
    "ffill_section": "select rec_no, last_value(section ignore nulls) over (partition by source order by rec_no rows between unbounded preceding and current row) as section_filled from corpus_record",
    "ffill_reset": f"""with e as (select *, {_SECNO} as s, chapter is not null and lag(chapter) over (partition by source order by rec_no) is distinct from chapter as fresh from corpus_record)
      select rec_no, last_value(coalesce(s, case when fresh then 1 end) ignore nulls) over (partition by source order by rec_no rows between unbounded preceding and current row) as section_no from e""",
    "counter_islands": """with g as (select *, count(verse) over (partition by source order by rec_no rows between unbounded preceding and current row) as g from corpus_record),
      k as (select *, row_number() over (partition by source, g order by rec_no) as k, max(verse) over (partition by source, g) as v from g)
      select rec_no, cast(coalesce(v + k - 1, k) as bigint) as verse_no from k""",
    "prefer_top2": """select rec_no, array_to_string(list_transform(list_concat(list_filter(commentaries, lambda c: coalesce(c.lang in ('en', 'sa'), false)), list_filter(commentaries, lambda c: not coalesce(c.lang in ('en', 'sa'), false)))[1:2], lambda c: coalesce(c.lang, '?')), ',') as langs
      from corpus_record where len(commentaries) > 0""",
    "prompt_build": """with s as (select *, coalesce(list_concat(list_filter(commentaries, lambda c: coalesce(c.lang in ('en', 'sa'), false)), list_filter(commentaries, lambda c: not coalesce(c.lang in ('en', 'sa'), false)))[1:2], []) as sel from corpus_record)
      select rec_no, 'Source: ' || coalesce(source, 'unknown') || chr(10) || 'System: ' || coalesce(darshana, 'unknown') || chr(10) || 'Commentators: '
        || coalesce(nullif(array_to_string(list_transform(sel, lambda c: coalesce(c.commentator, '?')), ', '), ''), 'none') || chr(10)
        || 'Text: ' || coalesce(nullif(substr(text, 1, 600), ''), '(no verse text)') || chr(10) || 'Commentary: '
        || coalesce(nullif(array_to_string(list_transform(list_filter(sel, lambda c: coalesce(c.text, '') <> ''), lambda c: '[' || coalesce(c.commentator, 'unknown') || ' / ' || coalesce(c.school, 'unknown') || ']: ' || substr(c.text, 1, 500)), chr(10) || chr(10)), ''), '(no commentary)') as prompt from s""",
    "priority_pick": """select rec_no, lang, commentator, com_pos from (select rec_no, commentaries[i].lang as lang, commentaries[i].commentator as commentator, i - 1 as com_pos,
      row_number() over (partition by rec_no order by case commentaries[i].lang when 'en' then 1 when 'sa' then 2 when 'hi' then 3 else 999 end, i) as k
      from corpus_record, unnest(range(1, len(commentaries) + 1)) as u(i) where trim(commentaries[i].text, chr(9) || chr(10) || chr(13) || ' ') <> '') where k = 1""",
    "verse_parallel": """select chapter, regexp_extract(coalesce(section, ''), '([0-9]+)', 1) as section_no, verse, count(distinct source) as n_sources, count(*) as n_records
      from corpus_record where chapter is not null and verse is not null group by 1, 2, 3""",
    "resume_anti": "select id, rec_no, source from corpus_record r where not exists (select 1 from tagged_record t where t.record_id = r.id and coalesce(t.error, '') = '')",
    "gap_check": "select s.source, count(r.rec_no) as n_records, case when count(r.rec_no) = 0 then 'missing' else 'present' end as status from source_info s left join corpus_record r on r.source = s.source group by 1",
    "source_default": """select coalesce(s.t, 'unlisted') as tradition, coalesce(s.d, 'unlisted') as darshana, count(*) as n_records from corpus_record r
      left join (select source, coalesce(tradition, 'unknown') as t, coalesce(darshana, 'unknown') as d from source_info) s on s.source = r.source group by 1, 2""",
    "parallel_align": "select rec_no, i - 1 as com_pos, coalesce(segment_id, '') as segment_id, length(coalesce(text, '')) as n_text, length(coalesce(commentaries[i].text, '')) as n_other from corpus_record, unnest(range(1, len(commentaries) + 1)) as u(i)",
    "verse_commentary_nest": """select rec_no, coalesce(len(commentaries), 0) as n_commentaries, coalesce(len(list_filter(commentaries, lambda c: coalesce(c.type = 'translation', false))), 0) as n_translations,
      coalesce(len(list_distinct(list_filter(list_transform(commentaries, lambda c: c.school), lambda s: s is not null))), 0) as n_schools from corpus_record""",
    "inventory_commentators": "select coalesce(c.commentator, '?') as commentator, count(*) as n, count(distinct source) as n_sources from (select source, unnest(commentaries) as c from corpus_record) group by 1",
    "chapter_tally": "select source, chapter, count(*) as n, count(verse) as n_verses from corpus_record group by 1, 2",
    "inventory": """with l as (select _source_file, count(distinct c.lang) as n from (select _source_file, unnest(commentaries) as c from corpus_record) group by 1)
      select r._source_file, count(*) as n, count(*) filter (where len(commentaries) > 0) as n_commented, count(*) filter (where text <> '') as n_text, cast(coalesce(sum(length(text)), 0) as bigint) as n_chars, coalesce(max(l.n), 0) as n_langs
      from corpus_record r left join l on l._source_file is not distinct from r._source_file group by 1""",
    "verse_numbers": "select rec_no, array_to_string(list_sort(list_distinct(verse_nums)), ',') as verses from corpus_record where verse_nums is not null",
    "corpus_merge": """select 'record' as kind, source, count(*) as n, count(tradition) as n_tradition, 0 as n_lang, cast(coalesce(sum(length(text)), 0) as bigint) as n_chars from corpus_record group by 2
      union all select 'document', source, count(*), 0, count(lang), cast(coalesce(sum(length(text)), 0) as bigint) from documents group by 2""",
    "centroids": _CENT.format(first=1000000000) + "select label, i, round(x, 6) as x from cent where label in (select * from big)",
    "centroid_pairs": _C40 + "select * from pairs",
    "rank_disagreement": _C40 + "select g, round(avg(distance), 6) as mean_distance, max_by(o, struct_pack(d := distance, o := o)) as farthest, max(distance) as max_distance from both_ group by 1",
    "group_isolation": _C40
    + """select round(avg(case when group_a < 5 and group_b < 5 then distance end), 6) as within, round(avg(case when (group_a < 5) <> (group_b < 5) then distance end), 6) as across,
      round(avg(case when (group_a < 5) <> (group_b < 5) then distance end) / avg(case when group_a < 5 and group_b < 5 then distance end), 6) as ratio from pairs""",
}
