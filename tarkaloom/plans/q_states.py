"""Queries of line parsers, page filters and small record rewrites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.functions import text as X
from tarkaloom.operators import line_states as L
from tarkaloom.operators import records as R
from tarkaloom.operators import vectors as V
from tarkaloom.plans.q_passages import SQL as PASSAGES
from tarkaloom.plans.q_passages import passages_by_commentator
from tarkaloom.plans.session import table

CHAPTER, ITEM = r"^([IVXLC]+)[.][0-9]+$", r"^Verse ([0-9]+)[.]$"
MARKERS = {"speech": r"^He said —$", "ending": r"^Here ends "}
NAVIGATION = ["previous section", "return to the contents", "jump to verse"]
SKIP_PHRASES = ["index of sections", "subscribe to the weekly", "all rights reserved"]
PAGE_MARKS = [r"^[0-9]{1,4}$", r"^\[?[0-9]{1,4}\]$", r"^[-—] ?[0-9]{1,4} ?[-—]$", r"^Page [0-9]{1,4}$", r"^[ivxlc]+$"]
KINDS = [("the book of", "book"), ("notes on", "notes"), ("a digest", "digest"), ("lessons", "lessons"), ("concerning", "treatise")]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.text_lines(table(spark, sf_dir, "documents"), "doc_id")


def head_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered verses of each document with their head lines and what follows."""
    d = L.head_and_body(_lines(spark, sf_dir), "doc_id", CHAPTER, ITEM)
    return d.select("doc_id", F.col("island").cast("bigint").alias("island"), "chapter", F.col("item").cast("bigint").alias("item"), "n_head", F.md5("head").alias("head_md5"), "n_body", F.md5("body").alias("body_md5"))


def line_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines inside numbered verses by their state: script, running text, lists, speech, ending."""
    opening = [("devanagari", X.script_share(F.col("line"), "[ऀ-ॿ]", spaces=False) > 0.3), ("running", ~F.col("line").contains(";"))]
    d = L.typed_lines(_lines(spark, sf_dir), "doc_id", CHAPTER, ITEM, MARKERS, opening, "clauses")
    return d.groupBy("doc_id", "item", "kind").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of running text with the kind of work that the last titled page of their source named."""
    low = F.lower("text")
    skip = (F.length("text") < 100) | X.contains_any(low, SKIP_PHRASES) | (X.script_share(F.col("text"), "[ऀ-ॿ]") > 0.3) | F.col("text").isNull()
    label = X.first_match(F.col("title"), KINDS, "")
    return L.carried_label(table(spark, sf_dir, "documents").select("doc_id", "source", "title", "text"), "source", "doc_id", skip, F.nullif(label, F.lit("")), "kind").select("doc_id", "kind")


def block_renumber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapter, carried section and running verse number of every record of its source."""
    r = table(spark, sf_dir, "corpus_record").select("rec_no", "source", "chapter", "section", "verse")
    section = F.nullif(F.regexp_extract("section", "([0-9]+)", 1), F.lit("")).cast("int")
    d = L.renumbered(r, "source", "rec_no", "chapter", section, "verse")
    return d.select("rec_no", F.col("section_no").cast("bigint").alias("section_no"), F.col("number_no").cast("bigint").alias("number_no"))


def line_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are navigation or page marks, per document and kind."""
    kind = F.when(X.starts_any(F.col("line"), NAVIGATION), "navigation").when(X.matches_any(F.col("line"), PAGE_MARKS), "page mark")
    return _lines(spark, sf_dir).select("doc_id", kind.alias("kind")).where("kind is not null").groupBy("doc_id", "kind").agg(F.count("*").alias("n_lines"))


def boilerplate_blanked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles blanked where they hold no name of a work, and whether they name a verse or section."""
    t = table(spark, sf_dir, "documents").where("title is not null")
    known = X.contains_any(F.lower("title"), [k for k, _ in KINDS])
    return t.select("doc_id", F.when(known, F.col("title")).otherwise("").alias("title"), F.col("title").rlike(r"[0-9]+[.][0-9]+|Verse [0-9]+").alias("names_number"))


def commentator_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commentaries by commentator, the unnamed ones under 'unknown'."""
    c = table(spark, sf_dir, "corpus_record").select(F.explode("commentaries").alias("c")).where("c.text <> ''")
    return c.groupBy(F.coalesce("c.commentator", F.lit("unknown")).alias("commentator")).agg(F.count("*").alias("n_passages"), F.sum(F.length("c.text")).alias("n_chars"))


def commentaries_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with their own text in the first commentary, and a look at its opening."""
    r = table(spark, sf_dir, "corpus_record")
    first = F.get("commentaries", F.lit(0))
    return R.text_over_first(r, "text").select("rec_no", F.size("commentaries").cast("bigint").alias("n"), F.left(first["text"], F.lit(150)).alias("opening"), first["school"].alias("school"))


def segment_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment ids cut once at their first point or colon."""
    r = table(spark, sf_dir, "corpus_record").where("segment_id is not null")
    return r.select("rec_no", F.regexp_extract("segment_id", "^([^.:]*)", 1).alias("head"), F.regexp_extract("segment_id", "^[^.:]*[.:](.*)$", 1).alias("tail"))


def drop_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dropped relation values of each source as one sorted map, written as JSON."""
    t = table(spark, sf_dir, "tagged_record")
    return R.counters_as_map(t.select("source", F.explode("dropped_relation_values").alias("value", "n")), "source", "value", "n").select("source", F.to_json("counts").alias("counts"))


def within_school(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of commentators by the words of their passages on each concept, for those with at
    least two passages on it."""
    p = passages_by_commentator(spark, sf_dir)
    words = p.select("concept", "group", F.explode(F.regexp_extract_all(F.lower("passage"), F.lit(r"([\p{L}\p{M}]+)"), F.lit(1))).alias("word"))
    named = p.groupBy("concept", "group").agg(F.count("*").alias("n")).where("n >= 2").select("concept", "group")
    counts = words.groupBy("concept", "group", "word").agg(F.count("*").alias("x")).join(named, ["concept", "group"], "left_semi")
    return V.sparse_pairs(counts, "concept", "group", "word", "x")


_STRIP = "trim({0}, chr(9) || chr(10) || chr(13) || ' ' || chr(160) || chr(8239) || chr(8197))"
_LINES = f"""l as (select doc_id, i - 1 as line_no, {_STRIP.format('p[i]')} as line from (select doc_id, string_split(text, chr(10)) as p from documents), unnest(range(1, len(p) + 1)) as u(i) where {_STRIP.format('p[i]')} <> '')"""
_ITEMS = f"""{_LINES},
 e as (select *, nullif(regexp_extract(line, '{ITEM}', 1), '') as _item, nullif(regexp_extract(line, '{CHAPTER}', 1), '') as _chapter from l),
 b as (select * from (select *, count(_item) over w as begun from e window w as (partition by doc_id order by line_no rows between unbounded preceding and current row)) where begun > 0 or _chapter is not null),
 i as (select *, count(coalesce(_item, _chapter)) over w as island, last_value(_chapter ignore nulls) over w as chapter from b window w as (partition by doc_id order by line_no rows between unbounded preceding and current row)),
 f as (select * from (select *, first_value(_item) over w as item, row_number() over w - 1 as place from i window w as (partition by doc_id, island order by line_no)) where item is not null)"""
_ANY = lambda c, words: "(" + " or ".join(f"contains({c}, '{w}')" for w in words) + ")"
_SHARE = "length(regexp_replace({0}, '[^\\x{{0900}}-\\x{{097F}}]', '', 'g')) / greatest(length({0}), 1)"
_SKIP = f"(text is null or length(text) < 100 or {_ANY('lower(text)', SKIP_PHRASES)} or {_SHARE.format('text')} > 0.3)"
_KIND = "case " + " ".join(f"when contains(lower(title), '{n}') then '{k}'" for n, k in KINDS) + " end"
_HERE = "rows between unbounded preceding and current row"

QUERIES = {
    "head_body": head_body,
    "line_types": line_types,
    "page_labels": page_labels,
    "block_renumber": block_renumber,
    "line_noise": line_noise,
    "boilerplate_blanked": boilerplate_blanked,
    "commentator_passages": commentator_passages,
    "commentaries_rewritten": commentaries_rewritten,
    "segment_parts": segment_parts,
    "drop_maps": drop_maps,
    "within_school": within_school,
}
SQL = {
    "head_body": f"""with {_ITEMS},
      s as (select *, max(case when place > 0 and (place > 3 or regexp_matches(line, '^\\p{{Ll}}')) then 1 else 0 end) over (partition by doc_id, island order by line_no {_HERE}) as in_body from f)
      select doc_id, island, chapter, cast(item as bigint) as item, count(*) filter (where place > 0 and in_body = 0) as n_head, md5(coalesce(string_agg(line, ' ' order by line_no) filter (where place > 0 and in_body = 0), '')) as head_md5,
        count(*) filter (where in_body = 1) as n_body, md5(coalesce(string_agg(line, ' ' order by line_no) filter (where in_body = 1), '')) as body_md5 from s group by doc_id, island, chapter, item""",
    "line_types": f"""with {_ITEMS},
      m as (select *, case when line = 'He said —' then 'speech' when starts_with(line, 'Here ends ') then 'ending' end as mark,
        case when {_SHARE.format("regexp_replace(line, '\\s', '', 'g')")} > 0.3 then 0 else 1 end as not_deva, case when contains(line, ';') then 1 else 0 end as not_running from f where place > 0),
      p as (select *, last_value(mark ignore nulls) over w as set_to, max(not_deva) over w as past0 from m window w as (partition by doc_id, island order by line_no {_HERE})),
      q as (select *, max(case when past0 = 1 and not_running = 1 then 1 else 0 end) over (partition by doc_id, island order by line_no {_HERE}) as past1 from p)
      select doc_id, item, coalesce(set_to, case when past0 = 0 then 'devanagari' when past1 = 0 then 'running' else 'clauses' end) as kind, count(*) as n_lines, cast(sum(length(line)) as bigint) as n_chars from q where mark is null group by 1, 2, 3""",
    "page_labels": f"select doc_id, last_value({_KIND} ignore nulls) over (partition by source order by doc_id {_HERE}) as kind from documents where not {_SKIP}",
    "block_renumber": f"""with r as (select rec_no, source, chapter, verse, try_cast(nullif(regexp_extract(section, '([0-9]+)', 1), '') as int) as s, lag(chapter) over w as prior, row_number() over w as pos, count(verse) over (partition by source order by rec_no {_HERE}) as seen from corpus_record window w as (partition by source order by rec_no)),
      e as (select *, case when s is not null then s when chapter is not null and (pos = 1 or prior is distinct from chapter) then 1 end as ev from r),
      f as (select *, last_value(ev ignore nulls) over (partition by source order by rec_no {_HERE}) as section_no from e),
      k as (select *, row_number() over (partition by source order by rec_no) as n from f where seen > 0),
      v as (select *, last_value(verse ignore nulls) over w as lv, last_value(case when verse is not null then n end ignore nulls) over w as ln from k window w as (partition by source order by rec_no {_HERE}))
      select rec_no, cast(section_no as bigint) as section_no, lv + n - ln as number_no from v""",
    "line_noise": f"""with {_LINES}, k as (select doc_id, case when {" or ".join(f"starts_with(lower(line), '{w}')" for w in NAVIGATION)} then 'navigation' when {" or ".join(f"regexp_matches(line, '{p}')" for p in PAGE_MARKS)} then 'page mark' end as kind from l)
      select doc_id, kind, count(*) as n_lines from k where kind is not null group by 1, 2""",
    "boilerplate_blanked": f"select doc_id, case when {_ANY('lower(title)', [k for k, _ in KINDS])} then title else '' end as title, regexp_matches(title, '[0-9]+[.][0-9]+|Verse [0-9]+') as names_number from documents where title is not null",
    "commentator_passages": "select coalesce(c.commentator, 'unknown') as commentator, count(*) as n_passages, cast(sum(length(c.text)) as bigint) as n_chars from (select unnest(commentaries) as c from corpus_record) where c.text <> '' group by 1",
    "commentaries_rewritten": "select rec_no, cast(case when commentaries is null or len(commentaries) = 0 then 0 else len(commentaries) end as bigint) as n, case when len(commentaries) > 0 then left(text, 150) end as opening, commentaries[1].school as school from corpus_record",
    "segment_parts": "select rec_no, regexp_extract(segment_id, '^([^.:]*)', 1) as head, regexp_extract(segment_id, '^[^.:]*[.:](.*)$', 1) as tail from corpus_record where segment_id is not null",
    "drop_maps": """with e as (select source, unnest(map_entries(dropped_relation_values)) as e from tagged_record), n as (select source, e.key as k, sum(e.value) as n from e group by 1, 2)
      select source, '{' || string_agg('"' || k || '":' || n, ',' order by k) || '}' as counts from n group by 1""",
    "within_school": f"""with p as ({PASSAGES["passages_by_commentator"]}), w as (select concept, "group" as g, unnest(regexp_extract_all(lower(passage), '([\\p{{L}}\\p{{M}}]+)')) as word from p),
      named as (select concept, "group" as g from p group by 1, 2 having count(*) >= 2), c as (select concept, g, word, cast(count(*) as double) as x from w semi join named using (concept, g) group by 1, 2, 3),
      n as (select concept, g, sqrt(sum(x * x)) as norm from c group by 1, 2),
      d as (select a.concept, a.g as ga, b.g as gb, sum(a.x * b.x) as dot from c a join c b on a.concept = b.concept and a.word = b.word and a.g < b.g group by 1, 2, 3)
      select a.concept, a.g as group_a, b.g as group_b, round(1 - coalesce(dot, 0) / (a.norm * b.norm), 6) as distance from n a join n b on a.concept = b.concept and a.g < b.g left join d on d.concept = a.concept and ga = a.g and gb = b.g""",
}
