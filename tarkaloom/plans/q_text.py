"""Queries over texts: style, ratios, splitting, snippets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarkaloom.functions import text as X
from tarkaloom.functions.vocab import DIALOGUE, PROSE, QUOTATION, REFUTATION
from tarkaloom.operators import style as S
from tarkaloom.plans.session import table

TERMS = ["witness", "mirror", "doubt", "release", "silence"]
# Verse references that stand alone on a line.
VERSE_LINE = r"(?m)^(Verse [0-9]+[.]|[IVXLC]+[.][0-9]+)$"
MARK = "\u0001"


def _d(f):
    return lambda spark, sf_dir: f(table(spark, sf_dir, "documents"))


def _schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    info = table(spark, sf_dir, "source_info").where("darshana is not null").select("source", F.col("darshana").alias("school"))
    return S.passages_dual(table(spark, sf_dir, "corpus_record"), info)


def passages_dual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _schools(spark, sf_dir).groupBy("school", "kind").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))


def stylometry_by_school(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.profile(_schools(spark, sf_dir), "school", PROSE, min_passages=10)


def _ratios(d: DataFrame) -> DataFrame:
    deva, ascii_ = X.script_share(F.col("text"), r"[ऀ-ॿ]"), 1 - X.script_share(F.col("text"), r"[^\x00-\x7F]")
    return d.select("doc_id", F.round(deva, 6).alias("devanagari"), (deva > 0.3).alias("mostly_devanagari"), F.round(ascii_, 6).alias("ascii"), (ascii_ >= 0.7).alias("mostly_ascii"))


def _segments(d: DataFrame) -> DataFrame:
    """Texts cut before each verse reference: the reference, and the length of what follows."""
    parts = F.split(F.regexp_replace("text", VERSE_LINE, MARK + "$1"), MARK)
    s = d.select("doc_id", F.posexplode(parts).alias("seg_no", "seg"))
    return s.select("doc_id", F.col("seg_no").cast("bigint").alias("seg_no"), F.regexp_extract("seg", r"^(Verse [0-9]+[.]|[IVXLC]+[.][0-9]+)\n", 1).alias("ref"), F.length("seg").cast("bigint").alias("n_chars"))


def _leading(d: DataFrame) -> DataFrame:
    n = F.expr("try_cast(nullif(regexp_extract(text, 'Verse ([0-9]+)[.]', 1), '') as int)")
    return d.select("doc_id", n.alias("verse_no"), F.nullif(F.regexp_extract("text", r"([IVXLC]+[.][0-9]+)", 1), F.lit("")).alias("ref"))


def _roman_refs(d: DataFrame) -> DataFrame:
    """Book and verse of every reference such as XIV.3 that stands alone on a line."""
    refs = F.regexp_extract_all("text", F.lit(r"(?m)^([IVXLC]+[.][0-9]+)$"), F.lit(1))
    r = d.select("doc_id", F.posexplode(refs).alias("pos", "ref"))
    return r.select("doc_id", F.col("pos").cast("bigint").alias("pos"), X.roman(F.substring_index("ref", ".", 1)).alias("book"), F.substring_index("ref", ".", -1).cast("int").alias("verse"))


def _seek(d: DataFrame) -> DataFrame:
    """The text from the first word of a marker on, where there is one."""
    at = F.locate("the ", F.lower("text"))
    return d.where(at > 0).select("doc_id", F.md5(F.expr("substring(text, locate('the ', lower(text)))")).alias("rest"), at.cast("bigint").alias("start"))


def _kwic(d: DataFrame) -> DataFrame:
    k = d.select("doc_id", F.explode(F.array(*[F.struct(F.lit(t).alias("term"), X.kwic(F.col("text"), t, 60).alias("snippet")) for t in TERMS])).alias("k"))
    return k.select("doc_id", "k.term", "k.snippet").where("snippet is not null")


def _sentences(d: DataFrame) -> DataFrame:
    s = X.sentences(F.col("text"))
    return d.select("doc_id", F.size(s).cast("bigint").alias("n_sentences"), (F.size(F.split("text", r"[.!?]+\s+")) < 2).alias("fallback"), F.size(X.words_ascii(F.col("text"))).cast("bigint").alias("n_words"))


RULES = [("the book of", "book"), ("notes on", "notes"), ("a digest", "digest"), ("lessons", "lessons"), ("concerning", "treatise")]
_NS = r"""case when len(parts) >= 2 then len(parts) when len(words) = 0 then 0 when len(words) < 5 then 1 else cast(ceil(len(words) / 20.0) as bigint) end"""
_TOK = r"""select {g} as g, text, regexp_split_to_array(text, '[.!?]+\s+') as raw, list_filter(regexp_split_to_array(text, '[.!?]+\s+'), lambda s: trim(s) <> '') as parts,
  list_filter(regexp_split_to_array(trim(text, chr(9) || chr(10) || chr(13) || ' '), '\s+'), lambda s: s <> '') as words, regexp_extract_all(lower(text), '([a-z'']+)') as toks from {t}"""


def _profile_sql(g: str, t: str, markers: dict[str, list[str]], least: int, having: str = "") -> str:
    q = lambda p: "|".join(p).replace("'", "''")
    flags = ", ".join(f"count(*) filter (where regexp_matches(text, '(?i)({q(p)})')) as n_{k}" for k, p in markers.items())
    pcts = ", ".join(f"round(100.0 * n_{k} / n_passages, 6) as pct_{k}" for k in markers)
    return f"""with t as ({_TOK.format(g=g, t=t)}), s as (select g, count(*) as n_passages, sum(length(text)) as n_chars, sum({_NS}) as n_sentences, count(*) filter (where len(raw) < 2) as n_fallback, {flags} from t group by 1),
      v as (select g, count(*) as n_words, count(distinct w) as n_vocabulary from (select g, unnest(toks) as w from t) group by 1)
      select s.g as {g}, n_passages, round(n_chars / n_passages, 6) as avg_chars, round(coalesce(n_words, 0) / n_sentences, 6) as words_per_sentence,
        round(coalesce(n_vocabulary, 0) / greatest(coalesce(n_words, 0), 1), 6) as vocabulary_diversity, {pcts}, round(100.0 * n_fallback / n_passages, 6) as pct_fallback
      from s left join v on s.g is not distinct from v.g where n_passages >= {least} and n_sentences > 0"""


_PRESET = {"quotation": QUOTATION, "refutation": REFUTATION, "dialogue": DIALOGUE}
_DUAL = """(select c.school as school, c.text as text, 'commentary' as kind from (select unnest(commentaries) as c from corpus_record) where c.text <> '' and c.school <> ''
  union all select i.darshana, r.text, 'text' from corpus_record r join source_info i on i.source = r.source where i.darshana is not null and r.text <> '' and i.darshana <> '')"""

QUERIES = {
    "stylometry_by_source": _d(lambda d: S.profile(d, "source", PROSE, min_passages=10)),
    "stylometry_by_lang": _d(lambda d: S.profile(d, "lang", PROSE)),
    "stylometry_preset": _d(lambda d: S.profile(d, "source", _PRESET, min_passages=10)),
    "stylometry_by_school": stylometry_by_school,
    "style_corr": _d(lambda d: S.marker_correlation(S.profile(d, "source", PROSE, min_passages=10), "pct_quotation", "pct_refutation")),
    "term_by_group": _d(lambda d: S.term_by_group(d, "lang", TERMS)),
    "passages_dual": passages_dual,
    "sentences": _d(_sentences),
    "script_ratio": _d(_ratios),
    "block_split": _d(_segments),
    "leading_number": _d(_leading),
    "roman_refs": _d(_roman_refs),
    "seek_start": _d(_seek),
    "kwic": _d(_kwic),
    "ws_normalise": _d(lambda d: d.select("doc_id", F.md5(X.squash_ws(F.col("text"))).alias("text_md5"))),
    "slug": _d(lambda d: d.where("title is not null").select("doc_id", X.slug(F.col("title")).alias("slug"))),
    "classify_first_match": _d(lambda d: d.select("doc_id", X.first_match(F.coalesce("title", F.lit("")), RULES, "other").alias("kind"))),
}
_LIKE = " ".join(f"when contains(lower(coalesce(title, '')), '{n}') then '{k}'" for n, k in RULES)
_WS = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
SQL = {
    "stylometry_by_source": _profile_sql("source", "documents", PROSE, 10),
    "stylometry_by_lang": _profile_sql("lang", "documents", PROSE, 1),
    "stylometry_preset": _profile_sql("source", "documents", _PRESET, 10),
    "stylometry_by_school": _profile_sql("school", _DUAL, PROSE, 10),
    "style_corr": f"select case when not isnan(corr(pct_quotation, pct_refutation)) then round(corr(pct_quotation, pct_refutation), 6) end as r, count(*) as n_groups from ({_profile_sql('source', 'documents', PROSE, 10)})",
    "term_by_group": f"""select h.lang, term, n_hits, round(100.0 * n_hits / n, 6) as pct from (select lang, term, count(*) as n_hits from documents, (select unnest([{", ".join(f"'{t}'" for t in TERMS)}]) as term) where contains(lower(text), term) group by 1, 2) h
      join (select lang, count(*) as n from documents group by 1) g on g.lang = h.lang""",
    "passages_dual": f"select school, kind, count(*) as n, cast(sum(length(text)) as bigint) as n_chars from {_DUAL} group by 1, 2",
    "sentences": f"select g as doc_id, {_NS} as n_sentences, len(raw) < 2 as fallback, len(toks) as n_words from ({_TOK.format(g='doc_id', t='documents')})",
    "script_ratio": r"""select doc_id, round(d, 6) as devanagari, d > 0.3 as mostly_devanagari, round(a, 6) as ascii, a >= 0.7 as mostly_ascii from (select doc_id,
      length(regexp_replace(text, '[^\x{0900}-\x{097F}]', '', 'g')) / greatest(length(text), 1) as d, 1 - length(regexp_replace(text, '[\x00-\x7F]', '', 'g')) / greatest(length(text), 1) as a from documents)""",
    "block_split": r"""with s as (select doc_id, string_split(regexp_replace(text, '(?m)^(Verse [0-9]+[.]|[IVXLC]+[.][0-9]+)$', chr(1) || '\1', 'g'), chr(1)) as p from documents)
      select doc_id, i - 1 as seg_no, regexp_extract(p[i], '^(Verse [0-9]+[.]|[IVXLC]+[.][0-9]+)\n', 1) as ref, length(p[i]) as n_chars from s, unnest(range(1, len(p) + 1)) as u(i)""",
    "leading_number": "select doc_id, try_cast(nullif(regexp_extract(text, 'Verse ([0-9]+)[.]', 1), '') as int) as verse_no, nullif(regexp_extract(text, '([IVXLC]+[.][0-9]+)', 1), '') as ref from documents",
    "seek_start": "select doc_id, md5(substr(text, strpos(lower(text), 'the '))) as rest, strpos(lower(text), 'the ') as start from documents where strpos(lower(text), 'the ') > 0",
    "roman_refs": """with r as (select doc_id, regexp_extract_all(text, '(?m)^([IVXLC]+[.][0-9]+)$') as refs from documents),
      p as (select doc_id, i - 1 as pos, split_part(refs[i], '.', 1) as b, cast(split_part(refs[i], '.', 2) as int) as verse from r, unnest(range(1, len(refs) + 1)) as u(i)),
      v as (select *, list_transform(string_split(b, ''), lambda c: case c when 'I' then 1 when 'V' then 5 when 'X' then 10 when 'L' then 50 when 'C' then 100 else 0 end) as n from p)
      select doc_id, pos, cast(list_sum(list_transform(range(1, len(n) + 1), lambda k: case when n[k] < coalesce(n[k + 1], 0) then -n[k] else n[k] end)) as int) as book, verse from v""",
    "kwic": f"""with k as (select doc_id, term, text, strpos(lower(text), term) as p from documents, (select unnest([{", ".join(f"'{t}'" for t in TERMS)}]) as term)),
      s as (select doc_id, term, trim(substr(text, greatest(p - 60, 1), least(p + length(term) + 60, length(text) + 1) - greatest(p - 60, 1)), chr(9) || chr(10) || chr(13) || ' ' || chr(160) || chr(8239) || chr(8197)) as snippet from k where p > 0)
      select * from s where length(snippet) > 30""",
    "ws_normalise": f"select doc_id, md5({_WS}) as text_md5 from documents",
    "slug": "select doc_id, substr(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), 1, 40) as slug from documents where title is not null",
    "classify_first_match": f"select doc_id, case {_LIKE} else 'other' end as kind from documents",
}
