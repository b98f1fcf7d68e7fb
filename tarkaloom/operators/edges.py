"""Operators over the edge table of a labelled multigraph.

Every ranking or "first" has an explicit tie-break.  Pairs are unordered; null or
empty concepts never pair, and the ``general`` school is left out where asked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarkaloom.functions.vocab import CONFIDENCE, RELATIONS, SCHOOLS
from tarkaloom.operators.hot import salted_join

NO_SCHOOL, NO_RELATION = "(none)", "(none)"


def paired(edges: DataFrame, exclude_general: bool = True) -> DataFrame:
    """Edges with both concepts, as ``concept_lo <= concept_hi``."""
    e = edges.where("concept_a <> '' and concept_b <> ''")
    if exclude_general:
        e = e.where("school is null or school <> 'general'")
    return e.withColumns({"concept_lo": F.least("concept_a", "concept_b"), "concept_hi": F.greatest("concept_a", "concept_b"), "school": F.coalesce("school", F.lit(NO_SCHOOL)), "relation": F.coalesce("relation", F.lit(NO_RELATION))})


def contested_pairs(edges: DataFrame, min_schools: int = 2, exclude_general: bool = True) -> DataFrame:
    """Pairs that at least ``min_schools`` schools use, with more than one relation.

    Distinct (pair, school, relation) first: partial aggregation shrinks a hot pair
    before anything is counted.
    """
    d = paired(edges, exclude_general).select("concept_lo", "concept_hi", "school", "relation").distinct()
    g = d.groupBy("concept_lo", "concept_hi").agg(F.count_distinct("school").alias("n_schools"), F.count_distinct("relation").alias("n_relations"))
    return g.where((F.col("n_schools") >= min_schools) & (F.col("n_relations") > 1))


def pair_profile(edges: DataFrame) -> DataFrame:
    """Relations of each school for each contested pair."""
    d = paired(edges).groupBy("concept_lo", "concept_hi", "school", "relation").agg(F.count("*").alias("n_edges"))
    return d.join(contested_pairs(edges).select("concept_lo", "concept_hi"), ["concept_lo", "concept_hi"], "left_semi")


def _confidence() -> Column:
    c = F.lit(0)
    for k, v in CONFIDENCE.items():
        c = F.when(F.col("confidence") == k, v).otherwise(c)
    return c


def first_evidence(edges: DataFrame) -> DataFrame:
    """The first edge (by id) of each pair, school and relation."""
    return paired(edges).groupBy("concept_lo", "concept_hi", "school", "relation").agg(F.min("edge_id").alias("edge_id"))


def best_evidence(edges: DataFrame) -> DataFrame:
    """Per pair and school the edge of highest confidence, then longest quote, then
    first id, and how many edges it stands for."""
    e = paired(edges).withColumns({"conf": _confidence(), "len": F.coalesce(F.length("evidence_quote"), F.lit(0))})
    # min of (-conf, -len, id) takes the first id among equals and combines map-side
    key = F.struct((-F.col("conf")).alias("c"), (-F.col("len")).alias("l"), F.col("edge_id").alias("id"), F.col("relation").alias("relation"), F.col("evidence_quote").alias("quote"))
    g = e.groupBy("concept_lo", "concept_hi", "school").agg(F.min(key).alias("k"), F.count("*").alias("n_edges"))
    return g.select("concept_lo", "concept_hi", "school", F.col("k.id").alias("edge_id"), F.col("k.relation").alias("relation"), F.col("k.quote").alias("quote"), "n_edges")


def pair_markdown(edges: DataFrame) -> DataFrame:
    """A line of Markdown for each school of each contested pair that has a quote."""
    b = best_evidence(edges).where("quote <> ''").join(contested_pairs(edges).select("concept_lo", "concept_hi"), ["concept_lo", "concept_hi"], "left_semi")
    line = F.concat(F.lit("**"), "school", F.lit("** ("), F.col("n_edges").cast("string"), F.when(F.col("n_edges") == 1, " passage): ").otherwise(" passages): "), "concept_lo", F.lit(" "), "relation", F.lit(" "), "concept_hi", F.lit('. "'), "quote", F.lit('"'))
    return b.select("concept_lo", "concept_hi", "school", line.alias("line"))


def display(c: Column, names: dict[str, str]) -> Column:
    """The name to show for a value: the one given, else its words in capitals."""
    own = F.initcap(F.replace(c, F.lit("_"), F.lit(" ")))
    if not names:
        return own
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), c), own)


def pair_pages(edges: DataFrame, names: dict[str, str]) -> DataFrame:
    """``concept_lo, concept_hi, n_schools, page``: a Markdown page per contested pair, a heading with a
    line for each school, in the order of their keys.

    Schools name at most one line each, so a page is bounded by their number.
    """
    lines = pair_markdown(edges).withColumn("line", F.replace("line", F.concat(F.lit("**"), "school", F.lit("**")), F.concat(F.lit("**"), display(F.col("school"), names), F.lit("**"))))
    g = lines.groupBy("concept_lo", "concept_hi").agg(F.array_sort(F.collect_list(F.struct("school", "line"))).alias("ls"))
    heading = F.concat(F.lit("### "), "concept_lo", F.lit(" and "), "concept_hi", F.lit("\n\n"))
    return g.select("concept_lo", "concept_hi", F.size("ls").cast("bigint").alias("n_schools"), F.concat(heading, F.array_join(F.transform("ls", lambda x: x["line"]), "\n")).alias("page"))


def relation_profile(edges: DataFrame, by: str, min_edges: int = 20, exclude_general: bool = False) -> DataFrame:
    """Share of each relation of the vocabulary within each group, zero-filled."""
    e = edges.where(F.col(by).isNotNull() & (F.col(by) != ""))
    if exclude_general:
        e = e.where(F.col(by) != "general")
    g = e.groupBy(by).agg(F.count("*").alias("n_edges"), *[F.count_if(F.col("relation") == r).alias(r) for r in RELATIONS]).where(F.col("n_edges") >= min_edges)
    long = F.inline(F.array(*[F.struct(F.lit(r).alias("relation"), F.col(r).alias("n")) for r in RELATIONS]))
    return g.select(by, "n_edges", long).select(by, "relation", "n", F.round(100 * F.col("n") / F.col("n_edges"), 6).alias("pct"))


def small_groups(edges: DataFrame, by: str, min_edges: int = 20) -> DataFrame:
    """The groups that a profile leaves out."""
    return edges.groupBy(by).agg(F.count("*").alias("n_edges")).where(F.col("n_edges") < min_edges)


def validity(edges: DataFrame) -> Column:
    """The first check an edge fails, in order: relation, school, then concepts."""
    return (
        F.when(~F.coalesce(F.col("relation").isin(RELATIONS), F.lit(False)), "relation")
        .when(~F.coalesce(F.col("school").isin(SCHOOLS), F.lit(False)), "school")
        .when(F.coalesce(F.lower(F.trim("concept_a")), F.lit("")).isin(""), "empty")
        .when(F.coalesce(F.lower(F.trim("concept_b")), F.lit("")).isin(""), "empty")
        .when(F.lower(F.trim("concept_a")) == F.lower(F.trim("concept_b")), "self_loop")
        .otherwise("valid")
    )


def validated(edges: DataFrame) -> DataFrame:
    return edges.select("edge_id", validity(edges).alias("verdict"))


def drop_counts(edges: DataFrame) -> DataFrame:
    """How often each value outside the vocabulary was dropped."""
    v = edges.withColumn("verdict", validity(edges)).where("verdict in ('relation', 'school')")
    return v.groupBy("verdict", F.coalesce(F.when(F.col("verdict") == "relation", F.col("relation")).otherwise(F.col("school")), F.lit("")).alias("value")).agg(F.count("*").alias("n_dropped"))


def concept_degree(edges: DataFrame) -> DataFrame:
    """Edges and distinct neighbours of each concept, self-loops left out."""
    e = edges.where("concept_a <> '' and concept_b <> '' and concept_a <> concept_b")
    ends = e.select(F.inline(F.array(F.struct(F.col("concept_a").alias("concept"), F.col("concept_b").alias("other")), F.struct(F.col("concept_b").alias("concept"), F.col("concept_a").alias("other")))))
    d = ends.groupBy("concept", "other").agg(F.count("*").alias("n"))
    return d.groupBy("concept").agg(F.sum("n").alias("n_edges"), F.count("*").alias("n_neighbours"))


def two_hop(edges: DataFrame, school: str | None = None, most: int = 1_000) -> DataFrame:
    """Chains a -> b -> c of one relation inside one school, with whether some edge
    a -> c of that relation and school confirms them.

    Distinct edges first, so a hot concept costs its distinct neighbours, not its rows.  A
    concept in the middle with more than ``most`` neighbours before it is dealt over
    several tasks, each of which makes a bounded share of its chains and counts them
    before they are moved.
    """
    by = ["relation", "school"]
    e = edges.where(F.col("relation").isNotNull() & F.col("school").isNotNull() & (F.col("concept_a") != F.col("concept_b")))
    if school:
        e = e.where(F.col("school") == school)
    d = e.select(*by, "concept_a", "concept_b").distinct()
    middle = lambda c: F.struct(*by, F.col(c).alias("b")).alias("middle")
    one = d.select(middle("concept_b"), F.col("concept_a").alias("a"))
    two = d.select(middle("concept_a"), F.col("concept_b").alias("c"))
    direct = d.select(*by, F.col("concept_a").alias("a"), F.col("concept_b").alias("c"), F.lit(True).alias("confirmed"))
    paths = salted_join(one, two, "middle", "a", most=most).where("a <> c").select("middle.relation", "middle.school", "a", "c")
    hops = paths.groupBy(*by, "a", "c").agg(F.count("*").alias("n_paths"))
    return hops.join(direct, [*by, "a", "c"], "left").select(*by, "a", "c", "n_paths", F.coalesce("confirmed", F.lit(False)).alias("confirmed"))


def frequency(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Values with their counts; with ``k`` the most frequent ones (ties by value)."""
    g = df.groupBy(column).agg(F.count("*").alias("n"))
    return g.orderBy(F.desc("n"), column).limit(k) if k else g


def evidence_in_record(edges: DataFrame, records: DataFrame) -> DataFrame:
    """Is the quote really a part of the cited record's text or commentaries?

    Only records cited by very many edges are copied, to spread these.
    """
    bodies = F.concat(F.array("text"), F.coalesce(F.col("commentaries.text"), F.array().cast("array<string>")))
    r = records.select(F.col("id").alias("source_record_id"), F.array_join(bodies, "\n").alias("body"))
    e = edges.where("evidence_quote <> ''").select("edge_id", "source_record_id", "evidence_quote")
    j = salted_join(e, r, "source_record_id", "edge_id", keys=edges.select("source_record_id"))
    return j.groupBy("edge_id").agg(F.max(F.col("body").contains(F.col("evidence_quote"))).alias("verbatim"))
