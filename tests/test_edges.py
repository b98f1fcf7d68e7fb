from tarkaloom.operators import edges as E

EDGE = "edge_id string, concept_a string, concept_b string, relation string, school string, confidence string, evidence_quote string, source_text string"


def edges(spark, *rows):
    return spark.createDataFrame([(f"e{i:02d}", *r) for i, r in enumerate(rows)], EDGE)


def test_pairs_are_unordered_and_need_two_relations(spark):
    e = edges(
        spark,
        ("b", "a", "LEADS_TO", "yoga", "high", "q", "t"),
        ("a", "b", "SUBLATES", "nyaya", None, None, "t"),
        ("a", "b", "SUBLATES", "general", "high", "long quote", "t"),
        (None, "b", "SUBLATES", "yoga", "low", "", "t"),
        ("a", "c", "SUBLATES", None, "low", "x", "t"),
        ("a", "c", "SUBLATES", "yoga", "low", "x", "t"),
    )
    assert [(r.concept_lo, r.concept_hi, r.n_schools, r.n_relations) for r in E.contested_pairs(e).collect()] == [("a", "b", 2, 2)]
    assert E.contested_pairs(e, min_schools=3).count() == 0
    assert E.contested_pairs(e, min_schools=3, exclude_general=False).count() == 1


def test_best_evidence_breaks_ties_by_the_first(spark):
    e = edges(spark, ("a", "b", "LEADS_TO", "yoga", "low", "much longer", "t"), ("a", "b", "SUBLATES", "yoga", "high", "qq", "t"), ("b", "a", "RECONCILES", "yoga", "high", "zz", "t"))
    r = E.best_evidence(e).first()
    assert (r.edge_id, r.relation, r.n_edges) == ("e01", "SUBLATES", 3)
    assert E.first_evidence(e).count() == 3


def test_checks_come_in_order(spark):
    e = edges(
        spark,
        ("a", "a", "IS_UNBORN", "nowhere", "", "", ""), ("a", "a", "LEADS_TO", "nowhere", "", "", ""), ("A ", "a", "LEADS_TO", "yoga", "", "", ""),
        ("", "a", "LEADS_TO", "yoga", "", "", ""), ("a", "b", "LEADS_TO", "yoga", "", "", ""), ("a", "b", None, None, "", "", ""),
    )
    assert [r.verdict for r in E.validated(e).orderBy("edge_id").collect()] == ["relation", "school", "self_loop", "empty", "valid", "relation"]
    assert {(r.verdict, r.value): r.n_dropped for r in E.drop_counts(e).collect()} == {("relation", "IS_UNBORN"): 1, ("relation", ""): 1, ("school", "nowhere"): 1}


def test_profiles_sum_to_hundred_and_zero_fill(spark):
    e = edges(spark, *[("a", "b", r, "yoga", "", "", "t") for r in ("LEADS_TO", "LEADS_TO", "SUBLATES")])
    p = E.relation_profile(e, "school", min_edges=3).collect()
    assert len(p) == 13 and abs(sum(r.pct for r in p) - 100) < 1e-5
    assert E.relation_profile(e, "school", min_edges=4).count() == 0 and E.small_groups(e, "school", 4).count() == 1


def test_two_hop_confirms(spark):
    e = edges(spark, ("a", "b", "LEADS_TO", "yoga", "", "", ""), ("b", "c", "LEADS_TO", "yoga", "", "", ""), ("a", "c", "LEADS_TO", "yoga", "", "", ""), ("b", "a", "LEADS_TO", "yoga", "", "", ""))
    assert {(r.a, r.c): r.confirmed for r in E.two_hop(e).collect() if r.relation == "LEADS_TO"} == {("a", "c"): True, ("b", "c"): True}


def test_empty_table(spark):
    e = spark.createDataFrame([], EDGE)
    assert E.contested_pairs(e).count() == E.concept_degree(e).count() == E.best_evidence(e).count() == 0


def test_concepts_of_a_source_are_numbered_in_blocks(spark, tmp_path):
    from tarkaloom.plans.q_graph import concepts_flatten

    rows = [(k * 9_000, f"r{k}", s, [(f"c{k}", "x"), (f"d{k}", "x")]) for k in range(10) for s in ("hot", None)]
    spark.createDataFrame(rows, "tag_no bigint, record_id string, source string, concepts array<struct<name:string,category:string>>").write.parquet(f"{tmp_path}/tagged_record.parquet")
    df = concepts_flatten(spark, str(tmp_path))
    want = {(f"{s}_{2 * k + i + 1:06d}", f"{c}{k}") for k in range(10) for s in ("hot", "") for i, c in enumerate("cd")}
    assert {(r.concept_key, r.name) for r in df.collect()} == want
    windows = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "row_number()" in x]
    assert windows and all("windowspecdefinition(source#" in x and ", _b#" in x for x in windows)
