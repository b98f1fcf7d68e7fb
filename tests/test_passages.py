import json

from tarkaloom.operators import passages as P
from tarkaloom.sources import io

C = "array<struct<commentator:string,school:string,lang:string,type:string,text:string>>"


def com(school, text, who="a"):
    return {"commentator": who, "school": school, "lang": None, "type": None, "text": text}


def test_passages_of_both_shapes(spark):
    long = "The seeker speaks of MAYA+ and of nothing else in this whole sentence."
    rows = [
        (1, "s", long, [com("advaita", long), com("general", long), com(None, long), com("advaita", None), com("advaita", "maya+")]),
        (2, "t", long, None),
        (3, None, None, []),
        (4, "s", "The word mayavada doesn't count, as plus is a part of the name here.", [com("", long, None)]),
    ]
    r = spark.createDataFrame([(*x, "clash", 5) for x in rows], f"rec_no bigint, source string, text string, commentaries {C}, school string, com_pos int")
    schools = spark.createDataFrame([("s", "theravada")], "source string, school string")
    got = {(x.concept, x.group, x.kind, x.rec_no, x.com_pos) for x in P.concept_passages(r, {"illusion": ["maya+", "moha"], "none": ["xyz"]}, "school", schools).collect()}
    assert got == {("illusion", "advaita", "commentary", 1, 0), ("illusion", "theravada", "text", 1, -1)}
    by = P.concept_passages(r, {"illusion": ["maya+"]}, "commentator", schools, window=20).collect()
    assert {(x.group, x.rec_no, x.com_pos) for x in by} == {("a", 1, 0), ("a", 1, 1), ("a", 1, 2)} or all(len(x.passage) <= 30 for x in by)
    assert P.concept_passages(r.limit(0), {"illusion": ["maya+"]}).count() == 0


def test_window_is_half_before_and_half_after(spark):
    t = "x" * 300 + "MAYA" + "y" * 300
    got = spark.createDataFrame([(t,), ("maya",), (None,)], "t string").select(P.passage(P.F.col("t"), ["maya"], 100).alias("p")).collect()
    assert [r.p for r in got] == ["x" * 50 + "MAYA" + "y" * 50, None, None]


def test_line_numbers(spark):
    t = "12. The vow\n 3. the vow\nsee Mantra 7 and Mantra 8\nText 12\n5 \n6 x\n99999999999999999999\n"
    got = spark.createDataFrame([(t,), ("",), (None,)], "t string").select(P.line_numbers(P.F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [[5, 7, 12], [], None]


def test_nest(spark):
    r = spark.createDataFrame([(1,), (2,)], "rec_no bigint")
    parts = spark.createDataFrame([(1, 2, "a", "z"), (1, 0, "a", "y"), (1, 1, "b", None), (1, 3, None, "w")], "rec_no bigint, com_pos int, type string, text string")
    got = {x.rec_no: ([y.text for y in x.one], [y.text for y in x.two]) for x in P.nest_by_record(r, parts, {"one": "a", "two": "b"}).collect()}
    assert got == {1: (["y", "z"], [None]), 2: ([], [])}


def test_tagged_edges_and_exports(spark, tmp_path):
    src = tmp_path / "tagged"
    src.mkdir()
    rel = lambda a: {"concept_a": a, "concept_b": "b", "relation": "R", "school": "s", "confidence": "high", "evidence_quote": "q"}
    line = lambda k, *a: json.dumps({"record_id": k, "source": "src", "relationships": [rel(x) for x in a]})
    (src / "b.jsonl").write_text(line("r3", "e") + "\n")
    (src / "a.jsonl").write_text(line("r1", "x", "y") + "\n\n{broken\n" + line("r2") + "\n" + line("r2", "z"))
    (src / "test_verse.jsonl").write_text(line("r9", "no"))
    edges = io.read_tagged_edges(spark, str(src))
    got = [(r.edge_no, r.edge_id, r.concept_a, r.source_record_id, r.tagged_from_file) for r in edges.orderBy("edge_no").collect()]
    assert got == [(1, "edge_000001", "x", "r1", "a.jsonl"), (2, "edge_000002", "y", "r1", "a.jsonl"), (3, "edge_000003", "z", "r2", "a.jsonl"), (4, "edge_000004", "e", "r3", "b.jsonl")]
    io.write_json_array(edges, str(tmp_path / "array"), "edge_no")
    (part,) = (tmp_path / "array").glob("part-*")
    back = json.loads(part.read_text())
    assert [r["edge_no"] for r in back] == [1, 2, 3, 4] and back[0]["concept_a"] == "x"
    io.write_json_array(edges.limit(0), str(tmp_path / "empty"), "edge_no")
    assert [json.loads(p.read_text()) for p in (tmp_path / "empty").glob("part-*") if p.stat().st_size] == [[]]
    io.write_jsonl(spark.sql("select 1 as a, cast(null as string) as b"), str(tmp_path / "lines"))
    assert [json.loads(p.read_text()) for p in (tmp_path / "lines").glob("part-*") if p.stat().st_size] == [{"a": 1, "b": None}]
