import json

from pyspark.sql import functions as F

from tarkaloom.functions import html as H
from tarkaloom.functions import text as X
from tarkaloom.functions.vocab import PROSE
from tarkaloom.operators import records as R
from tarkaloom.operators import style as S
from tarkaloom.operators.chains import chain_positions
from tarkaloom.operators.tagging import tag_with
from tarkaloom.operators.vectors import centroid_pairs, centroids
from tarkaloom.sources import io
from tarkaloom.streaming.resume import run_available

PAGE = '<html><head><title>t</title><style>p{}</style></head><body><h1>A <b>head</h1><p>One &amp; two<p>three <a href="x1.htm">l</a></p><script>"</p>"</script><!-- <p>no</p> --><a href=\'y.htm\'>m</a></body>'


def one(spark, c, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols)).select(c.alias("x")).first().x


def test_sentences(spark):
    texts = {"": 0, "  ": 0, "four words only here": 1, " ".join(["w"] * 20): 1, " ".join(["w"] * 21): 2, "One. Two! Three": 3, "One. ": 1}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.n for r in df.select("t", F.size(X.sentences(F.col("t"))).alias("n")).collect()} == texts


def test_snippet_is_clamped(spark):
    assert one(spark, X.kwic(F.col("t"), "mid", 5, 3), t="mid") is None
    assert one(spark, X.kwic(F.col("t"), "mid", 5, 3), t="abcdefgh mid stuvwxyz") == "efgh mid stuv"
    assert one(spark, X.strip_ws(F.col("t")), t="   x \n") == "x"


def test_html(spark):
    assert one(spark, H.title(F.col("t")), t=PAGE) == "A head"
    assert one(spark, H.paragraphs(F.col("t")), t=PAGE) == ["One & two", "three l"]
    assert one(spark, H.links(F.col("t")), t=PAGE) == ["x1.htm", "y.htm"]
    assert one(spark, H.links(F.col("t"), r"^x\d"), t=PAGE) == ["x1.htm"]
    assert "no" not in one(spark, H.to_text(F.col("t")), t=PAGE).split("\n")
    assert one(spark, H.contains_fragment(F.col("t"), "ONE &AMP;"), t=PAGE)


def test_style_profile(spark):
    df = spark.createDataFrame([("a", "How could it be? It is objected that so. End"), ("a", None), ("b", "")], "g string, text string")
    rows = {r.g: r for r in S.profile(df, "g", PROSE).collect()}
    assert set(rows) == {"a"} and rows["a"].n_passages == 2 and rows["a"].pct_dialogue == 50.0 and rows["a"].words_per_sentence == round(10 / 3, 6)


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1", "chapter": 2}, {"id": "2", "commentaries": [{"text": "x"}]}]))
    (tmp_path / "b.json").write_text(json.dumps({"done": [1]}))
    (tmp_path / "c.json").write_text("[{")
    got = io.read_json_arrays(spark, str(tmp_path / "*.json")).orderBy("pos").collect()
    assert [(r.file, r.pos, r.id) for r in got] == [("a.json", 0, "1"), ("a.json", 1, "2")] and got[1].commentaries[0].text == "x"
    assert {r.file: r.status for r in io.file_status(spark, str(tmp_path / "*.json")).collect()} == {"a.json": "array", "b.json": "other", "c.json": "broken"}
    (tmp_path / "l.jsonl").write_text('{"edge_id": "e1"}\n\nbroken\n{"edge_id": "e2", "school": "yoga"}\n')
    assert sorted(r.edge_id for r in io.read_jsonl(spark, str(tmp_path / "l.jsonl"), io.EDGE).collect()) == ["e1", "e2"]
    (tmp_path / "s.seg").write_text('{"a:0.1": "title of the text", "a:1.1": "first words", "b": "short", "a:1.1": "last of the same key"}')
    seg = io.content_segments(io.read_segments(spark, str(tmp_path / "s.seg"))).collect()
    assert [(r.key, r.text) for r in seg] == [("a:1.1", "last of the same key")]
    (tmp_path / "t.txt").write_text("a\n\nb")
    assert [(r.line_no, r.line) for r in io.read_lines(spark, str(tmp_path / "t.txt")).orderBy("line_no").collect()] == [(0, "a"), (1, ""), (2, "b")]


def test_sinks_and_review(spark, tmp_path):
    rows = spark.createDataFrame([("c", "he said \"so\",\nand left")], "category string, passage string")
    io.write_review(rows, str(tmp_path / "r"))
    assert io.read_review(spark, str(tmp_path / "r")).first().passage == 'he said "so",\nand left'
    marks = spark.createDataFrame([(" y",), ("N",), ("",), (None,), ("Y",)], "correct string")
    assert tuple(io.review_precision(marks).first()) == (3, 2, 2 / 3)
    a = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "z")], "k string, v string")
    io.append_new(a, str(tmp_path / "t"), "k")
    io.append_new(a, str(tmp_path / "t"), "k")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    assert spark.read.parquet(io.write_version(a, str(tmp_path / "v"))).count() == 3


def test_stream_takes_only_what_is_new(spark, tmp_path):
    src, sink, chk = (str(tmp_path / x) for x in ("src", "sink", "chk"))
    spark.createDataFrame([("1",), ("1",), ("2",)], "k string").write.parquet(src)
    run_available(spark, src, sink, chk, "k")
    spark.createDataFrame([("2",), ("3",)], "k string").write.mode("append").parquet(src)
    run_available(spark, src, sink, chk, "k")
    run_available(spark, src, sink, chk, "k")
    assert sorted(r.k for r in spark.read.parquet(sink).collect()) == ["1", "2", "3"]


def test_ids_and_versions(spark, day):
    df = spark.createDataFrame([("a_1", 1), ("a_1", 2), ("b", 3), ("a_7", 4), ("a_x2", 5)], "id string, rec_no int")
    got = {r.rec_no: r.new_id for r in R.repaired_ids(df, "id", ["rec_no"]).collect()}
    assert got == {1: "a_00001", 2: "a_00002", 4: "a_00003", 3: "b_00001", 5: "a_x2_00001"}
    u = R.id_uniqueness(spark.createDataFrame([("s", None), ("s", None), ("s", "a")], "s string, id string"), "s", "id").first()
    assert (u.n_rows, u.n_ids, u.is_unique) == (3, 2, False)
    d = R.dedupe_first(spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), (None, 1, "n")], "k string, pos int, v string"), "k", ["pos"])
    assert [r.v for r in d.collect()] == ["a"]


def test_chains(spark):
    links = [(i, i - 1 if i else None) for i in range(40)] + [(100, 101), (101, 100), (200, 999)]
    got = {r.n: (r.head, r.position) for r in chain_positions(spark.createDataFrame(links, "n int, p int"), "n", "p").collect()}
    assert got[39] == (0, 39) and got[0] == (0, 0) and got[100] == (None, None) and got[200] == (200, 0)


def test_a_failed_tag_is_a_row(spark):
    def tagger(text):
        if "bad" in text:
            raise ValueError(text)
        return [("mirror", "ethical")] if "mirror" in text else []

    df = spark.createDataFrame([("1", "the mirror"), ("2", "bad"), ("3", None)], "id string, text string")
    assert {r.record_id: (len(r.concepts), r.error) for r in tag_with(df, tagger).collect()} == {"1": (1, None), "2": (0, "ValueError"), "3": (0, None)}


def test_centroids(spark):
    df = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [1.0, 0.0]), (3, "b", [0.0, 1.0]), (4, "b", [0.0, 3.0]), (5, "c", [1.0, 1.0]), (6, None, [1.0, 1.0])], "k int, g string, v array<float>")
    assert [tuple(r) for r in centroid_pairs(centroids(df, "g", "k", "v"), "g").collect()] == [("a", "b", 1.0)]


def test_numerals(spark):
    cases = {"I": 1, "IV": 4, "XIX": 19, "xlii": 42, "MCMXC": 1990, "": None, "A": None}
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert {r.c: r.n for r in df.select("c", X.roman(F.col("c")).alias("n")).collect()} == cases
    assert one(spark, X.number_word(F.col("t")), t=" Third ") == 3 and one(spark, X.number_word(F.col("t")), t="last") is None
    assert one(spark, X.is_front_matter(F.col("t")), t="The introduction") and not one(spark, X.is_front_matter(F.col("t")), t="1. The introduction")


def test_a_roman_page_mark_is_front_matter(spark):
    front = lambda t: one(spark, X.is_front_matter(F.col("t")), t=t)
    assert front("p. xii Of the translation") and front("1. Preface, P.IV") and front("p.\nxl")
    assert not front("p. 12 Of the rope") and not front("cp. xiiz") and not front("x" * 50 + " p. xii")
