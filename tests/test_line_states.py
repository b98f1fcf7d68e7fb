import random

from pyspark.sql import functions as F

from tarkaloom.functions import text as X
from tarkaloom.operators import line_states as L
from tarkaloom.operators import records as R
from tarkaloom.operators import vectors as V

CHAPTER, ITEM = r"^Chapter ([0-9]+)$", r"^Text ([0-9]+)$"
MARKERS = {"speech": "^SPEECH$", "note": "^NOTE$"}
LINES = ["Chapter 1", "Chapter 2", "Text 1", "Text 2", "Text 3", "SPEECH", "NOTE", "A line", "a low line", "एक पद", "word; word", "", "   ", " Text 9 "]


def walk(text):
    """The same parser with variables."""
    items, chapter, now = [], None, None
    for line in (x.strip() for x in (text or "").split("\n")):
        if not line:
            continue
        if line.startswith("Chapter "):
            chapter, now = line.split()[1], None
        elif line.startswith("Text "):
            now = {"chapter": chapter, "item": line.split()[1], "lines": []}
            items.append(now)
        elif now:
            now["lines"].append(line)
    return items


def heads(lines, most):
    n = next((i for i, x in enumerate(lines) if i >= most or x[0].islower()), len(lines))
    return lines[:n], lines[n:]


def kinds(lines):
    state, out = "script", []
    for x in lines:
        if x in ("SPEECH", "NOTE"):
            state = x.lower()
            continue
        if state == "script" and x[0] < "ऀ":
            state = "running"
        if state == "running" and ";" in x:
            state = "clauses"
        out.append((x, state))
    return out


def texts(spark):
    rnd = random.Random(3)
    rows = [(d, "\n".join(rnd.choices(LINES, k=rnd.randrange(30))), "clash") for d in range(60)] + [(90, None, ""), (91, "", ""), (92, "Text 1\n" + "long line\n" * 3_000, "")]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, item string")


def test_head_and_body_equal_a_walk(spark):
    rows, df = texts(spark)
    got = sorted(((r.doc_id, r.island, r.chapter, r.item, r.head, r.body, r.n_head, r.n_body) for r in L.head_and_body(L.text_lines(df, "doc_id"), "doc_id", CHAPTER, ITEM, 2).collect()), key=lambda r: r[:2])
    want = []
    for d, t, _ in rows:
        for i in walk(t):
            h, b = heads(i["lines"], 2)
            want.append((d, i["chapter"], i["item"], " ".join(h), " ".join(b), len(h), len(b)))
    assert [(r[0], *r[2:]) for r in got] == want and len(want) > 60


def test_typed_lines_equal_a_walk(spark):
    rows, df = texts(spark)
    opening = [("script", X.script_share(F.col("line"), "[ऀ-ॿ]", spaces=False) > 0.3), ("running", ~F.col("line").contains(";"))]
    got = sorted(L.typed_lines(L.text_lines(df, "doc_id"), "doc_id", CHAPTER, ITEM, MARKERS, opening, "clauses").collect(), key=lambda r: (r.doc_id, r.line_no))
    want = [(d, i["chapter"], i["item"], x, k) for d, t, _ in rows for i in walk(t) for x, k in kinds(i["lines"])]
    assert [(r.doc_id, r.chapter, r.item, r.line, r.kind) for r in got] == want and {w[4] for w in want} == {"script", "running", "clauses", "speech", "note"}


def test_empty_tables(spark):
    lines = L.text_lines(spark.createDataFrame([], "doc_id bigint, text string"), "doc_id")
    assert L.head_and_body(lines, "doc_id", CHAPTER, ITEM).count() == 0
    assert L.typed_lines(lines, "doc_id", CHAPTER, ITEM, {}, [], "all").count() == 0


def test_skipped_pages_give_no_label(spark):
    rows = [(1, "a", None, False), (2, "a", "x", False), (3, "a", "y", True), (4, "a", None, False), (5, None, None, None), (30_000, "a", None, False)]
    df = spark.createDataFrame(rows, "page bigint, src string, label string, skip boolean")
    got = {r.page: r.kind for r in L.carried_label(df, "src", "page", F.col("skip"), F.col("label"), "kind").collect()}
    assert got == {1: None, 2: "x", 4: "x", 5: None, 30_000: "x"}


def test_renumbered(spark):
    rows = [(1, None, None, None), (2, 1, None, 7), (3, 1, 3, None), (4, 1, None, None), (5, 2, None, 1), (6, 2, None, None)]
    df = spark.createDataFrame([("s", *r) for r in rows], "src string, at bigint, chapter int, section int, verse int")
    for block in (2, 100):
        got = {r["at"]: (r.section_no, r.number_no) for r in L.renumbered(df, "src", "at", "chapter", F.col("section"), "verse", block).collect()}
        assert got == {2: (1, 7), 3: (3, 8), 4: (3, 9), 5: (1, 1), 6: (1, 2)}


def test_text_over_first_and_counters(spark):
    df = spark.createDataFrame([(1, "own", [("c", "t"), ("d", "u")]), (2, None, [("c", "t")]), (3, "x", []), (4, "x", None)], "k int, text string, commentaries array<struct<commentator:string,text:string>>")
    got = {r.k: [tuple(c) for c in r.commentaries] for r in R.text_over_first(df).collect()}
    assert got == {1: [("c", "own"), ("d", "u")], 2: [("c", None)], 3: [], 4: []}
    n = spark.createDataFrame([("a", "y", 2), ("a", "x", 1), ("a", "y", 3), ("a", None, 9), (None, "x", 1)], "g string, v string, n int")
    assert {r.g: r.counts for r in R.counters_as_map(n, "g", "v", "n").collect()} == {"a": {"x": 1, "y": 5}, None: {"x": 1}}


def test_sparse_pairs(spark):
    rows = [("q", "a", "x", 3), ("q", "a", "y", 4), ("q", "b", "x", 1), ("q", "c", "z", 2), ("r", "a", "x", 1)]
    got = {(r.q, r.group_a, r.group_b): r.distance for r in V.sparse_pairs(spark.createDataFrame(rows, "q string, g string, i string, x int"), "q", "g", "i", "x").collect()}
    assert got == {("q", "a", "b"): 0.4, ("q", "a", "c"): 1.0, ("q", "b", "c"): 1.0}
