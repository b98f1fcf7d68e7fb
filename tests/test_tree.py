import json

from pyspark.sql import functions as F

from tarkaloom.functions import html as H
from tarkaloom.sources import tree

PAGE = """<html><head><title>t</title></head><body><p>before</p><h1>One <b>head</h1><p>first &amp; second</p><div>third</div><h2>Two</h2><hr><p>after the rule</p><h3>Empty</h3>
<a href="b.htm">b</a><a href="a.htm">a</a><a href="b.htm">again</a></body></html>"""


def write(base, path, value):
    p = base / path
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(value if isinstance(value, str) else json.dumps(value), encoding="utf-8")


def test_parallel_trees(spark, tmp_path):
    write(tmp_path, "en/sn/sn12/a_en.json", {"sn12.1:0.1": "a long enough title", "sn12.1:1.1": " a long enough line ", "sn12.1:1.2": "short", "nocolon": "also long enough"})
    write(tmp_path, "en/sn/sn1/b_en.json", '{"sn1.1:1.1": "the first of two values", "sn1.1:1.1": "the last of two values"}')
    write(tmp_path, "en/dn/c_en.json", {"dn1:1.1": "no parallel file here"})
    write(tmp_path, "en/dn/broken_en.json", "{")
    write(tmp_path, "pli/sn/sn12/a_pli.json", {"sn12.1:1.1": "evam me sutam", "sn12.1:9.9": "nothing matches"})
    texts = tree.tree_segments(tree.read_tree(spark, f"{tmp_path}/en"), "_en")
    others = tree.tree_segments(tree.read_tree(spark, f"{tmp_path}/pli"), "_pli")
    got = {r.key: (r.stem, r.collection, r.folder, r.theme, r.head, r.place, r.text, r.other) for r in tree.parallel_segments(texts, others, {"sn12": "causation"}).collect()}
    assert got == {
        "sn12.1:1.1": ("sn/sn12/a.json", "sn", "sn12", "causation", "sn12.1", "1.1", "a long enough line", "evam me sutam"),
        "nocolon": ("sn/sn12/a.json", "sn", "sn12", "causation", "nocolon", "", "also long enough", ""),
        "sn1.1:1.1": ("sn/sn1/b.json", "sn", "sn1", None, "sn1.1", "1.1", "the last of two values", ""),
        "dn1:1.1": ("dn/c.json", "dn", "", None, "dn1", "1.1", "no parallel file here", ""),
    }
    assert tree.parallel_segments(texts, others).where("theme is not null").count() == 0


def test_sections_links_and_records(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<p>" + "word " * 20)], "k int, html string")
    c = F.col("html")
    got = {r.k: r for r in df.select("k", H.sections(c).alias("s"), H.links_first_seen(c).alias("l"), H.page_record(c, 20).alias("r")).collect()}
    assert [tuple(x) for x in got[1].s] == [("", "before"), ("One head", "first & second third"), ("Two", ""), ("", "after the rule"), ("Empty", "b a again")]
    assert got[1].l == ["b.htm", "a.htm"] and got[2].s is None and got[3].s == []
    assert got[1].r.title == "One head" and got[1].r.text == "before\nfirst & second\nafter the rule" and got[2].r is None and got[3].r is None
    assert got[4].r.title == "" and [x.header for x in got[4].r.sections] == [""]
