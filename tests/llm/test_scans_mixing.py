import random

import numpy as np
import pytest

from tarkaloom.llm import mixing as M
from tarkaloom.llm import scan_noise as N

WORDS = "the seeker asks whether mirror supports doubt chain births reader known silence chapter before release ordinary experience second witness".split()


def page_set(rnd, n=60):
    docs, truth = [], set()
    for d in range(n):
        title = f"Notes on the {rnd.choice(['Hollow', 'Tender', 'Distant'])} {rnd.choice(['Mirror', 'Ladder', 'Echo'])}"
        text = [w for _ in range(70) for w in [rnd.choice(WORDS)]]
        if d % 3:
            docs.append((d, title + "\n" + " ".join(text).capitalize() + ".\n" + " ".join(text[:30]).capitalize() + ".", title))
            continue
        lines, cur = [], ""
        for w in text:
            if len(cur) + len(w) > 44:
                if len(w) > 5 and rnd.random() < 0.5 and len(cur) < 42:
                    lines.append((f"{cur} {w[:3]}-", True))
                    cur = w[3:]
                    continue
                lines.append((cur, False))
                cur = w
            else:
                cur = f"{cur} {w}".strip()
        lines.append((cur + ".", False))
        out = []
        for k, (line, broken) in enumerate(lines):
            if broken:
                truth.add((d, len(out), "hyphen"))
            if d == 0 and k == 1:
                line = "0f " + line.replace("silence", "siIence") if "silence" in line else line
            elif d and k % 4 == 1 and " witness" in line:
                line = line.replace(" witness", " vvitness", 1)
                truth.add((d, len(out), "char"))
            out.append(line)
            if k == 3:
                truth.add((d, len(out), "pageno"))
                out.append(rnd.choice(["- 12 -", "[l7]", "Page 31", "xiv"]))
                truth.add((d, len(out), "header"))
                out.append(rnd.choice([title.upper(), f"{title}    17", f"17 · {title}"]))
        docs.append((d, "\n".join(out), title))
    return docs, truth


@pytest.fixture(scope="module")
def pages(spark):
    docs, truth = page_set(random.Random(6))
    docs += [(900, None, None), (901, "", None), (902, "word " * 20_000, "x"), (903, "12\n13", None)]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id bigint, text string, title string, kinds string, word int")
    read = N.read_pages(df)
    fixes = N.corrections(read)
    return df, truth, read, fixes


def test_noise_is_found(pages):
    df, truth, read, fixes = pages
    got = {(r.doc_id, r.line_no, r.noise_kind) for r in N.line_noise(read, fixes).collect() if r.doc_id}
    assert got == {t for t in truth if t[0]}


def test_text_is_continuous_and_right(pages):
    df, truth, read, fixes = pages
    clean = {r.doc_id: r.text for r in N.repaired(df, read, fixes).collect()}
    assert {r.word: r.fix for r in fixes.collect()} == {"vvitness": "witness", "siience": "silence"}
    for d, t in clean.items():
        if d and d < 900:
            assert set(t.lower().rstrip(".").replace("\n", " ").split()) <= {*WORDS}, t


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, title string")
    read = N.read_pages(df)
    assert N.line_noise(read, N.corrections(read)).count() == 0


def test_glyph_variants():
    assert "modern" in N.glyph_variants("modem") and "witness" in N.glyph_variants("vvitness") and "less" in N.glyph_variants("1e5s")


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    x = rng.integers(50, 2000, 500).astype(float)
    p = np.full(500, 0.37)
    got = M.flight(p, x, np.random.default_rng(3), land=False)
    open_ = (got > 0) & (got < 1)
    assert open_.sum() <= 2 and abs(got.sum() - p.sum()) < 1e-6 and abs(got @ x - p @ x) < 1e-3
    landed = M.flight(p, x, np.random.default_rng(3), land=True)
    assert set(landed) <= {0.0, 1.0} and abs(landed @ x - p @ x) <= x.max()


def test_flight_keeps_probabilities():
    x = np.array([5.0, 7, 7, 9, 30, 31, 2, 8])
    hits = sum(M.flight(np.full(8, 0.25), x, np.random.default_rng(s), land=False) for s in range(3000)) / 3000
    assert np.abs(hits - 0.25).max() < 0.03


@pytest.mark.parametrize("block", [40, 2000])
def test_mix(spark, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)
    rnd = random.Random(2)
    docs = [(i, "big" if i < 300 else "small" if i < 320 else "other", "word " * rnd.randrange(5, 60)) for i in range(330)] + [(900, "big", None), (901, None, "x"), (902, "big", "")]
    df = spark.createDataFrame([(*d, 5) for d in docs], "doc_id bigint, source string, text string, n_tokens int")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 3), ("absent", 0.2, 2)], "source string, target_share double, max_repeats int")
    mix = M.mixed(df, targets)
    rows = {r.doc_id: r for r in mix.collect()}
    assert len(rows) == mix.count() and {r.source for r in rows.values()} == {"big", "small"}
    assert max(r.copies for r in rows.values() if r.source == "small") <= 3 and max(r.copies for r in rows.values() if r.source == "big") == 1
    s = {r.source: r for r in M.shares(mix, targets).collect()}
    assert abs(s["big"].reached_share - 0.625) < 0.02 and abs(s["small"].reached_share - 0.375) < 0.02 and s["absent"].tokens == 0
    again = {r.doc_id: r.copies for r in M.mixed(df, targets).collect()}
    assert again == {k: r.copies for k, r in rows.items()}


def test_a_mix_of_the_size_of_the_corpus_stops_at_caps(spark):
    """Without a stated total 'few' would set the size; with one it is used to its cap and the others in full."""
    rows = [(i, "few" if i < 5 else "many" if i < 85 else "rest", f"text {i} " * (3 + i % 4)) for i in range(125)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    t = spark.createDataFrame([("few", 0.5, 3), ("many", 0.25, 1), ("rest", 0.25, 2), ("none", 0.5, 9)], "source string, target_share double, max_repeats int")
    sizes = M.token_counts(docs).groupBy("source").agg({"n_tokens": "sum"}).collect()
    have = {r.source: r[1] for r in sizes}
    total = sum(have.values())
    got = {r.source: r for r in M.shares(M.mixed(docs, t, of_corpus=1.0), t).collect()}
    assert got["few"].tokens == 3 * have["few"] < 0.5 * total and got["few"].most_copies == 3
    for s, cap in (("many", 1), ("rest", 2)):
        assert abs(got[s].tokens - 0.25 * total) < 60 and got[s].most_copies <= cap
    assert got["none"].tokens == 0 and abs(sum(r.reached_share for r in got.values()) - 1) < 1e-5


def test_mix_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id bigint, source string, text string")
    t = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    assert M.mixed(df, t).count() == 0


def test_two_letters_of_a_word_misread(spark):
    assert "teacher" in N.glyph_variants("teacbcr") and "again" in N.glyph_variants("a9aiu")
    near = {"teacher": "rope rope silence silence", "teacbcr": "rope rope silence silence", "rope": "_ _ _ _", "silence": "_ _ _ _"}
    tokens = lambda n, *ws: [(0, 0, len(w), w, near[w]) for w in ws for _ in range(n)]
    rows = [(0, False, tokens(20, "teacher", "rope", "silence")), (1, True, tokens(2, "teacbcr", "rope"))]
    pages = spark.createDataFrame(rows, "doc_id bigint, scan boolean, tokens array<struct<line:bigint,last:bigint,cut:bigint,word:string,near:string>>")
    got = N.corrections(pages).collect()
    assert {(r.word, r.fix) for r in got} == {("teacbcr", "teacher")} and len(got) == 2


def context_pages(spark):
    """Clean text with its words in two settings, and a scan: (word, near) of each token."""
    clean = [("modern", "a the house of")] * 30 + [("modem", "my cable box is")] * 30 + [("tree", "root of this grows")] * 30 + [("free", "set him now and")] * 30
    clean += [(w, "_ _ _ _") for _, near in clean for w in near.split()]
    scan = [("modem", "a the house of"), ("modem", "my cable box is"), ("modem", "_ _ _ _"), ("trce", "root of this grows"), ("trce", "set him now and")]
    tokens = lambda ws: [(0, 0, len(w), w, near) for w, near in ws]
    rows = [(0, False, tokens(clean)), (1, True, tokens(scan))]
    return spark.createDataFrame(rows, "doc_id bigint, scan boolean, tokens array<struct<line:bigint,last:bigint,cut:bigint,word:string,near:string>>")


def test_only_context_tells_candidates_apart(spark):
    """One spelling is corrected to two words, and a word of clean text only where it doesn't fit."""
    pages = context_pages(spark)
    got = {r["at"]: (r.word, r.fix) for r in N.corrections(pages).collect()}
    assert got == {0: ("modem", "modern"), 3: ("trce", "tree"), 4: ("trce", "free")}
    off = {r["at"]: r.fix for r in N.corrections(pages, use_vectors=False).collect()}
    assert off[3] == off[4] and 0 not in off


@pytest.mark.parametrize(
    ("line", "words"),
    [
        ("PREFACE", ["PREFACE"]), ("12   A Digest of the Lattice", ["A", "Digest", "of", "the", "Lattice"]), ("A Digest of the Lattice", None), ("THE VOW IS KEPT.", None), ("and so the rope 12", None),
        ("A Very Long Running Header of the Elder Digest on the Measured Harbour and the Woven Lattice 17", "A Very Long Running Header of the Elder Digest on the Measured Harbour and the Woven Lattice".split()),
        ("---", None),
    ],
)
def test_header_like_lines(line, words):
    assert N.Page.header_words(line) == words
