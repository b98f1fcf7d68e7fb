import random

import numpy as np
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from tarkaloom.llm import site_lines as S

DOC = "doc_id bigint, source string, text string, chunk string, line_key int"


def key(line):
    return regex.sub(r"[^\p{L}\p{M}]+", "", line.lower())


def brute(rows, min_docs=3, share=0.08):
    docs, where = {}, {}
    for d, s, t, *_ in rows:
        docs.setdefault(s or "", set()).add(d)
        for i, x in enumerate((t or "").split("\n")):
            if len(key(x)) >= 12:
                where.setdefault((s or "", key(x)), set()).add((d, i))
    return {o for (s, _), os in where.items() if len({d for d, _ in os}) >= min_docs and 100 * len({d for d, _ in os}) >= round(100 * share) * len(docs[s]) for o in os}


def test_found_equals_brute_force(spark):
    rnd = random.Random(1)
    words = ["silent", "mirror", "of", "the", "seeker", "vow", "प्रकाश", "rope", "coiled", "wick"]
    notices = ["Share this text with a friend | Print", "all rights reserved 2021", "short one", "इस पाठ को साझा करें"]
    rows = []
    for d in range(150):
        s = rnd.choice(["a", "a", "a", "b", None])
        lines = [" ".join(rnd.choices(words, k=rnd.randrange(1, 9))) for _ in range(rnd.randrange(6))]
        lines += [n.upper() if rnd.random() < 0.3 else f"{n} {rnd.randrange(99)}" for n in notices if rnd.random() < 0.2]
        rnd.shuffle(lines)
        rows.append((d, s, "\n".join(lines), "clash", 1))
    rows += [(900, "a", None, "", 1), (901, "a", "", "", 1), (902, "b", "x" * 60_000, "", 1), rows[0], rows[0]]
    df = spark.createDataFrame(rows, DOC)
    found = S.repeated_lines(df)
    assert {(r.doc_id, r.line_no) for r in found.collect()} == brute(rows)
    clean = {r.doc_id: r for r in S.without_lines(df.dropDuplicates(["doc_id"]), found).collect()}
    assert len(clean) == len({r[0] for r in rows}) and clean[900].text is None
    gone = brute(rows)
    for d, _, t, *_ in rows:
        if t:
            assert clean[d].text == "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)


@settings(max_examples=200, deadline=None)
@given(st.text("abcdef", min_size=12, max_size=40), st.text("abcdef", max_size=30), st.text("abcdef", max_size=30))
def test_chunks_of_a_line_stand_in_every_context(line, before, after):
    def chunks(*texts):
        h, _, g = S.chunk_hashes(*S._letters(list(texts), per_line=False)[1:])
        return set(h[g == 1].tolist())

    inner, outer = chunks("other", line, "text"), chunks("", before + line + after, None)
    assert inner and inner <= outer


def test_empty(spark):
    df = spark.createDataFrame([], DOC)
    found = S.repeated_lines(df)
    assert found.count() == 0 and S.without_lines(df, found).count() == 0
    assert len(S.chunk_hashes(np.empty(0, np.uint32), np.empty(0, np.int64))[0]) == 0


def test_the_share_is_exact(spark):
    """14 of 175 documents are 8 %, though 175 * 0.08 is more than 14 in binary fractions."""
    rows = [(d, "a", "the same notice in all" if d < 14 else f"nothing {d}", "", 1) for d in range(175)]
    assert S.repeated_lines(spark.createDataFrame(rows, DOC)).count() == 14
