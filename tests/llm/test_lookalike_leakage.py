import pickle
import random

from tarkaloom.llm import leakage as K
from tarkaloom.llm import lookalike as L

BASE = "The fine office of Émile at naïve Café was cut off; the mirror supports an opaque scope."


def disguise(text, rnd):
    out = []
    for ch in text:
        twins = [c for k, v in L.LOOKALIKES.items() if k == ch for c in v]
        if twins and rnd.random() < 0.3:
            ch = rnd.choice(twins)
        elif "!" <= ch <= "~" and rnd.random() < 0.1:
            ch = chr(ord(ch) + 0xFEE0)
        elif ch == " " and rnd.random() < 0.3:
            ch = rnd.choice("   ")
        out.append(ch + (rnd.choice("​‍⁠﻿­") if rnd.random() < 0.05 else ""))
    t = "".join(out).replace("fi", "ﬁ")
    import unicodedata

    return unicodedata.normalize("NFD", t) if rnd.random() < 0.5 else t


def test_pairs_equal_brute_force(spark):
    rnd = random.Random(5)
    texts = [BASE, BASE, BASE.lower(), BASE.replace("Café", "Cafe"), BASE.replace("cut", "put"), BASE + "\n", "", None, "", "вода", "BOДA", "x" * 50_000]
    texts += [disguise(BASE, rnd) for _ in range(6)] + [disguise("वाणी से परे", rnd), "वाणी से परे"]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, form int, text_key string")
    forms = L.consistent(df)
    got = {(r.doc_id_a, r.doc_id_b) for r in L.alike_pairs(forms).collect()}
    ident = [None if t is None else L.base_form(t).translate(L._FIRST) for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if texts[i] is not None and texts[j] is not None and texts[i] != texts[j] and ident[i] == ident[j]}
    assert got == want and len(want) > 10


def test_tokens_take_the_script_of_their_other_letters():
    lattice = L.Lattice({("^", "t"): 50, ("t", "h"): 50, ("h", "e"): 50, ("e", "$"): 50, ("^", "в"): 5, ("в", "о"): 9, ("о", "д"): 9, ("д", "а"): 9, ("а", "$"): 9})
    assert lattice.text("thе") == "the" and lattice.text("вoдa") == "вода"
    assert lattice.text("") == "" and lattice.text("7 — !") == "7 — !"


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert L.alike_pairs(L.consistent(df)).count() == 0
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert K.leaked(items, df).count() == 0
    docs = spark.createDataFrame([(1, "some words")], "doc_id bigint, text string")
    assert K.leaked(items, docs).count() == 0 and K.leaked(docs.withColumnRenamed("doc_id", "item_id"), df).count() == 0


def brute_leaks(items, docs, n=K.WORDS):
    def runs(t):
        w = L.plain_words(t or "")
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    return {(i, d) for i, a in items for d, b in docs if b is not None and runs(a) & runs(b)}


def test_leaks_equal_brute_force(spark):
    rnd = random.Random(9)
    vocab = ["the", "seer", "ārya", "of", "vow", "mirror", "वाणी", "silence", "un", "do", "rope", "naïve"]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([5, 11, 12, 13, 40])))) for i in range(25)] + [(90, None), (91, ""), (92, "one two")]
    docs = []
    for d in range(60):
        body = rnd.choices(vocab, k=40)
        w = (rnd.choice(items)[1] or "").split()
        k = rnd.choice([10, 11, 12, 20])
        at = rnd.randrange(30)
        body[at:at] = w[:k] if rnd.random() < 0.5 else w[-k:]
        t = rnd.choice([" ", "\n", ", "]).join(body)
        docs.append((d, disguise(t.upper() if rnd.random() < 0.3 else t, rnd) if rnd.random() < 0.5 else t))
    docs += [(500, None), (501, ""), (502, "mirror " * 20_000), docs[0]]
    a = spark.createDataFrame([(*x, "c") for x in items], "item_id bigint, text string, doc_id string")
    b = spark.createDataFrame([(*x, "c") for x in docs], "doc_id bigint, text string, item_id string")
    want = brute_leaks(items, docs)
    assert {(r.item_id, r.doc_id) for r in K.leaked(a, b).collect()} == want and len(want) > 10
    # several blocks of patterns
    assert {(r.item_id, r.doc_id) for r in K.leaked(a, b, letters=4_000).collect()} == want


def test_long_items_are_cut_into_slices(spark, monkeypatch):
    monkeypatch.setattr(K, "SLICE", 7)
    text = " ".join("w" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(60))
    items = spark.createDataFrame([(1, text), (2, text), (None, text)], "item_id bigint, text string")
    runs = [r.run for r in K.item_runs(items).where("item_id = 1").collect()]
    words = text.split()
    assert sorted(runs) == sorted({"".join(words[i : i + 12]) for i in range(49)})
    docs = spark.createDataFrame([(5, " ".join(words[48:])), (6, " ".join(words[49:]))], "doc_id bigint, text string")
    assert {(r.item_id, r.doc_id) for r in K.leaked(items, docs).collect()} == {(1, 5), (2, 5)}


def test_lengths_have_tables_of_their_own():
    short, long = "abcdefghijkl", "mnopqrstuvwx" * 9
    w = K.WuManber([short, long])
    assert w.search(f"so {short}\n{long} it is") == {short, long}
    assert sorted(c.m for c in w.classes) == [len(short), len(long)]
    assert pickle.loads(pickle.dumps(w)).classes is None


def test_broken_words_still_match():
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omicron"
    run = item.replace(" ", "")
    assert K.WuManber([run]).search("x alpha beta gam-\nma delta epsilon zeta eta theta iota kappa lambda omicron y") == {run}
    assert K.WuManber([run]).search(item.replace("alpha", "xalpha")) == set()
