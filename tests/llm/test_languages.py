import random

import pytest

from tarkaloom.llm import languages as G

RECORD = "rec_no bigint, lang string, segments int, commentaries array<struct<commentator string, school string, lang string, type string, text string>>"
LINES = {
    "en": "the seeker asks whether the mirror of the mind is known before the vow of silence and it is not",
    "de": "der Suchende fragt ob die Seele nicht mit dem Spiegel des Geistes und der Welt verbunden ist",
    "fr": "le disciple dit que la connaissance ne dépasse pas le miroir de la parole et des choses",
    "hi": "यह कहा गया है कि जीव का मन और गुरु का वचन अलग नहीं है तथा वह मुक्ति की ओर जाता है",
    "sa": "यदि परमं तत्त्वम् अनुमीयते तर्हि तस्य कथं सिद्धिः इति बोद्धव्यम् न युक्तम् एव",
    "pi": "atha kho bhikkhave so puggalo na vindati evameva tasmiṃ samaye dhammo nirujjhati ti vuccati",
}


@pytest.fixture(scope="module")
def labelled(spark):
    rnd = random.Random(4)
    rows = [(f"{lang}{i}", lang, " ".join(rnd.sample(t.split(), 10)) + ".") for lang, t in LINES.items() for i in range(30)]
    return spark.createDataFrame([(i, lang, t) for i, (_, lang, t) in enumerate(rows)], "doc_id bigint, lang string, text string")


def com(lang, text):
    return {"commentator": None, "school": None, "lang": lang, "type": None, "text": text}


def found(spark, labelled, *coms):
    recs = spark.createDataFrame([(1, "x", 1, list(coms)), (2, "x", 1, None), (3, "x", 1, [])], RECORD)
    return sorted((r.com_pos, r.lang_code) for r in G.doubtful(G.commentary_languages(recs, labelled)).collect())


EN, DE, HI = "It is not known before the vow of silence.", "Der Suchende fragt nicht mit dem Spiegel des Geistes.", "yah kaha gaya hai ki jeev ka man alag nahin hai"


def test_cases(spark, labelled):
    got = found(spark, labelled, com("en", EN), com(" EN-gb ", EN), com("English", EN), com("de", EN), com(None, DE), com("??", DE), com("mul", EN), com("en", f"{EN} {DE}"), com("en", f"{EN} “{DE}” {EN}"), com("hi", HI), com("en", None), com("en", " \n"), com("en", "It is known before the Seele vow of silence."))
    assert got == [(3, "en"), (4, "de"), (5, "de"), (6, "en"), (7, "de"), (7, "en"), (8, "de"), (8, "en")]


def test_every_language_is_held_out_right(labelled):
    scores = G.fit_scores(labelled)
    rnd = random.Random(8)
    for lang, t in LINES.items():
        for _ in range(5):
            seg = scores.segments(" ".join(rnd.sample(t.split(), 7)))
            assert [s["lang"] for s in seg] == [lang] and seg[0]["confidence"] > 0.9


def test_segments_cover_the_text(labelled):
    text = f"{EN} {DE}\n{HI}"
    seg = G.fit_scores(labelled).segments(text)
    assert [s["lang"] for s in seg] == ["en", "de", "hi"]
    assert seg[0]["start"] == 0 and seg[-1]["end"] == len(text)


def test_labels():
    assert [G.label_code(x) for x in ("en", "ENG", "de-AT", "sa-Latn", "Pāli", "", None, "und", "mul", "-")] == ["en", "en", "de", "sa", "pi", None, None, None, None, None]


def test_empty_and_long(spark, labelled):
    scores = G.fit_scores(labelled)
    assert scores.segments("") == [] and scores.segments("1 2 3 !") == []
    assert [s["lang"] for s in scores.segments((EN + " ") * 2000)] == ["en"]
    assert found(spark, labelled.limit(0)) == []


def test_places_are_those_of_the_given_text(labelled):
    """Decomposed accents count as they stand."""
    text = "E\u0301t non. " + LINES["fr"] + ". " + DE
    seg = G.fit_scores(labelled).segments(text)
    assert [s["lang"] for s in seg] == ["fr", "de"] and text[seg[1]["start"] : seg[1]["end"]].strip() == DE and seg[-1]["end"] == len(text)


def test_main_language_and_confidence(spark, labelled):
    recs = spark.createDataFrame([(1, "x", 1, [com("en", f"{EN} {DE} {DE}"), com(None, EN), com("en", "1 2"), com("en", None)])], RECORD)
    got = {r.com_pos: (r.lang, r.confidence) for r in G.commentary_languages(recs, labelled).collect()}
    assert sorted(got) == [0, 1, 2] and got[0][0] == "de" and 0.5 < got[0][1] < 0.8 and got[1][0] == "en" and got[1][1] > 0.9 and got[2] == (None, None)
