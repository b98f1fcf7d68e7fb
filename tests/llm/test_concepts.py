from tarkaloom.llm import concept_match as C

REF = [(1, "dhīnyṛla", "returning compass"), (2, "ṣidhekīla", "tender pasture"), (3, "roṭūka", "fading ledger"), (4, "khācajala", "hollow echo"), (5, "tranyāmibhidha", "hidden compass")]
CASES = {
    "Dhīnyṛla": 1, "dhinyrla": 1, " dhīnyṛla": 1, "dhīynṛla": 1, "the dhinyrla": 1, "dhi-nyrla": 1, "dhiny rla": 1, "dhīnyṛla (returning compass)": 1, "returning compasss": 1, "Returning-Compass": 1,
    "shidhekeela": 2, "ṣidhekīla / concept": 2, '"ṣidhekīla"': 2, "षिधेकील": 2, "rotuka": 3, "rootka": -1, "hollow echos": 4, "khaacajala, hollow echo": 4, "hidden compass": 5,
    "hidden ledger": -1, "returning compass of rain": -1, "none stated": -1, "n/a": -1, "???": -1, "vabhāna": -1, "x" * 5000: -1,
}


def match(spark, values, ref=REF):
    edges = spark.createDataFrame([(f"e{i}", v, None, "clash", 1) for i, v in enumerate(values)], "edge_id string, concept_a string, concept_b string, value string, token int")
    refs = spark.createDataFrame(ref, "concept_id bigint, name string, gloss string")
    return C.match_edges(edges, refs).collect()


def test_each_spelling_finds_its_entry(spark):
    got = {r.value: r.concept_id for r in match(spark, list(CASES))}
    assert {v: got[v] for v in CASES if got[v] != CASES[v]} == {}


def test_names_as_they_stand_and_blanks_are_left_out(spark):
    assert match(spark, ["dhīnyṛla", None, "", "  "]) == []
    assert len(match(spark, ["Rotuka"] * 3)) == 3


def test_empty_tables(spark):
    assert match(spark, []) == []
    assert [r.concept_id for r in match(spark, ["dhinyrla"], [])] == [-1]
    assert [r.concept_id for r in match(spark, ["dhinyrla"], [(1, "dhīnyṛla", None), (7, None, "x")])] == [1]


def test_repair_equals_brute_force(spark):
    vocab = ["compass", "compare", "echo", "pasture", "rut", "dhinyrla"]
    tokens = ["compas", "compazz", "ecoh", "eco", "ruts", "rt", "dhinrlya", "patsure", "pastrue", "compzxs", "xxxx"]

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j - 1] + (x != y), old[j] + 1, row[j - 1] + 1))
        return row[-1]

    want = set()
    for t in tokens:
        near = {}
        for v in vocab:
            d = lev(t, v)
            d = 1 if d == 2 and sorted(t) == sorted(v) else d
            most = 0 if max(len(t), len(v)) <= 3 else 1 if min(len(t), len(v)) < 6 else 2
            if d <= most:
                near[v] = d
        want |= {(t, v, d == min(near.values())) for v, d in near.items()}
    a = spark.createDataFrame([(t,) for t in tokens], "token string")
    b = spark.createDataFrame([(t,) for t in vocab], "token string")
    assert {(r.token, r.ref_token, r.nearest) for r in C.repair(a, b).collect()} == want


def test_words_farther_than_the_nearest_count(spark):
    """'sheadow' is one edit from 'shadow' and two from 'meadow', which the rest of the value asks for."""
    ref = spark.createDataFrame([(1, "quiet meadow", None), (2, "long shadow", None)], "concept_id bigint, name string, gloss string")
    values = spark.createDataFrame([("quiet sheadow",), ("long sheadow",), ("sheadow quite other",)], "value string")
    got = {r.value: r.concept_id for r in C.match_values(values, ref).collect()}
    assert got == {"quiet sheadow": 1, "long sheadow": 2, "sheadow quite other": -1}
