import random

from tarkaloom.operators.orphans import child_keys, orphan_report, orphans, parent_keys

PARENT = "id string, _original_id string, loaded_at timestamp_ntz, withdrawn_at timestamp_ntz, salt int, ref_key string"
CHILD = "k string, ref string, at timestamp_ntz, salt int, loaded timestamp_ntz"


def brute(parents, children):
    out = []
    for k, ref, at, *_ in children:
        key = (ref or "").strip().lower()
        if not key:
            continue
        hits = [(ld, wd) for i, o, ld, wd, *_ in parents for x in {(i or "").strip().lower(), (o or "").strip().lower()} if x == key]
        period = at.strftime("%Y-%m") if at else None
        if not hits:
            out.append(("t", k, "missing", period))
        elif at:
            early = [h for h in hits if h[0] <= at]
            if not early:
                out.append(("t", k, "late", period))
            elif all(w is not None and w <= at for _, w in early):
                out.append(("t", k, "withdrawn", period))
    return sorted(out, key=str)


def run(spark, parents, children, **kw):
    p = parent_keys(spark.createDataFrame(parents, PARENT), ["id", "_original_id"])
    c = child_keys(spark.createDataFrame(children, CHILD), "t", "k", "ref", "at")
    return orphans(p, c, **kw)


def test_orphans_equal_brute_force(spark, day):
    rnd = random.Random(7)
    ids = [f"a_{i}" for i in range(12)]
    parents = [(rnd.choice(ids), rnd.choice([None, "", " A_3 ", "b_1"]), day(ld := rnd.randrange(300)), rnd.choice([None, day(ld + rnd.randrange(90)), day(ld)]), 1, "x") for _ in range(60)]
    children = [(f"c{i}", rnd.choice(["a_1", "A_1 ", " a_3", "nowhere", "", None, "b_1", *ids]), rnd.choice([None, *[day(rnd.randrange(420)) for _ in range(6)]]), 1, None) for i in range(300)]
    children += [(f"hot{i}", "a_2", day(i % 400), 1, None) for i in range(200)] + [children[0]] * 2
    got = sorted((tuple(r) for r in run(spark, parents, children).collect()), key=str)
    assert got == brute(parents, children)
    assert {r[2] for r in got} == {"missing", "late", "withdrawn"}


def test_empty_tables(spark, day):
    assert run(spark, [], []).count() == 0
    assert run(spark, [("a", None, day(1), None, 1, "x")], []).count() == 0
    lone = run(spark, [], [("c", "a", day(40), 1, None)])
    assert [tuple(r) for r in lone.collect()] == [("t", "c", "missing", "2024-02")]
    assert orphan_report(lone).first().n_orphans == 1
