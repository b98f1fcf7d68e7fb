import random

import pytest
from pyspark.sql import functions as F

from tarkaloom.operators import ordered as O


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_state_is_carried_over_blocks(spark, block):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), i, rnd.choice([None, None, rnd.randrange(9)]), rnd.choice([None, 1, 1, 2])) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, pos int, v int, chapter int")
    fill = {r.pos: r.f for r in O.forward_fill(df, ["g"], ["pos"], "v", "f", block).collect()}
    num = {r.pos: r.n for r in O.number_rows(df, ["g"], ["pos"], "n", block).collect()}
    cnt = {r.pos: r.c for r in O.counter(df, ["g"], ["pos"], "v", "c", block).collect()}
    sec = {r.pos: r.s for r in O.section_with_reset(df, ["g"], ["pos"], "chapter", F.col("v"), "s", block).collect()}
    last, n, c, s, ch = {}, {}, {}, {}, {}
    for g, pos, v, chapter in rows:
        last[g] = v if v is not None else last.get(g)
        n[g] = n.get(g, 0) + 1
        c[g] = v if v is not None else c.get(g, 0) + 1
        fresh = chapter is not None and (g not in ch or ch[g] != chapter)
        ch[g] = chapter
        s[g] = v if v is not None else 1 if fresh else s.get(g)
        assert (fill[pos], num[pos], cnt[pos], sec[pos]) == (last[g], n[g], c[g], s[g])


def test_empty(spark):
    df = spark.createDataFrame([], "g string, pos int, v int")
    assert O.counter(df, ["g"], ["pos"], "v", "c").count() == 0


def test_a_hot_group_is_really_split(spark):
    n = 2 * O.BLOCK + 100
    df = spark.range(1, n + 1).select(F.lit("hot").alias("g"), F.col("id").alias("pos"), F.when(F.col("id") == 5, 7).alias("v"))
    assert n <= 160_000 and O._blocked(df, ["pos"], O.BLOCK).select("_b").distinct().count() == 3
    d = O.forward_fill(O.number_rows(df, ["g"], ["pos"], "n"), ["g"], ["pos"], "v", "f")
    assert d.where("n <> pos or (pos >= 5 and not f <=> 7) or (pos < 5 and f is not null)").count() == 0
