import sys
import types

import pytest

from tarkaloom.operators.hot import hot_keys, salted_join
from tarkaloom.plans import session


class Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class Unset:
    def get(self, name, default=None):
        return default


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(types.SimpleNamespace(sparkContext=Context(master), conf=Unset()))


def test_staged_tables_can_be_dropped(spark):
    import os

    df = session.stage(spark.range(10), "numbers")
    assert df.count() == 10
    session.drop_staged(spark)
    at = session.shared_dir(spark).removeprefix("file:")
    assert not os.path.exists(f"{at}/staged")


def test_a_missing_module_is_not_taken_for_a_missing_subpackage(monkeypatch):
    pytest.importorskip("tarkaloom.llm")

    class Broken:
        def find_spec(self, name, path=None, target=None):
            if name == "tarkaloom.llm.catalog":
                raise ModuleNotFoundError("No module named 'xxhash'", name="xxhash")

    monkeypatch.setattr(sys, "meta_path", [Broken(), *sys.meta_path])
    for name in [m for m in sys.modules if m == "__spark_entry__" or m.startswith("tarkaloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    import tarkaloom

    monkeypatch.delattr(tarkaloom, "llm", raising=False)
    with pytest.raises(ModuleNotFoundError, match="xxhash"):
        import __spark_entry__  # noqa: F401


def test_salted_join_equals_a_join(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 7}") for i in range(300)] + [(1000, None), (1001, "alone")], "id bigint, k string")
    side = spark.createDataFrame([("hot", 1), ("hot", 2), ("k0", 3), ("k1", 4), (None, 5)], "k string, x int")
    for how in ("inner", "left"):
        got = salted_join(rows, side, "k", "id", how, most=20)
        want = rows.join(side, "k", how)
        assert sorted(got.select("id", "k", "x").collect(), key=str) == sorted(want.select("id", "k", "x").collect(), key=str)
    assert {r.k: r.parts for r in hot_keys(rows, "k", 20).collect()} == {"hot": 10}


def test_a_side_is_broadcast_by_its_unpacked_size(spark):
    size = lambda df: int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    small = session.stage(spark.range(1000).selectExpr("id", "'x' as v"), "small")
    counted = size(small)
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "1.0")
    plain = size(spark.read.parquet(small.inputFiles()[0].rsplit("/", 1)[0]))
    session.count_unpacked(spark)
    assert counted > 4 * plain
