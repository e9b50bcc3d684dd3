import os

import pytest
from pyspark.sql import functions as F

from veldspar import runtime


def test_first_rows(spark, monkeypatch):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None), (None, 0, "z"), ("c", 5, "q"), ("c", 5, "p"), ("c", 5, "p")], "k string, o int, v string").withColumn("r", F.lit(1))
    want = [("a", "y"), ("b", None), ("c", "p")]
    assert sorted(tuple(r) for r in runtime.first_rows(df, "k", "o", "v").collect()) == want
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", 1)
    assert sorted(tuple(r) for r in runtime.first_rows(df, "k", "o", "v").collect()) == want
    assert runtime.first_rows(df.limit(0), "k", "o", "v").count() == 0


def test_scratch_follows_the_session(spark):
    t = runtime.materialize(spark.range(5).toDF("a"), "x")
    assert t.count() == 5 and t.inputFiles()[0].startswith("file:")
    assert runtime.bounded_broadcast(t, 3) is t


def test_broadcasts_are_bounded_in_rows_and_bytes(spark):
    wide = spark.createDataFrame([("x" * 1000, ["y" * 500] * 10)], "a string, b array<string>")
    assert runtime.is_small(wide) and not runtime.is_small(wide, 10, 5000) and not runtime.is_small(spark.range(5), 4)
    assert runtime.is_small(wide.limit(0), 0, 0)


def test_scratch_is_deleted_on_request(spark):
    t = runtime.materialize(spark.range(5).toDF("a"), "x")
    path = t.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and runtime.release(spark) >= 1 and not os.path.exists(path)


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        runtime.scratch_root(Session())
