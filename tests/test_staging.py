from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidemark import merge_cdc, stage_batch
from tidemark.operators import staging


def test_stage_and_release(spark):
    df = spark.createDataFrame([(1, "a" * 1000, "U"), (2, None, "D")], "k int, v string, op string")
    batch = stage_batch(df, ["k"])
    described = spark.sql(f"DESCRIBE DATABASE {batch.database}").collect()
    folder = next(r[1] for r in described if r[0] == "Location").removeprefix("file:")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir") + "/")
    assert os.listdir(folder)
    assert sorted(tuple(r)[0] for r in batch.rows.collect()) == [1, 2]
    assert batch.count == 2
    assert 1000 < batch.size_bytes < 2000
    assert 0 < batch.key_bytes < 100
    assert batch.broadcast(batch.size_bytes) == "rows"
    assert batch.broadcast(batch.size_bytes - 1) == "keys"
    assert batch.broadcast(batch.key_bytes - 1) == "nothing"
    batch.release()
    assert not os.path.exists(folder)


def test_empty(spark):
    batch = stage_batch(spark.createDataFrame([], "k int, v string, op string"), ["k"])
    assert (batch.count, batch.size_bytes, batch.key_bytes) == (0, 0, 0)
    assert batch.rows.collect() == []


def test_size_follows_nested_and_binary_values(spark):
    df = spark.range(1).select(
        F.array_repeat(F.lit("abcdefgh"), 1000).alias("l"),
        F.lit(bytearray(5000)).alias("b"),
        F.create_map(F.lit("k"), F.repeat(F.lit("x"), 3000)).alias("m"),
        F.lit(1.5).cast("decimal(30,3)").alias("d"),
    )
    assert stage_batch(df, ["d"]).size_bytes > 8000 + 5000 + 3000


def test_ties_are_settled_by_staging(spark):
    from tidemark import latest_per_pk

    log = spark.range(0, 4000, 1, 8).selectExpr("id % 50 AS k", "id AS v", "0 AS ts", "'U' AS op")
    batch = stage_batch(latest_per_pk(log, ["k"], "ts"), ["k"])
    first = sorted(map(tuple, batch.rows.collect()))
    assert sorted(map(tuple, batch.rows.collect())) == first


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("__", "."): v for k, v in values.items()})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(Session(spark__master="yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(Session(spark__master="local-cluster[3,2,1000]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.shared_dir(Session())  # a session that does not say where it runs
    named = Session(spark__master="yarn", spark__checkpoint__dir="hdfs:///ck/")
    assert staging.shared_dir(named) == "hdfs:///ck"
    local = Session(spark__master="local[8]", spark__app__id="x")
    assert staging.shared_dir(local) == staging.shared_dir(local)


@pytest.fixture
def conf(spark):
    before = {}

    def set_all(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def test_small_batch_leaves_the_target_unshuffled(spark, conf, tmp_path):
    conf(autoBroadcastJoinThreshold="-1")
    spark.range(10000).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = stage_batch(spark.createDataFrame([(1, 0, "U")], "k long, v long, op string"), ["k"])
    merged = merge_cdc(target, batch.rows, ["k"], staged_unique=True, broadcast="rows")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    # The one exchange by key carries the keys the batch and the target share.
    assert plan.count("Exchange hashpartitioning") == 1
    assert "LeftSemi" in plan.split("Exchange hashpartitioning")[1]
    # The second scan of the target reads its key only.
    assert "ReadSchema: struct<k:bigint>" in plan


def test_wide_batch_moves_only_the_rows_it_changes(spark, conf, tmp_path):
    conf(autoBroadcastJoinThreshold="-1")
    spark.range(10000).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = stage_batch(spark.createDataFrame([(1, 0, "U")], "k long, v long, op string"), ["k"])
    merged = merge_cdc(target, batch.rows, ["k"], staged_unique=True, broadcast="keys")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    untouched, joined = plan.split("SortMergeJoin")
    assert "Exchange hashpartitioning" not in untouched and "LeftAnti" in untouched
    moved = joined.split("Exchange hashpartitioning")[1]
    assert "BroadcastHashJoin" in moved and "LeftSemi" in moved
