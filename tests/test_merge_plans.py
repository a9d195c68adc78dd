"""What the merge moves: plans, ranges pushed into scans, hot keys, buckets."""

from __future__ import annotations

import datetime
import decimal

import pytest
from pyspark.sql import functions as F

from tidemark import merge_cdc, stage_batch
from tidemark.operators.hot_keys import PARTS, hot_keys
from tidemark.operators.merge import merge_effects, merge_parts


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


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_scanned(df):
    """Rows that leave the scans of ``df``, which is run."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()

    def leaves(plan):
        children = plan.children()
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            return leaves(plan.executedPlan())
        if "QueryStage" in plan.getClass().getSimpleName():
            return leaves(plan.plan())
        own = [plan] if plan.nodeName().startswith("Scan parquet") else []
        return sum((leaves(children.apply(i)) for i in range(children.size())), own)

    return [n.metrics().apply("numOutputRows").value() for n in leaves(execution.executedPlan())]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- the range of the batch's keys


@pytest.mark.parametrize("broadcast", ["rows", "keys", "nothing"])
def test_the_range_of_the_keys_reaches_the_scan(spark, conf, tmp_path, broadcast):
    """Changes of recent keys: of the target's key column only their row groups are read."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "t")
    spark.range(0, 80_000, 1, 8).selectExpr("id AS k", "id AS v").write.parquet(path)
    spark.range(500).selectExpr("CAST(NULL AS BIGINT) AS k", "-id AS v").write.mode("append").parquet(path)
    target = spark.read.parquet(path)
    changes = spark.range(75_000, 80_100).selectExpr(
        "if(id % 100 = 0, NULL, id) AS k", "-1L AS v", "CASE id % 3 WHEN 0 THEN 'U' WHEN 1 THEN 'D' ELSE 'I' END AS op"
    )
    batch = stage_batch(changes, ["k"])
    assert [(k, low, high) for k, _, low, high in batch.key_range] == [("k", 75_001, 80_099)]

    def merged(key_range):
        return merge_cdc(
            target, batch.rows, ["k"], staged_unique=True, broadcast=broadcast, key_range=key_range
        )

    limited, whole = merged(batch.key_range), merged(())
    assert collected(limited) == collected(whole)
    assert "GreaterThanOrEqual(k,75001)" in plan_of(limited).replace(" ", "")
    if broadcast != "nothing":  # there the other rows are read to be passed on
        assert sum(rows_scanned(limited)) < sum(rows_scanned(whole)) - 60_000
    effects = {
        r["effect"]: r["n"]
        for r in merge_effects(
            target, batch.rows, ["k"], staged_unique=True, broadcast=broadcast, key_range=batch.key_range
        ).collect()
    }
    assert effects == {
        r["effect"]: r["n"]
        for r in merge_effects(target, batch.rows, ["k"], staged_unique=True, broadcast=broadcast).collect()
    }


def test_rows_out_of_range_are_not_moved(spark, conf, tmp_path):
    conf(autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "t")
    spark.range(0, 80_000, 1, 8).selectExpr("if(id < 100, NULL, id) AS k", "id AS v").write.parquet(path)
    target = spark.read.parquet(path)
    batch = stage_batch(spark.range(70_000, 70_050).selectExpr("id AS k", "0L AS v", "'U' AS op"), ["k"])
    in_place, moved = merge_parts(target, batch.rows, ["k"], staged_unique=True, key_range=batch.key_range)
    assert "Exchange" not in plan_of(in_place)
    assert in_place.count() == 79_950 and moved.count() == 50
    # Row groups without such keys are left out of what is shuffled.
    assert sorted(rows_scanned(moved))[-1] <= 10_000


TYPED = {
    "tinyint": [1, 2, 100],
    "int": [-5, 0, 7],
    "bigint": [-(2**60), 3, 2**60],
    "decimal(20,4)": [decimal.Decimal("-1.5"), decimal.Decimal("0"), decimal.Decimal("99999.0001")],
    "date": [datetime.date(1600, 1, 1), datetime.date(2024, 2, 29), datetime.date(9999, 12, 31)],
    "timestamp": [datetime.datetime(1950, 1, 1), datetime.datetime(2024, 3, 31, 2, 30), datetime.datetime(2100, 1, 1)],
    "string": ["", "Z", "é\U0001f600"],
    "double": [float("-inf"), -0.0, float("nan")],
    "boolean": [False, True],
    "binary": [b"", b"a"],
}


@pytest.mark.parametrize("kind", TYPED)
def test_ranges_of_all_types(spark, conf, tmp_path, kind):
    conf(session__timeZone="Europe/Berlin")
    values = TYPED[kind]
    target = spark.createDataFrame([(v, 1) for v in [None, *values]], f"k {kind}, v int")
    target.write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    for held in (values[:1], values[-1:], []):
        batch = stage_batch(
            spark.createDataFrame([(v, 2, "U") for v in [*held, None]], f"k {kind}, v int, op string"), ["k"]
        )
        got = [
            collected(
                merge_cdc(target, batch.rows, ["k"], staged_unique=True, broadcast=b, key_range=r)
            )
            for b in ("rows", "nothing")
            for r in (batch.key_range, ())
        ]
        assert all(str(g) == str(got[0]) for g in got)
        assert sum(v == 2 for _, v in got[0]) == len(held) + 1


def test_other_types_have_no_range(spark):
    """An int key and a long one: the range is not used, the rows are the same."""
    target = spark.createDataFrame([(0, 1), (5, 1)], "k long, v int")
    batch = stage_batch(spark.createDataFrame([(0, 2, "U")], "k int, v int, op string"), ["k"])
    got = merge_cdc(target, batch.rows, ["k"], staged_unique=True, key_range=batch.key_range)
    assert collected(got) == [(0, 2), (5, 1)]
    assert "GreaterThan" not in plan_of(got)


# ---- hot keys


def test_no_key_is_hot_in_even_tables(spark):
    assert hot_keys(spark.range(1000).selectExpr("id AS k"), ["k"], 10, 1) is None
    assert hot_keys(spark.range(0).selectExpr("id AS k"), ["k"], 10, 1) is None
    nulls = spark.range(1000).selectExpr("CAST(NULL AS INT) AS k", "1 AS l")
    assert hot_keys(nulls, ["k", "l"], 10, 1) is None


def test_hot_keys_are_found(spark):
    table = spark.range(9000).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN CAST(id AS STRING) END AS a", "if(id % 2 = 0, 1, 2) AS b"
    )
    found = hot_keys(table, ["a", "b"], 10, 1)
    # 1,500 rows each of (hot, 1) and (hot, 2); an even share of 6,000 is 600.
    assert sorted(map(tuple, found.keys.collect())) == [("hot", 1, 3), ("hot", 2, 3)]
    assert found.keys.columns == ["a", "b", PARTS]
    found.release()
    assert hot_keys(table, ["a", "b"], 10) is None  # too few rows to matter


def test_a_hot_key_is_joined_in_parts(spark, conf, tmp_path):
    """A third of the target has no key, a third has one: one join, and even tasks."""
    conf(
        shuffle__partitions="16",
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__coalescePartitions__enabled="false",
    )
    path = str(tmp_path / "t")
    spark.range(0, 300000, 1, 8).selectExpr(
        "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN -1 ELSE id END AS k", "id AS v"
    ).write.parquet(path)
    target = spark.read.parquet(path)
    batch = stage_batch(
        spark.range(0, 300000, 1, 8).selectExpr("if(id = 0, -1, id) AS k", "-id AS v", "'U' AS op"),
        ["k"],
    )
    hot = hot_keys(target, ["k"], 16, 1)
    assert [r["k"] for r in hot.keys.collect()] == [-1]
    in_place, moved = merge_parts(target, batch.rows, ["k"], staged_unique=True, hot=hot.keys)
    plan = plan_of(moved)
    # One pass over the rows that can match, one join by key, one shuffle a side.
    assert plan.count(str(tmp_path / "t")) == 1
    assert plan.count("FullOuter") == 1 and plan.count("Exchange hashpartitioning") == 2
    result = in_place.unionByName(moved).groupBy((F.col("k") == -1).alias("hot")).agg(
        F.count("*").alias("n"), F.max("v").alias("v")
    )
    counts = {r["hot"]: (r["n"], r["v"]) for r in result.collect()}
    # 100k NULL keys, 100k hot rows all updated, 299,999 other keys.
    assert counts == {None: (100000, 299997), True: (100000, 0), False: (299999, -1)}
    sizes = sorted(
        r["n"] for r in moved.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    )
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
    hot.release()


@pytest.mark.parametrize("op", ["I", "U", "D", "X", None])
def test_changes_of_hot_keys(spark, op):
    """Whatever happens to a hot key happens once to each of its rows, and nothing is inserted."""
    target = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0), (None, 1)], "k int, v int")
    batch = spark.createDataFrame([(1, -1, op), (3, -3, op)], "k int, v int, op string")
    hot = hot_keys(target, ["k"], 8, 1)
    got = merge_cdc(target, batch, ["k"], staged_unique=True, hot=hot.keys)
    assert collected(got) == collected(merge_cdc(target, batch, ["k"], staged_unique=True, broadcast="rows"))
    hot.release()
