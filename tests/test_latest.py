from __future__ import annotations

import pytest

from tidemark import latest_per_pk

LOG = "k int, ts int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_newest_wins(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 5, "only")], LOG)
    assert rows(latest_per_pk(df, ["k"], "ts")) == [(1, 2, "new"), (2, 5, "only")]


def test_null_timestamp_ranks_last_but_is_kept(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 0, "b"), (2, None, "c")], LOG)
    assert rows(latest_per_pk(df, ["k"], "ts")) == [(1, 0, "b"), (2, None, "c")]


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b")], LOG)
    assert rows(latest_per_pk(df, ["k"], "ts")) == [(None, 2, "b")]


@pytest.mark.parametrize("ts", [None, "", "other", "TS"])
def test_no_timestamp_changes_nothing(spark, ts):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], LOG)
    assert latest_per_pk(df, ["k"], ts) is df


def test_tie_columns(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "c"), (1, 1, "b")], LOG)
    assert rows(latest_per_pk(df, ["k"], "ts", ["v"])) == [(1, 1, "c")]


def test_one_row_on_a_tie(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], LOG)
    assert latest_per_pk(df, ["k"], "ts").count() == 1


def test_key_is_required(spark):
    df = spark.createDataFrame([(1, 1, "a")], LOG)
    with pytest.raises(ValueError):
        latest_per_pk(df, [], "ts")
    with pytest.raises(ValueError, match="nope"):
        latest_per_pk(df, ["nope"], "ts")


def test_empty(spark):
    df = spark.createDataFrame([], LOG)
    assert latest_per_pk(df, ["k"], "ts").count() == 0


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS ts")
    latest = latest_per_pk(df, ["k"], "ts")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "row_number(), 1, Partial" in before_shuffle
    assert latest.filter("k = -1").collect()[0]["ts"] == 29997


def test_names_resolve_as_in_sql(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], LOG)
    assert rows(latest_per_pk(df, ["K"], "ts", ["V"])) == [(1, 2, "b")]
