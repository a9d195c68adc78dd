"""The effect of each operation, key case and defect decision."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import OpCodes, merge_cdc, merge_effects
from tidemark.sinks.tables import table_schema

TARGET = "k int, v string"
BATCH = "k int, v string, op string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


@pytest.fixture
def merge(spark):
    def run(target, batch, **options):
        return rows(
            merge_cdc(
                spark.createDataFrame(target, TARGET),
                spark.createDataFrame(batch, BATCH),
                ["k"],
                **options,
            )
        )

    return run


BOTH = pytest.mark.parametrize("unique", [True, False])
JOINS = pytest.mark.parametrize("broadcast", ["rows", "keys", "nothing"])


# (target rows, batch rows, merged rows) of (k, v[, op])
CASES = [
    ([(1, "a")], [(1, "x", "I")], [(1, "a")]),
    ([(1, "a")], [(1, "x", "U")], [(1, "x")]),
    ([(1, "a")], [(1, "x", "D")], []),
    ([], [(1, "x", "I")], [(1, "x")]),
    ([], [(1, "x", "U")], [(1, "x")]),
    ([], [(1, "x", "D")], []),
    ([(1, "a")], [(1, "x", None), (2, "y", None)], [(1, "a")]),
    ([(1, "a")], [(1, "x", "u"), (2, "y", "i")], [(1, "a")]),
    ([(1, "a")], [(1, "x", "Z"), (2, "y", "Z")], [(1, "a")]),
    ([(None, "a")], [(None, "x", "U")], [(None, "a"), (None, "x")]),
    ([(None, "a")], [(None, "x", "D")], [(None, "a")]),
    ([(1, "a")], [(1, None, "U")], [(1, None)]),
    ([(1, "a"), (1, "b")], [(1, "x", "U")], [(1, "x"), (1, "x")]),
    ([(1, "a"), (1, "b")], [(1, "x", "D")], []),
    ([(1, "a")], [], [(1, "a")]),
    ([(1, "a"), (2, "b")], [(2, "c", "U")], [(1, "a"), (2, "c")]),
    # Repeated NULL keys match nothing, so they are no repeats.
    ([(None, "a")], [(None, "x", "I"), (None, "y", "U")], [(None, "a"), (None, "x"), (None, "y")]),
]
# Repeated keys that match nothing; only for a batch that may repeat keys.
REPEATS = [
    ([(9, "z")], [(1, "x", "I"), (1, "y", "U")], [(1, "x"), (1, "y"), (9, "z")]),
    ([(9, "z")], [(1, "x", "D"), (1, "y", "Z")], [(9, "z")]),
]


@BOTH
@JOINS
def test_effects_of_each_case(spark, unique, broadcast):
    """All cases in one merge, told apart by a further key column."""
    cases = CASES if unique else CASES + REPEATS
    target = [(n, *r) for n, (rows, _, _) in enumerate(cases) for r in rows]
    batch = [(n, *r) for n, (_, rows, _) in enumerate(cases) for r in rows]
    merged = merge_cdc(
        spark.createDataFrame(target, "n int, " + TARGET),
        spark.createDataFrame(batch, "n int, " + BATCH),
        ["n", "k"],
        staged_unique=unique,
        broadcast=broadcast,
    )
    got = rows(merged)
    for n, (_, _, expected) in enumerate(cases):
        assert [r[1:] for r in got if r[0] == n] == expected, f"case {n}"


@JOINS
def test_empty_batch_and_empty_target(merge, broadcast):
    assert merge([(1, "a")], [], broadcast=broadcast) == [(1, "a")]
    assert merge([], [(1, "x", "U")], broadcast=broadcast) == [(1, "x")]


@JOINS
@pytest.mark.parametrize("second", ["U", "I", "Z"])
def test_matched_duplicate_raises(merge, second, broadcast):
    with pytest.raises(PySparkException, match="several batch rows"):
        merge([(1, "a")], [(1, "x", "U"), (1, "y", second)], broadcast=broadcast)


def test_other_codes(merge):
    ops = OpCodes(insert="c", update="u", delete="it's")
    batch = [(1, "x", "it's"), (2, "y", "c"), (3, "z", "u")]
    assert merge([(1, "a"), (3, "b")], batch, ops=ops) == [(2, "y"), (3, "z")]


def test_all_columns_are_keys(spark):
    target = spark.createDataFrame([(1,)], "k int")
    batch = spark.createDataFrame([(1, "U"), (2, "I")], "k int, op string")
    assert rows(merge_cdc(target, batch, ["k"])) == [(1,), (2,)]


def test_target_only_columns(spark):
    target = spark.createDataFrame([(1, "a", 5)], "k int, v string, kept int")
    batch = spark.createDataFrame([(1, "x", "U"), (2, "y", "I")], BATCH)
    assert rows(merge_cdc(target, batch, ["k"])) == [(1, "x", 5), (2, "y", None)]


def test_batch_only_columns_raise(spark):
    target = spark.createDataFrame([(1, "a")], TARGET)
    batch = spark.createDataFrame([(1, "x", 1, "U")], "k int, v string, extra int, op string")
    with pytest.raises(ValueError, match="extra"):
        merge_cdc(target, batch, ["k"])


def test_no_key_raises(spark):
    target = spark.createDataFrame([(1, "a")], TARGET)
    batch = spark.createDataFrame([(1, "x", "U")], BATCH)
    with pytest.raises(ValueError, match="no key"):
        merge_cdc(target, batch, [])
    with pytest.raises(ValueError, match="'nope'"):
        merge_cdc(target, batch, ["nope"])


def test_op_column_is_checked(spark):
    target = spark.createDataFrame([(1, "a")], TARGET)
    numeric = spark.createDataFrame([(1, "x", 3)], "k int, v string, op int")
    with pytest.raises(ValueError, match="not text"):
        merge_cdc(target, numeric, ["k"])
    with pytest.raises(ValueError, match="missing"):
        merge_cdc(target, numeric.drop("op"), ["k"])


def test_types_and_order_are_the_targets(spark):
    target = spark.createDataFrame([(1, 1.5, "a")], "k bigint, n double, v string")
    batch = spark.createDataFrame(
        [("x", 2, 1, "U"), ("y", 3, 7, "I")], "v string, n int, k int, op string"
    )
    merged = merge_cdc(target, batch, ["k"])
    assert table_schema(merged.schema) == table_schema(target.schema)
    assert rows(merged) == [(1, 2.0, "x"), (7, 3.0, "y")]


def test_names_resolve_as_in_sql(spark):
    target = spark.createDataFrame([(1, "a")], "K int, V string")
    batch = spark.createDataFrame([(1, "x", "U"), (2, "y", "I")], BATCH)
    merged = merge_cdc(target, batch, ["k"])
    assert merged.columns == ["K", "V"]
    assert rows(merged) == [(1, "x"), (2, "y")]


def test_awkward_names(spark):
    target = spark.createDataFrame([(1, 2, "a")], "`k.1` int, `k``2` int, `a b` string")
    batch = spark.createDataFrame(
        [(1, 2, "x", "U"), (1, 3, "y", "I")],
        "`k.1` int, `k``2` int, `a b` string, `the.op` string",
    )
    merged = merge_cdc(target, batch, ["k.1", "k`2"], op_col="the.op")
    assert rows(merged) == [(1, 2, "x"), (1, 3, "y")]


def test_composite_key_with_a_null_part(spark):
    schema = "a int, b int, v string"
    target = spark.createDataFrame([(1, None, "t"), (1, 2, "t")], schema)
    batch = spark.createDataFrame(
        [(1, None, "x", "U"), (1, 2, "y", "U"), (None, 2, "z", "D")], schema + ", op string"
    )
    merged = merge_cdc(target, batch, ["a", "b"])
    assert rows(merged) == [(1, None, "t"), (1, None, "x"), (1, 2, "y")]


def test_nested_and_binary_values(spark):
    schema = "k int, s struct<`a-b`: int>, m map<string,int>, l array<int>, b binary"
    target = spark.createDataFrame([(1, (1,), {"x": 1}, [1], b"1")], schema)
    batch = spark.createDataFrame(
        [(1, (2,), {"y": 2}, [2, 3], b"2", "U")], schema + ", op string"
    )
    merged = merge_cdc(target, batch, ["k"], staged_unique=True)
    assert [tuple(r) for r in merged.collect()] == [(1, (2,), {"y": 2}, [2, 3], b"2")]


def test_batch_derived_from_the_target(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], TARGET)
    batch = target.withColumn("op", F.when(F.col("k") == 1, "D").otherwise("U")).withColumn(
        "v", F.upper("v")
    )
    assert rows(merge_cdc(target, batch, ["k"])) == [(2, "B")]


@JOINS
def test_effects(spark, broadcast):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], TARGET)
    batch = spark.createDataFrame(
        [
            (1, "x", "D"), (2, "x", "U"), (3, "x", "I"), (4, "x", "I"),
            (5, "x", "U"), (6, "x", "D"), (None, "x", "U"), (7, "x", None),
        ],
        BATCH,
    )
    counted = merge_effects(target, batch, ["k"], broadcast=broadcast)
    assert rows(counted) == [("delete", 1), ("ignored", 3), ("insert", 3), ("update", 1)]
