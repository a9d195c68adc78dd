from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from tidemark import drop_op, read_landed, select_existing


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(1, "a", "I")], "k int, v string, op string")


def test_select_existing(frame):
    assert select_existing(frame, ["v", "gone", "k"]).columns == ["v", "k"]
    assert select_existing(frame, ["V", "k"]).columns == ["k"]
    assert select_existing(frame, None) is frame
    assert select_existing(frame, []) is frame
    assert select_existing(frame, ["gone"]).columns == []


def test_drop_op_is_exact(spark, frame):
    assert drop_op(frame).columns == ["k", "v"]
    assert drop_op(frame, "OP").columns == ["k", "v", "op"]
    assert drop_op(frame, "v").columns == ["k", "op"]


CLASS_NAME = "org.apache.spark.sql.execution.datasources.json.JsonFileFormat"


@pytest.mark.parametrize("fmt", ["parquet", "Parquet", "PARQUET", "orc", "json", "JSON", CLASS_NAME])
def test_formats(frame, spark, tmp_path, fmt):
    path = str(tmp_path / "landed")
    frame.write.format("json" if fmt == CLASS_NAME else fmt.lower()).save(path)
    got = read_landed(spark, path, fmt, ["v", "op"])
    assert [tuple(r) for r in got.collect()] == [("a", "I")]


def test_csv(frame, spark, tmp_path):
    path = str(tmp_path / "landed")
    frame.write.option("header", True).csv(path)
    assert read_landed(spark, path, "csv", ["k", "v"]).columns == []
    got = read_landed(spark, path, "csv", ["k", "v"], options={"header": "true"})
    assert [tuple(r) for r in got.collect()] == [("1", "a")]
    typed = read_landed(
        spark, path, "csv", ["k"], schema=frame.schema, options={"header": "true"}
    )
    assert [tuple(r) for r in typed.collect()] == [(1,)]


def test_only_requested_columns_are_scanned(frame, spark, tmp_path):
    path = str(tmp_path / "landed")
    frame.write.parquet(path)
    plan = read_landed(spark, path, columns=["k"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:int>" in plan


def test_nothing_landed_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_landed(spark, str(tmp_path))
