"""Targets that lie in buckets by their key."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tidemark import ChangeSpec, TableSpec, apply_table, stage_batch
from tidemark.operators import merge as merge_operator
from tidemark.sinks import buckets, tables


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def target(spark, database):
    """Keys 0 to 99 in 4 buckets; key 7 has 300 rows more, 50 rows have no key."""
    name = f"{database}.t"
    df = spark.range(450).selectExpr(
        "CASE WHEN id < 100 THEN id WHEN id < 400 THEN 7 END AS k", "CAST(id AS STRING) AS v"
    )
    buckets.ensure_table(spark, name, df.schema, ["K"], 4)
    buckets.overwrite(spark, name, df, least_rows=10)
    return name


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def held(spark, target):
    """(place, bucket) -> files of the version that is shown."""
    version = buckets.snapshots.current(spark, target)
    store = spark.table(f"{target}__v{version}")
    out = {}
    for r in store.select("__place", F.input_file_name().alias("f"), "k").collect():
        bucket = int(r["f"].rpartition("_")[2].partition(".")[0])
        out.setdefault((r["__place"], bucket), set()).add(r["f"])
    return out


def apply(spark, target, data, kind="k long, v string, op string", **options):
    batch = stage_batch(spark.createDataFrame(data, kind), ["k"])
    buckets.merge(spark, target, batch, ["k"], staged_unique=True, **options)
    batch.release()


def test_load(spark, target):
    assert spark.table(target).columns == ["k", "v"]
    assert spark.table(target).count() == 450
    files = held(spark, target)
    # One file a bucket; rows without a key and of the crowded one are elsewhere.
    assert all(len(f) == 1 for (place, _), f in files.items() if place == "by_key")
    version = buckets.snapshots.current(spark, target)
    apart = spark.table(f"{target}__v{version}").filter("__place = 'apart'")
    assert rows(apart.groupBy("k").count()) == [(7, 301), (None, 50)]


@pytest.mark.parametrize("hashed", [merge_operator.HASHED_BYTES, 0])
def test_merge(spark, target, monkeypatch, hashed):
    monkeypatch.setattr(merge_operator, "HASHED_BYTES", hashed)
    before = rows(spark.table(target))
    data = [(1, "x", "U"), (2, "", "D"), (3, "x", "I"), (200, "n", "I"), (201, "n", "U"), (202, "n", "D"),
            (4, "x", "?"), (5, "x", None), (None, "a", "I"), (None, "b", "U"), (None, "c", "D")]
    apply(spark, target, data)
    expected = [r for r in before if r[0] not in (1, 2)]
    expected += [(1, "x"), (200, "n"), (201, "n"), (None, "a"), (None, "b")]
    assert rows(spark.table(target)) == sorted(expected, key=str)
    assert all(len(f) == 1 for (place, _), f in held(spark, target).items() if place == "by_key")
    apply(spark, target, [])
    assert rows(spark.table(target)) == sorted(expected, key=str)


def test_crowded_key(spark, target):
    apply(spark, target, [(7, "x", "U"), (8, "y", "U")])
    assert spark.table(target).filter("v = 'x'").count() == 301
    apply(spark, target, [(7, "z", "I")])
    assert spark.table(target).filter("k = 7").count() == 301
    apply(spark, target, [(7, "", "D")])
    assert spark.table(target).filter("k = 7").count() == 0
    apply(spark, target, [(7, "back", "U"), (9, "", "D")])
    assert rows(spark.table(target).filter("k IN (7, 9)")) == [(7, "back")]
    assert spark.table(target).filter("k IS NULL").count() == 50


def test_the_target_is_not_shuffled(spark, target):
    """No exchange, and with a hash table no sort, above the target's scan."""
    batch = stage_batch(spark.createDataFrame([(1, "x", "U")], "k long, v string, op string"), ["k"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = buckets.merged_rows(spark, target, batch)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joined = next(part for part in plan.split("\n:- ") if "FullOuter" in part)
    lines = joined.splitlines()
    at = next(i for i, line in enumerate(lines) if "FullOuter" in line)
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    above = lines[at + 1 : scan]
    assert "ShuffledHashJoin" in lines[at] and len(above) <= 4
    assert not any("Exchange" in line or "Sort" in line for line in above)
    assert "SelectedBucketsCount: 4 out of 4" in lines[scan]


def test_failed_merge_changes_nothing(spark, target):
    before = rows(spark.table(target))
    batch = stage_batch(spark.createDataFrame([(1, "x", "U")], "k long, v string, op string"), ["k"])
    with pytest.raises(ValueError, match="one row a key"):
        buckets.merge(spark, target, batch, ["k"])
    with pytest.raises(ValueError, match="kept by key"):
        buckets.merge(spark, target, batch, ["v"], staged_unique=True)
    with pytest.raises(Exception, match="CAST"):
        apply(spark, target, [("no number", "x", "U")], "k string, v string, op string")
    assert rows(spark.table(target)) == before
    reader = spark.table(target)
    apply(spark, target, [(1, "x", "U")])
    assert rows(reader) == before


def test_other_targets(spark, database):
    spark.range(1).write.saveAsTable(f"{database}.plain")
    tables.ensure_table(spark, f"{database}.s", spark.range(1).schema)
    for name in ("plain", "s", "none"):
        assert not buckets.is_target(spark, f"{database}.{name}")
    with pytest.raises(ValueError, match="not a target kept in buckets"):
        buckets.overwrite(spark, f"{database}.s", spark.range(1))
    with pytest.raises(ValueError, match="not in the target"):
        buckets.ensure_table(spark, f"{database}.u", spark.range(1).schema, ["k"], 4)


def test_job(spark, database, tmp_path):
    """Created, merged into and replaced by jobs; the layout stays."""
    changes = ChangeSpec(ts_column="ts")
    batches = [
        [(1, "a", 1, "I"), (2, "b", 1, "I"), (1, "c", 2, "U")],
        [(2, "", 3, "D"), (3, "d", 3, "U"), (None, "e", 3, "I")],
        [(4, "f", 4, "U")],
    ]
    name = f"{database}.orders"
    for n, data in enumerate(batches):
        path = f"{tmp_path}/landed{n}"
        spark.createDataFrame(data, "k int, v string, ts int, op string").write.parquet(path)
        columns = ("k", "v", "ts", "op")
        spec = TableSpec("orders", path, name, True, ("k",), columns, bucket_by=3)
        assert apply_table(spark, spec, changes) == "merge"
    assert rows(spark.table(name)) == [(1, "c", 2), (3, "d", 3), (4, "f", 4), (None, "e", 3)]
    assert apply_table(spark, TableSpec("orders", path, name, False, columns=columns), changes) == "overwrite"
    assert rows(spark.table(name)) == [(4, "f", 4)]
    assert all(place == "by_key" for place, _ in held(spark, name))


@pytest.mark.parametrize(
    "wrong", [{"has_pk": False}, {"target_format": "iceberg"}, {"slice_by": "k"}, {"bucket_by": -1}]
)
def test_wrong_specs(wrong):
    fields = {"name": "t", "source_path": "p", "target": "d.t", "has_pk": True, "pk": ("k",), "bucket_by": 4}
    with pytest.raises(ValueError, match="bucket_by|slice_by"):
        TableSpec(**(fields | wrong))
