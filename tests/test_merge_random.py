"""Random batches on random targets, against DuckDB's own MERGE."""

from __future__ import annotations

import random
import uuid

import duckdb
import pytest

from tidemark import latest_per_pk, merge_cdc, stage_batch
from tidemark.operators.hot_keys import hot_keys
from tidemark.sinks import buckets, slices

MERGE = """
MERGE INTO t USING s ON t.a = s.a AND t.b = s.b
WHEN MATCHED AND s.op = 'D' THEN DELETE
WHEN MATCHED AND s.op = 'U' THEN UPDATE SET v = s.v, ts = s.ts
WHEN NOT MATCHED AND s.op IN ('I', 'U') THEN INSERT (a, b, v, ts) VALUES (s.a, s.b, s.v, s.ts)
"""
TARGET = "a int, b string, v int, ts int"


def draw(seed):
    rng = random.Random(seed)
    keys = [(a, b) for a in [None, *range(6)] for b in [None, "x", "y", ""]]
    held = rng.sample(keys, rng.randint(0, len(keys)))
    held += [(None, "x")] * rng.randint(0, 3)
    held += [rng.choice(keys)] * rng.choice([0, 0, 9])  # a key with several rows
    target = [(a, b, rng.randint(0, 9), 0) for a, b in held]
    log = [
        (*rng.choice(keys), rng.randint(10, 99), ts, rng.choice(["I", "U", "D", "u", "X", None]))
        for ts in rng.sample(range(1, 200), rng.choice([0, 1, 40]))
    ]
    return target, log


def merged_by_duckdb(target, staged):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a int, b varchar, v int, ts int)")
    con.execute("CREATE TABLE s (a int, b varchar, v int, ts int, op varchar)")
    for table, rows in (("t", target), ("s", staged)):
        if rows:
            marks = ", ".join("?" * len(rows[0]))
            con.executemany(f"INSERT INTO {table} VALUES ({marks})", rows)
    con.execute(MERGE)
    return sorted(con.execute("FROM t").fetchall(), key=str)


@pytest.mark.parametrize("seed", range(8))
def test_merge(spark, tmp_path, seed):
    target, log = draw(seed)
    rng = random.Random(seed)
    frame = spark.createDataFrame(target, TARGET)
    latest = latest_per_pk(spark.createDataFrame(log, TARGET + ", op string"), ["a", "b"], "ts")
    batch = stage_batch(latest, ["a", "b"])
    staged = [tuple(r) for r in batch.rows.collect()]
    assert batch.count == len(staged)
    expected = merged_by_duckdb(target, staged)

    for broadcast in ("rows", "keys", "nothing"):
        unique = bool(rng.randint(0, 1))
        got = merge_cdc(frame, batch.rows, ["a", "b"], staged_unique=unique, broadcast=broadcast)
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected

    # The range of the keys, and keys with several rows taken for hot.
    hot = hot_keys(frame, ["a", "b"], tasks=rng.randint(2, 30), least_rows=1)
    for unique in (True, False):
        for held in (None, hot.keys if hot else None):
            got = merge_cdc(
                frame, batch.rows, ["a", "b"], staged_unique=unique, key_range=batch.key_range, hot=held
            )
            assert sorted((tuple(r) for r in got.collect()), key=str) == expected

    database = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/{database}'")
    slices.ensure_table(spark, f"{database}.t", frame.schema, ["a", "b"], "pmod(hash(a, b), 5)")
    slices.overwrite(spark, f"{database}.t", frame)
    slices.merge(spark, f"{database}.t", batch, ["a", "b"], staged_unique=True)
    got = spark.table(f"{database}.t").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected

    name = f"{database}.u"
    buckets.ensure_table(spark, name, frame.schema, ["a", "b"], rng.randint(1, 9))
    buckets.overwrite(spark, name, frame, least_rows=1)
    buckets.merge(spark, name, batch, ["b", "a"], staged_unique=True)
    assert sorted((tuple(r) for r in spark.table(name).collect()), key=str) == expected
    spark.sql(f"DROP DATABASE {database} CASCADE")
