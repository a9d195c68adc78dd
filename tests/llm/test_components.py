from __future__ import annotations

import random
from collections import Counter
from pathlib import Path

import pytest

from tidemark.llm.common import stage
from tidemark.llm.components import components
from tidemark.operators.staging import shared_dir


@pytest.fixture
def many_partitions(spark):
    """A shuffle's partitions are as many as set, however few rows there are."""
    own = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield 12
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rounds_over_few_edges_write_few_files(spark, many_partitions):
    rng = random.Random(3)
    ids = rng.sample(range(1000), 120)
    edges = [(ids[n], ids[n + 1]) for n in range(119) if n % 40 != 39]  # three chains
    rng.shuffle(edges)
    folder = Path(shared_dir(spark))
    there = set(folder.iterdir()) if folder.exists() else set()
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: min(part) for part in (ids[:40], ids[40:80], ids[80:]) for x in part}
    files = Counter({p.name: len(list(p.glob("*.parquet"))) for p in set(folder.iterdir()) - there})
    assert len(files) > 8
    # But for the first edges, of which nobody knows how many there are.
    assert sorted(files.values())[:-1] == [1] * (len(files) - 1)


def test_as_many_tasks_write_as_the_size_asks_for(spark, many_partitions, monkeypatch):
    monkeypatch.setattr("tidemark.llm.common.STAGED_BYTES", 1000)
    rows = spark.range(2000).repartition(many_partitions)
    for size, files in ((None, 12), (0, 1), (1, 1), (1001, 2), (7000, 7), (10**9, 12)):
        got = stage(rows, "any", size)
        assert len(got.inputFiles()) == files and got.count() == 2000
