"""Every registered query against its SQL oracle."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def normalized(rows):
    return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = queries()[name](spark, SF_DIR)
    want = duck.execute(oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    expected = normalized(want.fetchall())
    assert expected
    assert normalized(tuple(r) for r in got.select(*names).collect()) == expected


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
