"""The queries that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())


def test_reruns_agree(spark):
    first, again = (sorted(map(tuple, QUERIES["op5_mix"](spark, SF).collect())) for _ in range(2))
    assert first == again
