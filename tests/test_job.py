from __future__ import annotations

import logging
import uuid

import pytest

from tidemark import JobSpec, TableSpec, apply_table, run_job
from tidemark.sinks import lakehouse, tables


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def land(spark, path, data, schema):
    spark.createDataFrame(data, schema).write.mode("overwrite").parquet(str(path))
    return str(path)


ORDERS = "order_id bigint, amount double, commit_ts int, op string"
CUSTOMERS = "customer_id bigint, tier string, commit_ts int, op string"


@pytest.fixture
def config(spark, database, tmp_path):
    orders = land(
        spark,
        tmp_path / "orders",
        [(1, 1.0, 1, "I"), (1, 2.0, 2, "U"), (2, 5.0, 1, "I"), (3, 7.0, 1, "D")],
        ORDERS,
    )
    customers = land(
        spark,
        tmp_path / "customers",
        [(1, "gold", 1, "I"), (1, "gold", 1, "I"), (2, "tin", 2, "D")],
        CUSTOMERS,
    )
    return {
        "catalog": {"enable_catalog": True},
        "dms": {
            "format": "parquet",
            "op_column": "op",
            "ops": {"insert": "I", "update": "U", "delete": "D"},
            "ts_column": "commit_ts",
        },
        "tables": [
            {
                "name": "orders",
                "source_path": orders,
                "target_identifier": f"{database}.orders",
                "has_pk": True,
                "pk": ["order_id"],
                "select_columns": ["order_id", "amount", "gone", "commit_ts", "op"],
            },
            {
                "name": "customers",
                "source_path": customers,
                "target_identifier": f"{database}.customers",
                "has_pk": False,
                "pk": [],
                "select_columns": ["customer_id", "tier", "op"],
            },
        ],
    }


def test_all_tables(spark, config, database):
    assert run_job(spark, config) == [("orders", "merge"), ("customers", "overwrite")]
    assert rows(spark.table(f"{database}.orders")) == [(1, 2.0, 2), (2, 5.0, 1)]
    # Loaded as landed: no reduction, and the D row is a row.
    assert rows(spark.table(f"{database}.customers")) == [(1, "gold"), (1, "gold"), (2, "tin")]


def test_next_batch(spark, config, database, tmp_path):
    run_job(spark, config)
    land(
        spark,
        tmp_path / "orders",
        [(1, 9.0, 0, "U"), (2, 0.0, 5, "D"), (2, 6.0, 6, "I"), (4, 4.0, 3, "U"), (5, 5.0, 3, "D")],
        ORDERS,
    )
    land(spark, tmp_path / "customers", [(7, "new", 1, "I")], CUSTOMERS)
    run_job(spark, config)
    # 1: an older change still applies; 2: delete then insert leaves the old row.
    assert rows(spark.table(f"{database}.orders")) == [(1, 9.0, 0), (2, 5.0, 1), (4, 4.0, 3)]
    assert rows(spark.table(f"{database}.customers")) == [(7, "new")]


def test_replay_changes_nothing(spark, config, database):
    run_job(spark, config)
    before = rows(spark.table(f"{database}.orders"))
    run_job(spark, config)
    assert rows(spark.table(f"{database}.orders")) == before


def test_empty_batch(spark, config, database, tmp_path):
    run_job(spark, config)
    land(spark, tmp_path / "orders", [], ORDERS)
    land(spark, tmp_path / "customers", [], CUSTOMERS)
    run_job(spark, config)
    assert spark.table(f"{database}.orders").count() == 2
    assert spark.table(f"{database}.customers").count() == 0


@pytest.mark.parametrize(
    ("mode", "done"),
    [("merge", [("orders", "merge")]), ("overwrite", [("customers", "overwrite")])],
)
def test_modes(spark, config, database, mode, done):
    assert run_job(spark, config, mode) == done
    made = {t.name for t in spark.catalog.listTables(database) if t.tableType == "VIEW"}
    assert made == {done[0][0]}


def test_unknown_mode(spark, config):
    with pytest.raises(ValueError, match="unknown mode"):
        run_job(spark, config, "some")


def test_order_of_failure(spark, config, database, caplog):
    config["tables"].insert(1, dict(config["tables"][0], name="bad", source_path="/nowhere"))
    with caplog.at_level(logging.INFO), pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_job(spark, config)
    assert spark.table(f"{database}.orders").count() == 2
    assert not spark.catalog.tableExists(f"{database}.customers")
    assert any("bad: failed" in m for m in caplog.messages)
    assert spark.range(1).count() == 1


def test_missing_op_column(spark, config):
    config["tables"][0]["select_columns"] = ["order_id", "amount"]
    with pytest.raises(ValueError, match="no operation column 'op'"):
        run_job(spark, config)


def test_empty_schema(spark, config, database, caplog):
    config["tables"][0]["select_columns"] = ["gone"]
    config["tables"][1]["select_columns"] = ["gone"]
    assert run_job(spark, config) == [("orders", "skipped"), ("customers", "skipped")]
    assert "orders: none of the columns ['gone'] was landed" in caplog.messages
    for mode in ("merge", "overwrite"):
        with pytest.raises(ValueError, match="none of the columns"):
            run_job(spark, config, mode)


def test_missing_has_pk(spark, config):
    del config["tables"][1]["has_pk"]
    with pytest.raises(ValueError, match="has_pk"):
        run_job(spark, config)
    assert run_job(spark, config, "merge") == [("orders", "merge")]
    assert run_job(spark, config, "overwrite") == [("customers", "overwrite")]
    spec = JobSpec.from_dict(config).tables[1]
    with pytest.raises(ValueError, match="has_pk"):
        apply_table(spark, spec, JobSpec.from_dict(config).changes)


def test_keyed_table_needs_a_key():
    with pytest.raises(ValueError, match="at least one key"):
        TableSpec("t", "/p", "d.t", True)


def test_creation_off(spark, config, database):
    config["catalog"]["enable_catalog"] = False
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        run_job(spark, config)
    assert spark.catalog.listTables(database) == []


def test_other_op_column(spark, config, database, tmp_path):
    config["dms"]["op_column"] = "kind"
    for t, schema in zip(config["tables"], (ORDERS, CUSTOMERS)):
        df = spark.read.parquet(t["source_path"]).withColumnRenamed("op", "kind")
        t["source_path"] = str(tmp_path / f"{t['name']}-kind")
        df.write.parquet(t["source_path"])
        t["select_columns"] = []
    run_job(spark, config)
    assert spark.table(f"{database}.orders").columns == ["order_id", "amount", "commit_ts"]
    assert spark.table(f"{database}.customers").columns == ["customer_id", "tier", "commit_ts"]


def test_without_timestamp(spark, config, database, tmp_path):
    config["dms"]["ts_column"] = None
    run_job(spark, config)  # duplicates of a new key are all inserted
    assert [r[0] for r in rows(spark.table(f"{database}.orders"))] == [1, 1, 2]
    with pytest.raises(Exception, match="several batch rows"):
        run_job(spark, config)


def test_large_batch_is_shuffle_joined(spark, config, database):
    config["tables"][0]["broadcast_bytes"] = 0
    run_job(spark, config)
    run_job(spark, config)
    assert rows(spark.table(f"{database}.orders")) == [(1, 2.0, 2), (2, 5.0, 1)]


def test_from_dict_defaults():
    table = {"name": "t", "source_path": "/p", "target_identifier": "d.t", "has_pk": True, "pk": ["k"]}
    job = JobSpec.from_dict({"tables": [table]})
    assert job.create_tables
    assert (job.changes.format, job.changes.op_column, job.changes.ts_column) == ("parquet", "op", None)
    assert (job.changes.ops.insert, job.changes.ops.update, job.changes.ops.delete) == ("I", "U", "D")
    assert job.tables[0].columns == ()


def test_row_level_targets(spark, config, database, monkeypatch):
    """Such targets are created, merged and overwritten by their own catalog."""
    calls = []
    monkeypatch.setattr(
        lakehouse, "ensure_table", lambda spark, *a, **k: calls.append(("create", a[0], a[2]))
    )
    monkeypatch.setattr(
        lakehouse,
        "merge_into",
        lambda ident, staged, *a: calls.append(("merge", ident, rows(staged), list(a[0]), a[1])),
    )
    monkeypatch.setattr(
        lakehouse,
        "overwrite_partitions",
        lambda ident, df: calls.append(("overwrite", ident, df.columns)),
    )
    for table in config["tables"]:
        table["target_format"] = "iceberg"
    run_job(spark, config)
    orders, customers = f"{database}.orders", f"{database}.customers"
    staged = [(1, 2.0, 2, "U"), (2, 5.0, 1, "I"), (3, 7.0, 1, "D")]
    assert calls == [
        ("create", orders, "iceberg"),
        ("merge", orders, staged, ["order_id"], "op"),
        ("create", customers, "iceberg"),
        ("overwrite", customers, ["customer_id", "tier"]),
    ]


@pytest.mark.parametrize("said", ["parquet", "PARQUET"])
def test_format_is_compared_without_case(spark, config, database, said):
    for table in config["tables"]:
        table["target_format"] = said
    run_job(spark, config)
    assert spark.table(f"{database}.orders").count() == 2


def test_route_by_what_the_target_is(spark, config, database, monkeypatch):
    """A target that the catalog knows in a row-level format is merged by its own MERGE."""
    kept = {f"{database}.orders": "iceberg"}
    monkeypatch.setattr(tables, "provider", lambda spark, ident: kept.get(ident))
    calls = []
    monkeypatch.setattr(lakehouse, "ensure_table", lambda spark, *a, **k: calls.append(a[2]))
    monkeypatch.setattr(lakehouse, "merge_into", lambda ident, *a: calls.append(ident))
    assert run_job(spark, config, "merge") == [("orders", "merge")]
    assert calls == ["iceberg", f"{database}.orders"]
    kept[f"{database}.orders"] = "csv"
    with pytest.raises(ValueError, match="kept as 'csv'"):
        run_job(spark, config, "merge")


def test_existing_table_of_another_format_is_refused(spark, config, database):
    spark.sql(f"CREATE TABLE {database}.orders (order_id bigint, amount double) USING json")
    with pytest.raises(ValueError, match="kept as 'json'"):
        run_job(spark, config)


def test_key_in_another_case(spark, config, database):
    config["tables"][0]["pk"] = ["ORDER_ID"]
    run_job(spark, config)
    run_job(spark, config)
    assert rows(spark.table(f"{database}.orders")) == [(1, 2.0, 2), (2, 5.0, 1)]


def test_empty_batch_writes_nothing(spark, config, database, tmp_path):
    run_job(spark, config)
    made = sorted(t.name for t in spark.catalog.listTables(database))
    land(spark, tmp_path / "orders", [], ORDERS)
    run_job(spark, config, "merge")
    assert sorted(t.name for t in spark.catalog.listTables(database)) == made


def test_nothing_staged_is_left(spark, config):
    before = {d.name for d in spark.catalog.listDatabases()}
    run_job(spark, config)
    assert {d.name for d in spark.catalog.listDatabases()} <= before


def test_broadcast_has_a_bound():
    with pytest.raises(ValueError, match="below 8 GB"):
        TableSpec("t", "/p", "d.t", True, ("k",), broadcast_bytes=8 * 1024**3)


# ---- side by side


def test_tables_side_by_side(spark, config, database, tmp_path):
    """The same results in the same order, with a slice overwrite and a partition load at once."""
    entries = []
    for n in range(4):
        path = land(spark, tmp_path / f"o{n}", [(k, float(n), 1, "U") for k in range(30)], ORDERS)
        entries.append(
            {**config["tables"][0], "name": f"o{n}", "source_path": path, "slice_by": "order_id div 10",
             "target_identifier": f"{database}.o{n}"}
        )
        spark.createDataFrame([(1, "gold"), (5, "steel")], "customer_id bigint, tier string").write.partitionBy(
            "tier"
        ).saveAsTable(f"{database}.c{n}")
        entries.append({**config["tables"][1], "name": f"c{n}", "target_identifier": f"{database}.c{n}"})
    entries[2]["slice_by"] = None
    done = run_job(spark, {**config, "tables": entries}, at_once=4)
    assert done == [(e["name"], "merge" if e["has_pk"] else "overwrite") for e in entries]
    for n in range(4):
        assert spark.table(f"{database}.o{n}").where(f"amount = {n}").count() == 30
        # Partitions that the load does not touch stay: its overwrite was dynamic.
        assert rows(spark.table(f"{database}.c{n}")) == [(1, "gold"), (1, "gold"), (2, "tin"), (5, "steel")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_side_by_side_uses_the_callers_settings(spark, config, database):
    entries = [{**t, "target_identifier": t["target_identifier"].split(".")[1]} for t in config["tables"]]
    before, here = spark.conf.get("spark.sql.session.timeZone"), spark.catalog.currentDatabase()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    spark.catalog.setCurrentDatabase(database)
    try:
        run_job(spark, {**config, "tables": [{**entries[0], "slice_by": "order_id div 10"}, entries[1]]}, at_once=2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
        spark.catalog.setCurrentDatabase(here)
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {database}.orders__slices").collect()}
    assert kept["tidemark.time_zone"] == "Asia/Tokyo"
    assert spark.table(f"{database}.customers").count() == 3


def test_the_first_failure_in_the_list_is_raised(spark, config, database, tmp_path):
    """Tables that run beside it are finished, later ones are not started."""
    orders, customers = config["tables"]
    bad = [
        {**orders, "name": f"bad{n}", "select_columns": ["order_id", "amount"], "target_identifier": f"{database}.bad{n}"}
        for n in range(2)
    ]
    late = [
        {**customers, "name": f"late{n}", "target_identifier": f"{database}.late{n}"} for n in range(6)
    ]
    with pytest.raises(ValueError, match="bad0"):
        run_job(spark, {**config, "tables": [orders, *bad, *late]}, at_once=3)
    assert spark.table(f"{database}.orders").count() == 2
    assert not spark.catalog.tableExists(f"{database}.late5")
    with pytest.raises(ValueError, match="targets of their own"):
        run_job(spark, {**config, "tables": [customers, customers]}, at_once=2)
    with pytest.raises(ValueError, match="at_once"):
        run_job(spark, config, at_once=0)
