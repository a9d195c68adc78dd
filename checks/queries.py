"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.frames import (
    ORDER_COLUMNS,
    event_log,
    order_log,
    order_target,
    scratch_database,
    scratch_path,
    table,
    table_path,
)
from tidemark.config import DEFAULT_BROADCAST_BYTES, ChangeSpec, JobSpec, TableSpec
from tidemark.operators.hot_keys import hot_keys
from tidemark.operators.latest import latest_per_pk
from tidemark.operators.merge import NOTHING, merge_cdc, merge_effects
from tidemark.operators.staging import StagedBatch, stage_batch
from tidemark.plans.job import apply_table, run_job
from tidemark.sinks import buckets, slices, tables
from tidemark.sources.landed import drop_op, read_landed

Query = Callable[[SparkSession, str], DataFrame]
CHANGES = ChangeSpec(ts_column="commit_ts")


# ---- sources and projections


def read_select_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = ["c_custkey", "c_name", "tier", "c_mktsegment"]
    return read_landed(spark, table_path(sf_dir, "customer"), "PARQUET", wanted)


def read_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark)
    customer.write.json(path)
    wanted = ["c_custkey", "c_name", "c_acctbal"]
    return read_landed(spark, path, "JSON", wanted, schema=customer.schema)


def read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark)
    customer.write.option("header", True).csv(path)
    return read_landed(
        spark,
        path,
        "csv",
        ["c_custkey", "c_name", "c_mktsegment"],
        schema=customer.schema,
        options={"header": "true"},
    )


def drop_op_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_op(order_log(spark, sf_dir))


# ---- newest change per key


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_pk(order_log(spark, sf_dir), ["order_id"], "commit_ts")


def latest_composite_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return latest_per_pk(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


def latest_tie_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    ties = ["l_partkey", "l_suppkey", "l_extendedprice"]
    return latest_per_pk(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", ties)


def latest_null_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.nullif(F.col("o_orderkey") % 10, F.lit(0)).alias("pk"),
        F.col("o_orderdate").alias("commit_ts"),
    )
    return latest_per_pk(rows, ["pk"], "commit_ts")


def latest_null_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = (F.col("o_custkey") % 4 != 0) & (F.col("o_orderstatus") != "P")
    rows = table(spark, sf_dir, "orders").select(
        "o_custkey", F.when(known, F.col("o_orderdate")).alias("ts")
    )
    return latest_per_pk(rows, ["o_custkey"], "ts")


def latest_no_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_pk(order_log(spark, sf_dir).drop("commit_ts"), ["order_id"], "commit_ts")


# ---- merge


def _staged_orders(spark: SparkSession, sf_dir: str) -> StagedBatch:
    return stage_batch(latest_orders(spark, sf_dir), ["order_id"])


def _merge(target: DataFrame, batch: StagedBatch, rows: DataFrame | None = None) -> DataFrame:
    """Merge the batch, or some columns or rows of it."""
    return merge_cdc(
        target,
        batch.rows if rows is None else rows,
        ["order_id"],
        staged_unique=True,
        broadcast=batch.broadcast(DEFAULT_BROADCAST_BYTES),
    )


def merge_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge(order_target(spark, sf_dir), _staged_orders(spark, sf_dir))


def merge_broadcast_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for a batch of which only the keys are measured to fit into every task."""
    batch = _staged_orders(spark, sf_dir)
    limit = min(batch.size_bytes - 1, DEFAULT_BROADCAST_BYTES)
    return merge_cdc(
        order_target(spark, sf_dir),
        batch.rows,
        ["order_id"],
        staged_unique=True,
        broadcast=batch.broadcast(limit),
    )


def merge_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for a batch that does not fit, on a target partly without keys."""
    key = F.col("order_id")
    target = order_target(spark, sf_dir).withColumn("order_id", F.when(key % 3 != 0, key))
    batch = _staged_orders(spark, sf_dir)
    return merge_cdc(target, batch.rows, ["order_id"], staged_unique=True, broadcast=NOTHING)


def merge_filtered_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same plan with the range of the batch's keys: other rows are not moved."""
    key = F.col("order_id")
    target = order_target(spark, sf_dir).withColumn("order_id", F.when(key % 3 != 0, key))
    batch = _staged_orders(spark, sf_dir)
    return merge_cdc(
        target,
        batch.rows,
        ["order_id"],
        staged_unique=True,
        broadcast=NOTHING,
        key_range=batch.key_range,
    )


def merge_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for a batch that does not fit, on a target with a third of its rows under one key."""
    key = F.col("order_id")
    stored = scratch_path(spark)
    target = order_target(spark, sf_dir).withColumn("order_id", F.when(key % 3 != 0, key).otherwise(6))
    target.write.parquet(stored)
    target = spark.read.parquet(stored)
    hot = hot_keys(target, ["order_id"], least_rows=1)
    batch = _staged_orders(spark, sf_dir)
    return merge_cdc(
        target,
        batch.rows,
        ["order_id"],
        staged_unique=True,
        broadcast=NOTHING,
        key_range=batch.key_range,
        hot=hot.keys if hot else None,
    )


def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge on a target that lies in buckets by key, partly without keys."""
    key = F.col("order_id")
    target = order_target(spark, sf_dir).withColumn("order_id", F.when(key % 3 != 0, key))
    name = f"{scratch_database(spark)}.orders"
    buckets.ensure_table(spark, name, target.schema, ["order_id"], 16)
    buckets.overwrite(spark, name, target)
    buckets.merge(spark, name, _staged_orders(spark, sf_dir), ["order_id"], staged_unique=True)
    return spark.table(name)


def merge_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _staged_orders(spark, sf_dir)
    return _merge(order_target(spark, sf_dir), batch, batch.rows.filter("op = 'D'"))


def merge_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _staged_orders(spark, sf_dir)
    return _merge(order_target(spark, sf_dir), batch, batch.rows.filter("op = 'U'"))


def merge_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _staged_orders(spark, sf_dir)
    return _merge(order_target(spark, sf_dir), batch, batch.rows.filter("op IN ('I', 'U')"))


def merge_noop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the merged table whose key the batch holds under another op."""
    batch = _staged_orders(spark, sf_dir)
    target = order_target(spark, sf_dir)
    quiet = batch.rows.filter("op NOT IN ('U', 'D')").select("order_id")
    held = target.select("order_id").join(quiet, "order_id", "left_semi")
    return (
        _merge(target, batch)
        .join(held, "order_id", "left_semi")
        .select("order_id", "amount", "commit_ts")
    )


def merge_unknown_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _staged_orders(spark, sf_dir)
    unknown = batch.rows.withColumn("op", F.concat(F.lit("?"), F.col("op")))
    return _merge(order_target(spark, sf_dir), batch, unknown)


def merge_null_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _staged_orders(spark, sf_dir)
    key = F.col("order_id")
    rows = batch.rows.withColumn("order_id", F.when(key % 50 != 1, key))
    return _merge(order_target(spark, sf_dir), batch, rows)


def merge_null_target_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the target has no key."""
    key = F.col("order_id")
    target = order_target(spark, sf_dir).withColumn("order_id", F.when(key % 3 != 0, key))
    return _merge(target, _staged_orders(spark, sf_dir))


def merge_subset_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _staged_orders(spark, sf_dir)
    rows = batch.rows.select("order_id", "status", "commit_ts", "op")
    return _merge(order_target(spark, sf_dir), batch, rows)


def merge_composite_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, sf_dir, "lineitem")
    stored = scratch_path(spark)
    lines.groupBy(*keys).agg(F.max("l_quantity").alias("qty")).write.parquet(stored)
    target = spark.read.parquet(stored)
    kind = (F.col("l_orderkey") + F.col("l_linenumber")) % 3
    batch = stage_batch(
        target.select(
            "l_orderkey",
            (F.col("l_linenumber") + 1).alias("l_linenumber"),
            (F.col("qty") + 100).alias("qty"),
            F.when(kind == 0, "I").when(kind == 1, "U").otherwise("D").alias("op"),
        ),
        keys,
    )
    return merge_cdc(
        target,
        batch.rows,
        keys,
        staged_unique=True,
        broadcast=batch.broadcast(DEFAULT_BROADCAST_BYTES),
    )


def merge_duplicate_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that was not reduced, with keys the target does not have."""
    log = order_log(spark, sf_dir).withColumn("order_id", -1 - F.col("order_id"))
    batch = stage_batch(log, ["order_id"])
    return merge_cdc(
        order_target(spark, sf_dir),
        batch.rows,
        ["order_id"],
        broadcast=batch.broadcast(DEFAULT_BROADCAST_BYTES),
    )


def merge_order_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = _staged_orders(spark, sf_dir)
    return merge_effects(
        order_target(spark, sf_dir),
        batch.rows,
        ["order_id"],
        staged_unique=True,
        broadcast=batch.broadcast(DEFAULT_BROADCAST_BYTES),
    )


# ---- targets and jobs, through the catalog


def _orders_spec(spark: SparkSession, sf_dir: str, database: str) -> TableSpec:
    """Land the order log and load the target it applies to."""
    landing = scratch_path(spark)
    order_log(spark, sf_dir).write.parquet(landing)
    spec = TableSpec(
        name="orders",
        source_path=landing,
        target=f"{database}.orders",
        has_pk=True,
        pk=("order_id",),
        columns=(*ORDER_COLUMNS, "op"),
    )
    target = order_target(spark, sf_dir)
    tables.ensure_table(spark, spec.target, target.schema)
    tables.overwrite(spark, spec.target, target)
    return spec


def _customers_spec(sf_dir: str, database: str) -> TableSpec:
    return TableSpec(
        name="customers",
        source_path=table_path(sf_dir, "customer"),
        target=f"{database}.customers",
        has_pk=False,
        columns=("c_custkey", "c_name", "tier", "c_mktsegment", "op"),
    )


def merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _orders_spec(spark, sf_dir, scratch_database(spark))
    apply_table(spark, spec, CHANGES)
    apply_table(spark, spec, CHANGES)
    return spark.table(spec.target)


def merge_key_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge on a target of which only the touched slices are rewritten."""
    name = f"{scratch_database(spark)}.orders"
    target = order_target(spark, sf_dir)
    slices.ensure_table(spark, name, target.schema, ["order_id"], "pmod(xxhash64(order_id), 64)")
    slices.overwrite(spark, name, target)
    slices.merge(
        spark, name, _staged_orders(spark, sf_dir), ["order_id"], staged_unique=True
    )
    return spark.table(name)


def merge_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches in turn, into a target the first one creates."""
    database = scratch_database(spark)
    events = event_log(spark, sf_dir)
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (F.col("commit_ts") < split, F.col("commit_ts") >= split):
        landing = scratch_path(spark)
        events.filter(part).write.parquet(landing)
        spec = TableSpec("events", landing, f"{database}.users", True, ("user_id",))
        apply_table(spark, spec, CHANGES)
    return spark.table(f"{database}.users")


def create_table_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a created table, with the values a load puts in each."""
    target = f"{scratch_database(spark)}.orders"
    log = order_log(spark, sf_dir)
    tables.ensure_table(spark, target, log.schema, op_col="op")
    tables.overwrite(spark, target, drop_op(log))
    fields = spark.table(target).schema.fields
    counted = spark.table(target).agg(*[F.count(f.name).alias(f.name) for f in fields])
    described = F.array(
        *[
            F.struct(
                F.lit(pos).alias("pos"),
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f.name).alias("n"),
            )
            for pos, f in enumerate(fields, start=1)
        ]
    )
    return counted.select(F.inline(described))


def truncate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace a filled target by the log, whose op codes are not looked at."""
    database = scratch_database(spark)
    spec = _orders_spec(spark, sf_dir, database)
    apply_table(spark, TableSpec("orders", spec.source_path, spec.target, False), CHANGES)
    return spark.table(spec.target)


def overwrite_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load one status into a table partitioned by status."""
    name = f"{scratch_database(spark)}.orders"
    target = order_target(spark, sf_dir)
    tables.ensure_table(spark, name, target.schema, partition_by=["status"])
    tables.overwrite(spark, name, target)
    open_orders = drop_op(order_log(spark, sf_dir)).filter("status = 'O'")
    tables.overwrite_partitions(spark, name, open_orders)
    return spark.table(name).select(*ORDER_COLUMNS)


def _job(spark: SparkSession, sf_dir: str) -> JobSpec:
    database = scratch_database(spark)
    return JobSpec(
        changes=CHANGES,
        tables=(_orders_spec(spark, sf_dir, database), _customers_spec(sf_dir, database)),
    )


def route_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _job(spark, sf_dir)
    done = dict(run_job(spark, job))
    counts = [
        spark.table(t.target).agg(
            F.lit(t.name).alias("tbl"),
            F.lit(done[t.name]).alias("mode"),
            F.count(F.lit(1)).alias("n"),
        )
        for t in job.tables
    ]
    return counts[0].unionByName(counts[1])


def route_merge_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _job(spark, sf_dir)
    run_job(spark, job, mode="merge")
    return spark.table(job.tables[0].target)


def route_overwrite_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = _job(spark, sf_dir)
    run_job(spark, job, mode="overwrite")
    return spark.table(job.tables[1].target)


def _counts(spark: SparkSession, results: list[tuple[str, str, str]]) -> DataFrame:
    """(tbl, mode, n) for (name, what was done, target)."""
    counted = [
        spark.table(target).agg(
            F.lit(name).alias("tbl"), F.lit(done).alias("mode"), F.count(F.lit(1)).alias("n")
        )
        for name, done, target in results
    ]
    return reduce(DataFrame.unionByName, counted)


def route_skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source without any requested column is skipped, the next table is loaded."""
    job = _job(spark, sf_dir)
    orders, customers = job.tables
    done = run_job(spark, replace(job, tables=(replace(orders, columns=("nothing",)), customers)))
    targets = [t.target for t in job.tables]
    return _counts(spark, [(*d, target) for d, target in zip(done, targets)])


def route_existing_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creation is off: the target that exists is merged into."""
    job = replace(_job(spark, sf_dir), create_tables=False)
    run_job(spark, job, mode="merge")
    return spark.table(job.tables[0].target)


def route_fail_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second table lacks the operation code: the first is done, the third untouched."""
    database = scratch_database(spark)
    orders = _orders_spec(spark, sf_dir, database)
    customers = _customers_spec(sf_dir, database)
    keyed = replace(customers, name="keyed", target=f"{database}.keyed", has_pk=True, pk=("c_custkey",))
    tables.ensure_table(spark, customers.target, table(spark, sf_dir, "customer").limit(0).select(
        "c_custkey", "c_name", "c_mktsegment").schema)
    try:
        run_job(spark, JobSpec(changes=CHANGES, tables=(orders, keyed, customers)))
        failed = "no"
    except ValueError:
        failed = "yes"
    return _counts(spark, [("orders", failed, orders.target), ("customers", failed, customers.target)])


QUERIES: dict[str, Query] = {
    "read_select_existing": read_select_existing,
    "read_json": read_json,
    "read_csv": read_csv,
    "drop_op": drop_op_column,
    "latest_per_pk": latest_orders,
    "latest_composite_pk": latest_composite_pk,
    "latest_tie_cols": latest_tie_cols,
    "latest_null_pk": latest_null_pk,
    "latest_null_ts": latest_null_ts,
    "latest_no_ts": latest_no_ts,
    "merge_cdc": merge_orders,
    "merge_broadcast_keys": merge_broadcast_keys,
    "merge_shuffled": merge_shuffled,
    "merge_filtered_keys": merge_filtered_keys,
    "merge_hot_keys": merge_hot_keys,
    "merge_bucketed": merge_bucketed,
    "merge_delete": merge_delete,
    "merge_update": merge_update,
    "merge_insert": merge_insert,
    "merge_noop_rows": merge_noop_rows,
    "merge_unknown_op": merge_unknown_op,
    "merge_null_pk": merge_null_pk,
    "merge_null_target_pk": merge_null_target_pk,
    "merge_subset_columns": merge_subset_columns,
    "merge_composite_pk": merge_composite_pk,
    "merge_duplicate_inserts": merge_duplicate_inserts,
    "merge_replay": merge_replay,
    "merge_key_slices": merge_key_slices,
    "merge_two_batches": merge_two_batches,
    "merge_effects": merge_order_effects,
    "create_table_schema": create_table_schema,
    "truncate_load": truncate_load,
    "overwrite_partitions": overwrite_partitions,
    "route_tables": route_tables,
    "route_merge_only": route_merge_only,
    "route_overwrite_only": route_overwrite_only,
    "route_skip_empty": route_skip_empty,
    "route_existing_target": route_existing_target,
    "route_fail_fast": route_fail_fast,
}
