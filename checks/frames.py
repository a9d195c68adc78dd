"""Change logs and targets derived from the test tables.

Every frame uses all rows of its table. In the order fixtures a target key is
1.5 times an order number, so two thirds of the keys in the log are in the
target and the rest are not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.staging import shared_dir

ORDER_COLUMNS = ["order_id", "customer_id", "amount", "status", "commit_ts"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def scratch_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession) -> str:
    """A new database whose tables lie in the shared folder."""
    name = f"tidemark_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/{name}'")
    return name


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of every order, a day before and after or the reverse."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    day = F.expr("INTERVAL '1' DAY")
    first_op = F.when(key % 5 == 0, "D").when(key % 5 == 1, "I").otherwise("U")
    second_op = (
        F.when(key % 7 == 0, "D")
        .when(key % 7 == 1, "I")
        .when(key % 7 == 2, "X")
        .otherwise("U")
    )
    second_ts = F.when(
        F.col("o_custkey") % 3 == 0, F.col("o_orderdate") - day
    ).otherwise(F.col("o_orderdate") + day)

    def version(amount, ts, op):
        return orders.select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            amount.alias("amount"),
            F.col("o_orderstatus").alias("status"),
            ts.alias("commit_ts"),
            op.alias("op"),
        )

    first = version(F.col("o_totalprice"), F.col("o_orderdate"), first_op)
    second = version(F.col("o_totalprice") + 10, second_ts, second_op)
    return first.unionByName(second)


def order_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.expr("o_orderkey * 3 div 2").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("commit_ts"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of their user: few keys, many versions."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_type",
        "value",
        F.col("ts").alias("commit_ts"),
        F.when(kind == "signup", "I").when(kind == "error", "D").otherwise("U").alias("op"),
    )
