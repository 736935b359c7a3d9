"""Dirty and keyed inputs, derived from the test tables by arithmetic on their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The run's time and the cut-off after which an order counts as "future".
RUN_TS = "2001-01-02 00:00:00"
AS_OF = "2001-01-01 00:00:00"
SECOND_RUN_TS = "2001-01-03 00:00:00"
# When the later run's changes were made: after all of the first source's.
CHANGED_AT = "2009-01-01 00:00:00"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def price():
    return F.col("o_totalprice").cast("decimal(10,2)")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nulls, negative amounts, and a later conflicting version of every 11th."""
    k, version = F.col("o_orderkey"), F.col("version")
    versions = F.when(k % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    orders = load(spark, sf_dir, "orders").select("*", F.explode(versions).alias("version"))
    amount = F.when(k % 53 == 0, None).when(k % 29 == 0, -price()).otherwise(price())
    return orders.select(
        F.when(k % 97 != 0, k).alias("order_id"),
        F.when(k % 41 != 0, F.col("o_custkey")).alias("customer_id"),
        (amount + version).cast("decimal(10,2)").alias("amount"),
        F.when(version == 1, "shipped")
        .when(k % 5 != 0, F.lower("o_orderstatus"))
        .alias("status"),
        F.when(k % 61 != 0, F.col("o_orderdate")).alias("created_at"),
        (F.col("o_orderdate") + F.make_dt_interval(version)).alias("updated_at"),
    )


def later_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source at a later run: some orders deleted, some turned bad, some changed."""
    key = F.col("order_id")
    return (
        raw_orders(spark, sf_dir)
        .filter(key.isNull() | (key % 3 != 0))
        .withColumn("amount", F.when(key % 7 == 0, -F.col("amount")).otherwise(F.col("amount")))
        .withColumn("status", F.when(key % 2 == 0, "returned").otherwise(F.col("status")))
    )


def text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose amount and time arrive as text, some of it unreadable."""
    k = F.col("o_orderkey")
    amount = (
        F.when(k % 53 == 0, "abc")
        .when(k % 31 == 0, "123456789.00")
        .when(k % 29 == 0, F.concat(F.lit("-"), price().cast("string")))
        .otherwise(price().cast("string"))
    )
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    time = (
        F.when(k % 61 == 0, "garbage")
        .when(k % 59 == 0, F.concat(written, F.lit(".123")))
        .otherwise(written)
    )
    status = F.when(k % 5 == 0, None).when(k % 7 == 0, "").when(k % 3 == 0, " f ")
    return load(spark, sf_dir, "orders").select(
        k.alias("order_id"),
        amount.alias("amount"),
        status.otherwise(F.lower("o_orderstatus")).alias("status"),
        time.alias("created_at"),
    )


def upsert_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        load(spark, sf_dir, "orders")
        .filter(F.col("o_orderkey") % 10 < 8)
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            price().alias("total_amount"),
            F.col("o_orderstatus").alias("order_status"),
        )
    )


def upsert_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        load(spark, sf_dir, "orders")
        .filter(F.col("o_orderkey") % 10 >= 6)
        .select(
            F.col("o_orderkey").alias("order_id"),
            (F.col("o_custkey") + 1).alias("customer_id"),
            (price() + 10).cast("decimal(10,2)").alias("total_amount"),
            F.lower("o_orderstatus").alias("order_status"),
        )
    )


def changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source at a later run at which each change moves ``updated_at``; some orders are new."""
    key, is_changed = F.col("order_id"), F.col("order_id") % 9 == 0
    raw = raw_orders(spark, sf_dir)
    changed = raw.withColumns(
        {
            "amount": F.when(key % 18 == 0, -F.col("amount")).otherwise(F.col("amount")),
            "status": F.when(is_changed, "returned").otherwise(F.col("status")),
            "updated_at": F.when(is_changed, F.lit(CHANGED_AT).cast("timestamp_ntz")).otherwise(
                F.col("updated_at")
            ),
        }
    )
    added = raw.filter(key % 50 == 0).withColumns(
        {"order_id": -key, "updated_at": F.lit(CHANGED_AT).cast("timestamp_ntz")}
    )
    return changed.unionByName(added)


def dated_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("updated_at")
    )
    return upsert_target(spark, sf_dir).join(dates, "order_id")


def dated_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of which a third is older than what is stored, and a third is as old."""
    later = F.make_dt_interval((F.col("o_orderkey") % 3 - 1).cast("int"))
    dates = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_orderdate") + later).alias("updated_at")
    )
    return upsert_updates(spark, sf_dir).join(dates, "order_id")
