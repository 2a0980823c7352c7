"""Parquet tables and the views over them that feed the three job families."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FRAUD_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_ticks(events: DataFrame) -> DataFrame:
    """``(symbol, price, timestamp)`` from events; works on batch and streaming frames.

    ``ts`` has no zone, and watermarks need one, so it is cast under the session zone (UTC).
    """
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(read_table(spark, sf_dir, "events"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip records derived from orders, one per order."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    start = F.col("o_orderdate").cast("timestamp")
    duration = F.lit(30) + (c * 37 + k * 11) % 24000

    def plus_seconds(seconds):
        return F.timestamp_micros(F.unix_micros(start) + seconds * 1_000_000)

    return read_table(spark, sf_dir, "orders").select(
        F.concat(F.lit("id"), k.cast("string")).alias("id"),
        (1 + c % 2).alias("vendor_id"),
        plus_seconds(k * 7 % 86400).alias("pickup_datetime"),
        plus_seconds(k * 7 % 86400 + duration + (k % 7) * 50 - 100).alias("dropoff_datetime"),
        (1 + k % 6).alias("passenger_count"),
        (F.lit(-74.32) + (k * 13 % 640) / F.lit(1000.0)).alias("pickup_longitude"),
        (F.lit(40.48) + (k * 17 % 540) / F.lit(1000.0)).alias("pickup_latitude"),
        (F.lit(-74.32) + (k * 19 % 640) / F.lit(1000.0)).alias("dropoff_longitude"),
        (F.lit(40.48) + (k * 23 % 540) / F.lit(1000.0)).alias("dropoff_latitude"),
        F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("store_and_fwd_flag"),
        duration.alias("trip_duration"),
    )


def fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric classification rows from lineitem: ``row_key``, four features and ``Class``."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("row_key"),
        *FRAUD_FEATURES,
        (F.col("l_returnflag") == "R").cast("int").alias("Class"),
    )


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, features array<double>, label double)`` from embeddings; label 0 is the rare class."""
    return read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        F.col("embedding").cast("array<double>").alias("features"),
        (F.col("label") == 0).cast("double").alias("label"),
    )
