"""Streaming scans. Production reads topics; tests read the same records from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.codec import decode_ticks


def read_topic(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest") -> DataFrame:
    """Message stream with ``key`` and ``value``; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )


def read_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files of a folder as a stream, in order of modification time."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def tick_stream(messages: DataFrame, watermark: str = "10 seconds") -> DataFrame:
    """Decoded ticks with a watermark on their timestamp."""
    return decode_ticks(messages).withWatermark("timestamp", watermark)
