"""JSON record codec: key and value as carried by a message topic."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import TICK_TIMESTAMP_FORMAT, parse_tick_timestamp


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_WINDOW_STAT = [("window", T.StringType()), ("avg_price", T.DoubleType()), ("std_price", T.DoubleType())]

# Record layouts of the tick, window-stat, packed-stat and z-score topics.
TICK_SCHEMA = _struct(("symbol", T.StringType()), ("price", T.DoubleType()), ("timestamp", T.StringType()))
STAT_SCHEMA = _struct(("timestamp", T.TimestampType()), ("symbol", T.StringType()), *_WINDOW_STAT)
PACKED_SCHEMA = _struct(
    ("timestamp", T.TimestampType()),
    ("symbol", T.StringType()),
    ("windows", T.ArrayType(_struct(*_WINDOW_STAT))),
)
ZSCORE_SCHEMA = _struct(
    ("timestamp", T.StringType()),
    ("symbol", T.StringType()),
    ("zscores", T.ArrayType(_struct(("window", T.StringType()), ("zscore_price", T.FloatType())))),
)


def decode(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` from the binary or text ``value`` column; bad records give nulls."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def decode_ticks(messages: DataFrame) -> DataFrame:
    return decode(messages, TICK_SCHEMA).withColumn("timestamp", parse_tick_timestamp(F.col("timestamp")))


def decode_zscores(messages: DataFrame) -> DataFrame:
    return decode(messages, ZSCORE_SCHEMA).withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))


def encode(df: DataFrame, key: str = "symbol") -> DataFrame:
    """``key`` and the whole row as JSON ``value``; times keep their microseconds."""
    value = F.to_json(F.struct("*"), {"timestampFormat": TICK_TIMESTAMP_FORMAT})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def encode_change(changes: DataFrame, column: str, field: str) -> DataFrame:
    """``value`` only: base time as text and one waiting time under its own name."""
    return changes.select(
        F.to_json(
            F.struct(F.col("base_timestamp").cast("string").alias("timestamp"), F.col(column).alias(field))
        ).alias("value")
    )
