"""Streaming price jobs: window stats, z-scores, look-ahead.

Each job is one query from ticks to result; event time is carried between stateful steps, so no
intermediate topic is needed. Watermark delays default to the published settings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.timewin import WINDOW_LABELS
from tidemark.operators.lookahead import DEFAULT_SPAN_SECONDS, time_to_change
from tidemark.operators.window_stats import DEFAULT_DURATIONS, pack_windows, window_stats_multi
from tidemark.operators.zscore import unpack_zscores, zscore_stream
from tidemark.sources.codec import decode_zscores, encode_change
from tidemark.streaming.sinks import collection_writer, fan_out, start_topic
from tidemark.streaming.sources import read_topic, tick_stream

# Watermark delays of the jobs.
MOVING_WATERMARK = "10 seconds"
ZSCORE_WATERMARK = "10 seconds"
CHANGE_WATERMARK = "25 seconds"


def moving(ticks: DataFrame, durations: list[str] | None = None) -> DataFrame:
    """Watermarked ticks to packed window stats: ``timestamp, symbol, windows``."""
    return pack_windows(window_stats_multi(ticks, durations)).select("timestamp", "symbol", "windows")


def zscores(ticks: DataFrame, durations: list[str] | None = None) -> DataFrame:
    """Watermarked ticks to packed z-scores: ``timestamp, symbol, zscores``."""
    durations = durations or DEFAULT_DURATIONS
    return zscore_stream(ticks, window_stats_multi(ticks, durations), durations)


def changes(ticks: DataFrame, span_seconds: int = DEFAULT_SPAN_SECONDS) -> DataFrame:
    """Watermarked ticks to seconds until the next lower and higher price."""
    return time_to_change(ticks, span_seconds)


def routed(records: DataFrame) -> DataFrame:
    """Flat z-scores ready to be partitioned by ``window``."""
    return unpack_zscores(records).filter(F.col("window").isNotNull())


def moving_topic_job(
    spark, servers: str, source: str, target: str, checkpoint: str, watermark: str = MOVING_WATERMARK
) -> StreamingQuery:
    ticks = tick_stream(read_topic(spark, servers, source), watermark)
    return start_topic(moving(ticks), servers, target, f"{checkpoint}/{target}")


def zscore_topic_job(
    spark, servers: str, source: str, target: str, checkpoint: str, watermark: str = ZSCORE_WATERMARK
) -> StreamingQuery:
    ticks = tick_stream(read_topic(spark, servers, source), watermark)
    return start_topic(zscores(ticks), servers, target, f"{checkpoint}/{target}")


def load_topic_job(
    spark,
    servers: str,
    source: str,
    fmt: str,
    options_for: Callable[[str], dict[str, str]],
    checkpoint: str,
    labels: list[str] | None = None,
) -> StreamingQuery:
    """Z-score messages into one collection per window label, with one scan and one query for all.

    ``options_for`` gives the connector options of a label, such as its collection name.
    """
    rows = routed(decode_zscores(read_topic(spark, servers, source, "latest")))
    writer = collection_writer(fmt, labels or list(WINDOW_LABELS.values()), options_for)
    return fan_out(rows, [writer], f"{checkpoint}/{source}-load")


def change_topic_job(
    spark, servers: str, source: str, higher: str, lower: str, checkpoint: str, watermark: str = CHANGE_WATERMARK
) -> StreamingQuery:
    """Both topics are written from one computed stream.

    A batch that is replayed after a failure goes only to the topic that had not got all of it. A topic
    only appends, so one that was lost on the way gets that batch again; messages carry the tick's
    time, by which readers keep one.
    """
    ticks = tick_stream(read_topic(spark, servers, source, "latest"), watermark)

    def to_topic(topic: str, column: str, field: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            out = encode_change(batch, column, field).write.format("kafka")
            out.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

        return write

    writers = {
        higher: to_topic(higher, "time_to_increase", "higher_window"),
        lower: to_topic(lower, "time_to_decrease", "lower_window"),
    }
    return fan_out(changes(ticks), writers, f"{checkpoint}/{higher}-{lower}")
