"""The price operators as streaming queries over event files, run until the input is used up."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.prices import (
    CHANGE_SQL,
    DURATIONS,
    PACK_SQL,
    PAIRS,
    SCORES,
    SCORES_SQL,
    SPAN,
    STATS,
    packed_stats_text,
    scores_text,
    tick_messages,
)
from tidemark.catalog.registry import query
from tidemark.operators import lookahead, window_stats, zscore
from tidemark.plans import prices as jobs
from tidemark.session import scratch_dir
from tidemark.sources import codec
from tidemark.sources.tables import as_ticks, read_table, ticks
from tidemark.streaming.sinks import fan_out, folder_writer, run_to_table, start
from tidemark.streaming.sources import read_files

WATERMARK = "10 seconds"

CLOSED = "(select max(ts) from ticks) - interval 10 seconds"
# A tick of a symbol of its own, far enough ahead for the watermark to close everything before it.
CLOSING_SYMBOL = "~closing"
CLOSING_GAP = "INTERVAL 30 DAYS"
PARTS = 3
# Ticks in a file of a part.
FILE_ROWS = 1_000_000


def _event_files(spark, sf_dir) -> DataFrame:
    schema = read_table(spark, sf_dir, "events").schema
    return read_files(spark, sf_dir, schema, pattern="events.parquet")


def _tick_stream(spark, sf_dir) -> DataFrame:
    """All ticks in several parts in order of time, one per batch, and the closing tick behind them.

    A part has as many files as its rows ask for. Ticks without a time come with the first part. An empty table
    gives an empty stream, without a closing tick.
    """
    events = read_table(spark, sf_dir, "events")
    path = scratch_dir(spark, "events")
    first, last, n_events = events.agg(F.min("ts"), F.max("ts"), F.count(F.lit(1))).first()
    files = max(1, -(-n_events // (PARTS * FILE_ROWS)))
    if first is None:
        events.repartition(files).write.parquet(path)
    else:
        bounds = [first + n * (last - first) / PARTS for n in range(PARTS)]
        for n in range(PARTS):
            part = events.filter(F.col("ts") >= F.lit(bounds[n])) if n else events
            if n + 1 < PARTS:
                part = part.filter(F.coalesce(F.col("ts") < F.lit(bounds[n + 1]), F.lit(True)))
            part.repartition(files).write.mode("append").parquet(path)
        closing = events.limit(1).withColumns(
            {"event_type": F.lit(CLOSING_SYMBOL), "ts": F.lit(last) + F.expr(CLOSING_GAP)}
        )
        closing.write.mode("append").parquet(path)
    stream = read_files(spark, path, events.schema, files_per_batch=files)
    return as_ticks(stream).withWatermark("timestamp", WATERMARK)


def _without_closing(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("symbol").eqNullSafe(CLOSING_SYMBOL))


@query("stream_tick_scan", """select event_type as symbol, round(value, 6) as price, ts as "timestamp" from events""")
def stream_tick_scan(spark, sf_dir):
    return run_to_table(as_ticks(_event_files(spark, sf_dir)), "tick-scan")


@query(
    "stream_sink_roundtrip",
    """select event_type as symbol, round(value, 6) as price, ts as "timestamp" from events""",
)
def stream_sink_roundtrip(spark, sf_dir):
    """Stream to a message sink and decode what was written."""
    return codec.decode_ticks(run_to_table(tick_messages(as_ticks(_event_files(spark, sf_dir))), "sink"))


@query(
    "stream_window_stats",
    f"""with {STATS}
    select wend as "timestamp", symbol, win as "window", round(avg_price, 6) as avg_price,
           round(std_price, 6) as std_price
    from stats""",
)
def stream_window_stats(spark, sf_dir):
    stats = window_stats.window_stats_multi(_tick_stream(spark, sf_dir), DURATIONS)
    return _without_closing(run_to_table(stats.drop("event_time"), "window-stats"))


@query("stream_window_pack", f"with {STATS} {PACK_SQL}")
def stream_window_pack(spark, sf_dir):
    packed = run_to_table(jobs.moving(_tick_stream(spark, sf_dir), DURATIONS), "window-pack")
    return packed_stats_text(_without_closing(packed))


@query(
    "stream_window_unpack",
    f"""with {STATS}
    select wend as "timestamp", symbol, win as "window", round(avg_price, 6) as avg_price,
           round(std_price, 6) as std_price
    from stats""",
)
def stream_window_unpack(spark, sf_dir):
    unpacked = window_stats.unpack_windows(jobs.moving(_tick_stream(spark, sf_dir), DURATIONS))
    return _without_closing(run_to_table(unpacked, "window-unpack"))


LATE = "event_id % 10 = 3 and ts < (select max(ts) from events) - interval 2 days"


@query(
    "stream_late_drop",
    "with "
    + STATS.replace("from events)", f"from events where not ({LATE}))")
    + f"""
    select wend as "timestamp", symbol, win as "window", round(avg_price, 6) as avg_price,
           round(std_price, 6) as std_price
    from stats where wend <= {CLOSED}""",
)
def stream_late_drop(spark, sf_dir):
    """A tenth of the older events arrives after the watermark passed them and must not count."""
    events = read_table(spark, sf_dir, "events")
    cut = events.agg((F.max("ts") - F.expr("INTERVAL 2 DAYS")).alias("cut")).first()["cut"]
    late = (F.col("event_id") % 10 == 3) & (F.col("ts") < F.lit(cut).cast("timestamp_ntz"))
    path = scratch_dir(spark, "late")
    for part in (events.filter(~late), events.filter(late)):
        part.write.mode("append").parquet(f"{path}/events")
        stream = as_ticks(read_files(spark, f"{path}/events", events.schema)).withWatermark("timestamp", WATERMARK)
        stats = window_stats.window_stats_multi(stream, DURATIONS).drop("event_time")
        # Restarted from its checkpoint, the query meets the second part as later input.
        start(
            stats, "parquet", f"{path}/_checkpoint", available_now=True, path=f"{path}/stats"
        ).awaitTermination()
    return spark.read.schema(stats.schema).parquet(f"{path}/stats")


@query("stream_zscore", f"with {SCORES} {SCORES_SQL}")
def stream_zscore(spark, sf_dir):
    records = run_to_table(jobs.zscores(_tick_stream(spark, sf_dir), DURATIONS), "zscore")
    return scores_text(_without_closing(records))


@query("stream_lookahead", f"with {PAIRS} {CHANGE_SQL}")
def stream_lookahead(spark, sf_dir):
    return _without_closing(run_to_table(jobs.changes(_tick_stream(spark, sf_dir), SPAN), "lookahead"))


@query("stream_lookahead_pairs", f"with {PAIRS} {CHANGE_SQL}")
def stream_lookahead_pairs(spark, sf_dir):
    """The same by a self-join of the stream and an aggregate over its pairs."""
    pairs = lookahead.lookahead_pairs(_tick_stream(spark, sf_dir), SPAN, ranges=True)
    return _without_closing(run_to_table(lookahead.first_change(pairs, SPAN), "lookahead-pairs"))


@query(
    "stream_lookahead_fanout",
    f"""with {PAIRS}, changes as ({CHANGE_SQL})
    select base_timestamp as "timestamp", 'higher' as kind, time_to_increase as wait from changes
    union all select base_timestamp, 'lower', time_to_decrease from changes""",
)
def stream_lookahead_fanout(spark, sf_dir):
    """Two outputs of one stream, written as JSON messages by each micro-batch."""
    path = scratch_dir(spark, "fanout")
    kinds = {"higher": "time_to_increase", "lower": "time_to_decrease"}

    def encoder(kind: str):
        return lambda batch: codec.encode_change(batch, kinds[kind], f"{kind}_window")

    writers = [folder_writer(f"{path}/{kind}", encoder(kind)) for kind in kinds]
    changes = jobs.changes(_tick_stream(spark, sf_dir), SPAN)
    fan_out(changes, writers, f"{path}/_checkpoint", available_now=True).awaitTermination()
    parts = []
    for kind in kinds:
        schema = f"timestamp string, {kind}_window double"
        data = spark.read.parquet(f"{path}/{kind}").select(F.from_json("value", schema).alias("d"))
        parts.append(
            data.select(
                F.col("d.timestamp").cast("timestamp").alias("timestamp"),
                F.lit(kind).alias("kind"),
                F.col(f"d.{kind}_window").alias("wait"),
            )
        )
    return parts[0].unionByName(parts[1])


@query(
    "zscore_routed",
    f"""with {SCORES}
    select ts as "timestamp", symbol, win as "window", round(cast(cast(z as float) as double), 6) as zscore_price
    from scores where win is not null""",
)
def zscore_routed(spark, sf_dir):
    """Z-score messages streamed into one partition folder per window label."""
    source = ticks(spark, sf_dir)
    stats = window_stats.window_stats_multi(source, DURATIONS)
    path = scratch_dir(spark, "zscore-messages")
    codec.encode(zscore.zscore_records(source, stats, DURATIONS)).write.parquet(path)
    messages = read_files(spark, path, "key string, value string")
    routed = jobs.routed(codec.decode_zscores(messages))
    return run_to_table(routed, "zscore-routed", partition_by=["window"])


@query(
    "stream_fanout_restart",
    f"""with {PAIRS}, changes as ({CHANGE_SQL})
    select symbol, base_timestamp as "timestamp", 'higher' as kind, time_to_increase as wait from changes
    union all select symbol, base_timestamp, 'lower', time_to_decrease from changes""",
)
def stream_fanout_restart(spark, sf_dir):
    """Two outputs that only append; the second fails once, and the query is started again."""
    path = scratch_dir(spark, "fanout-restart")
    changes = jobs.changes(_tick_stream(spark, sf_dir), SPAN)
    failed: list[int] = []

    def appender(kind: str, column: str, fails: bool):
        def write(batch: DataFrame, batch_id: int) -> None:
            if fails and batch_id == 1 and not failed:
                failed.append(batch_id)
                raise ConnectionError("output lost")
            rows = batch.select("symbol", F.col("base_timestamp").alias("timestamp"), F.lit(kind).alias("kind"), F.col(column).alias("wait"))
            rows.write.mode("append").parquet(f"{path}/data")

        return write

    writers = {
        "higher": appender("higher", "time_to_increase", False),
        "lower": appender("lower", "time_to_decrease", True),
    }
    for _ in range(2):
        running = fan_out(changes, writers, f"{path}/_checkpoint", available_now=True)
        try:
            running.awaitTermination()
        except StreamingQueryException as error:
            if "output lost" not in str(error):
                raise
    # The closing tick is filtered last: before the output, the filter would reach the scan and hide it from the watermark.
    return _without_closing(
        spark.read.schema("symbol string, timestamp timestamp, kind string, wait double").parquet(f"{path}/data")
    )
