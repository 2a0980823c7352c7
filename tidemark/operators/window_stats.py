"""Average and deviation of prices per tumbling window, in one or several sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timewin import (
    WINDOW_LABELS,
    duration_seconds,
    window_end,
    window_label,
)

DEFAULT_DURATIONS = list(WINDOW_LABELS)


def _std_or_zero() -> Column:
    """One price has no sample deviation; report 0 for it."""
    return F.when(F.col("n_prices") == 1, F.lit(0.0)).otherwise(F.col("std_price"))


def _price_aggregates() -> list[Column]:
    return [
        F.avg("price").alias("avg_price"),
        F.stddev_samp("price").alias("std_price"),
        F.count("price").alias("n_prices"),
    ]


def window_stats(ticks: DataFrame, duration: str) -> DataFrame:
    """One row per (window, symbol): ``timestamp`` (window end), symbol, window, avg and std.

    Streaming input gets an extra ``event_time`` column that keeps the watermark, which the
    window end does not; later stateful steps group and join on it.
    """
    grouped = ticks.groupBy(F.window("timestamp", duration).alias("win"), "symbol").agg(*_price_aggregates())
    columns = [
        F.col("win.end").alias("timestamp"),
        "symbol",
        F.lit(window_label(duration)).alias("window"),
        "avg_price",
        _std_or_zero().alias("std_price"),
    ]
    if ticks.isStreaming:
        columns.insert(0, F.window_time("win").alias("event_time"))
    return grouped.select(*columns)


def window_stats_multi(ticks: DataFrame, durations: list[str] | None = None) -> DataFrame:
    """Stats for every duration.

    Batch input is scanned once: each row fans out to its windows before the map-side
    aggregate, so only per-window partial moments are shuffled. A stream needs ``window()``
    itself to keep the watermark and takes one aggregate per size.
    """
    durations = durations or DEFAULT_DURATIONS
    if ticks.isStreaming:
        return reduce(DataFrame.unionByName, [window_stats(ticks, d) for d in durations])
    windows = F.array(
        *[
            F.struct(
                F.lit(window_label(d)).alias("window"),
                window_end(F.col("timestamp"), duration_seconds(d)).alias("timestamp"),
            )
            for d in durations
        ]
    )
    return (
        ticks.filter(F.col("timestamp").isNotNull())
        .select("symbol", "price", F.inline(windows))
        .groupBy("timestamp", "symbol", "window")
        .agg(*_price_aggregates())
        .select("timestamp", "symbol", "window", "avg_price", _std_or_zero().alias("std_price"))
    )


def pack_windows(stats: DataFrame) -> DataFrame:
    """Gather the stats that end at the same time per symbol; at most one entry per size."""
    entries = F.array_sort(F.collect_list(F.struct("window", "avg_price", "std_price"))).alias("windows")
    if stats.isStreaming:
        # Event time is the window end minus one microsecond.
        end = F.timestamp_micros(F.unix_micros("event_time") + 1).alias("timestamp")
        packed = stats.groupBy("event_time", "symbol").agg(entries)
        return packed.select("event_time", end, "symbol", "windows")
    return stats.groupBy("timestamp", "symbol").agg(entries)


def unpack_windows(packed: DataFrame) -> DataFrame:
    """Inverse of :func:`pack_windows`; empty arrays vanish."""
    keys = [c for c in packed.columns if c != "windows"]
    return packed.select(*keys, F.inline("windows"))
