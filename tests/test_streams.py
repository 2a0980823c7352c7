import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.window_stats import window_stats_multi
from tidemark.plans import prices as jobs
from tidemark.session import scratch_dir
from tidemark.streaming import sinks
from tidemark.streaming.sources import read_files, tick_stream

START = datetime(2024, 3, 1, 12, 0, 0)


def write_ticks(spark, path, rows):
    data = [(s, float(p), START + timedelta(seconds=t)) for s, t, p in rows]
    spark.createDataFrame(data, "symbol string, price double, timestamp timestamp").write.mode("append").parquet(path)


def open_ticks(spark, path, delay="10 seconds"):
    return read_files(spark, path, "symbol string, price double, timestamp timestamp").withWatermark("timestamp", delay)


def test_open_windows_are_not_emitted(spark):
    path = scratch_dir(spark, "t")
    write_ticks(spark, path, [("A", 1, 1), ("A", 2, 3), ("A", 31, 5), ("A", 45, 7)])
    out = sinks.run_to_table(window_stats_multi(open_ticks(spark, path), ["30 seconds"]).drop("event_time"), "o")
    assert [(r["timestamp"], r["avg_price"]) for r in out.collect()] == [(START + timedelta(seconds=30), 2.0)]


def test_stream_equals_batch_for_default_windows(spark):
    """Published windows and watermark, ticks every 3 s, and a far tick that closes everything."""
    path = scratch_dir(spark, "t")
    rows = [("A", t, (t * 7) % 11) for t in range(0, 4000, 3)] + [("B", t, t % 5) for t in range(0, 900, 10)]
    write_ticks(spark, path, [*rows, ("A", 40_000, 1)])
    records = sinks.run_to_table(jobs.zscores(open_ticks(spark, path)), "z")

    from tidemark.operators.zscore import zscore_records

    batch = spark.read.parquet(path)
    want = zscore_records(batch, window_stats_multi(batch))

    def plain(df):
        early = df.filter(F.col("timestamp") < F.lit(START + timedelta(seconds=20_000)))
        return sorted(
            (r["timestamp"], r["symbol"], [(z[0], None if z[1] is None else round(z[1], 9)) for z in r["zscores"]])
            for r in early.collect()
        )

    assert len(plain(want)) == len(rows)
    assert plain(records) == plain(want)


def test_messages_to_changes(spark):
    """JSON messages in, look-ahead out, with the published span and watermark."""
    path = scratch_dir(spark, "m")
    lines = [
        f'{{"symbol": "A", "price": {p}, "timestamp": "2024-03-01T12:{t // 60:02d}:{t % 60:02d}.000000+00:00"}}'
        for t, p in [(0, 5.0), (4, 6.0), (9, 4.0), (600, 1.0)]
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").write.parquet(path)
    ticks = tick_stream(read_files(spark, path, "value string"), "25 seconds")
    got = sinks.run_to_table(jobs.changes(ticks), "c").orderBy("base_timestamp").collect()
    assert [(r["base_price"], r["time_to_decrease"], r["time_to_increase"]) for r in got] == [
        (5.0, 9.0, 4.0),
        (6.0, 5.0, 20.0),
    ]


def test_fan_out_writes_every_output_and_replaces_on_replay(spark):
    path = scratch_dir(spark, "f")
    write = sinks.folder_writer(f"{path}/a", lambda df: df.select("symbol"))
    batch = spark.createDataFrame([("A",), ("B",)], "symbol string")
    write(batch, 3)
    write(batch, 3)
    assert spark.read.parquet(f"{path}/a").count() == 2


def test_replays_reach_only_outputs_that_lack_the_batch(spark):
    """An output fails in the second batch; later the mark of a finished batch is lost as well."""
    path = scratch_dir(spark, "replay")
    broken = []

    def appender(name):
        def write(batch, batch_id):
            if name == "b" and batch_id == 1 and not broken:
                broken.append(batch_id)
                raise ConnectionError("lost")
            batch.write.mode("append").parquet(f"{path}/{name}")

        return write

    def run():
        stats = window_stats_multi(open_ticks(spark, f"{path}/ticks"), ["30 seconds"]).drop("event_time")
        query = sinks.fan_out(stats, {n: appender(n) for n in "ab"}, f"{path}/check", available_now=True)
        query.awaitTermination()

    def ends(name):
        return sorted(int((r["timestamp"] - START).total_seconds()) for r in spark.read.parquet(f"{path}/{name}").collect())

    write_ticks(spark, f"{path}/ticks", [("A", 1, 1), ("A", 45, 7)])
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert ends("a") == ends("b") == [30]
    last = max(int(n) for n in os.listdir(f"{path}/check/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(f"{path}/check/commits/{name}"):
            os.remove(f"{path}/check/commits/{name}")
    run()
    assert ends("a") == ends("b") == [30]
    # State went on through the replayed batch: the open window still holds its first tick.
    write_ticks(spark, f"{path}/ticks", [("A", 50, 9), ("A", 200, 1)])
    run()
    assert ends("a") == ends("b") == [30, 60]
    assert spark.read.parquet(f"{path}/b").agg(F.max("avg_price")).first()[0] == 8.0


def test_collection_writer_splits_by_label(spark):
    path = scratch_dir(spark, "col")
    write = sinks.collection_writer("parquet", ["1m", "5m"], lambda w: {"path": f"{path}/zscore_{w}"})
    write(spark.createDataFrame([("1m", 1.0), ("5m", 2.0), ("1m", 3.0)], "window string, zscore_price double"), 0)
    assert spark.read.parquet(f"{path}/zscore_1m").count() == 2
    assert spark.read.parquet(f"{path}/zscore_5m").count() == 1


def test_a_stream_that_does_not_start_is_skipped(spark):
    path = scratch_dir(spark, "s")
    write_ticks(spark, path, [("A", 1, 1)])

    def good():
        df = open_ticks(spark, path)
        return sinks.start(df, "parquet", f"{path}-chk", available_now=True, path=f"{path}-out")

    def bad():
        raise RuntimeError("no such sink")

    queries = sinks.start_each({"bad": bad, "good": good})
    sinks.await_all(queries)
    assert len(queries) == 1
    assert spark.read.parquet(f"{path}-out").count() == 1


def test_late_rows_are_dropped(spark):
    path = scratch_dir(spark, "late")

    def run():
        stats = window_stats_multi(open_ticks(spark, path), ["30 seconds"]).drop("event_time")
        sinks.start(stats, "parquet", f"{path}-chk", available_now=True, path=f"{path}-out").awaitTermination()
        return stats.schema

    write_ticks(spark, path, [("A", 1, 1), ("A", 100, 1)])
    run()
    write_ticks(spark, path, [("A", 2, 99), ("A", 200, 1)])
    schema = run()
    got = spark.read.schema(schema).parquet(f"{path}-out").orderBy("timestamp").collect()
    assert [(r["timestamp"] - START).total_seconds() for r in got] == [30.0, 120.0]
    assert got[0]["avg_price"] == 1.0


def test_topic_source_needs_the_connector(spark):
    from tidemark.streaming.sources import read_topic

    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "localhost:9092", "ticks")
