"""Tick streams of empty tables, of null times and symbols, and of parts with several files."""

import datetime

import pytest

from __spark_entry__ import queries
from tidemark.catalog import streams

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
START = datetime.datetime(2024, 1, 1)


def events(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.mark.parametrize("rows", [[], [(1, None, 1, "a", 1.0)]])
def test_nothing_to_window(spark, tmp_path, rows):
    assert queries()["stream_window_stats"](spark, events(spark, tmp_path, rows)).count() == 0


def test_null_rows_and_several_files_per_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 40)
    rows = [(i, START + datetime.timedelta(seconds=5 * i), 1, None if i % 4 == 0 else f"s{i % 3}", float(i)) for i in range(400)]
    path = events(spark, tmp_path, [*rows, (400, None, 1, "s1", 1.0)])
    columns = ["timestamp", "symbol", "window", "avg_price", "std_price"]
    found = lambda name: sorted(str(tuple(r)) for r in queries()[name](spark, path).select(*columns).collect())
    assert found("stream_window_stats") == found("window_stats_multi")


def test_stream_pairs_keep_ticks_not_pairs(spark, tmp_path, monkeypatch):
    """A million pairs in a stream: same answer as in batch, and the self-join passes on a row per bucket."""
    rows = [(i, START + datetime.timedelta(seconds=2 * (i // 2)), 1, None if i % 50 == 0 else f"s{i % 2}", float(i % 7)) for i in range(3000)]
    path = events(spark, tmp_path, [*rows, *rows[:40], (3000, None, 1, "s1", 1.0)])
    made = []
    run = streams.run_to_table

    def watched(df, label):
        table = run(df, label)
        made.append(df._jdf.queryExecution().analyzed().toString())
        return table

    monkeypatch.setattr(streams, "run_to_table", watched)
    found = lambda name: sorted(str(tuple(r)) for r in queries()[name](spark, path).collect())
    assert found("stream_lookahead_pairs") == found("time_to_change")
    # Both sides are gathered before they are joined, and nothing is grouped behind the join.
    above, below = made[0].split("Join", 1)
    assert "Aggregate" not in above and below.count("Aggregate") == 2
