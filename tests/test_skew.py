"""Same results when half of all rows share one key and nothing may be broadcast by size."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookahead, zscore
from tidemark.operators.window_stats import window_stats_multi
from tidemark.sources.tables import ticks

SF = "/root/testdata/sf0.001"
DURATIONS = ["1 hour", "6 hours"]
FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
}


@pytest.fixture
def forced(spark):
    before = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_ticks(spark):
    """One symbol and one hour hold most ticks, many of them at the same instant."""
    base = ticks(spark, SF)
    hot = base.select(
        F.lit("hot").alias("symbol"),
        "price",
        F.timestamp_micros(F.unix_micros(F.lit("2024-01-05 10:00:00").cast("timestamp")) + F.unix_micros("timestamp") % 1800 * 1_000_000)
        .alias("timestamp"),
    )
    return base.unionByName(hot)


def rows_of(df):
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.collect())


BUILDERS = {
    "stats": lambda t: window_stats_multi(t, DURATIONS),
    "rows": lambda t: zscore.zscore_rows(t, window_stats_multi(t, DURATIONS), DURATIONS),
    "records": lambda t: zscore.unpack_zscores(zscore.zscore_records(t, window_stats_multi(t, DURATIONS), DURATIONS)),
    "changes": lambda t: lookahead.time_to_change(t, 60),
    "pairs": lambda t: lookahead.first_change(lookahead.lookahead_pairs(t, 60), 60),
}
plain_results = {}


@pytest.mark.parametrize("name", BUILDERS)
def test_plain(spark, name):
    plain_results[name] = rows_of(BUILDERS[name](hot_ticks(spark)))
    assert plain_results[name]


@pytest.mark.parametrize("name", BUILDERS)
def test_forced(spark, forced, name):
    assert rows_of(BUILDERS[name](hot_ticks(spark))) == plain_results[name]


def test_scan_equals_pairs(spark):
    assert plain_results["changes"] == plain_results["pairs"]


def test_skewed_join_is_split(spark, forced):
    # A partition is split between map outputs, so the hot rows must come from several.
    t = hot_ticks(spark).repartition(6)
    df = zscore.zscore_rows(t, window_stats_multi(t, DURATIONS), DURATIONS)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_records_need_no_second_shuffle_of_ticks(spark, forced):
    t = hot_ticks(spark)
    plan = zscore.zscore_records(t, window_stats_multi(t, DURATIONS), DURATIONS)
    text = plan._jdf.queryExecution().executedPlan().toString()
    top = text.split("SortMergeJoin")[0]
    assert "Exchange" not in top
