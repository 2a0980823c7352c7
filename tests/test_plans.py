"""Plans stay free of Python, of cross joins and of single-task windows."""

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"
BATCH = [
    "window_stats_multi", "window_pack", "zscore_join", "zscore_records", "zscore_dedup", "lookahead_pairs",
    "lookahead_pack", "first_change", "time_to_change", "trip_clean", "trip_features", "compare_predictions",
    "threshold_metrics", "auc_rank", "gd_step", "distinct_rows", "tree_thresholds", "tree_split_gain",
    "median_tree_predict", "median_tree_importance", "zscore_scale", "json_decode", "weighted_metrics",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_plan(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    for operator in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan
    assert "InPandas" not in plan and "InArrow" not in plan
    spark.catalog.clearCache()


def test_scan_reads_only_needed_columns(spark):
    plan = plan_of(queries()["window_stats"](spark, SF))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["event_type", "ts", "value"]


def test_filters_reach_the_scan(spark):
    from tidemark.sources.tables import read_table
    from tidemark.operators.cleaning import drop_nonfinite

    df = drop_nonfinite(read_table(spark, SF, "lineitem").select("l_tax"), ["l_tax"])
    assert "PushedFilters: [IsNotNull(l_tax)" in df._jdf.queryExecution().executedPlan().toString()


def test_tree_walks_join_blocks_only(spark):
    """At depth 20 no row is shuffled to a level, with automatic broadcasts off too."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(queries()["tree_depth_grid"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert 1 <= plan.count("BroadcastHashJoin") <= 4
    spark.catalog.clearCache()
