"""Nothing is cut off, lost or left to size: splits, look-ahead, trees, sinks and sessions."""

import datetime
import math
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookahead, median_tree, tree_nodes
from tidemark.operators.library_models import fit_tree, node_tree, with_vectors
from tidemark.operators.split import hash_split
from tidemark.operators.trips import TRIP_FEATURES, score_table, train_table, unscored
from tidemark.session import scratch_dir, spread
from tidemark.sources import csv
from tidemark.sources.tables import trips
from tidemark.streaming.sinks import collection_writer

SMALL = "/root/testdata/sf0.001"
INF, NAN = float("inf"), float("nan")


def test_splits_add_up_for_fine_weights_and_null_keys(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 10 > 0, F.col("id").cast("string")).alias("key"))
    parts = [p.count() for p in hash_split(df, "key", [0.999, 0.0007, 0.0003])]
    assert sum(parts) == 60_000
    assert parts[1] > 0 and parts[2] > 0


def ticks_of(spark, rows):
    start = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [("s", p, start + datetime.timedelta(seconds=t)) for t, p in rows], "symbol string, price double, timestamp timestamp"
    )


def test_not_a_number_is_neither_lower_nor_higher(spark):
    ticks = ticks_of(spark, [(0, 1.0), (2, NAN), (5, 3.0), (8, 2.0), (9, None), (9, NAN)])
    columns = ["base_timestamp", "base_price", "time_to_decrease", "time_to_increase"]
    rows = lambda df: sorted(str(tuple(r)) for r in df.select(*columns).collect())
    by_scan = rows(lookahead.time_to_change(ticks))
    assert by_scan == rows(lookahead.first_change(lookahead.lookahead_pairs(ticks)))
    got = {r["base_timestamp"].second: tuple(r)[2:] for r in lookahead.time_to_change(ticks).select(*columns).collect()}
    assert got[0] == (20.0, 5.0) and got[2] == (20.0, 20.0) and got[5] == (3.0, 20.0) and got[8] == (20.0, 20.0)


def thresholds(spark, values, sort_rows):
    rows = spark.createDataFrame([([float(v)], float(i), 1) for i, v in enumerate(values)], "features array<double>, label double, node long")
    splits, _ = median_tree.median_splits(median_tree.value_sums(rows), 1, sort_rows)
    return [r["threshold"] for r in splits.collect()]


@pytest.mark.parametrize(
    "values",
    [
        [-INF, *range(50), INF], [*range(50), INF, NAN], [-1.7e308, *range(49), 1.7e308], [1e300, *[i * 1e-9 for i in range(60)]],
        [0.0, 5e-324, 1e-323, 1.5e-323] * 5, [-INF, INF], list(range(2000)),
    ],
)
def test_medians_of_any_numbers(spark, values):
    known = sorted(set(values), key=lambda v: (math.isnan(v), v))
    want = known[len(known) // 2]
    for sort_rows in (10, 200_000):
        assert thresholds(spark, values, sort_rows) == [want]


@pytest.mark.parametrize("scale", [1e-10, 1.0, 2e9, 1e15])
def test_labels_of_any_size(spark, scale):
    rows = spark.createDataFrame([([float(i)], scale * (1 + 2 * (i > 4))) for i in range(10)], "features array<double>, label double")
    odd = spark.createDataFrame([([INF], scale), ([NAN], scale), ([None], scale), ([1.0], None)], rows.schema)
    tree = median_tree.fit_median_tree(rows.union(odd), ["x"], 3)
    by_node = {r["node"]: r for r in tree.nodes.collect()}
    assert by_node[1]["n_rows"] == 10
    assert by_node[1]["prediction"] == pytest.approx(2 * scale)
    assert max(r["prediction"] for r in by_node.values()) == pytest.approx(3 * scale)


def test_trees_too_deep_are_refused(spark):
    with pytest.raises(ValueError):
        median_tree.fit_median_tree(spark.createDataFrame([([1.0], 1.0)], "features array<double>, label double"), ["x"], 70)


def test_impurity_importance_is_the_library_ones(spark):
    rows = spark.range(500).select(
        F.array((F.col("id") % 17).cast("double"), (F.col("id") % 5).cast("double"), F.lit(1.0)).alias("features"),
        ((F.col("id") % 17) * 2 + F.col("id") % 5).cast("double").alias("label"),
    )
    model = fit_tree(with_vectors(rows), 4)
    got = {r["feature"]: r["importance"] for r in tree_nodes.impurity_importances(node_tree(model, ["a", "b", "c"], spark)).collect()}
    assert [got[i] for i in range(3)] == pytest.approx(model.featureImportances.toArray().tolist(), abs=1e-9)


def test_trips_with_infinite_features(spark):
    odd = trips(spark, SMALL).limit(4).withColumns(
        {"id": F.concat(F.lit("odd"), F.monotonically_increasing_id()), "passenger_count": F.lit(INF)}
    )
    plain = trips(spark, SMALL)
    every = plain.withColumn("passenger_count", F.col("passenger_count").cast("double")).unionByName(odd)
    assert train_table(every).count() == train_table(plain).count()
    assert score_table(every).count() + unscored(every).count() == every.count()
    assert unscored(every).count() == 4
    assert set(score_table(every).columns) == {"id", *TRIP_FEATURES}


def test_header_lines_anywhere(spark, tmp_path):
    (tmp_path / "a.csv").write_text('t,x,Class\n1,2.5,"""1"""\nt,x,Class\n2,3.5,0\n')
    rows = csv.read_labelled(spark, str(tmp_path / "a.csv"), ["t", "x", "Class"])
    assert sorted((r["features"][0], r["label"]) for r in rows.collect()) == [(2.5, 1), (3.5, 0)]


def test_collections_are_the_same_after_a_replay(spark, tmp_path):
    rows = spark.createDataFrame([("s", 1, "1m", 0.5), ("s", 1, "1m", 0.5), ("s", 2, "5m", 1.5)], "symbol string, timestamp long, window string, z double")
    write = collection_writer("parquet", ["1m", "5m"], lambda label: {"path": f"{tmp_path}/{label}"})
    write(rows, 7)
    write(rows, 7)
    assert spark.read.parquet(f"{tmp_path}/1m").drop("batch_id").count() == 1
    assert spark.read.parquet(f"{tmp_path}/5m").drop("batch_id").count() == 1
    with pytest.raises(ValueError, match="2h"):
        write(rows.withColumn("window", F.lit("2h")), 8)


def test_spread_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("spread", "no jobs")
    df = spread(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    assert tracker.getJobIdsForGroup("spread") == []
    spark.sparkContext._jsc.clearJobGroup()
    assert df.count() == 7


def test_runs_from_any_folder_and_cleans_up(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
from __spark_entry__ import queries
from tidemark.session import scratch_dir
print("ROWS", queries()["time_to_change"](spark, {SMALL!r}).count())
spark.range(3).write.parquet(scratch_dir(spark, "kept"))
spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
    assert not [p for p in os.listdir(tmp_path / "shared") if p.startswith("kept")]


def test_scratch_folders_differ(spark):
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")
