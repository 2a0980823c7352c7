"""Trip-duration jobs: train a tree, choose its depth on held-out trips, predict new trips."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import from_log_label
from tidemark.operators.library_models import TREE_DEPTHS, depth_grid, depth_metrics
from tidemark.operators.median_tree import fit_median_tree
from tidemark.operators.metrics import best_candidate
from tidemark.operators.split import hash_split
from tidemark.operators.tree_nodes import NodeTree, impurity_importances, predict, split_importances, tree_lines
from tidemark.operators.trips import TRIP_FEATURES, feature_array, score_table, train_table
from tidemark.session import spread
from tidemark.sources.csv import metrics_frame

SPLIT = [0.8, 0.2]


@dataclass
class RegressionResult:
    tree: NodeTree
    depth_table: DataFrame
    metrics: DataFrame
    predictions: DataFrame


def trip_job(
    train_trips: DataFrame,
    test_trips: DataFrame,
    method: str = "library",
    depths: list[int] | None = None,
    inclusive_bounds: bool = False,
) -> RegressionResult:
    """``method`` is ``library`` (binned splits) or ``median`` (one median split per feature).

    One tree is grown to the largest depth; shallower candidates are cuts of it. Predictions carry
    the id with the row and are on the original scale. ``inclusive_bounds`` keeps trips on the edge
    of the service area. The depth table has validation and training figures per depth.
    """
    depths = depths or TREE_DEPTHS
    total_started = time.perf_counter()
    iso_week = method == "median"
    rows = feature_array(train_table(train_trips, inclusive_bounds, iso_week))
    train, validation = hash_split(rows, "id", SPLIT)
    train = spread(train).persist()
    started = time.perf_counter()
    if method == "median":
        full = fit_median_tree(train, TRIP_FEATURES, max(depths))
        table = depth_metrics(full, validation, depths)
    else:
        full, table = depth_grid(train, validation, TRIP_FEATURES, depths)
    on_train = depth_metrics(full, train, depths).select(
        "depth", F.col("rmse").alias("train_rmse"), F.col("r2").alias("train_r2")
    )
    table = table.join(on_train, "depth").checkpoint()
    seconds = time.perf_counter() - started
    best = best_candidate(table, "rmse", "depth", largest=False).first()
    tree = full.cut(best["depth"])
    train.unpersist()
    scored = predict(feature_array(score_table(test_trips, iso_week=iso_week)), tree)
    predictions = scored.select("id", from_log_label(F.col("prediction")).alias("prediction"))
    metrics = metrics_frame(
        train_trips.sparkSession,
        [
            ("best_max_depth", best["depth"]),
            ("validation_rmse", best["rmse"]),
            ("validation_r2", best["r2"]),
            ("train_rmse", best["train_rmse"]),
            ("train_r2", best["train_r2"]),
            ("impurity", "variance"),
            ("training_seconds", seconds),
            ("total_seconds", time.perf_counter() - total_started),
        ],
    )
    return RegressionResult(tree, table, metrics, predictions)


def result_tables(result: RegressionResult) -> DataFrame:
    """Metrics, feature importances and tree text as one ``(metric, value)`` table."""
    importances = split_importances(result.tree).select(
        F.concat(F.lit("importance of "), "name").alias("metric"), F.col("importance").cast("string").alias("value")
    )
    impurity = impurity_importances(result.tree).select(
        F.concat(F.lit("impurity importance of "), "name").alias("metric"),
        F.col("importance").cast("string").alias("value"),
    )
    by_depth = result.depth_table.select(
        F.concat(F.lit("depth "), F.col("depth").cast("string")).alias("metric"),
        F.to_json(F.struct("rmse", "r2", "train_rmse", "train_r2")).alias("value"),
    )
    lines = tree_lines(result.tree).select(
        F.concat(F.lit("tree line "), "position").alias("metric"), F.col("line").alias("value")
    )
    return result.metrics.unionByName(importances).unionByName(impurity).unionByName(by_depth).unionByName(lines)
