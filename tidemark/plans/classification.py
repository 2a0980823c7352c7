"""Rare-event classification jobs, from a table with a 0/1 label to a metrics table.

All three use keyed splits, so a lost executor or a re-read cannot move rows between splits.
"""

from __future__ import annotations

import time

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cleaning import distinct_rows, drop_nan, drop_nulls
from tidemark.operators.library_models import fit_logistic, library_auc
from tidemark.operators.logistic import (
    GDParams,
    SGD_ITERATIONS,
    SGD_STEPS,
    gd_search,
    logistic_score,
    score_candidates,
    sgd_train,
)
from tidemark.operators.metrics import (
    binary_metrics,
    hard_cross_entropy,
    threshold_metrics,
    weighted_metrics,
    with_hard_cross_entropy,
    with_rates,
)
from tidemark.operators.scale import array_moments, scale_array, scale_columns
from tidemark.operators.split import hash_split, split_number
from tidemark.session import spread
from tidemark.sources.csv import metrics_frame

SPLIT = [0.7, 0.1, 0.2]


def library_job(
    data: DataFrame, key: str, columns: list[str], label: str, max_iter: int = 10, weights: list[float] | None = None
) -> DataFrame:
    """Scale, fit by L-BFGS, and report coefficients and train / test metrics."""
    label_value = F.col(label).cast("double").alias("label")
    rows = drop_nulls(data).select(
        split_number(F.col(key), weights or SPLIT).alias("split"), *[F.col(c).cast("double") for c in columns], label_value
    )
    # Moments of the training rows in one aggregate; scaling stays in column expressions.
    scaled = scale_columns(rows, rows.filter("split = 0"), columns).select(
        "split", array_to_vector(F.array(*columns)).alias("features"), "label"
    )
    last = len(weights or SPLIT) - 1
    train = spread(scaled.filter("split = 0").drop("split")).persist()
    test = scaled.filter(F.col("split") == last).drop("split")
    started = time.perf_counter()
    model = fit_logistic(train, max_iter)
    seconds = time.perf_counter() - started
    predictions = model.transform(test).persist()
    m, w = binary_metrics(predictions).first(), weighted_metrics(predictions).first()
    summary = model.summary
    result = [
        ("coefficients", model.coefficients.toArray().tolist()),
        ("intercept", model.intercept),
        ("training_seconds", seconds),
        ("accuracy_train", summary.accuracy),
        ("accuracy_test", m["accuracy"]),
        ("auc_train", library_auc(model.transform(train))),
        ("auc_train_summary", summary.areaUnderROC),
        ("auc_test", library_auc(predictions)),
        ("precision_test", m["precision"]),
        ("recall_test", m["recall"]),
        ("f1_test", m["f1_score"]),
        ("weighted_precision_test", w["weighted_precision"]),
        ("weighted_recall_test", w["weighted_recall"]),
    ]
    predictions.unpersist()
    train.unpersist()
    return metrics_frame(data.sparkSession, result)


def _array_splits(data: DataFrame, key: str, columns: list[str], label: str) -> list[DataFrame]:
    rows = drop_nulls(data).select(
        key,
        F.array(*[F.col(c).cast("double") for c in columns]).alias("features"),
        F.col(label).cast("double").alias("label"),
    )
    return hash_split(rows, key, SPLIT)


def sgd_job(
    data: DataFrame,
    key: str,
    columns: list[str],
    label: str,
    steps: list[float] | None = None,
    iterations: list[int] | None = None,
) -> DataFrame:
    """Search step and iteration count by validation F1; test metrics come from the best model."""
    train, validation, test = _array_splits(data, key, columns, label)
    means, stds = array_moments(train, len(columns), sample=True)
    # The library route has no intercept, so the appended bias position is cut off again.
    size = len(columns)
    train, validation, test = (
        scale_array(s, means, stds).withColumn("features", F.slice("features", 1, size)).select("features", "label")
        for s in (train, validation, test)
    )
    train = spread(train).persist()
    started = time.perf_counter()
    models = sgd_train(train, size, steps or SGD_STEPS, iterations or SGD_ITERATIONS)
    seconds = time.perf_counter() - started
    weights = [m.weights for m in models]
    on_train, on_validation = (_candidate_rates(rows, weights) for rows in (train, validation))
    # Ties, and a search in which every score is zero, go to the first candidate.
    best = max(range(len(models)), key=lambda i: (on_validation.get(i, {}).get("f1_score", 0.0), -i))
    winner = models[best]
    tested = logistic_score(test, winner.weights).withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    m = binary_metrics(tested).first()
    result = [
        ("training_seconds", seconds),
        ("best_iterations", winner.iterations),
        ("best_step", winner.step),
        ("f1_validation", on_validation.get(best, {}).get("f1_score", 0.0)),
        ("cross_entropy_test", hard_cross_entropy(tested).first()["cross_entropy"]),
        ("accuracy_test", m["accuracy"]),
        ("precision_test", m["precision"]),
        ("recall_test", m["recall"]),
        ("f1_test", m["f1_score"]),
        ("weights", winner.weights),
    ]
    for i, model in enumerate(models):
        params = {"iterations": model.iterations, "step": model.step}
        result.append((f"run {i}", {**params, "train": on_train.get(i), "validation": on_validation.get(i)}))
    train.unpersist()
    return metrics_frame(data.sparkSession, result)


def _candidate_rates(rows: DataFrame, weights: list[list[float]]) -> dict[int, dict[str, float]]:
    """Cross entropy and rates of every candidate at threshold one half; one small row each."""
    counts = threshold_metrics(score_candidates(rows, weights), [0.5], by=["candidate"])
    names = ["cross_entropy", "accuracy", "precision", "recall", "f1_score"]
    table = with_hard_cross_entropy(with_rates(counts)).select("candidate", *names)
    return {r["candidate"]: {n: r[n] for n in names} for r in table.collect()}


def gd_job(
    data: DataFrame,
    columns: list[str],
    label: str,
    grid: list[GDParams] | None = None,
    thresholds: list[float] | None = None,
) -> DataFrame:
    """Search the gradient-descent grid and the threshold by validation F1, then test the winner.

    Copies of a row are merged first. What is left differs in content, so the content is the split
    key, and no copy can sit in both training and test rows.
    """
    rows = drop_nan(distinct_rows(data, [*columns, label]), columns)
    keyed = rows.withColumn("row_content", F.concat_ws("|", *[F.col(c).cast("string") for c in [*columns, label]]))
    train, validation, test = _array_splits(keyed, "row_content", columns, label)
    means, stds = array_moments(train, len(columns))
    train, validation, test = (
        scale_array(s, means, stds).select("features", "label") for s in (train, validation, test)
    )
    train = spread(train).persist()
    started = time.perf_counter()
    models, table = gd_search(train, validation, len(columns) + 1, grid, thresholds)
    seconds = time.perf_counter() - started
    # One row per candidate: its best threshold, the lowest among equals.
    rank = F.struct("f1_score", -F.col("threshold_index"))
    picked = F.struct("threshold", "accuracy", "precision", "recall", "f1_score")
    per_run = {
        r["candidate"]: r["picked"]
        for r in table.groupBy("candidate").agg(F.max_by(picked, rank).alias("picked")).collect()
    }
    if not per_run:
        raise ValueError("no validation rows")
    chosen = max(per_run, key=lambda i: (per_run[i]["f1_score"], -i))
    best, winner = per_run[chosen], models[chosen]
    m = threshold_metrics(logistic_score(test, winner.weights), [best["threshold"]]).first()
    result = [
        ("training_seconds", seconds),
        ("best_parameters", winner.params),
        ("best_threshold", best["threshold"]),
        ("f1_validation", best["f1_score"]),
        ("accuracy_test", m["accuracy"]),
        ("precision_test", m["precision"]),
        ("recall_test", m["recall"]),
        ("f1_test", m["f1_score"]),
        ("weights", winner.weights),
    ]
    for i, model in enumerate(models):
        result.append((f"run {i}", {"parameters": model.params, **(per_run[i].asDict() if i in per_run else {})}))
    train.unpersist()
    return metrics_frame(data.sparkSession, result)
