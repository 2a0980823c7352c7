"""Evaluation metrics, each from one pass over the predictions."""

from __future__ import annotations

from math import log

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.scalars import from_log_label, ratio_or_zero
from tidemark.session import ensure_checkpoint_dir

# Added to denominators, clip of hard labels, thresholds tried.
EPSILON = 1e-10
HARD_LABEL_CLIP = 1e-15
DEFAULT_THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]


def _confusion_counts(predicted: Column, actual: Column) -> list[Column]:
    return [
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & ~actual).alias("tn"),
        F.count_if(~predicted & actual).alias("fn"),
    ]


def confusion(predictions: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    return predictions.agg(*_confusion_counts(F.col(prediction) == 1, F.col(label) == 1))


def with_rates(counts: DataFrame) -> DataFrame:
    """Add accuracy, and precision, recall and F1 of class 1, to confusion counts; 0 for an empty denominator."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    rates = counts.withColumns(
        {
            "accuracy": ratio_or_zero(tp + tn, tp + fp + tn + fn),
            "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1_score", ratio_or_zero(2 * p * r, p + r))


def binary_metrics(predictions: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Accuracy, precision, recall and F1 of 0/1 predictions, from one confusion count."""
    return with_rates(confusion(predictions, prediction, label)).select("accuracy", "precision", "recall", "f1_score")


def with_hard_cross_entropy(counts: DataFrame) -> DataFrame:
    """Add the clipped cross entropy of 0/1 predictions, which depends on the counts alone."""
    wrong, right = F.col("fp") + F.col("fn"), F.col("tp") + F.col("tn")
    total = wrong * -log(HARD_LABEL_CLIP) + right * -log(1 - HARD_LABEL_CLIP)
    return counts.withColumn("cross_entropy", ratio_or_zero(total, wrong + right))


def threshold_metrics(
    scores: DataFrame,
    thresholds: list[float] | None = None,
    score: str = "score",
    label: str = "label",
    by: list[str] | None = None,
) -> DataFrame:
    """Metrics per threshold (strictly above counts as positive), epsilon form, one aggregate."""
    thresholds = DEFAULT_THRESHOLDS if thresholds is None else thresholds
    by = by or []
    s, positive = F.col(score), F.col(label) == 1
    hits = []
    for i, t in enumerate(thresholds):
        hits += [F.count_if((s > t) & positive).alias(f"tp_{i}"), F.count_if((s > t) & ~positive).alias(f"fp_{i}")]
    totals = scores.groupBy(*by).agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"), *hits)
    per_threshold = F.array(
        *[
            F.struct(
                F.lit(i).alias("threshold_index"),
                F.lit(float(t)).alias("threshold"),
                F.col(f"tp_{i}").alias("tp"),
                F.col(f"fp_{i}").alias("fp"),
                (F.col("neg") - F.col(f"fp_{i}")).alias("tn"),
                (F.col("pos") - F.col(f"tp_{i}")).alias("fn"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    counts = totals.select(*by, F.inline(per_threshold))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    rates = counts.withColumns(
        {
            "accuracy": (tp + tn) / (tp + tn + fp + fn + EPSILON),
            "precision": tp / (tp + fp + EPSILON),
            "recall": tp / (tp + fn + EPSILON),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1_score", 2 * (p * r) / (p + r + EPSILON))


def best_candidate(candidates: DataFrame, metric: str, order: str, largest: bool = True) -> DataFrame:
    """The best row; among equals the one that comes first in ``order``."""
    by_metric = F.desc_nulls_last(metric) if largest else F.asc_nulls_last(metric)
    return candidates.orderBy(by_metric, F.asc(order)).limit(1)


def hard_cross_entropy(predictions: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Cross entropy of 0/1 predictions clipped away from 0 and 1; about 34.54 x error rate."""
    p = F.greatest(F.least(F.col(prediction).cast("double"), F.lit(1 - HARD_LABEL_CLIP)), F.lit(HARD_LABEL_CLIP))
    y = F.col(label).cast("double")
    return predictions.agg(F.avg(-y * F.log(p) - (1 - y) * F.log(1 - p)).alias("cross_entropy"))


def row_log_loss(probability: Column, label: Column, class_weights: dict[int, float] | None = None) -> Column:
    """Log loss of one row, weighted by class."""
    weights = class_weights or {0: 1.0, 1: 1.0}
    positive = F.when(label == 1, 1.0).otherwise(0.0)
    weight = F.when(label == 1, float(weights[1])).otherwise(float(weights[0]))
    loss = -positive * F.log(probability + EPSILON) - (1 - positive) * F.log(1 - probability + EPSILON)
    return weight * loss


def log_loss(
    scores: DataFrame,
    score: str = "score",
    label: str = "label",
    class_weights: dict[int, float] | None = None,
    weights: list[float] | None = None,
    reg_param: float = 0.0,
) -> DataFrame:
    """Mean class-weighted log loss plus an L2 penalty on all weights but the last (bias)."""
    penalty = reg_param * sum(w * w for w in (weights or [])[:-1])
    mean = F.avg(row_log_loss(F.col(score), F.col(label), class_weights))
    return scores.agg((mean + F.lit(float(penalty))).alias("loss"))


def weighted_metrics(predictions: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Accuracy, and precision and recall averaged over classes by support."""
    cells = predictions.groupBy(F.col(label).alias("actual"), F.col(prediction).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # One row per class: as actual (support), as predicted, and both (hits).
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("support"), F.lit(0).alias("chosen"), hit.alias("hit")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).alias("support"), F.col("n").alias("chosen"), F.lit(0).alias("hit")),
    )
    per_class = (
        cells.select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("chosen").alias("chosen"), F.sum("hit").alias("hit"))
    )
    total = F.sum("support")
    return per_class.agg(
        ratio_or_zero(F.sum("hit"), total).alias("accuracy"),
        ratio_or_zero(F.sum(F.col("support") * ratio_or_zero(F.col("hit"), F.col("chosen"))), total).alias(
            "weighted_precision"
        ),
        ratio_or_zero(F.sum(F.col("support") * ratio_or_zero(F.col("hit"), F.col("support"))), total).alias(
            "weighted_recall"
        ),
    )


def regression_metrics(
    predictions: DataFrame, prediction: str = "prediction", label: str = "label", by: list[str] | None = None
) -> DataFrame:
    """RMSE and R2 on the original scale of log1p labels and predictions."""
    original = predictions.select(
        *(by or []),
        from_log_label(F.col(label)).alias("y"),
        from_log_label(F.col(prediction)).alias("p"),
    )
    error = F.pow(F.col("y") - F.col("p"), 2)
    total = F.var_pop("y") * F.count("y")
    return original.groupBy(*(by or [])).agg(
        F.sqrt(F.avg(error)).alias("rmse"),
        F.coalesce(1 - F.try_divide(F.sum(error), F.nullif(total, F.lit(0.0))), F.lit(0.0)).alias("r2"),
    )


def area_under_roc(
    scores: DataFrame, score: str = "score", label: str = "label", buckets: int | None = None
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half.

    Rows with a null or NaN score or a null label take no part. Equal scores collapse first. The running count of negatives is taken inside score ranges and
    shifted by the totals of the ranges below, so no single task sorts all scores. The range
    bounds come from a sketch and affect only balance, not the result.
    """
    cores = scores.sparkSession.sparkContext.defaultParallelism
    buckets = buckets or min(max(64, 2 * cores), 4096)
    known = scores.select(F.col(score).cast("double").alias("s"), (F.col(label) == 1).alias("y")).na.drop()
    # Written out, as the bounds and the counts both read it.
    ensure_checkpoint_dir(scores.sparkSession)
    per_score = (
        known.groupBy("s")
        .agg(F.count_if(F.col("y")).alias("pos"), F.count_if(~F.col("y")).alias("neg"))
        .checkpoint()
    )
    steps = [i / buckets for i in range(1, buckets)]
    bounds = per_score.approxQuantile("s", steps, 0.5 / buckets) if steps else []
    inner = sorted({b for b in bounds if float("-inf") < b < float("inf")})
    splits = [float("-inf"), *(inner or [0.0]), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="s", outputCol="range", handleInvalid="keep").transform(per_score)
    # At most ``buckets`` + 1 rows: small enough for one window and a broadcast.
    below = (
        ranged.groupBy("range")
        .agg(F.sum("neg").alias("range_neg"))
        .select(
            "range",
            F.coalesce(
                F.sum("range_neg").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("neg_below"),
        )
    )
    running = Window.partitionBy("range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("neg_here", F.coalesce(F.sum("neg").over(running), F.lit(0))).join(
        F.broadcast(below), "range"
    )
    beaten = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg_here") + F.col("neg") / 2)
    return placed.agg(
        F.try_divide(F.sum(beaten), F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc")
    )
