"""Logistic regression by full-batch gradient descent, as Spark aggregates.

Rows are ``(features array<double>, label)``. Many candidates advance together: a pass takes every
row once and measures all live candidates on it inside its task, and only one partial gradient per
candidate and task is shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product
from math import inf, sqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import dot, sigmoid
from tidemark.operators.metrics import EPSILON, threshold_metrics

# Executors need not have this package: functions travel with their code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_CLASS_WEIGHTS = {0: 1.0, 1: 1.0}


def logistic_score(rows: DataFrame, weights: list[float]) -> DataFrame:
    """Add ``score = sigmoid(weights . features)``."""
    return rows.withColumn("score", sigmoid(dot(F.col("features"), weights)))


def gradient_sums(rows: DataFrame, weights: list[float]) -> DataFrame:
    """One row: ``g_i`` = mean of ``f_i * (score - label)`` per position, and the row count."""
    residual = sigmoid(dot(F.col("features"), weights)) - F.col("label")
    return (
        rows.select("features", residual.alias("residual"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            *[F.avg(F.col("features")[i] * F.col("residual")).alias(f"g_{i}") for i in range(len(weights))],
        )
    )


@dataclass(frozen=True)
class GDParams:
    """One point of the search grid; defaults are the reference settings of a single run."""

    learning_rate: float = 0.3
    num_epochs: int = 30
    reg_param: float = 0.003
    momentum: float = 0.9
    class_weights: tuple[float, float] = (1.0, 581.0)
    early_stop_patience: int = 10
    early_stop_factor: float = 1.01


# The search grid, in order of search.
GD_GRID_LISTS = {
    "learning_rate": [0.1, 0.3, 0.5, 0.7, 1.0],
    "num_epochs": [30],
    "reg_param": [0.003, 0.001, 0.0007],
    "momentum": [0.9],
    "class_weights": [(1.0, 581.0)],
    "early_stop_patience": [10],
    "early_stop_factor": [1.01],
}
SGD_STEPS = [15, 20, 25, 30, 35]
SGD_ITERATIONS = [50, 75, 100, 150, 200]


def param_grid(lists: dict[str, list] | None = None) -> list[GDParams]:
    """Every combination of the parameter lists, last list varying fastest."""
    lists = lists or GD_GRID_LISTS
    return [GDParams(**dict(zip(lists, values))) for values in product(*lists.values())]


def _candidates(weights: dict[int, list[float]], class_weights: dict[int, tuple[float, float]]) -> Column:
    """Literal array of (candidate, weights, class weights), written as SQL text: one call per pass."""

    def number(x: float) -> str:
        return f"{float(x)!r}D"

    entries = [
        f"named_struct('candidate', {i}, 'w', array({', '.join(map(number, w))}), "
        f"'w0', {number(class_weights[i][0])}, 'w1', {number(class_weights[i][1])})"
        for i, w in weights.items()
    ]
    return F.inline(F.expr(f"array({', '.join(entries)})"))


def _candidate_score(size: int) -> Column:
    z = F.lit(0.0)
    for i in range(size):
        z = z + F.col("features")[i] * F.col("w")[i]
    return sigmoid(z).alias("score")


@dataclass
class _Sums:
    gradient: list[float | None]
    loss: float | None


def _numpy_sigmoid(z: np.ndarray) -> np.ndarray:
    """As :func:`sigmoid`, where NaN is larger than any number."""
    with np.errstate(over="ignore"):
        score = 1.0 / (1.0 + np.exp(-z))
    score[(z > 100) | np.isnan(z)] = 1.0
    score[z < -100] = 0.0
    return score


class _Partial:
    """Sums of one candidate over the rows of a task."""

    def __init__(self, weights: list[float], class_weights: tuple[float, float]) -> None:
        self.weights, self.class_weights = weights, class_weights
        self.gradient, self.loss = np.zeros(len(weights)), 0.0

    def add(self, features: np.ndarray, label: np.ndarray, n_known: int, weighted: bool, with_loss: bool) -> None:
        """Rows from ``n_known`` on are without a label: they have a loss, as of class 0, and no gradient."""
        z = np.zeros(len(label))
        for f, w in zip(features, self.weights):
            z += f * w
        score = _numpy_sigmoid(z)
        weight = np.where(label == 1, self.class_weights[1], self.class_weights[0]) if weighted or with_loss else None
        residual = (score - label) * weight if weighted else score - label
        self.gradient += features[:, :n_known] @ residual[:n_known]
        if with_loss:
            chance = np.where(label == 1, score, 1 - score)
            self.loss -= float(np.sum(weight * np.log(chance + EPSILON)))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per batch: labels and features as one block of doubles, rows without label last.

    A row with any unknown feature has no score and is left out.
    """
    for batch in batches:
        if batch.num_rows:
            known, *others = (c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns)
            whole = np.logical_and.reduce(others)
            order = np.concatenate([np.flatnonzero(whole & known), np.flatnonzero(whole & ~known)])
            block = np.stack([c.to_numpy(zero_copy_only=False)[order] for c in batch.columns])
            n_known = int(np.sum(whole & known))
            block[0, n_known:] = 0.0
            yield pa.RecordBatch.from_pydict(
                {
                    "n_known": pa.array([n_known], pa.int64()),
                    "n": pa.array([len(order)], pa.int64()),
                    "block": pa.array([block.tobytes()], pa.binary()),
                }
            )


class _GradientPass:
    """Mean gradient and, where asked, mean weighted loss of every candidate, from one scan of the rows.

    The rows are read once and kept as blocks of plain doubles until the pass is left.
    """

    def __init__(self, rows: DataFrame, size: int, weighted_gradient: bool = False) -> None:
        self.size, self.weighted_gradient = size, weighted_gradient
        numbers = rows.select(
            F.col("label").cast("double").alias("label"),
            *[F.col("features")[i].cast("double").alias(f"f{i}") for i in range(size)],
        )
        self.blocks = numbers.mapInArrow(_packed, "n_known long, n long, block binary").persist()
        self.means = [
            (F.sum("loss") / F.nullif(F.sum("n_loss"), F.lit(0))).alias("loss"),
            *[(F.sum(F.col("g")[i]) / F.nullif(F.sum("n"), F.lit(0))).alias(f"g_{i}") for i in range(size)],
        ]

    def __enter__(self) -> _GradientPass:
        return self

    def __exit__(self, *_) -> None:
        self.blocks.unpersist()

    def run(
        self, weights: dict[int, list[float]], class_weights: dict[int, tuple[float, float]], with_loss: bool = True
    ) -> dict[int, _Sums]:
        size, weighted = self.size, self.weighted_gradient
        class_weights = {i: class_weights[i] for i in weights}

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {i: _Partial(w, class_weights[i]) for i, w in weights.items()}
            n = n_loss = 0
            seen = False
            for batch in batches:
                for n_known, n_rows, block in zip(*(c for c in batch.columns)):
                    seen = True
                    rows = np.frombuffer(block.as_buffer(), dtype=np.float64).reshape(size + 1, n_rows.as_py())
                    n += n_known.as_py()
                    n_loss += n_rows.as_py()
                    for candidate in sums.values():
                        candidate.add(rows[1:], rows[0], n_known.as_py(), weighted, with_loss)
            if seen:
                yield pa.RecordBatch.from_pydict(
                    {
                        "candidate": pa.array(list(sums), pa.int32()),
                        "n": pa.array([n] * len(sums), pa.int64()),
                        "n_loss": pa.array([n_loss] * len(sums), pa.int64()),
                        "loss": pa.array([x.loss for x in sums.values()], pa.float64()),
                        "g": pa.array([x.gradient.tolist() for x in sums.values()], pa.list_(pa.float64())),
                    }
                )

        schema = "candidate int, n long, n_loss long, loss double, g array<double>"
        means = self.blocks.mapInArrow(partial, schema).groupBy("candidate").agg(*self.means)
        # One row per candidate: bounded by the grid.
        return {r[0]: _Sums(list(r[2:]), r[1] if with_loss else None) for r in means.collect()}


@dataclass
class GDModel:
    params: GDParams
    weights: list[float]
    losses: dict[int, float] = field(default_factory=dict)
    stopped_early: bool = False


def gd_train(
    rows: DataFrame, size: int, params: GDParams | list[GDParams], weighted_gradient: bool = False
) -> list[GDModel]:
    """Gradient descent with momentum from zero weights; the last position is the bias.

    ``velocity = m * velocity + (1 - m) * gradient``, ``weights -= rate * velocity``. The loss is
    checked every fifth epoch and after the last. It is read off the next pass, which scores the
    rows under the same weights anyway, so checking costs no extra scan except after the last epoch.
    Class weights enter the loss only, unless ``weighted_gradient`` is set. The rows are read once.
    """
    grid = [params] if isinstance(params, GDParams) else list(params)
    models = [GDModel(p, [0.0] * size) for p in grid]
    velocity = [[0.0] * size for _ in grid]
    lowest = [inf] * len(grid)
    live = {i: grid[i].class_weights for i in range(len(grid))}
    epoch = 0
    with _GradientPass(rows, size, weighted_gradient) as one_pass:
        while live:
            done = epoch - 1
            checked = {i for i in live if done >= 0 and (done % 5 == 0 or done == grid[i].num_epochs - 1)}
            passes = one_pass.run({i: models[i].weights for i in live}, live, with_loss=bool(checked))
            if not passes:
                raise ValueError("no training rows")
            for i in list(live):
                p, model = grid[i], models[i]
                if i in checked:
                    penalty = p.reg_param * sum(w * w for w in model.weights[:-1])
                    loss = passes[i].loss + penalty
                    model.losses[done] = loss
                    if done > p.early_stop_patience and loss > lowest[i] * p.early_stop_factor:
                        model.stopped_early = True
                        del live[i]
                        continue
                    lowest[i] = min(lowest[i], loss)
                if epoch >= p.num_epochs:
                    del live[i]
                    continue
                for j in range(size):
                    g = passes[i].gradient[j] + (p.reg_param * model.weights[j] if j < size - 1 else 0.0)
                    velocity[i][j] = p.momentum * velocity[i][j] + (1 - p.momentum) * g
                model.weights = [w - p.learning_rate * v for w, v in zip(model.weights, velocity[i])]
            epoch += 1
    return models


def score_candidates(rows: DataFrame, weights: list[list[float]], kept: list[str] | None = None) -> DataFrame:
    """Rows scored by each weight vector: ``candidate``, ``score`` and the kept columns."""
    numbered = dict(enumerate(weights))
    ones = {i: (1.0, 1.0) for i in numbered}
    kept = kept or ["label"]
    fanned = rows.select("features", *kept, _candidates(numbered, ones))
    return fanned.select("candidate", *kept, _candidate_score(len(weights[0])))


def gd_search(
    train: DataFrame,
    validation: DataFrame,
    size: int,
    grid: list[GDParams] | None = None,
    thresholds: list[float] | None = None,
) -> tuple[list[GDModel], DataFrame]:
    """Train the whole grid, then the validation metrics of every (candidate, threshold)."""
    grid = grid or param_grid()
    models = gd_train(train, size, grid)
    scored = score_candidates(validation, [m.weights for m in models])
    return models, threshold_metrics(scored, thresholds, by=["candidate"])


@dataclass
class SGDModel:
    step: float
    iterations: int
    weights: list[float]


def _updated(weights: list[float], gradient: list[float], step: float, iteration: int, reg_param: float):
    rate = step / sqrt(iteration)
    return [w * (1 - rate * reg_param) - rate * g for w, g in zip(weights, gradient)]


def _norm(values: list[float]) -> float:
    return sqrt(sum(v * v for v in values))


def sgd_train(
    rows: DataFrame,
    size: int,
    steps: list[float],
    iterations: list[int],
    reg_param: float = 0.01,
    tolerance: float = 0.001,
) -> list[SGDModel]:
    """Logistic SGD with the library defaults: whole batch, no intercept, L2 with decaying step.

    With the whole batch a run of n iterations is a prefix of any longer run with the same step,
    so a step is trained once and its weights are noted at each iteration count; all steps
    advance in the same pass. The order of the result is step, then iterations.
    """
    state = {i: [0.0] * size for i in range(len(steps))}
    noted: dict[tuple[int, int], list[float]] = {}
    live = dict.fromkeys(state, (1.0, 1.0))
    with _GradientPass(rows, size) as one_pass:
        for iteration in range(1, max(iterations) + 1):
            passes = one_pass.run({i: state[i] for i in live}, live, with_loss=False)
            if not passes:
                raise ValueError("no training rows")
            for i in list(live):
                before = state[i]
                state[i] = _updated(before, passes[i].gradient, steps[i], iteration, reg_param)
                moved = _norm([a - b for a, b in zip(before, state[i])])
                # The library compares weights from its second iteration on.
                converged = iteration > 1 and moved < tolerance * max(_norm(state[i]), 1.0)
                for n in iterations:
                    if n == iteration or (converged and n > iteration):
                        noted[(i, n)] = state[i]
                if converged:
                    del live[i]
            if not live:
                break
    return [SGDModel(steps[i], n, noted[(i, n)]) for i in range(len(steps)) for n in iterations]
