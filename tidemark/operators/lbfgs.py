"""Logistic regression by L-BFGS, as Spark aggregates over ``(features array<double>, label)`` rows.

A step is one pass. Along a direction the score of a row is linear in the step length, so two dot
products a row give the mean loss at every length tried, and the gradient at length one comes with
them. That length is nearly always taken; another one costs a pass more. The driver holds weights,
the sums and ``HISTORY`` pairs of differences: numbers of the width of a row, whatever the table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import sigmoid

HISTORY = 10
# Step lengths tried, the first one with its gradient.
LENGTHS = [1.0, 4.0, 2.0, *(2.0**-k for k in range(1, 11))]
# Share of the promised fall that a step must bring.
SUFFICIENT = 1e-4


@dataclass
class LogisticModel:
    """``weights`` per position with the intercept last, and mean loss after each iteration."""

    weights: list[float]
    losses: list[float]
    converged: bool


def _row_loss(z: Column, label: Column) -> Column:
    """Log loss from the score before the sigmoid, without overflow."""
    margin = F.when(label == 1, -z).otherwise(z)
    return F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))


def _dot(weights: Column, size: int) -> Column:
    z = F.get(weights, F.lit(size))
    for i in range(size):
        z = z + F.col("features")[i] * F.get(weights, F.lit(i))
    return z


def _array(values: np.ndarray) -> str:
    return f"array({', '.join(f'{float(v)!r}D' for v in values)})"


class _LinePass:
    """Mean losses along a direction and the mean gradient at its end, from one scan."""

    def __init__(self, rows: DataFrame, size: int) -> None:
        self.rows, self.size = rows, size

    def run(self, weights: np.ndarray, direction: np.ndarray) -> tuple[dict[float, float], np.ndarray]:
        # Weights are one literal each, so generated code is reused between passes.
        line = F.inline(F.expr(f"array(named_struct('w', {_array(weights)}, 'd', {_array(direction)}))"))
        scored = (
            self.rows.select("features", "label", line)
            .select("features", "label", _dot(F.col("w"), self.size).alias("z"), _dot(F.col("d"), self.size).alias("dz"))
            .withColumn("residual", sigmoid(F.col("z") + F.col("dz")) - F.col("label"))
        )
        losses = [F.avg(_row_loss(F.col("z") + length * F.col("dz"), F.col("label"))) for length in LENGTHS]
        gradient = [F.avg(F.col("features")[i] * F.col("residual")) for i in range(self.size)]
        row = scored.agg(*losses, *gradient, F.avg("residual")).first()
        if row[0] is None:
            raise ValueError("no training rows")
        return dict(zip(LENGTHS, row)), np.array(row[len(LENGTHS) :])


def _downhill(gradient: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The direction of the last difference pairs' approximate curvature, by the two-loop recursion."""
    if not pairs:
        return -gradient / max(1.0, float(np.linalg.norm(gradient)))
    rest, shares = gradient.copy(), []
    for moved, turned in reversed(pairs):
        shares.append(moved @ rest / (moved @ turned))
        rest -= shares[-1] * turned
    moved, turned = pairs[-1]
    rest *= moved @ turned / (turned @ turned)
    for (moved, turned), share in zip(pairs, reversed(shares)):
        rest += (share - turned @ rest / (moved @ turned)) * moved
    return -rest


def lbfgs_train(rows: DataFrame, size: int, max_iter: int = 100, tolerance: float = 1e-8) -> LogisticModel:
    """Unregularised logistic regression with an intercept, until no gradient exceeds ``tolerance``.

    Rows with a null label or feature must be gone before. Where the classes can be separated no
    finite weights are best, and the model of the last iteration is returned, not converged; so it is
    when no step length lowers the loss any more. Pass cached or written rows: each iteration scans them.
    """
    one_pass = _LinePass(rows, size)
    weights = np.zeros(size + 1)
    found, gradient = one_pass.run(weights, np.zeros(size + 1))
    loss, losses = found[1.0], [found[1.0]]
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    while np.abs(gradient).max() > tolerance and len(losses) <= max_iter:
        direction = _downhill(gradient, pairs)
        slope = float(gradient @ direction)
        found, ahead = one_pass.run(weights, direction)
        enough = {a: v for a, v in found.items() if v <= loss + SUFFICIENT * a * slope}
        if 1.0 in enough:
            length = 1.0
        elif enough:
            length = min(enough, key=enough.get)
            _, ahead = one_pass.run(weights + length * direction, np.zeros(size + 1))
        elif pairs:
            pairs = []
            continue
        else:
            break
        moved, turned = length * direction, ahead - gradient
        if moved @ turned > 1e-12 * float(moved @ moved):
            pairs = [*pairs, (moved, turned)][-HISTORY:]
        weights, gradient, loss = weights + moved, ahead, found[length]
        losses.append(loss)
    return LogisticModel(weights.tolist(), losses, bool(np.abs(gradient).max() <= tolerance))
