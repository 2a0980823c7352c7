"""Feature moments and scaling over ``features array<double>`` or flat columns."""

from __future__ import annotations

from math import sqrt

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: floor inside the root of a population deviation.
VARIANCE_FLOOR = 1e-10


def assemble(df: DataFrame, columns: list[str], output: str = "features") -> DataFrame:
    """Columns to an ML vector; rows with nulls are dropped first, as the assembler rejects them."""
    return VectorAssembler(inputCols=columns, outputCol=output).transform(df.na.drop(subset=columns))


def feature_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per feature: mean and population deviation with a small floor, in one pass."""
    aggregates = []
    for c in columns:
        aggregates += [F.avg(c).alias(f"mean_{c}"), F.var_pop(c).alias(f"var_{c}")]
    moments = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"mean_{c}").alias("mean"),
            F.sqrt(F.col(f"var_{c}") + VARIANCE_FLOOR).alias("std"),
        )
        for c in columns
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*moments)))


def array_moments(
    df: DataFrame, size: int, features: str = "features", sample: bool = False
) -> tuple[list[float], list[float]]:
    """Mean and deviation per position, as two lists of ``size`` numbers.

    The population deviation has a small floor; the ``sample`` deviation, as the library scaler takes it, has none.
    """
    aggregates = []
    for i in range(size):
        spread_of = F.stddev_samp if sample else F.var_pop
        aggregates += [F.avg(F.col(features)[i]), spread_of(F.col(features)[i])]
    row = df.agg(*aggregates).first()
    means = list(row[0::2])
    if sample:
        return means, [v or 0.0 for v in row[1::2]]
    return means, [sqrt(v + VARIANCE_FLOOR) for v in row[1::2]]


def _scaled(value: Column, mean: float, std: float) -> Column:
    return (value - F.lit(float(mean))) / F.lit(float(std)) if std else F.lit(0.0)


def scale_array(df: DataFrame, means: list[float], stds: list[float], features: str = "features") -> DataFrame:
    """Standardise by given moments (zero deviation gives 0) and append the bias term 1.0."""
    parts = [_scaled(F.col(features)[i], m, s) for i, (m, s) in enumerate(zip(means, stds))]
    return df.withColumn(features, F.array(*parts, F.lit(1.0)))


def scale_columns(df: DataFrame, fit_on: DataFrame, columns: list[str]) -> DataFrame:
    """Standardise flat columns by the mean and sample deviation of ``fit_on``."""
    aggregates = []
    for c in columns:
        aggregates += [F.avg(c), F.stddev_samp(c)]
    row = fit_on.agg(*aggregates).first()
    return df.withColumns(
        {c: _scaled(F.col(c), row[2 * i], row[2 * i + 1] or 0.0) for i, c in enumerate(columns)}
    )


def fit_scaler(train: DataFrame, input_col: str = "raw_features", output_col: str = "features"):
    """Library scaler: mean and sample deviation of the training rows."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=True, withStd=True).fit(train)
