"""L-BFGS against the library's converged weights, and where no best weights exist."""

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.operators.lbfgs import lbfgs_train


def rows_of(spark, n, size, scales):
    columns = [(F.randn(seed=7 + i) * scales[i % len(scales)]).alias(f"v{i}") for i in range(size)]
    features = spark.range(n, numPartitions=4).select(*columns, F.rand(seed=3).alias("chance"))
    pull = sum((F.col(f"v{i}") / scales[i % len(scales)] * ((-1) ** i / (i + 1)) for i in range(size)), F.lit(-1.0))
    label = (F.col("chance") < 1 / (1 + F.exp(-pull))).cast("double").alias("label")
    return features.select(F.array(*[f"v{i}" for i in range(size)]).alias("features"), label).persist()


@pytest.mark.parametrize("size,scales", [(1, [1.0]), (3, [1.0, 5.0]), (20, [1.0, 0.2, 3.0])])
def test_weights_are_the_library_s(spark, size, scales):
    rows = rows_of(spark, 1500, size, scales)
    model = lbfgs_train(rows, size)
    library = LogisticRegression(maxIter=500, tol=1e-14, standardization=False).fit(
        rows.select(array_to_vector("features").alias("features"), "label")
    )
    assert model.converged
    assert model.losses == sorted(model.losses, reverse=True)
    assert model.weights == pytest.approx([*library.coefficients.toArray(), library.intercept], abs=2e-6)
    rows.unpersist()


def test_few_passes(spark):
    """About one pass for each iteration: the step of length one is mostly taken."""
    rows = rows_of(spark, 800, 4, [1.0])
    model = lbfgs_train(rows, 4)
    assert model.converged and len(model.losses) < 25
    assert lbfgs_train(rows, 4, max_iter=2).losses == model.losses[:3]


def test_separable_rows_and_no_rows(spark):
    rows = spark.createDataFrame([([float(i)], float(i > 4)) for i in range(10)], "features array<double>, label double")
    model = lbfgs_train(rows, 1, max_iter=12)
    assert not model.converged and model.losses[-1] < 0.05
    with pytest.raises(ValueError, match="no training rows"):
        lbfgs_train(rows.limit(0), 1)


def test_one_class_only(spark):
    rows = spark.createDataFrame([([1.0], 0.0), ([2.0], 0.0)], "features array<double>, label double")
    assert lbfgs_train(rows, 1, max_iter=5).losses[-1] < 0.2
