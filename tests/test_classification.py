import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import sigmoid
from tidemark.operators import cleaning, library_models, logistic, metrics, scale
from tidemark.operators.split import hash_split
from tidemark.plans import classification

NAN = float("nan")


def make_rows(spark, n=200, size=3, seed=1, bias=True):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        f = [rng.gauss(0, 1) for _ in range(size)] + ([1.0] if bias else [])
        data.append((str(i), f, 1.0 if sum(f[:size]) + rng.gauss(0, 1) > 1 else 0.0))
    df = spark.createDataFrame(data, "id string, features array<double>, label double")
    return df, np.array([d[1] for d in data]), np.array([d[2] for d in data])


def test_row_filters(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 2.0), (2, None, 2.0), (3, NAN, 2.0), (4, 1.0, math.inf), (5, 1.0, -math.inf)],
        "id int, a double, b double",
    )

    def ids(d):
        return sorted(r["id"] for r in d.collect())

    assert ids(cleaning.drop_nulls(df)) == [1, 4, 5]
    assert ids(cleaning.drop_nan(df, ["a", "b"])) == [1, 2, 4, 5]
    assert ids(cleaning.drop_nonfinite(df, ["a", "b"])) == [1]
    assert cleaning.project_except(df, ["id", "missing"]).columns == ["a", "b"]


def test_sigmoid_saturates(spark):
    df = spark.createDataFrame([(0.0,), (101.0,), (-101.0,), (1000.0,), (-1000.0,)], "z double")
    assert [r[0] for r in df.select(sigmoid(F.col("z"))).collect()] == [0.5, 1.0, 0.0, 1.0, 0.0]


def test_hash_split_is_a_partition_and_ignores_layout(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    parts = hash_split(df, "id", [0.7, 0.1, 0.2])
    ids = [sorted(r["id"] for r in p.collect()) for p in parts]
    assert sorted(sum(ids, [])) == sorted(str(i) for i in range(2000))
    again = [sorted(r["id"] for r in p.collect()) for p in hash_split(df.repartition(5), "id", [0.7, 0.1, 0.2])]
    assert ids == again
    assert 0.6 < len(ids[0]) / 2000 < 0.8


def test_assemble_drops_nulls_first(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a double, b double")
    assert scale.assemble(df, ["a", "b"]).count() == 1


def test_scaling_by_population_and_sample_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    moments = {r["feature"]: (r["mean"], r["std"]) for r in scale.feature_moments(df, ["a", "b"]).collect()}
    assert moments["a"] == pytest.approx((2.0, math.sqrt(1 + 1e-10)))
    assert moments["b"] == pytest.approx((5.0, 1e-5))
    flat = scale.scale_columns(df, df, ["a", "b"]).orderBy("a").first()
    assert flat["a"] == pytest.approx(-1 / math.sqrt(2)) and flat["b"] == 0.0
    arrays = df.select(F.array("a", "b").alias("features"))
    means, stds = scale.array_moments(arrays, 2)
    scaled = scale.scale_array(arrays, means, [stds[0], 0.0]).first()["features"]
    assert scaled == pytest.approx([-1.0, 0.0, 1.0])


def test_binary_metrics_with_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "prediction int, label int")
    assert tuple(metrics.binary_metrics(df).first()) == (1.0, 0.0, 0.0, 0.0)
    empty = df.limit(0)
    assert tuple(metrics.binary_metrics(empty).first()) == (0.0, 0.0, 0.0, 0.0)


def test_threshold_is_strict_and_first_best_wins(spark):
    df = spark.createDataFrame([(0.5, 1), (0.9, 1), (0.1, 0)], "score double, label int")
    table = metrics.threshold_metrics(df, [0.2, 0.4, 0.5])
    rows = {r["threshold"]: (r["tp"], r["fp"], r["tn"], r["fn"]) for r in table.collect()}
    assert rows[0.5] == (1, 0, 1, 1)
    assert rows[0.2] == rows[0.4] == (2, 0, 1, 0)
    assert metrics.best_candidate(table, "f1_score", "threshold_index").first()["threshold"] == 0.2


def test_hard_cross_entropy_is_error_rate_scaled(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (0, 0)], "prediction int, label int")
    value = metrics.hard_cross_entropy(df).first()["cross_entropy"]
    assert value == pytest.approx(-math.log(1e-15) / 4, rel=1e-3)
    counted = metrics.with_hard_cross_entropy(metrics.confusion(df)).first()["cross_entropy"]
    assert counted == pytest.approx(value, rel=1e-2)


@pytest.mark.parametrize("distinct", [3, 40, 5000])
def test_auc_matches_the_library(spark, distinct):
    df = spark.range(5000).select(
        (F.abs(F.xxhash64("id")) % distinct).cast("double").alias("score"),
        (F.abs(F.xxhash64("id", F.lit(1))) % 3 == 0).cast("double").alias("label"),
    )
    library = library_models.library_auc(df.withColumnRenamed("score", "rawPrediction"))
    for buckets in (1, 7, 64):
        assert metrics.area_under_roc(df, buckets=buckets).first()["auc"] == pytest.approx(library, abs=1e-12)


def test_auc_without_both_classes(spark):
    df = spark.createDataFrame([(0.5, 1), (0.6, 1)], "score double, label int")
    assert metrics.area_under_roc(df).first()["auc"] is None


def test_weighted_metrics_match_the_library(spark):
    df = spark.range(300).select(
        (F.col("id") % 3).cast("double").alias("label"),
        F.when(F.col("id") % 7 == 0, 2.0).otherwise((F.col("id") % 2).cast("double")).alias("prediction"),
    )
    row = metrics.weighted_metrics(df).first()
    names = [("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall")]
    for ours, theirs in names:
        assert row[ours] == pytest.approx(library_models.library_metric(df, theirs))


def numpy_descent(x, y, p):
    w = np.zeros(x.shape[1])
    v = np.zeros_like(w)
    lowest, losses = math.inf, {}
    for epoch in range(p.num_epochs):
        s = 1 / (1 + np.exp(-x @ w))
        reg = p.reg_param * w
        reg[-1] = 0
        v = p.momentum * v + (1 - p.momentum) * (x.T @ (s - y) / len(y) + reg)
        w = w - p.learning_rate * v
        if epoch % 5 == 0 or epoch == p.num_epochs - 1:
            s = 1 / (1 + np.exp(-x @ w))
            c = np.where(y == 1, p.class_weights[1], p.class_weights[0])
            row = -y * np.log(s + 1e-10) - (1 - y) * np.log(1 - s + 1e-10)
            losses[epoch] = float(np.mean(c * row) + p.reg_param * np.sum(w[:-1] ** 2))
            if epoch > p.early_stop_patience and losses[epoch] > lowest * p.early_stop_factor:
                break
            lowest = min(lowest, losses[epoch])
    return w, losses


def test_gradient_descent_against_numpy(spark):
    df, x, y = make_rows(spark)
    df = df.persist()
    grid = [
        logistic.GDParams(learning_rate=0.7, num_epochs=12),
        logistic.GDParams(learning_rate=0.3, num_epochs=30, class_weights=(1.0, 5.0)),
        # Stops early: class 0 dominates the loss while the unweighted gradient moves on.
        logistic.GDParams(learning_rate=1.0, num_epochs=40, class_weights=(50.0, 1.0), early_stop_patience=2, early_stop_factor=0.5),
    ]
    for model in logistic.gd_train(df, 4, grid):
        weights, losses = numpy_descent(x, y, model.params)
        assert model.weights == pytest.approx(weights, abs=1e-9)
        assert model.losses == pytest.approx(losses, abs=1e-9)
    assert model.stopped_early


def test_weighted_gradient_is_optional(spark):
    df, _, _ = make_rows(spark)
    p = logistic.GDParams(num_epochs=2, class_weights=(1.0, 9.0))
    plain = logistic.gd_train(df, 4, p)[0].weights
    weighted = logistic.gd_train(df, 4, p, weighted_gradient=True)[0].weights
    assert plain != pytest.approx(weighted)


def test_empty_training_set_is_an_error(spark):
    df, _, _ = make_rows(spark)
    with pytest.raises(ValueError):
        logistic.gd_train(df.limit(0), 4, logistic.GDParams())


def test_sgd_against_the_library(spark):
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.regression import LabeledPoint

    df, x, y = make_rows(spark, bias=False)
    points = spark.sparkContext.parallelize([LabeledPoint(b, a) for a, b in zip(x, y)]).cache()
    models = logistic.sgd_train(df.persist(), 3, [15.0, 1.0], [1, 2, 5, 30])
    assert [(m.step, m.iterations) for m in models] == [(s, n) for s in (15.0, 1.0) for n in (1, 2, 5, 30)]
    for m in models:
        library = LogisticRegressionWithSGD.train(points, iterations=m.iterations, step=m.step)
        assert m.weights == pytest.approx(library.weights.toArray(), abs=1e-9)


def test_param_grid_order():
    grid = logistic.param_grid()
    assert len(grid) == 15
    assert [(p.learning_rate, p.reg_param) for p in grid[:4]] == [(0.1, 0.003), (0.1, 0.001), (0.1, 0.0007), (0.3, 0.003)]


def test_log_loss_penalty_leaves_the_bias_out(spark):
    df = spark.createDataFrame([(0.5, 1)], "score double, label int")
    base = metrics.log_loss(df).first()["loss"]
    assert base == pytest.approx(math.log(2), abs=1e-6)
    assert metrics.log_loss(df, weights=[2.0, 100.0], reg_param=0.1).first()["loss"] == pytest.approx(base + 0.4)


def flat_rows(spark, n=400):
    df, _, _ = make_rows(spark, n=n)
    return df.select("id", *[F.col("features")[i].alias(f"v{i}") for i in range(3)], F.col("label").cast("int").alias("Class"))


def as_dict(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def test_jobs_report_every_metric(spark):
    data, names = flat_rows(spark).persist(), ["v0", "v1", "v2"]
    library = as_dict(classification.library_job(data, "id", names, "Class"))
    sides = {f"{m}_{side}" for m in ("accuracy", "auc") for side in ("train", "test")}
    test_only = {f"{m}_test" for m in ("precision", "recall", "f1", "weighted_precision", "weighted_recall")}
    assert float(library["auc_test"]) > 0.7
    assert set(library) == sides | test_only | {"coefficients", "intercept", "training_seconds", "auc_train_summary"}
    sgd = as_dict(classification.sgd_job(data, "id", names, "Class", steps=[1.0, 5.0], iterations=[5, 10]))
    assert float(sgd["f1_test"]) > 0.4 and sgd["best_iterations"] in ("5", "10")
    assert [k for k in sgd if k.startswith("run ")] == [f"run {i}" for i in range(4)]
    gd = as_dict(classification.gd_job(data, names, "Class", [logistic.GDParams(num_epochs=10, learning_rate=1.0)]))
    assert float(gd["f1_test"]) > 0.4


def test_job_survives_a_search_where_every_f1_is_zero(spark):
    data = flat_rows(spark, 60).withColumn("Class", F.lit(0))
    result = as_dict(classification.sgd_job(data, "id", ["v0", "v1", "v2"], "Class", steps=[1.0], iterations=[1]))
    assert result["best_iterations"] == "1" and float(result["f1_test"]) == 0.0


def test_copies_do_not_change_the_descent_job(spark):
    data, names = flat_rows(spark, 200).persist(), ["v0", "v1", "v2"]
    grid = [logistic.GDParams(num_epochs=3)]
    once = as_dict(classification.gd_job(data, names, "Class", grid))
    copied = as_dict(classification.gd_job(data.unionByName(data.limit(50)), names, "Class", grid))
    for key in set(once) - {"training_seconds"}:
        if key == "weights":
            assert eval(once[key]) == pytest.approx(eval(copied[key]))
        elif "run" not in key:
            assert once[key] == copied[key]


@pytest.mark.parametrize("weighted", [False, True])
def test_gradient_pass_reads_rows_once_and_leaves_out_unknown_ones(spark, weighted):
    nan, inf = float("nan"), float("inf")
    data = [([0.5, -1.0], 1), ([2.0, 0.25], 0), ([None, 1.0], 1), ([3.0, 4.0], None), (None, 1), ([500.0, 1.0], 0), ([-500.0, 2.0], 1)]
    for extra in ([], [([nan, 1.0], 1)], [([inf, 1.0], 0)]):
        df = spark.createDataFrame(data + extra, "features array<double>, label int").repartition(3)
        weights = {0: [0.3, -0.2], 4: [1.0, 0.5]}
        score = {i: logistic.sigmoid(F.lit(0.0) + F.col("features")[0] * w[0] + F.col("features")[1] * w[1]) for i, w in weights.items()}
        weight = F.when(F.col("label") == 1, 7.0).otherwise(2.0)
        with logistic._GradientPass(df, 2, weighted) as one_pass:
            got = one_pass.run(weights, dict.fromkeys(weights, (2.0, 7.0)))
            assert one_pass.blocks.storageLevel.useMemory and one_pass.run(weights, dict.fromkeys(weights, (1.0, 1.0)), False)[4].loss is None
        for i in weights:
            residual = (score[i] - F.col("label")) * (weight if weighted else 1.0)
            want = df.agg(
                F.avg(weight * metrics.row_log_loss(score[i], F.col("label"))),
                F.avg(F.col("features")[0] * residual),
                F.avg(F.col("features")[1] * residual),
            ).first()
            assert [got[i].loss, *got[i].gradient] == pytest.approx(list(want), nan_ok=True)
