import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import library_models, tree_nodes
from tidemark.operators.median_tree import fit_median_tree, median_splits, split_gains, value_sums
from tidemark.plans.regression import result_tables, trip_job
from tidemark.sources.tables import trips

SMALL = "/root/testdata/sf0.001"


def make_rows(spark, seed=5, n=300):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        f = [float(rng.randrange(6)), round(rng.uniform(0, 9), 3), float(rng.randrange(2)), 7.0]
        data.append((str(i), f, round(math.sin(f[0]) + f[1] / 5 + f[2] * rng.random(), 6)))
    return spark.createDataFrame(data, "id string, features array<double>, label double"), data


def brute_tree(rows, depth, node=1):
    """Plain recursion over (features, label), for comparison on a few rows."""
    mean = sum(y for _, y in rows) / len(rows)
    out = {node: (len(rows), mean, None, None)}
    if depth == 0:
        return out
    best = None
    for j in range(len(rows[0][0])):
        values = sorted({f[j] for f, _ in rows})
        if len(values) < 2:
            continue
        t = values[len(values) // 2]
        left = [y for f, y in rows if f[j] <= t]
        right = [y for f, y in rows if f[j] > t]
        if not right:
            continue
        gap = sum(left) / len(left) - sum(right) / len(right)
        gain = len(left) * len(right) / len(rows) ** 2 * gap * gap
        if best is None or gain > best[0] + 1e-12:
            best = (gain, j, t)
    if best is None:
        return out
    _, j, t = best
    out[node] = (len(rows), mean, j, t)
    out.update(brute_tree([r for r in rows if r[0][j] <= t], depth - 1, 2 * node))
    out.update(brute_tree([r for r in rows if r[0][j] > t], depth - 1, 2 * node + 1))
    return out


def node_map(tree):
    return {r["node"]: (r["n_rows"], r["prediction"], r["feature"], r["threshold"]) for r in tree.nodes.collect()}


@pytest.mark.parametrize("sort_rows", [200_000, 3])
def test_median_tree_against_recursion(spark, sort_rows):
    """Once with plain sorts, once with every group narrowed down by ranges first."""
    df, data = make_rows(spark)
    tree = fit_median_tree(df, list("abcd"), 5, sort_rows=sort_rows)
    want = brute_tree([(f, y) for _, f, y in data], 5)
    got = node_map(tree)
    assert got.keys() == want.keys()
    for node, (n, mean, j, t) in want.items():
        assert (got[node][0], got[node][2], got[node][3]) == (n, j, t)
        assert got[node][1] == pytest.approx(mean, abs=1e-9)


def test_upper_median_skips_single_values(spark):
    values = [(0, 3.0), (0, 1.0), (1, 4.0), (2, 5.0), (2, -2.0), (2, 9.0)]
    df = spark.createDataFrame(
        [(1, j, v, i + 1, v) for i, (j, v) in enumerate(values)],
        "node long, feature int, value double, n long, s double",
    ).withColumn("s", F.col("s").cast("decimal(28,9)"))
    splits, totals = median_splits(df, 3)
    got = {r["feature"]: (r["threshold"], r["n_left"], float(r["s_left"])) for r in splits.collect()}
    assert got == {0: (3.0, 3, 4.0), 2: (5.0, 9, 3.0)}
    assert totals.first()["n_rows"] == 3


def test_empty_side_is_only_allowed_on_request(spark):
    df = spark.createDataFrame([([0.0], 1.0), ([1.0], 2.0)], "features array<double>, label double")
    sums = value_sums(df.withColumn("node", F.lit(1).cast("long")))
    splits, _ = median_splits(sums, 1)
    assert split_gains(splits).count() == 0
    kept = split_gains(splits, allow_empty_child=True).first()
    assert (kept["threshold"], kept["n_right"], kept["gain"]) == (1.0, 0, 0.0)
    tree = fit_median_tree(df, ["a"], 1, allow_empty_child=True)
    unseen = spark.createDataFrame([([0.5],), ([7.0],)], "features array<double>")
    assert [r["prediction"] for r in tree_nodes.predict(unseen, tree).collect()] == [1.5, 0.0]


def test_lowest_feature_wins_ties(spark):
    df = spark.createDataFrame(
        [([float(i), float(i), float(-i)], float(i % 3) / 7) for i in range(9)], "features array<double>, label double"
    )
    assert node_map(fit_median_tree(df, list("abc"), 1))[1][2] == 0


def test_predictions_agree_however_they_are_made(spark):
    df, data = make_rows(spark)
    tree = fit_median_tree(df, list("abcd"), 4)
    leaves = node_map(tree)

    def follow(f):
        node = 1
        while leaves[node][2] is not None:
            node = 2 * node + (0 if f[leaves[node][2]] <= leaves[node][3] else 1)
        return leaves[node][1]

    by_case = {r["id"]: r["prediction"] for r in tree_nodes.predict(df, tree).collect()}
    by_walk = {r["id"]: r["predictions"] for r in tree_nodes.predict_depths(df, tree).collect()}
    cut = {r["id"]: r["prediction"] for r in tree_nodes.predict(df, tree.cut(2)).collect()}
    refit = node_map(fit_median_tree(df, list("abcd"), 2))
    assert node_map(tree.cut(2)) == refit
    for i, f, _ in data:
        assert by_case[i] == by_walk[i][-1] == follow(f)
        assert by_walk[i][2] == cut[i]


def test_paths_text_and_importances(spark):
    df = spark.createDataFrame(
        [([1.0], math.log1p(100)), ([2.0], math.log1p(100)), ([3.0], math.log1p(900))],
        "features array<double>, label double",
    )
    tree = fit_median_tree(df, ["size"], 1)
    steps = tree_nodes.decision_paths(df, tree).orderBy(F.col("features")[0].desc()).first()["steps"]
    assert steps == [
        "size = 3.0000 > 2.0000, go right",
        "Reached leaf, predict: 6.8035 (original scale: 900.00 seconds)",
    ]
    lines = [r["line"] for r in tree_nodes.tree_lines(tree).orderBy("position").collect()]
    assert lines == ["If size <= 2.00", "  Predict: 4.62", "Else", "  Predict: 6.80"]
    assert [r["importance"] for r in tree_nodes.split_importances(tree).collect()] == [1.0]


def test_library_depth_grid_equals_separate_fits(spark):
    df, _ = make_rows(spark)
    df = df.persist()
    tree, table = library_models.depth_grid(df, df, list("abcd"), [1, 2, 3, 5])
    got = {r["depth"]: (r["rmse"], r["r2"]) for r in table.collect()}
    from tidemark.operators.metrics import regression_metrics

    vectors = library_models.with_vectors(df)
    for depth in (1, 2, 3, 5):
        alone = regression_metrics(library_models.fit_tree(vectors, depth).transform(vectors)).first()
        assert got[depth] == pytest.approx((alone["rmse"], alone["r2"]))


@pytest.mark.parametrize("method", ["library", "median"])
def test_trip_job(spark, method):
    source = trips(spark, SMALL)
    result = trip_job(source, source, method, depths=[1, 2, 3])
    assert result.predictions.count() == source.count()
    assert result.predictions.filter("prediction < 0").count() == 0
    table = {r["metric"]: r["value"] for r in result_tables(result).collect()}
    assert int(table["best_max_depth"]) in (1, 2, 3)
    assert any(k.startswith("tree line") for k in table)
