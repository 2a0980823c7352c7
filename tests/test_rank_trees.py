"""Trees on whole numbers: numbering, medians by radix descent, histograms, against plain recursion."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import histogram_tree, median_tree, ranks, tree_nodes

NEAR = 1e-9


def make_rows(spark, n, seed, hot=False):
    r = random.Random(seed)
    data = []
    for i in range(n):
        wide = 5.0 if hot and i % 3 else r.uniform(-1e6, 1e6)
        data.append(([float(r.randrange(3)), wide, r.choice([-0.0, 0.0, 1e-300, -1e300]), float(i % 150)], round(r.gauss(3, 2) + (i % 150) / 50, 6)))
    return spark.createDataFrame(data, "features array<double>, label double").repartition(3), data


@pytest.mark.parametrize("dictionary_rows", [1 << 16, 3])
def test_ranks_keep_order_and_rows(spark, dictionary_rows):
    df, data = make_rows(spark, 400, 1, hot=True)
    df = df.withColumn("more", F.lit("x"))
    numbered = ranks.number_values(df, 4)
    columns = [sorted({f[j] + 0.0 for f, _ in data}) for j in range(4)]
    assert numbered.sizes == [len(c) for c in columns]
    got = ranks.to_ranks(df, numbered, dictionary_rows).select("label", "more", "ranks").collect()
    want = sorted((y, [columns[j].index(f[j]) for j in range(4)]) for f, y in data)
    assert sorted((r["label"], list(r["ranks"])) for r in got) == want and {r["more"] for r in got} == {"x"}


@pytest.mark.parametrize("digit_bits", [1, 3, 16])
def test_medians_by_radix_descent(spark, digit_bits):
    r = random.Random(2)
    groups = {(node, f): sorted(r.sample(range(5000), r.choice([1, 2, 3, 63, 64, 65, 700]))) for node in (1, 2, 9) for f in range(3)}
    n_rows = max(map(len, groups.values()))
    rows = [(node, [groups[node, f][i % len(groups[node, f])] for f in range(3)]) for node in (1, 2, 9) for i in range(n_rows)]
    words = median_tree.rank_words(spark.createDataFrame(rows, "node long, ranks array<int>"))
    got = {(m["node"], m["feature"]): m["threshold"] for m in median_tree.median_ranks(words, 5000 >> 6, digit_bits).collect()}
    assert got == {k: v[len(v) // 2] for k, v in groups.items() if len(v) > 1}


def brute_tree(rows, depth, candidates, least_gain, node=1):
    """``candidates(rows, feature)`` gives thresholds; the best gain, lowest feature, lowest threshold wins."""
    mean = sum(y for _, y in rows) / len(rows)
    out = {node: (len(rows), mean, None, None)}
    best = None
    for j in range(len(rows[0][0])) if depth else ():
        for t in candidates(rows, j):
            left = [y for f, y in rows if f[j] <= t]
            right = [y for f, y in rows if f[j] > t]
            if left and right:
                gap = sum(left) / len(left) - sum(right) / len(right)
                gain = len(left) * len(right) / len(rows) ** 2 * gap * gap
                if gain > least_gain and (best is None or gain > best[0] * (1 + 1e-12)):
                    best = (gain, j, t)
    if best:
        _, j, t = best
        out[node] = (len(rows), mean, j, t)
        for side, part in enumerate(([r for r in rows if r[0][j] <= t], [r for r in rows if r[0][j] > t])):
            out.update(brute_tree(part, depth - 1, candidates, least_gain, 2 * node + side))
    return out


def same_tree(tree, want):
    got = {r["node"]: r for r in tree.nodes.collect()}
    assert got.keys() == want.keys()
    for node, (n, mean, j, t) in want.items():
        assert (got[node]["n_rows"], got[node]["feature"], got[node]["threshold"]) == (n, j, t)
        assert got[node]["prediction"] == pytest.approx(mean, abs=NEAR)
    assert tree.sizes == [sum(1 for v in want if v.bit_length() == d + 1) for d in range(len(tree.levels))]


def test_median_tree_when_no_dictionary_is_broadcast(spark):
    df, data = make_rows(spark, 300, 3, hot=True)

    def median(rows, j):
        values = sorted({f[j] for f, _ in rows})
        return [values[len(values) // 2]] if len(values) > 1 else []

    tree = median_tree.fit_median_tree(df, list("abcd"), 4, sort_rows=2, dictionary_rows=0)
    same_tree(tree, brute_tree(data, 4, median, -1.0))


def bin_edges(rows, bins):
    edges = []
    for j in range(len(rows[0][0])):
        column = sorted(f[j] for f, _ in rows)
        values = sorted(set(column))
        if len(values) <= bins:
            edges.append(values)
        else:
            of = {v: column.index(v) * bins // len(column) for v in values}
            edges.append([max(v for v in values if of[v] == b) for b in sorted(set(of.values()))])
    return edges


@pytest.mark.parametrize(("bins", "hot"), [(32, False), (4, True), (500, True)])
def test_histogram_tree_against_recursion(spark, bins, hot):
    df, data = make_rows(spark, 500, bins, hot)
    edges = bin_edges(data, bins)
    assert histogram_tree.quantile_edges(df, 4, bins) == edges
    tree = histogram_tree.fit_histogram_tree(df, list("abcd"), 5, bins)
    same_tree(tree, brute_tree(data, 5, lambda _, j: edges[j], histogram_tree.LEAST_GAIN))


def test_equal_labels_and_odd_rows_give_one_leaf(spark):
    rows = [([float(i), 1.0], 0.1) for i in range(50)] + [([float("nan"), 1.0], 9.0), ([1.0, float("inf")], 9.0), ([1.0, 1.0], None), ([1.0, None], 9.0)]
    df = spark.createDataFrame(rows, "features array<double>, label double")
    tree = histogram_tree.fit_histogram_tree(df, ["a", "b"], 3)
    assert [(r["n_rows"], r["feature"]) for r in tree.nodes.collect()] == [(50, None)]
    with pytest.raises(ValueError):
        histogram_tree.fit_histogram_tree(df.limit(0), ["a", "b"], 3)


def test_rows_of_another_width_keep_the_start_value(spark):
    df, _ = make_rows(spark, 100, 5)
    tree = histogram_tree.fit_histogram_tree(df, list("abcd"), 2)
    odd = spark.createDataFrame([([1.0],), (None,)], "features array<double>")
    assert [r["prediction"] for r in tree_nodes.predict(odd, tree).collect()] == [0.0, 0.0]
