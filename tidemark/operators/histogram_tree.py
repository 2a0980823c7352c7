"""Regression tree on quantile bins: every bin edge of every feature is a candidate split.

Values are cut once into at most so many bins of about equal row counts, exactly and over all rows. Rows then carry
bin numbers. A level needs one aggregate, the label sums per (node, feature, bin), and of that only the smaller
child of each split: the larger one's histogram is its parent's less the smaller one's. Histograms have at
most nodes times features times bins rows, whatever the number of trips.

Labels are summed as whole numbers of fifteen digits, so sums do not depend on row order and equal splits tie exactly. Ties
go to the lowest feature, then to the lowest edge. Rows with a null, NaN or infinite feature or label are left out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.median_tree import exact_labels, exact_sum, finite_rows, label_places
from tidemark.operators.tree_nodes import DEEPEST, ROOT, NodeTree, child_of, sized
from tidemark.session import written

BINS = 32
# A split must remove at least so much of a node's label variance: more than rounding can make of equal labels.
LEAST_GAIN = 1e-9


def quantile_edges(rows: DataFrame, n_features: int, bins: int = BINS) -> list[list[float]]:
    """The largest value of each bin, per feature, in order.

    A value lies in bin ``rows below it * bins // rows``; a feature of at most ``bins`` distinct values has one bin for
    each. Values are dealt by ranges, and the rows below a range are a sum over ranges, so no task sees a
    whole feature. The driver gets the edges: ``bins`` numbers a feature.
    """
    counts = rows.selectExpr("posexplode(features) as (feature, value)").groupBy("feature", "value").agg(F.expr("count(1) as n"))
    ranged = counts.repartitionByRange("feature", "value").withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "bin-values")
    parts = ranged.groupBy("part", "feature").agg(F.expr("sum(n) as n_part"), F.expr("count(1) as values_part"))
    parts = parts.selectExpr(
        "part",
        "feature",
        "sum(n_part) over (partition by feature order by part rows unbounded preceding) - n_part as n_before",
        "sum(values_part) over (partition by feature order by part rows unbounded preceding) - values_part as values_before",
        "sum(n_part) over (partition by feature) as n_all",
        "sum(values_part) over (partition by feature) as values_all",
    )
    placed = ranged.join(parts, ["part", "feature"]).selectExpr(
        "feature",
        "value",
        "n_before + sum(n) over (partition by part, feature order by value rows unbounded preceding) - n as below",
        "values_before + row_number() over (partition by part, feature order by value) - 1 as place",
        "n_all",
        "values_all",
    )
    binned = placed.selectExpr("feature", "value", f"if(values_all <= {bins}, place, below * {bins} div n_all) as bin")
    edges: list[list[float]] = [[] for _ in range(n_features)]
    for r in sorted(binned.groupBy("feature", "bin").agg(F.max("value").alias("edge")).collect()):
        edges[r["feature"]].append(r["edge"])
    return edges


def to_bins(rows: DataFrame, edges: list[list[float]]) -> DataFrame:
    """``features`` replaced by ``bins``: the number of inner edges below each value."""
    each = [
        f"size(filter(cast(array({', '.join(f'{e!r}D' for e in own[:-1])}) as array<double>), e -> e < features[{f}]))"
        for f, own in enumerate(edges)
    ]
    return rows.selectExpr(*[c for c in rows.columns if c != "features"], f"array({', '.join(each)}) as bins")


def histogram(rows: DataFrame) -> DataFrame:
    """``(node, feature, bin, n, s)``: rows and label sum of every filled bin."""
    cells = rows.selectExpr("node", "high", "low", "posexplode(bins) as (feature, bin)")
    sums = cells.groupBy("node", "feature", "bin").agg(
        F.expr("count(1) as n"), F.expr("sum(high) as high"), F.expr("sum(low) as low")
    )
    return sums.selectExpr("node", "feature", "bin", "n", f"cast({exact_sum()} as decimal(38,0)) as s")


def best_edges(sums: DataFrame, depth: int, places: int, split: bool, least_gain: float) -> DataFrame:
    """The nodes of a level: ``(node, depth, n_rows, prediction, feature, bin, n_left)``, the last three null for leaves."""
    edge = "partition by node, feature order by bin rows unbounded preceding"
    sides = sums.selectExpr(
        "*",
        f"sum(n) over ({edge}) as n_left",
        f"cast(sum(s) over ({edge}) as decimal(38,0)) as s_left",
        "sum(n) over (partition by node, feature) as n_all",
        "cast(sum(s) over (partition by node, feature) as decimal(38,0)) as s_all",
    )
    gap = "cast(s_left as double) / n_left - cast(s_all - s_left as double) / nullif(n_all - n_left, 0)"
    share = "cast(n_left as double) * (n_all - n_left) / power(cast(n_all as double), 2)"
    unit = f"{10.0**places!r}D"
    gains = sides.selectExpr("*", f"{share} * power(({gap}) / {unit}, 2) as gain")
    sound = f"gain > {least_gain!r}D" if split else "false"
    return (
        gains.groupBy("node")
        .agg(
            F.expr("max(n_all) as n_rows"),
            F.expr("max(s_all) as s_all"),
            F.expr(f"max(if({sound}, struct(gain, -feature as f, -bin as b, n_left), null)) as best"),
        )
        .selectExpr(
            "node", f"{depth} as depth", "n_rows", f"cast(s_all as double) / n_rows / {unit} as prediction",
            "-best.f as feature", "-best.b as bin", "best.n_left as n_left",
        )
    )


def _child_histograms(rows: DataFrame, parents: DataFrame, chosen: DataFrame, nodes_at_most: int) -> DataFrame:
    """Histograms of both children of every split; only the rows of the smaller child are summed."""
    smaller = chosen.selectExpr("node as parent", "2 * node + if(2 * n_left <= n_rows, 0, 1) as node")
    own = histogram(rows.join(sized(smaller.select("node"), nodes_at_most), "node", "left_semi"))
    rest = (
        parents.withColumnRenamed("node", "parent")
        .join(sized(smaller, nodes_at_most), "parent")
        .join(own.withColumnsRenamed({"n": "n_own", "s": "s_own"}), ["node", "feature", "bin"], "left")
        .selectExpr(
            "node + if(node % 2 = 0, 1, -1) as node", "feature", "bin", "n - coalesce(n_own, 0) as n",
            "cast(s - coalesce(s_own, 0) as decimal(38,0)) as s",
        )
        .filter("n > 0")
    )
    return own.unionByName(rest)


def fit_histogram_tree(
    rows: DataFrame, feature_names: list[str], max_depth: int, bins: int = BINS, least_gain: float = LEAST_GAIN
) -> NodeTree:
    """Grow a tree on ``(features array<double>, label)``, which should be persisted by the caller."""
    if max_depth > DEEPEST:
        raise ValueError(f"trees go down to depth {DEEPEST}")
    rows, n_features = finite_rows(rows), len(feature_names)
    places = label_places(rows)
    edges = quantile_edges(rows, n_features, bins)
    if not all(edges):
        raise ValueError("no training rows")
    current = to_bins(rows.select("features", *exact_labels(places)), edges).withColumn("node", F.lit(ROOT).cast("long"))
    current = written(current, "binned")
    sums = written(histogram(current), "histogram")
    levels, sizes = [], []
    for depth in range(max_depth + 1):
        levels.append(written(best_edges(sums, depth, places, depth < max_depth, least_gain), "level"))
        nodes, splits = levels[-1].agg(F.count(F.lit(1)), F.count("feature")).first()
        sizes.append(nodes)
        if not splits:
            break
        chosen = levels[-1].filter(F.col("feature").isNotNull())
        child = child_of(F.col("node"), F.col("bins")[F.col("feature")], F.col("bin"))
        split = sized(chosen.select("node", "feature", "bin"), 1 << depth)
        current = written(current.join(split, "node").select("high", "low", "bins", child.alias("node")), "moved")
        sums = written(_child_histograms(current, sums, chosen, 1 << depth), "histogram")
    # One number per inner edge: at most features times bins.
    flat = [(f, b, e) for f, own in enumerate(edges) for b, e in enumerate(own)]
    table = rows.sparkSession.createDataFrame(flat, "feature int, bin int, threshold double")
    nodes = reduce(DataFrame.unionByName, levels).join(F.broadcast(table), ["feature", "bin"], "left")
    nodes = written(nodes.select("node", "depth", "n_rows", "prediction", "feature", "threshold"), "tree")
    return NodeTree(list(feature_names), [nodes.filter(F.col("depth") == d) for d in range(len(levels))], sizes)
