"""Regression trees as node tables: walking, prediction, decision paths, importances and text.

A node row is ``(node, depth, n_rows, prediction, feature, threshold)``; nodes are numbered 1 for
the root and ``2n`` / ``2n + 1`` for the children of ``n``, and ``<=`` goes left; leaves have null
``feature``. Every node keeps its own mean, so a tree cut at a lower depth is a prefix of this one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROOT = 1
# Node numbers double per level and must fit 64 bits.
DEEPEST = 61
# Texts of decision steps, reached leaves and tree lines.
STEP_TEXT = "%s = %.4f %s %.4f, go %s"
REACHED_TEXT = "Reached leaf, predict: %.4f (original scale: %.2f seconds)"
SPLIT_LINE = "If %s <= %.2f"
ELSE_LINE = "Else"
LEAF_LINE = "Predict: %.2f"
# A level or node table is broadcast only up to this many rows (a few MB).
BROADCAST_ROWS = 1 << 16
# Levels a row walks down per join.
BLOCK_LEVELS = 6
# Blocks that are broadcast at most; each holds up to 63 nodes, two kilobytes.
BROADCAST_BLOCKS = 1 << 11
# The nested expression is one node after the other in code, and so is refused for deeper trees.
EXPRESSION_DEPTH = 6


def sized(small: DataFrame, rows_at_most: int) -> DataFrame:
    """Broadcast a table whose row count is known to stay small; otherwise leave the join to Spark."""
    return F.broadcast(small) if rows_at_most <= BROADCAST_ROWS else small


def child_of(node: Column, value: Column, threshold: Column) -> Column:
    return 2 * node + F.when(value <= threshold, 0).otherwise(1)


@dataclass
class NodeTree:
    """Node tables by depth; each is written out and holds at most ``2 ** depth`` rows, ``sizes`` says how many."""

    feature_names: list[str]
    levels: list[DataFrame] = field(default_factory=list)
    sizes: list[int] | None = None

    @property
    def depth(self) -> int:
        return len(self.levels) - 1

    @property
    def nodes(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.levels)

    def cut(self, depth: int) -> NodeTree:
        """The tree that growth limited to ``depth`` would have given."""
        kept = self.levels[: depth + 1]
        last = kept[-1].withColumns(
            {"feature": F.lit(None).cast("int"), "threshold": F.lit(None).cast("double")}
        )
        return NodeTree(self.feature_names, [*kept[:-1], last], self.sizes and self.sizes[: depth + 1])

    def level_size(self, depth: int) -> int:
        """Number of nodes at a depth: as the fit counted them, else at most."""
        return self.sizes[depth] if self.sizes else 1 << depth


def _blocks(tree: NodeTree, first: int, levels: int) -> DataFrame:
    """Subtrees of so many levels whose roots are at depth ``first``: ``(root, block)``.

    ``block`` is an array in heap order: the root's place is 1, the children of ``p`` are ``2p`` and ``2p + 1``.
    """
    down = F.col("depth") - first
    root = F.floor(F.col("node") / F.pow(F.lit(2), down)).cast("long")
    place = (F.col("node") - (root - 1) * F.pow(F.lit(2), down).cast("long")).cast("int")
    nodes = reduce(DataFrame.unionByName, tree.levels[first : first + levels])
    entry = F.struct(
        place.alias("place"), F.struct("feature", "threshold", F.coalesce("prediction", F.lit(0.0)).alias("prediction"))
    )
    filled = nodes.groupBy(root.alias("root")).agg(F.map_from_entries(F.collect_list(entry)).alias("at"))
    places = F.sequence(F.lit(1), F.lit((1 << levels) - 1))
    return filled.select("root", F.transform(places, lambda p: F.try_element_at("at", p)).alias("block"))


Visit = Callable[[Column, Column, Column, Column], Column]


def _walk(rows: DataFrame, tree: NodeTree, name: str, start: Column, visit: Visit) -> DataFrame:
    """Follow each row down the tree and collect column ``name`` on the way.

    ``visit`` gives its new value from the one so far, whether the row is at a node still, the node
    ``(feature, threshold, prediction)`` and the feature's value. One join carries a row over
    ``BLOCK_LEVELS`` levels. The root's block meets every row with as many features as the tree has; a row of
    another width keeps the start value. Further down few blocks are broadcast; else the rows that are
    still on their way, and only they, are shuffled to them. The fit says how many blocks there are, so nothing runs here.
    """
    kept = rows.columns
    walked = rows.select(*kept, F.lit(ROOT).cast("long").alias("node"), start.alias(name))
    for first in range(0, len(tree.levels), BLOCK_LEVELS):
        levels = min(BLOCK_LEVELS, len(tree.levels) - first)
        blocks = _blocks(tree, first, levels)
        over = 1 << levels

        def step(so_far: Column, _: Column) -> Column:
            alive = so_far["place"].isNotNull()
            node = F.get(F.col("block"), so_far["place"] - 1)
            value = F.get(F.col("features"), node["feature"])
            child = 2 * so_far["place"] + F.when(value <= node["threshold"], 0).otherwise(1)
            return F.struct(
                F.when(node["feature"].isNotNull(), child).alias("place"),
                visit(so_far["value"], alive, node, value).alias("value"),
            )

        at_root = F.col("node").isNotNull() & F.col("block").isNotNull()
        here = F.struct(F.when(at_root, F.lit(1)).alias("place"), F.col(name).alias("value"))
        end = F.aggregate(F.sequence(F.lit(1), F.lit(levels)), here, step)
        onward = F.col("node") * over + F.col("end.place") - over
        if not first:
            # The root is number 1, read from its row: a literal would fold away, and the hash join with it.
            one = blocks.select((F.col("root") * len(tree.feature_names)).alias("width"), "block")
            met = walked.join(F.broadcast(one), F.size("features") == F.col("width"), "left")
        elif tree.level_size(first) <= BROADCAST_BLOCKS:
            met = walked.join(F.broadcast(blocks), F.col("node") == F.col("root"), "left")
        else:
            walked = walked.checkpoint()
            met = walked.filter(F.col("node").isNotNull()).join(blocks, F.col("node") == F.col("root"), "left")
            moved = met.withColumn("end", end).select(*kept, onward.alias("node"), F.col("end.value").alias(name))
            walked = moved.unionByName(walked.filter(F.col("node").isNull()))
            continue
        walked = met.withColumn("end", end).select(*kept, onward.alias("node"), F.col("end.value").alias(name))
    return walked.drop("node")


def predict_depths(rows: DataFrame, tree: NodeTree) -> DataFrame:
    """Add ``predictions``: what the tree cut at depth 0, 1, ... would predict, in one walk.

    A side that was empty in training predicts 0.
    """

    def visit(so_far: Column, alive: Column, node: Column, value: Column) -> Column:
        reached = F.array(F.coalesce(node["prediction"], F.lit(0.0)))
        return F.when(alive, F.concat(so_far, reached)).otherwise(so_far)

    walked = _walk(rows, tree, "predictions", F.array().cast("array<double>"), visit)
    # From its leaf on a row's prediction stays.
    missing = F.lit(tree.depth + 1) - F.size("predictions")
    last = F.array_repeat(F.element_at("predictions", -1), missing)
    return walked.withColumn("predictions", F.concat("predictions", last))


def predict(rows: DataFrame, tree: NodeTree) -> DataFrame:
    """Add ``prediction`` on the label scale."""

    def visit(so_far: Column, alive: Column, node: Column, value: Column) -> Column:
        return F.when(alive, F.coalesce(node["prediction"], F.lit(0.0))).otherwise(so_far)

    return _walk(rows, tree, "prediction", F.lit(0.0), visit)


def predict_expression(tree: NodeTree, features: str = "features") -> Column:
    """The tree as one nested CASE; needs no join. Meant for shallow trees."""
    if tree.depth > EXPRESSION_DEPTH:
        raise ValueError(f"expression form is limited to depth {EXPRESSION_DEPTH}")
    # At most 2 ** (EXPRESSION_DEPTH + 1) rows.
    nodes = {r["node"]: r for r in tree.nodes.collect()}

    def build(node: int) -> Column:
        row = nodes.get(node)
        if row is None:
            return F.lit(0.0)
        if row["feature"] is None:
            return F.lit(row["prediction"])
        return F.when(F.col(features)[row["feature"]] <= row["threshold"], build(2 * node)).otherwise(
            build(2 * node + 1)
        )

    return build(ROOT)


def decision_paths(rows: DataFrame, tree: NodeTree) -> DataFrame:
    """Add ``steps``: the decisions taken per row as text, ending with the leaf on both scales."""
    names = F.array(*[F.lit(n) for n in tree.feature_names])

    def visit(so_far: Column, alive: Column, node: Column, value: Column) -> Column:
        left = value <= node["threshold"]
        decision = F.format_string(
            STEP_TEXT,
            F.get(names, node["feature"]),
            value,
            F.when(left, "<=").otherwise(">"),
            node["threshold"],
            F.when(left, "left").otherwise("right"),
        )
        reached = F.coalesce(node["prediction"], F.lit(0.0))
        leaf = F.format_string(REACHED_TEXT, reached, F.expm1(reached))
        text = F.when(node["feature"].isNotNull(), decision).otherwise(leaf)
        return F.when(alive, F.concat(so_far, F.array(text))).otherwise(so_far)

    return _walk(rows, tree, "steps", F.array().cast("array<string>"), visit)


def split_importances(tree: NodeTree) -> DataFrame:
    """Share of splits per feature; unused features get 0."""
    used = tree.nodes.filter(F.col("feature").isNotNull()).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    spark = used.sparkSession
    names = spark.createDataFrame(list(enumerate(tree.feature_names)), "feature int, name string")
    # One row per feature name; their total is a window over these few rows.
    joined = names.join(used, "feature", "left")
    total = F.sum("n").over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    share = F.coalesce(F.try_divide(F.col("n"), total), F.lit(0.0))
    return joined.select("feature", "name", share.alias("importance"))


def impurity_importances(tree: NodeTree) -> DataFrame:
    """Share of the label variance that splits on each feature remove; unused features get 0."""
    nodes = tree.nodes
    side = lambda bit, s: nodes.filter(F.col("node") % 2 == bit).select(
        F.floor(F.col("node") / 2).alias("node"), F.col("n_rows").alias(f"n_{s}"), F.col("prediction").alias(f"p_{s}")
    )
    splits = (
        nodes.filter(F.col("feature").isNotNull())
        .select("node", "feature")
        .join(side(0, "left"), "node")
        .join(side(1, "right"), "node")
    )
    n_left, n_right = F.col("n_left").cast("double"), F.col("n_right").cast("double")
    removed = n_left * n_right / (n_left + n_right) * F.pow(F.col("p_left") - F.col("p_right"), 2)
    used = splits.groupBy("feature").agg(F.sum(removed).alias("removed"))
    names = used.sparkSession.createDataFrame(list(enumerate(tree.feature_names)), "feature int, name string")
    joined = names.join(used, "feature", "left")
    total = F.sum("removed").over(
        Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    share = F.coalesce(F.try_divide(F.col("removed"), F.nullif(total, F.lit(0.0))), F.lit(0.0))
    return joined.select("feature", "name", share.alias("importance"))


def tree_lines(tree: NodeTree) -> DataFrame:
    """The tree as indented text lines; order by ``position`` to read it."""
    names = F.array(*[F.lit(n) for n in tree.feature_names])
    # Path from the root: 0 = left, 2 = right; "1" places the Else line between the two subtrees.
    path = F.translate(F.substring(F.bin("node"), 2, 64), "1", "2")
    indent = F.repeat(F.lit("  "), F.col("depth"))
    is_leaf = F.col("feature").isNull()
    leaf = F.format_string(LEAF_LINE, F.col("prediction"))
    test = F.format_string(SPLIT_LINE, names[F.col("feature")], F.col("threshold"))
    first = F.struct(path.alias("position"), F.concat(indent, F.when(is_leaf, leaf).otherwise(test)).alias("line"))
    second = F.struct(F.concat(path, F.lit("1")).alias("position"), F.concat(indent, F.lit(ELSE_LINE)).alias("line"))
    lines = F.when(is_leaf, F.array(first)).otherwise(F.array(first, second))
    return tree.nodes.select(F.inline(lines))
