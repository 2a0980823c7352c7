"""Models fitted by ``pyspark.ml``: logistic regression and decision-tree regression."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import from_log_label
from tidemark.operators.metrics import regression_metrics
from tidemark.operators.tree_nodes import NodeTree, predict_depths
from tidemark.session import ensure_checkpoint_dir, scratch_dir

# Fixed value: depths searched.
TREE_DEPTHS = list(range(1, 21))


def with_vectors(rows: DataFrame, column: str = "features", output: str = "features") -> DataFrame:
    """``array<double>`` column to an ML vector."""
    return rows.withColumn(output, array_to_vector(F.col(column)))


def fit_logistic(train: DataFrame, max_iter: int = 10, label: str = "label") -> LogisticRegressionModel:
    """Unregularised logistic regression by L-BFGS on ``features``."""
    return LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter).fit(train)


def library_auc(predictions: DataFrame, label: str = "label", bins: int = 0) -> float:
    """Area under ROC from the library; ``bins = 0`` keeps every distinct score."""
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=bins).evaluate(predictions)


def library_metric(predictions: DataFrame, name: str, label: str = "label") -> float:
    return MulticlassClassificationEvaluator(labelCol=label, metricName=name).evaluate(predictions)


def fit_tree(train: DataFrame, max_depth: int) -> DecisionTreeRegressionModel:
    return DecisionTreeRegressor(
        featuresCol="features", labelCol="label", maxDepth=max_depth, impurity="variance"
    ).fit(train)


def predict_original(model: DecisionTreeRegressionModel, rows: DataFrame) -> DataFrame:
    """``id`` and ``prediction`` on the original scale; the id stays in the row throughout."""
    return model.transform(rows).select("id", from_log_label(F.col("prediction")).alias("prediction"))


def node_tree(model: DecisionTreeRegressionModel, feature_names: list[str], spark: SparkSession) -> NodeTree:
    """A fitted tree as node tables, read back from its saved form."""
    ensure_checkpoint_dir(spark)
    path = scratch_dir(spark, "tree-model")
    model.write().save(path)
    is_split = F.col("leftChild") >= 0
    saved = spark.read.parquet(f"{path}/data").select(
        "id",
        F.col("rawCount").alias("n_rows"),
        "prediction",
        F.when(is_split, F.col("split.featureIndex")).alias("feature"),
        F.when(is_split, F.try_element_at("split.leftCategoriesOrThreshold", F.lit(1))).alias("threshold"),
        F.when(is_split, F.array("leftChild", "rightChild")).alias("children"),
    )
    # Sides taken from an ancestor down to the node. Each round doubles the distance covered.
    up = saved.select(F.posexplode("children").alias("path", "id"), F.col("id").alias("top"))
    up = up.select("id", "top", F.col("path").cast("long").alias("path"), F.lit(1).alias("length"))
    covered = 1
    while covered < model.depth:
        above = up.select(
            F.col("id").alias("top"),
            F.col("top").alias("next_top"),
            F.col("path").alias("next_path"),
            F.col("length").alias("next_length"),
        )
        up = (
            up.join(above, "top", "left")
            .select(
                "id",
                F.coalesce("next_top", "top").alias("top"),
                (F.coalesce(F.col("next_path"), F.lit(0)) * F.pow(F.lit(2), F.col("length")).cast("long") + F.col("path")).alias("path"),
                (F.coalesce(F.col("next_length"), F.lit(0)) + F.col("length")).alias("length"),
            )
            .checkpoint()
        )
        covered *= 2
    depth = F.coalesce(F.col("length"), F.lit(0))
    nodes = (
        saved.join(up, "id", "left")
        .select(
            (F.pow(F.lit(2), depth).cast("long") + F.coalesce("path", F.lit(0))).alias("node"),
            depth.alias("depth"),
            "n_rows",
            "prediction",
            "feature",
            "threshold",
        )
        .checkpoint()
    )
    sizes = {r["depth"]: r["count"] for r in nodes.groupBy("depth").count().collect()}
    depths = range(model.depth + 1)
    return NodeTree(list(feature_names), [nodes.filter(F.col("depth") == d) for d in depths], [sizes[d] for d in depths])


def depth_metrics(tree: NodeTree, rows: DataFrame, depths: list[int]) -> DataFrame:
    """RMSE and R2 of the tree cut at each depth, from one walk over ``(features, label)`` rows.

    A tree grown to a lower maximum depth is the top of a deeper one, so the whole depth search
    needs one fitted tree and one pass. Depths beyond the tree repeat its deepest level.
    """
    by_depth = F.array(
        *[
            F.struct(F.lit(d).alias("depth"), F.col("predictions")[min(d, tree.depth)].alias("prediction"))
            for d in depths
        ]
    )
    fanned = predict_depths(rows.select("features", "label"), tree).select("label", F.inline(by_depth))
    return regression_metrics(fanned, by=["depth"])


def depth_grid(
    train: DataFrame, validation: DataFrame, feature_names: list[str], depths: list[int]
) -> tuple[NodeTree, DataFrame]:
    """Fit once to the largest depth and measure every depth on validation rows (array features)."""
    model = fit_tree(with_vectors(train), max(depths))
    tree = node_tree(model, feature_names, train.sparkSession)
    return tree, depth_metrics(tree, validation, depths)
