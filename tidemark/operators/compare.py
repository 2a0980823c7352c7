"""Pairwise comparison of prediction sets."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Differences in seconds reported as large.
LARGE_DIFFERENCES = [120, 180]


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """``id, prediction`` from a CSV folder or file; fails if either column is missing."""
    header = spark.read.option("header", True).csv(path).columns
    missing = {"id", "prediction"} - set(header)
    if missing:
        raise ValueError(f"{path} must have columns id and prediction; missing {sorted(missing)}")
    schema = ", ".join(f"`{c}` {'double' if c == 'prediction' else 'string'}" for c in header)
    return spark.read.schema(schema).option("header", True).csv(path).select("id", "prediction")


def compare_predictions(sets: dict[str, DataFrame]) -> DataFrame:
    """One row per pair of sets: do the ids match, mean absolute error, share of large differences.

    All sets are laid side by side by one aggregate over ids, and every pair is then measured in a
    single pass. Ids match when both sets hold the same ids, each once; otherwise the measures are
    null and ``ids_match`` says so.
    """
    names = list(sets)
    tagged = reduce(
        DataFrame.unionByName,
        [df.select("id", "prediction", F.lit(i).alias("source")) for i, df in enumerate(sets.values())],
    )
    mine = {i: F.col("source") == i for i in range(len(names))}
    aligned = tagged.groupBy("id").agg(
        *[F.count_if(mine[i]).alias(f"n_{i}") for i in mine],
        *[F.max(F.when(mine[i], F.col("prediction"))).alias(f"p_{i}") for i in mine],
    )
    pairs = list(combinations(range(len(names)), 2))
    aggregates = []
    for a, b in pairs:
        error = F.abs(F.col(f"p_{a}") - F.col(f"p_{b}"))
        present = (F.col(f"n_{a}") > 0) | (F.col(f"n_{b}") > 0)
        unmatched = present & ((F.col(f"n_{a}") != 1) | (F.col(f"n_{b}") != 1))
        key = f"{a}_{b}"
        aggregates += [F.count_if(unmatched).alias(f"unmatched_{key}"), F.avg(error).alias(f"mean_{key}")]
        aggregates += [F.count_if(error > limit).alias(f"over_{limit}_{key}") for limit in LARGE_DIFFERENCES]
        aggregates.append(F.count(error).alias(f"compared_{key}"))
    rows = []
    for a, b in pairs:
        key = f"{a}_{b}"
        matched = F.col(f"unmatched_{key}") == 0
        rows.append(
            F.struct(
                F.lit(f"{names[a]} vs {names[b]}").alias("file_pair"),
                matched.alias("ids_match"),
                F.when(matched, F.col(f"mean_{key}")).alias("mean_error"),
                *[
                    F.when(
                        matched,
                        F.coalesce(
                            F.try_divide(F.lit(100.0) * F.col(f"over_{limit}_{key}"), F.col(f"compared_{key}")), F.lit(0.0)
                        ),
                    ).alias(f"percentage_{limit}")
                    for limit in LARGE_DIFFERENCES
                ],
            )
        )
    return aligned.agg(*aggregates).select(F.inline(F.array(*rows)))
