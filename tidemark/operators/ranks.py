"""Order-preserving whole numbers in place of values: distinct values numbered once per feature.

Distinct values are dealt by ranges of (feature, value), so no task sorts a feature alone; a value's rank is its
place in its range plus the distinct values of its feature in the ranges before. Rows then carry
ranks. Features with few distinct values are looked up in broadcast dictionaries of a counted size; all others
go through one shuffle by value and one back by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import written

# Distinct values of a feature up to which its dictionary is broadcast (about a megabyte).
DICTIONARY_ROWS = 1 << 16


@dataclass
class Dictionary:
    """``values``: ``(feature, value, rank)`` with ranks from 0; ``sizes``: number of values per feature."""

    values: DataFrame
    sizes: list[int]


def number_values(rows: DataFrame, n_features: int) -> Dictionary:
    """Ranks of the distinct values of every position of ``features``."""
    distinct = rows.select(F.posexplode("features").alias("feature", "value")).distinct()
    ranged = written(
        distinct.repartitionByRange("feature", "value")
        .sortWithinPartitions("feature", "value")
        .select(
            "feature",
            "value",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        ),
        "values",
    )
    # One row per range and feature in it.
    parts = ranged.groupBy("part", "feature").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shifts = written(
        parts.select("part", "feature", "n", (F.sum("n").over(before) - F.col("n") - F.col("first")).alias("shift")), "shifts"
    )
    sizes = {r["feature"]: r["n"] for r in shifts.groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    ranked = ranged.join(shifts.drop("n"), ["part", "feature"]).select(
        "feature", "value", (F.col("place") + F.col("shift")).alias("rank")
    )
    return Dictionary(written(ranked, "ranks"), [sizes.get(f, 0) for f in range(n_features)])


def to_ranks(rows: DataFrame, dictionary: Dictionary, dictionary_rows: int = DICTIONARY_ROWS) -> DataFrame:
    """``features`` replaced by ``ranks``; the other columns stay. Every value must be in the dictionary."""
    sizes = dictionary.sizes
    kind = "int" if max(sizes, default=0) < 1 << 31 else "long"
    others = [c for c in rows.columns if c != "features"]
    small = [f for f, n in enumerate(sizes) if n <= dictionary_rows]
    large = [f for f in range(len(sizes)) if f not in small]
    out = rows
    for f in small:
        ranks = dictionary.values.where(F.col("feature") == f).select(
            F.col("value").alias(f"_value_{f}"), F.col("rank").cast(kind).alias(f"_rank_{f}")
        )
        out = out.join(F.broadcast(ranks), F.col("features")[f] == F.col(f"_value_{f}")).drop(f"_value_{f}")
    if large:
        # The row itself travels with the first of its values.
        payload = F.struct(*others, *[f"_rank_{f}" for f in small])
        cells = F.array(*[
            F.struct(F.lit(f).alias("feature"), F.col("features")[f].alias("value"), (payload if f == large[0] else F.lit(None)).alias("row"))
            for f in large
        ])
        long = out.withColumn("_id", F.monotonically_increasing_id()).select("_id", F.inline(cells))
        met = long.join(dictionary.values.hint("merge"), ["feature", "value"])
        out = (
            met.groupBy("_id")
            .agg(
                F.max("row").alias("row"),
                *[F.max(F.when(F.col("feature") == f, F.col("rank"))).cast(kind).alias(f"_rank_{f}") for f in large],
            )
            .select("row.*", *[f"_rank_{f}" for f in large])
        )
    return out.select(*others, F.array(*[f"_rank_{f}" for f in range(len(sizes))]).alias("ranks"))


def to_values(nodes: DataFrame, dictionary: Dictionary, nodes_at_most: int) -> DataFrame:
    """``threshold`` of ``(feature, threshold)`` rows from rank to value; null stays null."""
    wanted = nodes.where(F.col("feature").isNotNull()).select("feature", F.col("threshold").alias("rank")).distinct()
    if nodes_at_most <= DICTIONARY_ROWS:
        wanted = F.broadcast(wanted)
    values = dictionary.values.join(wanted, ["feature", "rank"]).select(
        F.col("feature").alias("_feature"), F.col("rank").alias("_rank"), "value"
    )
    met = (F.col("feature") == F.col("_feature")) & (F.col("threshold") == F.col("_rank"))
    return nodes.join(values, met, "left").withColumn("threshold", F.col("value")).drop("_feature", "_rank", "value")
