"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for each node of ``(a, b)`` edges: the smallest id it can reach.

    Alternates two steps until the edges are stars: every node hands its larger neighbours, then
    its smaller ones and itself, to the smallest node it knows. Both are an aggregate per node and a join, so a
    node with many neighbours is pre-aggregated and split like any hot key. Each round is written out.
    """
    smaller, larger = F.least("a", "b"), F.greatest("a", "b")
    now = materialise(
        edges.where(F.col("a") != F.col("b")).select(larger.alias("u"), smaller.alias("v")).distinct(), "edges"
    )
    before = _state(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        large = materialise(large.where(F.col("u") != F.col("v")), "edges-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        now = materialise(small, "edges-small")
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct()
    )
