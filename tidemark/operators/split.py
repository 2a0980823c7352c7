"""Train / validation / test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Values of a 32-bit hash; shares are met to one in four billion.
HASHES = 1 << 32


def key_hash(key: Column) -> Column:
    """The first 32 bits of the key's md5; the same in any engine and any partitioning. Null is ``''``."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def split_bounds(weights: list[float]) -> list[int]:
    """Hash values below which the splits end; the last one covers all."""
    total, bounds, running = sum(weights), [], 0.0
    for w in weights:
        running += w
        bounds.append(round(HASHES * running / total))
    return [*bounds[:-1], HASHES]


def split_number(key: Column, weights: list[float]) -> Column:
    """Index of the split a key belongs to; every key, null too, belongs to one."""
    hashed, number = key_hash(key), F
    for i, bound in enumerate(split_bounds(weights)):
        number = number.when(hashed < bound, i)
    return number


def hash_split(df: DataFrame, key: str, weights: list[float]) -> list[DataFrame]:
    """Disjoint splits by key that add up to all rows. Unlike a seeded random split it survives retries and re-reads."""
    number = split_number(F.col(key), weights)
    return [df.filter(number == i) for i in range(len(weights))]


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    return df.randomSplit(weights, seed=seed)
