"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Words are the runs between these characters: space and the control characters 9 to 13.
BREAKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A to Z lower-cased, other characters kept. Plain ASCII rows take the cheaper function."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: lineage ends there, and a lost
    executor costs no more than a read."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
