"""Query registry and output shaping."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PLACES = 6


def flat(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Comparable output: doubles to a number of places, timestamps without zone."""
    columns = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("double", "float"):
            c = F.round(c.cast("double"), places)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        columns.append(c.alias(name))
    return df.select(*columns)


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps inside arrays of structs without zone."""
    return df.select(*[F.col(f"`{name}`").cast(re.sub(r":timestamp\b", ":timestamp_ntz", kind)) for name, kind in df.dtypes])


def query(name: str, sql: str | None = None, places: int | None = PLACES):
    """Registers a query with its SQL twin; without ``places`` it shapes its rows by itself."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(tune(spark), sf_dir)
            return df if places is None else flat(df, places)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register
