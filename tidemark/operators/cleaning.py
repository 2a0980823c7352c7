"""Row filters on nulls and non-finite values, and row distinctness."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_except(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def drop_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any column, as ``na.drop`` does."""
    return df.na.drop(subset=columns)


def _all(conditions: list[Column]) -> Column:
    return reduce(and_, conditions)


def drop_nan(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with NaN in any of the columns; nulls stay."""
    return df.filter(_all([~F.coalesce(F.isnan(c), F.lit(False)) for c in columns]))


def drop_nonfinite(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with null, NaN or an infinity in any of the columns."""
    return df.filter(_all([F.col(c).isNotNull() & (F.abs(F.col(c)) < F.lit(float("inf"))) for c in columns]))


def distinct_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values of the columns; copies collapse before the shuffle."""
    return df.select(*columns).distinct()


def rejoin_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Inner join back to a list of ids.

    An id listed n times multiplies its rows by n. The pipelines carry ``id`` along instead and
    do not need this join.
    """
    return df.join(ids.select("id"), "id", "inner")
