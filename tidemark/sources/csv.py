"""CSV scans and sinks with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.cleaning import drop_nonfinite

# The columns of the trip files, in order.
TRIP_COLUMNS = [
    ("id", "string"),
    ("vendor_id", "double"),
    ("pickup_datetime", "timestamp"),
    ("dropoff_datetime", "timestamp"),
    ("passenger_count", "double"),
    ("pickup_longitude", "double"),
    ("pickup_latitude", "double"),
    ("dropoff_longitude", "double"),
    ("dropoff_latitude", "double"),
    ("store_and_fwd_flag", "string"),
    ("trip_duration", "double"),
]
TRAIN_ONLY_COLUMNS = ["dropoff_datetime", "trip_duration"]
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV with a given schema; no inference pass. Fields that do not parse become null."""
    return spark.read.schema(schema).option("header", True).csv(path)


# What a cell can be, narrowest first; a column is the first kind that all its cells can be. Kinds of a cell only ever
# grow from int to long to double, so taking the narrowest kind for all cells is merging them pairwise, in any order.
_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^([+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|NaN|[+-]?Infinity)$"
KINDS = ("boolean", "int", "bigint", "double", "timestamp")


# Cells looked at first: a kind that one of them rules out is not asked of the others. They decide nothing else.
FIRST_ROWS = 1000


def _can_be(text: Column, kind: str, time_format: str) -> Column:
    if kind == "boolean":
        return F.lower(text).isin("true", "false")
    if kind == "double":
        return text.rlike(_NUMBER)
    if kind == "timestamp":
        return F.try_to_timestamp(text, F.lit(time_format)).isNotNull()
    return text.rlike(_WHOLE) & text.try_cast(kind).isNotNull()


def _fitting(text: DataFrame, asked: list[list[str]], time_format: str) -> tuple[list[list[str]], list[bool]]:
    """Which of the kinds asked of a column all its cells can be, and whether it has cells."""
    cells = [F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")) for c in text.columns]
    every = [
        F.bool_and(cell.isNull() | _can_be(cell, kind, time_format)).alias(f"{i}_{kind}")
        for i, cell in enumerate(cells)
        for kind in asked[i]
    ]
    some = [F.count(cell).alias(f"{i}_some") for i, cell in enumerate(cells)]
    seen = text.agg(*every, *some).first()
    fits = [[kind for kind in kinds if seen[f"{i}_{kind}"] is not False] for i, kinds in enumerate(asked)]
    return fits, [seen[f"{i}_some"] > 0 for i in range(len(cells))]


def infer_kinds(text: DataFrame, time_format: str = DATETIME_FORMAT) -> list[str]:
    """The kind of each text column, from all its cells; nothing is sampled.

    Cells are taken without surrounding blanks; null and blank ones say nothing, and a column of those alone is
    text. Numbers with leading zeros are numbers. The driver gets one row of some first rows, which strike the kinds
    their cells cannot be, and one of all rows, which are asked for the others.
    """
    asked, _ = _fitting(text.limit(FIRST_ROWS), [list(KINDS)] * len(text.columns), time_format)
    fits, some = _fitting(text, asked, time_format)
    return [kinds[0] if kinds and has else "string" for kinds, has in zip(fits, some)]


def with_kinds(text: DataFrame, kinds: list[str], time_format: str = DATETIME_FORMAT) -> DataFrame:
    """Text columns as these kinds; text itself stays as it is, blanks included."""

    def typed(name: str, kind: str) -> Column:
        raw = F.col(f"`{name}`")
        if kind == "string":
            return raw
        cell = F.nullif(F.trim(raw), F.lit(""))
        return F.try_to_timestamp(cell, F.lit(time_format)) if kind == "timestamp" else cell.try_cast(kind)

    return text.select(*[typed(n, k).alias(n) for n, k in zip(text.columns, kinds)])


def read_csv_inferred(spark: SparkSession, path: str, time_format: str = DATETIME_FORMAT) -> DataFrame:
    """Header CSV whose column types follow from all of its rows, header lines of joined files left out.

    Two passes over the files: one finds the kinds, the other reads. A file without rows is all text.
    """
    text = _no_headers(spark.read.options(header=True, mode="FAILFAST", enforceSchema=False).csv(path))
    return with_kinds(text, infer_kinds(text, time_format), time_format)


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV where any malformed row fails the job."""
    return spark.read.schema(schema).options(header=True, mode="FAILFAST").csv(path)


def _no_headers(text: DataFrame) -> DataFrame:
    """Joined files repeat their header line; a row that equals its column names is one."""
    same = F.lit(True)
    for name in text.columns:
        same = same & F.col(f"`{name}`").eqNullSafe(name)
    return text.filter(~same)


def _text_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _parsed(name: str, kind: str) -> Column:
    text = F.trim(F.col(name))
    if kind == "timestamp":
        return F.try_to_timestamp(text, F.lit(DATETIME_FORMAT)).alias(name)
    if kind == "double":
        return text.try_cast("double").alias(name)
    return F.col(name)


def read_trips_permissive(spark: SparkSession, path: str, train: bool = True) -> DataFrame:
    """Trip CSV where a row with any number or time that does not parse, or is not finite, is dropped."""
    columns = [(n, k) for n, k in TRIP_COLUMNS if train or n not in TRAIN_ONLY_COLUMNS]
    names = [n for n, _ in columns]
    text = spark.read.schema(_text_schema(names)).options(header=True, mode="DROPMALFORMED").csv(path)
    parsed = text.select(*[_parsed(n, k) for n, k in columns])
    complete = parsed.na.drop(subset=[n for n, k in columns if k != "string"])
    return drop_nonfinite(complete, [n for n, k in columns if k == "double"])


def read_labelled(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """First column ignored, last one a 0/1 label that may be quoted, the rest numeric features.

    Gives ``(features array<double>, label int)``; any bad value fails the job.
    """
    text = _no_headers(spark.read.schema(_text_schema(header)).options(header=True, mode="FAILFAST").csv(path))
    label = F.replace(F.col(header[-1]), F.lit('"'), F.lit("")).cast("int").alias("label")
    return text.select(F.array(*[F.col(c).cast("double") for c in header[1:-1]]).alias("features"), label)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV, overwriting. One file only on request: it funnels all rows through one task."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_predictions(predictions: DataFrame, path: str, decimals: int | None = None, single_file: bool = False) -> None:
    """``id, prediction`` sorted by id, optionally as text with fixed decimals."""
    value = F.col("prediction")
    if decimals is not None:
        value = F.format_string(f"%.{decimals}f", value)
    write_csv(predictions.select("id", value.alias("prediction")).orderBy("id"), path, single_file)


def metrics_frame(spark: SparkSession, metrics: list[tuple[str, object]]) -> DataFrame:
    """Driver-side results as ``(metric, value)`` text rows."""
    return spark.createDataFrame([(k, str(v)) for k, v in metrics], "metric string, value string")


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """Text file of one column; fails if the path exists."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("errorifexists").text(path)
