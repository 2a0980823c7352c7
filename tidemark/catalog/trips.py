"""Trip cleaning, features, CSV scans and sinks, and comparison of prediction sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import query
from tidemark.functions.scalars import from_log_label, to_log_label
from tidemark.operators import trips as ops
from tidemark.operators.cleaning import rejoin_ids
from tidemark.operators.compare import compare_predictions, read_predictions
from tidemark.operators.metrics import regression_metrics
from tidemark.session import scratch_dir
from tidemark.sources import csv
from tidemark.sources.tables import trips

TRIPS = """
    k as (select o_orderkey as k, o_custkey as c, o_orderstatus as s, o_orderdate as d,
                 30 + (o_custkey * 37 + o_orderkey * 11) % 24000 as dur from orders),
    trips as (
      select 'id' || cast(k as varchar) as id, 1 + c % 2 as vendor_id,
             d + to_seconds(k * 7 % 86400) as pickup_datetime,
             d + to_seconds(k * 7 % 86400 + dur + (k % 7) * 50 - 100) as dropoff_datetime,
             1 + k % 6 as passenger_count,
             -74.32 + (k * 13 % 640) / 1000.0 as pickup_longitude,
             40.48 + (k * 17 % 540) / 1000.0 as pickup_latitude,
             -74.32 + (k * 19 % 640) / 1000.0 as dropoff_longitude,
             40.48 + (k * 23 % 540) / 1000.0 as dropoff_latitude,
             case when s = 'F' then 'Y' else 'N' end as store_and_fwd_flag,
             dur as trip_duration
      from k)"""
DISTANCE = """2 * asin(sqrt(
      power(sin((radians(dropoff_latitude) - radians(pickup_latitude)) / 2), 2)
      + cos(radians(pickup_latitude)) * cos(radians(dropoff_latitude))
      * power(sin((radians(dropoff_longitude) - radians(pickup_longitude)) / 2), 2))) * 6371"""


def features_sql(day_of_week: str = "dayofweek(pickup_datetime) + 1", distance: str = DISTANCE) -> str:
    return f"""
      vendor_id, passenger_count, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude,
      day(pickup_datetime) as day_of_month, month(pickup_datetime) as "month",
      {day_of_week} as day_of_week, hour(pickup_datetime) as "hour",
      case when store_and_fwd_flag in ('Y', 'yes') then 1 else 0 end as store_and_fwd_flag,
      case when hour(pickup_datetime) in (7, 8, 9, 16, 17, 18) then 1 else 0 end as peak_hour,
      {distance} as distance_haversine"""


def clean_sql(inclusive: bool = False) -> str:
    low, high = (">=", "<=") if inclusive else (">", "<")
    box = " and ".join(
        f"{end}_longitude {low} -74.3 and {end}_longitude {high} -73.7"
        f" and {end}_latitude {low} 40.5 and {end}_latitude {high} 41.0"
        for end in ("pickup", "dropoff")
    )
    return f"""
      abs(trip_duration - (epoch(dropoff_datetime) - epoch(pickup_datetime))) <= 120
      and trip_duration > 60 and trip_duration < 21600 and {box}
      and ({DISTANCE}) / (trip_duration / 3600.0) < 100"""


ROUNDED = ", ".join(
    f"round({c}, 6) as {c}" if c.endswith(("tude", "haversine")) else f'cast("{c}" as bigint) as "{c}"'
    for c in ops.TRIP_FEATURES
)


def _integers(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(c).cast("long").alias(c) if kind in ("int", "bigint") else F.col(c) for c, kind in df.dtypes]
    )


def _features_query_sql(day_of_week: str) -> str:
    return f"with {TRIPS}, f as (select id, {features_sql(day_of_week)} from trips) select id, {ROUNDED} from f"


@query("trip_features", _features_query_sql("dayofweek(pickup_datetime) + 1"))
def trip_features(spark, sf_dir):
    return _integers(ops.score_table(trips(spark, sf_dir)))


@query("trip_features_iso", _features_query_sql("isodow(pickup_datetime)"))
def trip_features_iso(spark, sf_dir):
    return _integers(ops.score_table(trips(spark, sf_dir), iso_week=True))


def _clean_query_sql(inclusive: bool) -> str:
    return f"""with {TRIPS}, f as (
      select id, {features_sql()}, ln(1 + trip_duration) as label from trips where {clean_sql(inclusive)})
    select id, {ROUNDED}, round(label, 6) as label from f"""


@query("trip_clean", _clean_query_sql(False))
def trip_clean(spark, sf_dir):
    return _integers(ops.train_table(trips(spark, sf_dir)))


@query("trip_clean_inclusive", _clean_query_sql(True))
def trip_clean_inclusive(spark, sf_dir):
    return _integers(ops.train_table(trips(spark, sf_dir), inclusive_bounds=True))


@query("haversine", f"with {TRIPS} select id, round({DISTANCE}, 6) as km from trips")
def haversine(spark, sf_dir):
    return trips(spark, sf_dir).select("id", ops.trip_distance().alias("km"))


@query(
    "label_transform",
    f"""with {TRIPS} select id, round(ln(1 + trip_duration), 6) as label,
           round(exp(ln(1 + trip_duration)) - 1, 6) as restored from trips""",
)
def label_transform(spark, sf_dir):
    label = to_log_label(F.col("trip_duration"))
    return trips(spark, sf_dir).select("id", label.alias("label"), from_log_label(label).alias("restored"))


@query(
    "id_rejoin",
    f"""with {TRIPS}, f as (select id, {features_sql()} from trips), ids as (select id from trips)
    select f.id, {ROUNDED} from f join ids on f.id = ids.id""",
)
def id_rejoin(spark, sf_dir):
    source = trips(spark, sf_dir)
    return _integers(rejoin_ids(ops.score_table(source), source))


@query(
    "regression_metrics",
    f"""with {TRIPS}, e as (
      select vendor_id, cast(trip_duration as double) as y,
             greatest(trip_duration * 1.01 + cast(substr(id, 3) as bigint) % 400 - 200, 1.0) as p
      from trips)
    select vendor_id, round(sqrt(avg(power(y - p, 2))), 6) as rmse,
           round(1 - sum(power(y - p, 2)) / (var_pop(y) * count(*)), 6) as r2
    from e group by vendor_id""",
)
def regression_metrics_query(spark, sf_dir):
    k = F.substring("id", 3, 20).cast("long")
    guess = F.greatest(F.col("trip_duration") * 1.01 + k % 400 - 200, F.lit(1.0))
    rows = trips(spark, sf_dir).select(
        "vendor_id", F.log1p("trip_duration").alias("label"), F.log1p(guess).alias("prediction")
    )
    return regression_metrics(rows, by=["vendor_id"])


TRIP_ROW_SQL = """id, cast(vendor_id as double) as vendor_id, pickup_datetime, dropoff_datetime,
           cast(passenger_count as double) as passenger_count, round(pickup_longitude, 6) as pickup_longitude,
           round(pickup_latitude, 6) as pickup_latitude, round(dropoff_longitude, 6) as dropoff_longitude,
           round(dropoff_latitude, 6) as dropoff_latitude, store_and_fwd_flag,
           cast(trip_duration as double) as trip_duration"""
TRIP_SCHEMA = ", ".join(f"{n} {k}" for n, k in csv.TRIP_COLUMNS)


def _as_text(df: DataFrame) -> DataFrame:
    stamp = {c: F.date_format(c, csv.DATETIME_FORMAT) for c in ("pickup_datetime", "dropoff_datetime")}
    return df.withColumns(stamp)


@query("csv_roundtrip", f"with {TRIPS} select {TRIP_ROW_SQL} from trips")
def csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    csv.write_csv(trips(spark, sf_dir), path)
    return csv.read_csv(spark, path, TRIP_SCHEMA)


@query("csv_permissive_scan", f"with {TRIPS} select {TRIP_ROW_SQL} from trips where cast(substr(id, 3) as bigint) % 11 not in (3, 7)")
def csv_permissive_scan(spark, sf_dir):
    """Two in eleven rows carry a broken number or time and must be dropped."""
    k = F.substring("id", 3, 20).cast("long") % 11
    broken = _as_text(trips(spark, sf_dir)).withColumns(
        {
            "vendor_id": F.when(k == 3, "n/a").otherwise(F.col("vendor_id").cast("string")),
            "pickup_datetime": F.when(k == 7, "2016-13-01").otherwise(F.col("pickup_datetime")),
        }
    )
    path = scratch_dir(spark, "csv-broken")
    csv.write_csv(broken, path)
    return csv.read_trips_permissive(spark, path)


def prediction_sets(spark, sf_dir) -> dict[str, DataFrame]:
    source = trips(spark, sf_dir)
    k, duration = F.substring("id", 3, 20).cast("long"), F.col("trip_duration").cast("double")

    def with_prediction(value):
        return source.select("id", value.alias("prediction"))

    return {
        "actual": with_prediction(duration),
        "shifted": with_prediction(duration + k % 400 - 200),
        "scaled": with_prediction(duration * 1.01),
        "partial": with_prediction(duration).filter(k % 5 != 0),
    }


@query(
    "predictions_csv",
    f"with {TRIPS} select id, cast(round(trip_duration * 1.01, 2) as double) as prediction from trips",
)
def predictions_csv(spark, sf_dir):
    path = scratch_dir(spark, "predictions")
    csv.write_predictions(prediction_sets(spark, sf_dir)["scaled"], path, decimals=2)
    return read_predictions(spark, path)


def _pair_sql(a: str, b: str) -> str:
    return f"""
    select '{a} vs {b}' as file_pair,
           count(*) filter (x.id is null or y.id is null) = 0 as ok,
           avg(abs(x.prediction - y.prediction)) as mean_error,
           100.0 * count(*) filter (abs(x.prediction - y.prediction) > 120) / count(*) as percentage_120,
           100.0 * count(*) filter (abs(x.prediction - y.prediction) > 180) / count(*) as percentage_180
    from {a} x full outer join {b} y on x.id = y.id"""


_SETS = ["actual", "shifted", "scaled", "partial"]


@query(
    "compare_predictions",
    f"""with {TRIPS},
    actual as (select id, cast(trip_duration as double) as prediction from trips),
    shifted as (select id, cast(trip_duration + cast(substr(id, 3) as bigint) % 400 - 200 as double) as prediction from trips),
    scaled as (select id, trip_duration * cast(1.01 as double) as prediction from trips),
    partial as (select * from actual where cast(substr(id, 3) as bigint) % 5 <> 0),
    pairs as ({" union all ".join(_pair_sql(a, b) for i, a in enumerate(_SETS) for b in _SETS[i + 1:])})
    select file_pair, cast(ok as int) as ids_match, round(case when ok then mean_error end, 6) as mean_error,
           round(case when ok then percentage_120 end, 6) as percentage_120,
           round(case when ok then percentage_180 end, 6) as percentage_180
    from pairs""",
)
def compare_predictions_query(spark, sf_dir):
    table = compare_predictions(prediction_sets(spark, sf_dir))
    return table.withColumn("ids_match", F.col("ids_match").cast("int"))
