"""Cleaning and features for trip records; one narrow pass, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import flag_to_int, haversine_km, is_peak, speed_kmh
from tidemark.operators.cleaning import drop_nonfinite

# Feature order, service area, and limits on duration (s), its error (s) and speed (km/h).
TRIP_FEATURES = [
    "vendor_id",
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "day_of_month",
    "month",
    "day_of_week",
    "hour",
    "store_and_fwd_flag",
    "peak_hour",
    "distance_haversine",
]
LONGITUDE_RANGE = (-74.3, -73.7)
LATITUDE_RANGE = (40.5, 41.0)
DURATION_RANGE_SECONDS = (60, 6 * 3600)
MAX_DURATION_ERROR_SECONDS = 120
MAX_SPEED_KMH = 100


def _in_area(inclusive: bool) -> Column:
    inside = F.lit(True)
    for end in ("pickup", "dropoff"):
        for axis, (low, high) in (("longitude", LONGITUDE_RANGE), ("latitude", LATITUDE_RANGE)):
            value = F.col(f"{end}_{axis}")
            inside = inside & (value.between(low, high) if inclusive else (value > low) & (value < high))
    return inside


def trip_distance() -> Column:
    return haversine_km(
        F.col("pickup_latitude"), F.col("pickup_longitude"), F.col("dropoff_latitude"), F.col("dropoff_longitude")
    )


def clean_trips(trips: DataFrame, inclusive_bounds: bool = False) -> DataFrame:
    """Keep trips with a consistent, plausible duration, inside the area, at a plausible speed."""
    measured = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    low, high = DURATION_RANGE_SECONDS
    duration = F.col("trip_duration")
    return trips.filter(
        (F.abs(duration - measured) <= MAX_DURATION_ERROR_SECONDS)
        & (duration > low)
        & (duration < high)
        & _in_area(inclusive_bounds)
        & (speed_kmh(trip_distance(), duration) < MAX_SPEED_KMH)
    )


def add_trip_features(trips: DataFrame, iso_week: bool = False) -> DataFrame:
    """Add calendar parts, peak flag, numeric store flag and distance.

    Weeks count from Sunday = 1, or from Monday = 1 with ``iso_week``.
    """
    pickup = F.col("pickup_datetime")
    return trips.withColumns(
        {
            "day_of_month": F.dayofmonth(pickup),
            "month": F.month(pickup),
            "day_of_week": F.weekday(pickup) + 1 if iso_week else F.dayofweek(pickup),
            "hour": F.hour(pickup),
            "peak_hour": is_peak(F.hour(pickup)),
            "store_and_fwd_flag": flag_to_int(F.col("store_and_fwd_flag")),
            "distance_haversine": trip_distance(),
        }
    )


def train_table(trips: DataFrame, inclusive_bounds: bool = False, iso_week: bool = False) -> DataFrame:
    """``id``, the features and ``label = log1p(trip_duration)`` of clean trips whose features are all finite."""
    rows = add_trip_features(clean_trips(trips, inclusive_bounds), iso_week)
    label = F.log1p(F.col("trip_duration")).alias("label")
    return drop_nonfinite(rows.select("id", *TRIP_FEATURES, label).na.drop(), [*TRIP_FEATURES, "label"])


def score_table(trips: DataFrame, iso_week: bool = False) -> DataFrame:
    """``id`` and the features of trips to predict; needs no drop-off time or duration.

    Trips with a null or non-finite feature get no prediction; :func:`unscored` lists them.
    """
    return drop_nonfinite(add_trip_features(trips, iso_week).select("id", *TRIP_FEATURES), TRIP_FEATURES)


def unscored(trips: DataFrame, iso_week: bool = False) -> DataFrame:
    """``id`` of the trips that :func:`score_table` leaves out."""
    rows = add_trip_features(trips, iso_week).select("id", *TRIP_FEATURES)
    whole = F.lit(True)
    for c in TRIP_FEATURES:
        value = F.col(c).cast("double")
        whole = whole & F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))
    return rows.filter(~whole).select("id")


def feature_array(table: DataFrame, columns: list[str] = TRIP_FEATURES) -> DataFrame:
    """Replace the feature columns by one ``features array<double>``."""
    kept = [c for c in table.columns if c not in columns]
    return table.select(*kept, F.array(*[F.col(c).cast("double") for c in columns]).alias("features"))
