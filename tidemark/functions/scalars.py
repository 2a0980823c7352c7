"""Scalar expressions shared by the job families."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hours counted as peak, accepted spellings of a set flag, mean Earth radius in km.
PEAK_HOURS = [7, 8, 9, 16, 17, 18]
SET_FLAGS = ["Y", "yes"]
EARTH_RADIUS_KM = 6371

# Tick timestamps carry microseconds and a zone offset.
TICK_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def is_peak(hour: Column) -> Column:
    return F.when(hour.isin(PEAK_HOURS), 1).otherwise(0)


def flag_to_int(flag: Column) -> Column:
    return F.when(flag.isin(SET_FLAGS), 1).otherwise(0)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    half_dlat = (p2 - p1) / 2
    half_dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = F.pow(F.sin(half_dlat), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(half_dlon), 2)
    return 2 * F.asin(F.sqrt(chord)) * EARTH_RADIUS_KM


def speed_kmh(km: Column, seconds: Column) -> Column:
    return F.try_divide(km, seconds / 3600)


def to_log_label(duration: Column) -> Column:
    return F.log1p(duration)


def from_log_label(label: Column) -> Column:
    return F.expm1(label)


def zscore(value: Column, mean: Column, std: Column) -> Column:
    """Null when any part is null or the deviation is zero."""
    return F.try_divide(value - mean, F.nullif(std, F.lit(0.0)))


def sigmoid(z: Column) -> Column:
    """Logistic function, exactly 1 or 0 beyond +-100."""
    return F.when(z > 100, 1.0).when(z < -100, 0.0).otherwise(1 / (1 + F.exp(-z)))


def dot(features: Column, weights: list[float]) -> Column:
    """Dot product with literal weights, summed left to right."""
    total = F.lit(0.0)
    for i, w in enumerate(weights):
        total = total + features[i] * F.lit(float(w))
    return total


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def parse_tick_timestamp(text: Column) -> Column:
    """ISO 8601 text with offset to timestamp; null on bad text, fraction optional."""
    return F.coalesce(F.try_to_timestamp(text, F.lit(TICK_TIMESTAMP_FORMAT)), text.try_cast("timestamp"))
