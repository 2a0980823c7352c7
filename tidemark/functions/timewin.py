"""Window durations, their labels, and epoch-aligned buckets."""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tumbling window sizes and the labels used in records and sink names.
WINDOW_LABELS = {
    "30 seconds": "30s",
    "1 minute": "1m",
    "5 minutes": "5m",
    "15 minutes": "15m",
    "30 minutes": "30m",
    "1 hour": "1h",
}

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}

MICROS = 1_000_000


def duration_seconds(duration: str) -> int:
    count, unit = duration.split()
    return int(count) * _UNIT_SECONDS[unit.rstrip("s")]


def window_label(duration: str) -> str:
    """Known label, or the duration text itself for sizes outside the fixed list."""
    return WINDOW_LABELS.get(duration, duration)


def common_step(durations: list[str]) -> int:
    """Largest number of seconds that divides every duration."""
    return reduce(gcd, (duration_seconds(d) for d in durations))


def bucket_of(ts: Column, seconds: int) -> Column:
    """Index of the epoch-aligned bucket holding ``ts``."""
    micros = F.unix_micros(ts)
    step = F.lit(seconds * MICROS)
    return F.floor((micros - F.pmod(micros, step)) / step).cast("long")


def window_end(ts: Column, seconds: int) -> Column:
    """End of the tumbling window that contains ``ts``; equals ``window(ts, size).end``."""
    micros = F.unix_micros(ts)
    step = F.lit(seconds * MICROS)
    return F.timestamp_micros(micros - F.pmod(micros, step) + step)


def label_seconds(label: Column, durations: dict[str, str] | None = None) -> Column:
    """Window label to seconds, 0 for an unknown label."""
    known = durations or WINDOW_LABELS
    pairs = [F.lit(x) for d, lab in known.items() for x in (lab, duration_seconds(d))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), label), F.lit(0)).cast("long")
