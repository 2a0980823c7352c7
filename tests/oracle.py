"""Compare a registered query with its SQL twin on the same parquet files."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(value):
    """One form per value, so that rows from both engines compare and sort alike."""
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, datetime.datetime):
        return ("time", value.isoformat())
    if isinstance(value, (int, float)) or hasattr(value, "as_tuple"):
        number = float(value)
        return ("nan",) if math.isnan(number) else ("num", number + 0.0)
    return ("text", str(value))


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str, limit: int = 5):
    """Empty list when both sides hold the same rows, else a few lines that say what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    want = normal_rows(names, cursor.fetchall())
    got = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return []
    report = [f"rows {len(got)} != {len(want)}"] if len(got) != len(want) else []
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    report.append(f"{len(bad)} rows differ")
    return report + [f"got {g}\n  want {w}" for g, w in bad[:limit]]
