"""Window statistics, z-scores and look-ahead over events, in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.registry import PLACES, query, zoneless
from tidemark.operators import lookahead, window_stats, zscore
from tidemark.sources import codec
from tidemark.sources.tables import ticks

# Events are minutes apart, so the queries use wider windows and a wider span than the defaults.
DURATIONS = ["1 hour", "6 hours", "1 day"]
SPAN = 3600

TICKS = """
    ticks as (select event_type as symbol, value as price, ts from events),
    sizes(win, secs) as (values ('1h', 3600), ('6 hours', 21600), ('1 day', 86400))"""
STATS = (
    TICKS
    + """,
    stats as (
      select symbol, win, secs,
             time_bucket(to_seconds(secs), ts, timestamp '1970-01-01') + to_seconds(secs) as wend,
             avg(price) as avg_price,
             case when count(price) = 1 then 0.0 else stddev_samp(price) end as std_price
      from ticks, sizes group by symbol, win, secs, wend)"""
)
SCORES = (
    STATS
    + """,
    scores as (
      select t.ts, t.symbol, s.win, (t.price - s.avg_price) / nullif(s.std_price, 0) as z
      from ticks t left join stats s
        on t.symbol = s.symbol and t.ts >= s.wend - to_seconds(s.secs) and t.ts < s.wend
       and s.std_price is not null)"""
)
PAIRS = (
    TICKS
    + """,
    pairs as (
      select b.symbol, b.ts as bts, b.price as bp, f.ts as fts, f.price as fp
      from ticks b join ticks f
        on b.symbol = f.symbol and f.ts > b.ts and f.ts <= b.ts + interval 3600 seconds)"""
)


def micros_number(value: Column) -> Column:
    """Whole millionths as text, '-' for null."""
    return F.coalesce(F.round(value * 1_000_000).cast("long").cast("string"), F.lit("-"))


def micros_text(entries: Column, part: str) -> Column:
    """One field of an array of structs as comma-separated whole millionths, '-' for null."""
    return F.array_join(F.transform(entries, lambda e: micros_number(e[part])), ",")


def labels_text(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda e: e["window"]), ",")


def packed_stats_text(packed: DataFrame) -> DataFrame:
    w = F.col("windows")
    return packed.select(
        "timestamp",
        "symbol",
        labels_text(w).alias("labels"),
        micros_text(w, "avg_price").alias("averages"),
        micros_text(w, "std_price").alias("deviations"),
    )


def scores_text(records: DataFrame) -> DataFrame:
    z = F.col("zscores")
    return records.select("timestamp", "symbol", labels_text(z).alias("labels"), micros_text(z, "zscore_price").alias("scores"))


def micros_agg(expression: str, order: str) -> str:
    """SQL twin of :func:`micros_text`."""
    return f"string_agg(coalesce(cast(cast(round({expression} * 1000000) as bigint) as varchar), '-'), ',' order by {order})"


def _stats(spark, sf_dir) -> DataFrame:
    return window_stats.window_stats_multi(ticks(spark, sf_dir), DURATIONS)


@query(
    "window_stats",
    f"""with {STATS}
    select wend as "timestamp", symbol, win as "window", round(avg_price, 6) as avg_price,
           round(std_price, 6) as std_price
    from stats where secs = 21600""",
)
def window_stats_query(spark, sf_dir):
    return window_stats.window_stats(ticks(spark, sf_dir), "6 hours")


@query(
    "window_stats_multi",
    f"""with {STATS}
    select wend as "timestamp", symbol, win as "window", round(avg_price, 6) as avg_price,
           round(std_price, 6) as std_price
    from stats""",
)
def window_stats_multi_query(spark, sf_dir):
    return _stats(spark, sf_dir)


PACK_SQL = f"""
    select wend as "timestamp", symbol, string_agg(win, ',' order by win) as labels,
           {micros_agg('avg_price', 'win')} as averages, {micros_agg('std_price', 'win')} as deviations
    from stats group by wend, symbol"""


@query("window_pack", f"with {STATS} {PACK_SQL}")
def window_pack_query(spark, sf_dir):
    return packed_stats_text(window_stats.pack_windows(_stats(spark, sf_dir)))


@query(
    "window_unpack",
    f"""with {STATS}
    select wend as "timestamp", symbol, win as "window", round(avg_price, 6) as avg_price,
           round(std_price, 6) as std_price
    from stats""",
)
def window_unpack_query(spark, sf_dir):
    return window_stats.unpack_windows(window_stats.pack_windows(_stats(spark, sf_dir)))


@query(
    "zscore_join",
    f"""with {SCORES}
    select ts as price_timestamp, symbol, win as "window", round(z, 6) as zscore_price from scores""",
)
def zscore_join_query(spark, sf_dir):
    return zscore.zscore_rows(ticks(spark, sf_dir), _stats(spark, sf_dir), DURATIONS)


SCORES_SQL = f"""
    select ts as "timestamp", symbol, string_agg(win, ',' order by win) as labels,
           {micros_agg('z', 'win')} as scores
    from scores group by ts, symbol"""


@query("zscore_pack", f"with {SCORES} {SCORES_SQL}")
def zscore_pack_query(spark, sf_dir):
    rows = zscore.zscore_rows(ticks(spark, sf_dir), _stats(spark, sf_dir), DURATIONS)
    return scores_text(zscore.pack_zscores(rows))


@query("zscore_records", f"with {SCORES} {SCORES_SQL}")
def zscore_records_query(spark, sf_dir):
    return scores_text(zscore.zscore_records(ticks(spark, sf_dir), _stats(spark, sf_dir), DURATIONS))


@query(
    "zscore_dedup",
    "with "
    + SCORES.replace("value as price, ts from events", "value as price, date_trunc('hour', ts) as ts from events")
    + """
    select ts as price_timestamp, symbol, win as "window", round(min(z), 6) as zscore_price
    from scores where win is not null group by all""",
)
def zscore_dedup_query(spark, sf_dir):
    """Ticks cut to the hour share their timestamps, so windows meet several prices."""
    coarse = ticks(spark, sf_dir).withColumn("timestamp", F.date_trunc("hour", "timestamp"))
    stats = window_stats.window_stats_multi(coarse, DURATIONS)
    return zscore.dedup_zscores(zscore.zscore_rows(coarse, stats, DURATIONS))


@query(
    "lookahead_pairs",
    f"""with {PAIRS}
    select symbol, bts as base_timestamp, round(bp, 6) as base_price, fts as future_timestamp,
           round(fp, 6) as future_price
    from pairs""",
    places=None,
)
def lookahead_pairs_query(spark, sf_dir):
    """Prices are rounded for each tick and times lose their zone in the gathered ticks, not in every pair."""
    rounded = ticks(spark, sf_dir).withColumn("price", F.round("price", PLACES))
    return lookahead.single_pairs(zoneless(lookahead.lookahead_pairs(rounded, SPAN, ranges=True)))


@query(
    "lookahead_pack",
    f"""with {PAIRS}
    select symbol, bts as base_timestamp, round(bp, 6) as base_price, count(*) as n_next,
           {micros_agg('fp', 'fts, fp')} as next_prices, max(fts) as last_timestamp
    from pairs group by symbol, bts, bp""",
)
def lookahead_pack_query(spark, sf_dir):
    """A price becomes text once per tick, not once per base that it follows."""

    def with_text(tick: Column) -> Column:
        return F.struct(tick["timestamp"].alias("timestamp"), micros_number(tick["price"]).alias("text"))

    pairs = lookahead.lookahead_pairs(ticks(spark, sf_dir), SPAN, nested=True, entry=with_text)
    packed = lookahead.pack_lookahead(pairs)
    return packed.select(
        "symbol",
        "base_timestamp",
        "base_price",
        F.size("next").cast("long").alias("n_next"),
        F.array_join("next.text", ",").alias("next_prices"),
        F.element_at("next", -1)["timestamp"].alias("last_timestamp"),
    )


CHANGE_SQL = """
    select symbol, bts as base_timestamp, round(bp, 6) as base_price,
           round(coalesce(min(case when fp < bp then (epoch_us(fts) - epoch_us(bts)) / 1e6 end), 3600.0), 6)
             as time_to_decrease,
           round(coalesce(min(case when fp > bp then (epoch_us(fts) - epoch_us(bts)) / 1e6 end), 3600.0), 6)
             as time_to_increase
    from pairs group by symbol, bts, bp"""


@query("time_to_change", f"with {PAIRS} {CHANGE_SQL}")
def time_to_change_query(spark, sf_dir):
    return lookahead.time_to_change(ticks(spark, sf_dir), SPAN)


@query("first_change", f"with {PAIRS} {CHANGE_SQL}")
def first_change_query(spark, sf_dir):
    return lookahead.first_change(lookahead.lookahead_pairs(ticks(spark, sf_dir), SPAN, ranges=True), SPAN)


def tick_messages(ticks_df: DataFrame) -> DataFrame:
    """Ticks as topic messages: ISO time text with offset, JSON value as bytes."""
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    encoded = codec.encode(ticks_df.withColumn("timestamp", text))
    return encoded.select("key", F.encode("value", "UTF-8").alias("value"))


@query(
    "json_decode",
    """select event_type as symbol, round(value, 6) as price, ts as "timestamp" from events""",
)
def json_decode_query(spark, sf_dir):
    return codec.decode_ticks(tick_messages(ticks(spark, sf_dir)))


@query(
    "json_encode",
    f"""with {STATS}
    select symbol as key, symbol, win as "window", round(avg_price, 6) as avg_price,
           round(std_price, 6) as std_price, wend as "timestamp"
    from stats""",
)
def json_encode_query(spark, sf_dir):
    messages = codec.encode(_stats(spark, sf_dir))
    field = F.from_json("value", codec.STAT_SCHEMA)
    return messages.select("key", field.alias("data")).select(
        "key", "data.symbol", "data.window", "data.avg_price", "data.std_price", "data.timestamp"
    )
