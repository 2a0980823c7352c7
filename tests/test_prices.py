import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import parse_tick_timestamp, zscore
from tidemark.operators import lookahead as look
from tidemark.operators import window_stats as ws
from tidemark.operators import zscore as zs
from tidemark.sources import codec

START = datetime(2024, 3, 1, 12, 0, 0)


def make_ticks(spark, rows):
    """Rows of (symbol, seconds after START, price)."""
    data = [(s, None if p is None else float(p), START + timedelta(seconds=t)) for s, t, p in rows]
    return spark.createDataFrame(data, "symbol string, price double, timestamp timestamp")


def test_default_windows_and_labels(spark):
    stats = ws.window_stats_multi(make_ticks(spark, [("A", 0, 1), ("A", 10, 3)]))
    got = {r["window"]: (r["timestamp"], r["avg_price"], round(r["std_price"], 6)) for r in stats.collect()}
    assert got == {
        label: (START + timedelta(seconds=s), 2.0, 1.414214)
        for label, s in [("30s", 30), ("1m", 60), ("5m", 300), ("15m", 900), ("30m", 1800), ("1h", 3600)]
    }


def test_single_price_has_zero_deviation_and_no_score(spark):
    ticks = make_ticks(spark, [("A", 0, 5)])
    stats = ws.window_stats_multi(ticks, ["30 seconds"])
    assert stats.first()["std_price"] == 0.0
    row = zs.zscore_rows(ticks, stats, ["30 seconds"]).first()
    assert (row["window"], row["zscore_price"]) == ("30s", None)


def test_window_with_only_null_prices(spark):
    stats = ws.window_stats_multi(make_ticks(spark, [("A", 0, None)]), ["30 seconds"]).first()
    assert stats["avg_price"] is None and stats["std_price"] is None


def test_constant_price_has_null_score(spark):
    ticks = make_ticks(spark, [("A", 0, 5), ("A", 1, 5)])
    stats = ws.window_stats_multi(ticks, ["30 seconds"])
    assert [r["zscore_price"] for r in zs.zscore_rows(ticks, stats, ["30 seconds"]).collect()] == [None, None]


def test_tick_without_window_keeps_one_row_and_an_empty_array(spark):
    ticks = make_ticks(spark, [("A", 0, 1), ("A", 1, 3), ("B", 0, 1)])
    stats = ws.window_stats_multi(ticks.filter("symbol = 'A'"), ["30 seconds"])
    rows = zs.zscore_rows(ticks, stats, ["30 seconds"])
    assert [(r["symbol"], r["window"]) for r in rows.filter("symbol = 'B'").collect()] == [("B", None)]
    records = zs.zscore_records(ticks, stats, ["30 seconds"])
    assert records.filter("symbol = 'B'").first()["zscores"] == []
    packed = zs.pack_zscores(rows)
    assert packed.filter("symbol = 'B'").first()["zscores"] == []


def test_missing_windows_leave_gaps_only(spark):
    ticks = make_ticks(spark, [("A", 0, 1), ("A", 40, 3)])
    durations = ["30 seconds", "1 minute"]
    stats = ws.window_stats_multi(ticks, durations).filter("window = '1m' or avg_price = 1")
    rows = zs.zscore_rows(ticks, stats, durations).orderBy("price_timestamp", "window")
    assert [(r["window"], r["zscore_price"] and round(r["zscore_price"], 6)) for r in rows.collect()] == [
        ("1m", -0.707107),
        ("30s", None),
        ("1m", 0.707107),
    ]


def test_records_equal_packed_rows_with_shared_timestamps(spark):
    rng = random.Random(3)
    rows = [(rng.choice("AB"), rng.randrange(0, 4000, 7), rng.uniform(1, 9)) for _ in range(600)]
    rows += [("A", 77, None), ("A", 84, None)]
    ticks = make_ticks(spark, rows)
    stats = ws.window_stats_multi(ticks)
    via_rows = zs.pack_zscores(zs.zscore_rows(ticks, stats))
    direct = zs.zscore_records(ticks, stats)

    def plain(df):
        return sorted((r["timestamp"], r["symbol"], [(z[0], z[1]) for z in r["zscores"]]) for r in df.collect())

    assert plain(via_rows) == plain(direct)


def test_dedup_keeps_one_score_per_window(spark):
    rows = spark.createDataFrame(
        [(START, "A", "1m", 2.0), (START, "A", "1m", -1.0), (START, "A", "5m", None), (START, "A", None, None)],
        "price_timestamp timestamp, symbol string, window string, zscore_price double",
    )
    got = sorted((r["window"], r["zscore_price"]) for r in zs.dedup_zscores(rows).collect())
    assert got == [("1m", -1.0), ("5m", None)]


def test_unpack_drops_empty_arrays(spark):
    packed = spark.createDataFrame(
        [(START, "A", [("1m", 1.0, 0.5)]), (START, "B", [])],
        "timestamp timestamp, symbol string, "
        "windows array<struct<window:string,avg_price:double,std_price:double>>",
    )
    assert [r["symbol"] for r in ws.unpack_windows(packed).collect()] == ["A"]


def test_zscore_of_zero_deviation_is_null(spark):
    row = spark.range(1).select(
        zscore(F.lit(1.0), F.lit(0.5), F.lit(0.0)).alias("zero"),
        zscore(F.lit(1.0), F.lit(0.5), F.lit(None).cast("double")).alias("none"),
        zscore(F.lit(1.0), F.lit(0.5), F.lit(0.25)).alias("two"),
    ).first()
    assert tuple(row) == (None, None, 2.0)


def brute_changes(rows, span):
    """Straight reading of the look-ahead rule over (symbol, seconds, price) rows."""
    out = {}
    for s, t, p in rows:
        later = sorted(((u, q) for r, u, q in rows if r == s and t < u <= t + span), key=lambda e: e[0])
        if later:
            down = next((float(u - t) for u, q in later if p is not None and q is not None and q < p), float(span))
            up = next((float(u - t) for u, q in later if p is not None and q is not None and q > p), float(span))
            out[(s, t, p)] = (down, up)
    return out


@pytest.mark.parametrize("seed,chunk", [(1, None), (2, 20), (3, 7), (4, 60)])
def test_time_to_change_against_brute_force(spark, seed, chunk):
    rng = random.Random(seed)
    rows = [
        (rng.choice("AAAB"), rng.randrange(400), rng.choice([None, *range(1, 6)])) for _ in range(300)
    ]
    rows = [(s, t, None if p is None else float(p)) for s, t, p in rows]
    want = brute_changes(rows, 20)

    def got(df):
        return {
            (r["symbol"], int((r["base_timestamp"] - START).total_seconds()), r["base_price"]): (
                r["time_to_decrease"],
                r["time_to_increase"],
            )
            for r in df.collect()
        }

    ticks = make_ticks(spark, rows)
    scanned = look.time_to_change(ticks, 20, chunk)
    assert scanned.count() == len(want)
    assert got(scanned) == want
    assert got(look.first_change(look.lookahead_pairs(ticks, 20), 20)) == want


@pytest.mark.parametrize("fan,levels", [(2, 1), (2, 3), (3, 2), (32, 3)])
def test_time_to_change_through_every_level(spark, monkeypatch, fan, levels):
    """Long runs without a change lead the search up all levels and down again."""
    monkeypatch.setattr(look, "FAN", fan)
    monkeypatch.setattr(look, "UPPER_LEVELS", levels)
    rng = random.Random(fan + levels)
    slow = [("A", t, float(t // 40 if t % 61 else 500 - t)) for t in range(0, 400)]
    rows = slow + [("A", rng.randrange(400), float(rng.randrange(12))) for _ in range(60)] + [("B", 7, 1.0)] * 3
    got = {
        (r["symbol"], int((r["base_timestamp"] - START).total_seconds()), r["base_price"]): (r["time_to_decrease"], r["time_to_increase"])
        for r in look.time_to_change(make_ticks(spark, rows), 90, 200).collect()
    }
    assert got == brute_changes(rows, 90)


def test_time_to_change_of_a_dense_symbol(spark):
    """Forty thousand ticks in one span, most of them far from their next change."""
    ticks = spark.range(40_000).select(
        F.lit("A").alias("symbol"),
        F.when(F.col("id") == 39_999, -1.0).otherwise(F.floor(F.col("id") / 10_000)).cast("double").alias("price"),
        F.timestamp_micros(F.col("id") * 500).alias("timestamp"),
    )
    got = look.time_to_change(ticks, 20)
    last, first = 39_999 * 500, F.unix_micros("base_timestamp")
    step = F.floor(first / 5_000_000) + 1
    up = F.when(step < 4, step * 5_000_000 - first).otherwise(20_000_000)
    wrong = got.filter(
        (F.round(F.col("time_to_decrease") * 1e6) != last - first) | (F.round(F.col("time_to_increase") * 1e6) != up)
    )
    assert got.count() == 39_999 and wrong.count() == 0


def test_lookahead_bounds_and_missing_futures(spark):
    ticks = make_ticks(spark, [("A", 0, 5), ("A", 20, 4), ("A", 41, 9), ("B", 0, 1)])
    pairs = look.lookahead_pairs(ticks, 20).collect()
    assert [(r["base_price"], r["future_price"]) for r in pairs] == [(5.0, 4.0)]
    changes = look.time_to_change(ticks, 20).collect()
    assert [(r["base_price"], r["time_to_decrease"], r["time_to_increase"]) for r in changes] == [(5.0, 20.0, 20.0)]


def test_lookahead_pack_is_ordered_by_time(spark):
    ticks = make_ticks(spark, [("A", 0, 5), ("A", 9, 1), ("A", 3, 7)])
    packed = look.pack_lookahead(look.lookahead_pairs(ticks, 20)).filter("base_price = 5").first()
    assert [e["price"] for e in packed["next"]] == [7.0, 1.0]


def test_tick_decode(spark):
    texts = [
        '{"symbol": "A", "price": 1.5, "timestamp": "2024-03-01T12:00:00.123456+00:00"}',
        '{"symbol": "A", "price": 2.5, "timestamp": "2024-03-01T14:00:00+02:00"}',
        '{"symbol": "A", "price": 3.5, "timestamp": "yesterday"}',
        "not json",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = [tuple(r) for r in codec.decode_ticks(df).collect()]
    assert got == [
        ("A", 1.5, START.replace(microsecond=123456)),
        ("A", 2.5, START),
        ("A", 3.5, None),
        (None, None, None),
    ]
    assert spark.range(1).select(parse_tick_timestamp(F.lit(None).cast("string"))).first()[0] is None


def test_zscore_message_roundtrip(spark):
    records = spark.createDataFrame(
        [(START.replace(microsecond=42), "A", [("1m", 0.5), ("5m", None)])],
        "timestamp timestamp, symbol string, zscores array<struct<window:string,zscore_price:double>>",
    )
    back = codec.decode_zscores(codec.encode(records)).first()
    assert back["timestamp"] == START.replace(microsecond=42)
    assert [tuple(z) for z in back["zscores"]] == [("1m", 0.5), ("5m", None)]


def test_change_message_fields(spark):
    changes = spark.createDataFrame([(START, 3.5)], "base_timestamp timestamp, time_to_increase double")
    value = codec.encode_change(changes, "time_to_increase", "higher_window").first()["value"]
    assert value == '{"timestamp":"2024-03-01 12:00:00","higher_window":3.5}'


def test_duplicate_bases_share_one_group(spark):
    ticks = make_ticks(spark, [("A", 0, 5), ("A", 0, 5), ("A", 4, 6)])
    packed = look.pack_lookahead(look.lookahead_pairs(ticks, 20))
    assert packed.count() == 1 and len(packed.first()["next"]) == 2
    assert look.time_to_change(ticks, 20).count() == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nested_pairs_are_packed_like_single_ones(spark, seed):
    """Copies, nulls, both zeros, NaN, ties in time and gaps; without a shuffle of pairs."""
    rng = random.Random(seed)
    prices = [None, 0.0, -0.0, float("nan"), 1.5, 2.0, -3.0]
    rows = [
        (rng.choice(["A", "B", None]), START + timedelta(milliseconds=500 * rng.randrange(400)), rng.choice(prices))
        for _ in range(300)
    ] + [("A", None, 1.0)] * 2
    ticks = spark.createDataFrame([(s, p, t) for s, t, p in rows], "symbol string, price double, timestamp timestamp")

    def packed(nested):
        df = look.pack_lookahead(look.lookahead_pairs(ticks, 20, nested=nested))
        return sorted(repr(tuple(r)).replace("-0.0", "0.0") for r in df.collect())

    assert packed(True) == packed(False) and packed(True)


def odd_ticks(spark, seed):
    """Copies, nulls, both zeros, NaN, ties in time and gaps."""
    rng = random.Random(seed)
    prices = [None, 0.0, -0.0, float("nan"), 1.5, 2.0, -3.0]
    rows = [
        (rng.choice(["A", "B", None]), rng.choice(prices), START + timedelta(milliseconds=500 * rng.randrange(400)))
        for _ in range(300)
    ] + [("A", 1.0, None)] * 2
    return spark.createDataFrame(rows, "symbol string, price double, timestamp timestamp")


def texts(df):
    return sorted(repr(tuple(r)).replace("-0.0", "0.0") for r in df.collect())


def as_pairs(ranges):
    """One row per pair, as often as it occurs."""
    bases = ranges.select("symbol", "ticks", F.explode("bases").alias("b"))
    copies = bases.select("symbol", "ticks", "b", F.explode(F.sequence(F.lit(1), F.col("b.n_base"))))
    later = F.inline(F.slice("ticks", F.col("b.start") + 1, F.col("b.end") - F.col("b.start")))
    return copies.select("symbol", "b.timestamp", "b.price", later.alias("future_timestamp", "future_price"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranges_hold_every_pair(spark, seed):
    ticks = odd_ticks(spark, seed)
    pairs, ranges = look.lookahead_pairs(ticks, 20), look.lookahead_pairs(ticks, 20, ranges=True)
    assert texts(as_pairs(ranges)) == texts(pairs) and texts(pairs)
    assert texts(look.first_change(ranges, 20)) == texts(look.first_change(pairs, 20))


def dense_ticks(spark):
    return spark.range(8000).select(
        F.lit("A").alias("symbol"),
        F.rand(1).alias("price"),
        F.timestamp_micros(F.col("id") * 2_000).alias("timestamp"),
    )


def rows_made(df):
    """Rows that came out of the joins of an executed plan."""
    plan, n = [df._jdf.queryExecution().executedPlan()], 0
    while plan:
        node = plan.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            node = node.executedPlan()
        if node.nodeName().endswith("QueryStage"):
            node = node.plan()
        if "Join" in node.nodeName():
            n += node.metrics().apply("numOutputRows").value()
        plan += [node.children().apply(i) for i in range(node.children().size())]
    return n


def test_first_change_of_ranges_makes_no_row_per_pair(spark):
    """32 million pairs of one symbol in one span."""
    df = look.first_change(look.lookahead_pairs(dense_ticks(spark), 20, ranges=True), 20)
    assert len(df.collect()) == 7999
    assert rows_made(df) == 1


def test_catalog_query_makes_no_row_per_pair(spark, tmp_path):
    from __spark_entry__ import queries

    dense_ticks(spark).select(
        F.col("symbol").alias("event_type"), F.col("price").alias("value"), F.col("timestamp").cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("long").alias("event_id"), F.lit(1).cast("long").alias("user_id"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    df = queries()["first_change"](spark, str(tmp_path))
    assert len(df.collect()) == 7999
    assert rows_made(df) < 10


def test_pairs_use_every_core_however_few_bytes(spark):
    """The bytes before the join are few; time arithmetic is done for ticks, not for pairs."""
    df = look.lookahead_pairs(odd_ticks(spark, 1), 20)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "coalesced" not in plan
    join = next(line for line in plan.splitlines() if "Join" in line)
    assert "INTERVAL" not in join.upper() and "until" in join
    assert df.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_lookahead_pack_shuffles_ticks_only(spark):
    ticks = spark.range(2000).select(
        F.lit("A").alias("symbol"),
        F.rand(1).alias("price"),
        F.timestamp_micros(F.col("id") * 10_000).alias("timestamp"),
    )
    df = look.pack_lookahead(look.lookahead_pairs(ticks, 20, nested=True))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert df.agg(F.sum(F.size("next"))).first()[0] == 2000 * 1999 // 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranges_become_single_pairs(spark, seed):
    ticks = odd_ticks(spark, seed)
    single = look.single_pairs(look.lookahead_pairs(ticks, 20, ranges=True))
    assert texts(single) == texts(look.lookahead_pairs(ticks, 20)) and single.columns == look.lookahead_pairs(ticks, 20).columns


def write_events(spark, path, ticks):
    ticks.select(
        F.col("symbol").alias("event_type"), F.col("price").alias("value"), F.col("timestamp").cast("timestamp_ntz").alias("ts"),
        F.lit(1).cast("long").alias("event_id"), F.lit(1).cast("long").alias("user_id"),
    ).write.parquet(f"{path}/events.parquet")


def test_pairs_query_joins_buckets_and_shapes_ticks(spark, tmp_path):
    """Pairs are not met one by one in a join, nor rounded and cast one by one."""
    from __spark_entry__ import queries

    write_events(spark, tmp_path, dense_ticks(spark).limit(300).withColumn("price", F.col("price") / 1000))
    df = queries()["lookahead_pairs"](spark, str(tmp_path))
    rows = df.collect()
    assert len(rows) == 300 * 299 // 2
    assert rows_made(df) == 1
    assert all(r["base_price"] == round(r["base_price"], 6) and r["future_price"] == round(r["future_price"], 6) for r in rows)
    assert dict(df.dtypes)["future_timestamp"] == "timestamp_ntz"
    top = df._jdf.queryExecution().optimizedPlan().expressions().mkString()
    assert "round" not in top and "cast" not in top


def test_pairs_query_gives_what_the_join_gives(spark, tmp_path):
    """Prices that are equal once they are rounded, copies, ties in time and nulls: as many rows as the join makes."""
    from __spark_entry__ import queries
    from tidemark.catalog.registry import flat

    ticks = odd_ticks(spark, 4).withColumn("price", F.col("price") + F.rand(1) / 1e6)
    write_events(spark, tmp_path, ticks)
    stored = spark.read.parquet(f"{tmp_path}/events.parquet").select(
        F.col("event_type").alias("symbol"), F.col("value").alias("price"), F.col("ts").cast("timestamp").alias("timestamp")
    )
    want = texts(flat(look.lookahead_pairs(stored, 3600)))
    assert texts(queries()["lookahead_pairs"](spark, str(tmp_path))) == want and want


def test_nested_pairs_send_few_ticks_twice(spark):
    """Ticks spread over 80 buckets, before 1970 too: what is gathered is at most 1.3 times the ticks, not twice."""
    ticks = spark.range(4000).select(
        F.lit("A").alias("symbol"),
        (F.col("id") % 7).cast("double").alias("price"),
        F.timestamp_micros((F.col("id") - 2000) * 400_000).alias("timestamp"),
    )
    df = look.lookahead_pairs(ticks, 20, nested=True)
    sizes = [len(r["next"]) for r in df.collect()]
    assert len(sizes) == 3999 and sum(sizes) == 3950 * 50 + sum(range(50))
    plan, written = [df._jdf.queryExecution().executedPlan()], 0
    while plan:
        node = plan.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            plan.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            plan.append(node.plan())
        else:
            plan += [node.children().apply(i) for i in range(node.children().size())]
            # The last one is the first that runs.
            written = node.metrics().apply("numOutputRows").value() if name == "Generate" else written
    assert 4000 <= written <= 1.3 * 4000
