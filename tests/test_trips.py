import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import trips as ops
from tidemark.operators.cleaning import rejoin_ids
from tidemark.operators.compare import compare_predictions, read_predictions
from tidemark.operators.metrics import regression_metrics
from tidemark.session import scratch_dir
from tidemark.sources import csv

PICKUP = datetime(2016, 3, 13, 8, 30, 0)  # a Sunday
SCHEMA = ", ".join(f"{n} {k}" for n, k in csv.TRIP_COLUMNS)


def trip(**changes):
    base = dict(
        id="a", vendor_id=1.0, pickup_datetime=PICKUP, dropoff_datetime=None, passenger_count=1.0,
        pickup_longitude=-74.0, pickup_latitude=40.7, dropoff_longitude=-73.99, dropoff_latitude=40.75,
        store_and_fwd_flag="N", trip_duration=900.0,
    )
    base.update(changes)
    if base["dropoff_datetime"] is None:
        base["dropoff_datetime"] = base["pickup_datetime"] + timedelta(seconds=base["trip_duration"])
    return tuple(base.values())


def kept(spark, *rows, **options):
    return [r["id"] for r in ops.clean_trips(spark.createDataFrame(list(rows), SCHEMA), **options).collect()]


@pytest.mark.parametrize(
    "changes,keep",
    [
        ({}, True),
        ({"trip_duration": 60.0}, False),
        ({"trip_duration": 21600.0}, False),
        ({"dropoff_datetime": PICKUP + timedelta(seconds=1020)}, True),
        ({"dropoff_datetime": PICKUP + timedelta(seconds=1021)}, False),
        ({"dropoff_datetime": PICKUP + timedelta(seconds=780)}, True),
        ({"pickup_longitude": -74.3, "trip_duration": 3600.0}, False),
        ({"dropoff_latitude": 41.0, "trip_duration": 3600.0}, False),
        ({"trip_duration": 120.0}, False),  # about 170 km/h
    ],
)
def test_clean_bounds(spark, changes, keep):
    assert kept(spark, trip(**changes)) == (["a"] if keep else [])


def test_inclusive_bounds_keep_the_edge(spark):
    edge = trip(pickup_longitude=-74.3, trip_duration=3600.0)
    assert kept(spark, edge) == []
    assert kept(spark, edge, inclusive_bounds=True) == ["a"]


def test_features(spark):
    df = spark.createDataFrame([trip(store_and_fwd_flag="yes")], SCHEMA)
    row = ops.add_trip_features(df).first()
    assert (row["day_of_month"], row["month"], row["day_of_week"], row["hour"]) == (13, 3, 1, 8)
    assert (row["peak_hour"], row["store_and_fwd_flag"]) == (1, 1)
    assert ops.add_trip_features(df, iso_week=True).first()["day_of_week"] == 7
    lat1, lat2 = math.radians(40.7), math.radians(40.75)
    a = math.sin((lat2 - lat1) / 2) ** 2
    a += math.cos(lat1) * math.cos(lat2) * math.sin(math.radians(0.01) / 2) ** 2
    assert row["distance_haversine"] == pytest.approx(2 * math.asin(math.sqrt(a)) * 6371, rel=1e-9)
    assert ops.feature_array(ops.train_table(df)).columns == ["id", "label", "features"]


def test_rows_with_missing_features_are_dropped(spark):
    df = spark.createDataFrame([trip(), trip(id="b", passenger_count=None)], SCHEMA)
    assert [r["id"] for r in ops.train_table(df).collect()] == ["a"]
    assert [r["id"] for r in ops.score_table(df).collect()] == ["a"]


def test_duplicate_ids_multiply(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "id string, v int")
    assert rejoin_ids(df, df).count() == 5


def test_permissive_csv(spark):
    path = scratch_dir(spark, "csv")
    header = ",".join(n for n, _ in csv.TRIP_COLUMNS)
    good = "a,1,2016-03-13 08:30:00,2016-03-13 08:45:00,1,-74.0,40.7,-73.99,40.75,N,900"
    lines = [
        header,
        good,
        header,
        good.replace("a,1,", "b,one,"),
        good.replace("2016-03-13 08:30:00", "2016-03-13T08:30"),
        "c,1,2016-03-13 08:30:00",
        "",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = csv.read_trips_permissive(spark, path).collect()
    assert [r["id"] for r in rows] == ["a"]
    assert rows[0]["pickup_datetime"] == PICKUP


def test_strict_csv_fails_on_a_bad_row(spark):
    path = scratch_dir(spark, "csv")
    lines = ["Time,V1,V2,Class", '0,1.5,2.5,"0"', '1,x,2.5,"1"']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = csv.read_labelled(spark, path, ["Time", "V1", "V2", "Class"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rows.collect()
    assert rows.select("label").orderBy("label").collect()[1]["label"] == 1
    with pytest.raises(Exception):
        csv.read_csv_strict(spark, path, "Time int, V1 double, V2 double, Class int").collect()


def test_text_sink_refuses_to_overwrite(spark):
    path = scratch_dir(spark, "text")
    df = csv.metrics_frame(spark, [("a", 1), ("b", [0.5])])
    csv.write_lines(df, "metric", path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == ["a", "b"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        csv.write_lines(df, "metric", path)


def test_predictions_are_sorted_and_formatted(spark):
    path = scratch_dir(spark, "pred")
    df = spark.createDataFrame([("b", 2.345), ("a", 1.0)], "id string, prediction double")
    csv.write_predictions(df, path, decimals=2, single_file=True)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    assert lines == ["id,prediction", "a,1.00", "b,2.35"] or lines == ["id,prediction", "a,1.00", "b,2.34"]


def test_prediction_files_need_both_columns(spark):
    path = scratch_dir(spark, "pred")
    csv.write_csv(spark.createDataFrame([("a", 1.0)], "id string, score double"), path)
    with pytest.raises(ValueError, match="prediction"):
        read_predictions(spark, path)


def test_compare(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "id string, prediction double")

    sets = {
        "x": frame([("a", 100.0), ("b", 0.0)]),
        "y": frame([("a", 250.0), ("b", 200.0)]),
        "z": frame([("a", 1.0)]),
        "d": frame([("a", 1.0), ("a", 1.0), ("b", 2.0)]),
    }
    got = {r["file_pair"]: tuple(r)[1:] for r in compare_predictions(sets).collect()}
    assert got["x vs y"] == (True, 175.0, 100.0, 50.0)
    assert got["x vs z"] == (False, None, None, None)
    assert got["x vs d"] == (False, None, None, None)
    assert len(got) == 6


def test_regression_metrics_of_constant_labels(spark):
    df = spark.createDataFrame([(1.0, 1.5), (1.0, 0.5)], "label double, prediction double")
    row = regression_metrics(df).first()
    assert row["r2"] == 0.0 and row["rmse"] > 0


def test_regression_metrics_match_the_library(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    df = spark.range(50).select(
        F.log1p(F.col("id") * 10.0).alias("label"), F.log1p(F.col("id") * 9.0 + 3).alias("prediction")
    )
    row = regression_metrics(df).first()
    original = df.select(F.expm1("label").alias("label"), F.expm1("prediction").alias("prediction"))
    for name in ("rmse", "r2"):
        assert row[name] == pytest.approx(RegressionEvaluator(metricName=name).evaluate(original))
