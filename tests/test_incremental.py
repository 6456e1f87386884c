"""Incremental tables: replays, touched keys only, rows that leave, days out of order."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from delaylens.operators import marts
from delaylens.plans import incremental as I
from delaylens.plans.model_build import STOP_KEY, Models

DAY = dt.date(2024, 9, 1)
RAW = ("train_number string, journey_date date, station_code string, station_sequence int, scheduled_arrival_at timestamp_ntz, "
       "actual_arrival_at timestamp_ntz, scheduled_departure_at timestamp_ntz, actual_departure_at timestamp_ntz, "
       "arrival_delay_minutes double, departure_delay_minutes double, status string, source_name string, "
       "source_record_hash string, ingested_at timestamp_ntz")


def row(train, day, station, seq, delay, version=0):
    at = dt.datetime.combine(day, dt.time(8 + seq))
    return (train, day, station, seq, at, None, None, None, delay, None, "observed", "src",
            f"{train}-{day}-{station}-{seq}-{version}", dt.datetime(2024, 10, 1 + version))


def files_of(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def read(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).drop("bucket", "made_by", "batch_id").collect()), key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_batches_equal_a_full_build_and_replays_change_nothing(spark, scratch):
    t = I.IncrementalTables(scratch, buckets=16)
    first = [row(f"t{k}", DAY + dt.timedelta(k % 3), f"s{k % 5}", 1 + k % 4, float(k)) for k in range(24)]
    second = [row("t1", DAY + dt.timedelta(1), "s1", 2, 99.0, 1), row("t2", DAY + dt.timedelta(2), "s2", 3, None, 1)]
    frames = [spark.createDataFrame(b, RAW) for b in (first, second)]

    def run(k):
        feed = I.apply_batch(spark, t, frames[k], k)
        I.update_features(spark, t, feed, k)
        for key in ("station_code", "train_number"):
            I.update_mart(spark, t, feed, key, k)

    run(0)
    before = files_of(t.path("mart_train_number"))
    run(1)
    after = files_of(t.path("mart_train_number"))
    # Two trains changed: the files of all other buckets are the same ones.
    assert 0 < len({os.path.dirname(f) for f in before.keys() - after.keys()}) <= 2
    full = Models(frames[0].unionByName(frames[1]))

    def check():
        assert read(spark, t.path("features")) == rows_of(full.delay_features.select(*spark.read.parquet(t.path("features")).columns))
        stations = spark.read.parquet(t.path("mart_station_code")).select(full.mart_station_delay.columns)
        assert rows_of(stations) == rows_of(full.mart_station_delay)
        trains = spark.read.parquet(t.path("mart_train_number")).select(full.mart_train_punctuality.columns)
        assert rows_of(trains) == rows_of(full.mart_train_punctuality)
        assert rows_of(spark.read.parquet(t.path("fact")).select(marts.FACT_COLUMNS)) == rows_of(full.fact_station_arrival)

    check()
    assert not [r for r in spark.read.parquet(t.path("mart_train_number")).collect() if r.train_number == "t2"]  # its only delay went
    run(1)  # replayed after all of it was stored
    check()


def test_an_emptied_partition_is_removed(spark, scratch):
    t = I.IncrementalTables(scratch, buckets=4)
    feed = lambda rows: spark.createDataFrame([(s, d, n) for s, d, n in rows], "station_code string, arrival_delay_minutes double, change int")
    I.update_mart(spark, t, feed([("a", 1.0, 1), ("b", 2.0, 1)]), "station_code", 0)
    I.update_mart(spark, t, feed([("a", 1.0, -1)]), "station_code", 1)
    assert [r.station_code for r in spark.read.parquet(t.path("mart_station_code")).collect()] == ["b"]


def test_ten_daily_runs_carry_the_history(spark, scratch):
    from delaylens.operators.baseline import expanding_history

    t = I.IncrementalTables(scratch, buckets=3)
    rows = [(f"t{k % 3}", DAY + dt.timedelta(d), f"s{k % 4}", k, float(k * d % 7) if (k + d) % 5 else None) for d in range(10) for k in range(12)]
    facts = spark.createDataFrame(rows, "train_number string, journey_date date, station_code string, station_sequence int, arrival_delay_minutes double")
    for d in range(10):
        day = facts.where(F.col("journey_date") == DAY + dt.timedelta(d))
        I.carry_history(spark, t, day, d)
        if d == 4:
            I.carry_history(spark, t, day, d)  # replayed
    want = expanding_history(facts)
    assert rows_of(spark.read.parquet(t.path("history")).select(want.columns)) == rows_of(want)
    with pytest.raises(ValueError, match="not later"):
        I.carry_history(spark, t, facts.where(F.col("journey_date") == DAY), 99)


def test_predictions_are_closed_once(spark, scratch):
    t = I.IncrementalTables(scratch)
    preds = spark.createDataFrame([("m", "v", "t1", DAY, "s1", 1, 5.0), ("m", "v", "t1", DAY, "s2", 2, 6.0), ("m", "v", "t2", DAY, "s1", 1, 7.0)],
                                  "model_name string, model_version string, train_number string, journey_date date, station_code string, "
                                  "station_sequence int, predicted_arrival_delay_minutes double")
    I.open_predictions(preds, t, 0)
    schema = "train_number string, journey_date date, station_code string, station_sequence int, arrival_delay_minutes double, change int"
    feeds = [[("t1", DAY, "s1", 1, 8.0, 1)], [("t1", DAY, "s1", 1, 8.0, -1), ("t1", DAY, "s1", 1, 20.0, 1), ("t1", DAY, "s2", 2, None, 1)],
             [("t1", DAY, "s2", 2, 3.0, 1)]]
    for k in (0, 1, 1, 2):
        I.close_predictions(spark, t, spark.createDataFrame(feeds[k], schema), k, preds.schema)
    got = I.evaluated_predictions(spark, t, preds.schema).select(*STOP_KEY, "actual_arrival_delay_minutes", "absolute_error_minutes")
    assert rows_of(got) == sorted([("t1", DAY, "s1", 1, 8.0, 3.0), ("t1", DAY, "s2", 2, 3.0, 3.0), ("t2", DAY, "s1", 1, None, None)], key=repr)
