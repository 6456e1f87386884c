"""Malformed rows, headers read once, stored keys, null dates, schedule quarantine."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from delaylens.operators import history, tables
from delaylens.plans import load_run
from delaylens.sources import files
from delaylens.streaming import jobs

HEAD = ",".join(files.DELAY_REQUIRED)
ROUTE_HEAD = "stnSerialNumber,trainNumber,station_code,trainName,station_name,arrivalTime,departureTime,distance"


def write(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def paths(scratch):
    return load_run.LoadPaths(*[os.path.join(scratch, x) for x in ("raw", "quarantine", "audit")])


def test_rows_of_a_wrong_number_of_fields(spark, scratch):
    p = write(scratch, "d.csv", "stnSerialNumber,trainNumber,station_code", "1,100,A", "2,101", "3,102,B,EXTRA,MORE", '4,"10,3",C')
    rows = files.read_route_csv(spark, p, malformed="raw").select("stnSerialNumber", "trainNumber", "station_code", "raw").collect()
    assert sorted((r.raw or "", r.stnSerialNumber, r.trainNumber, r.station_code) for r in rows if r.raw is None) == [
        ("", "1", "100", "A"), ("", "4", "10,3", "C")]
    assert sorted(r.raw for r in rows if r.raw) == ["2,101", "3,102,B,EXTRA,MORE"]
    for columns in (["stnSerialNumber"], ["*"]):
        with pytest.raises(Exception, match="(?i)malformed"):
            files.read_route_csv(spark, p).select(*columns).collect()


def test_malformed_rows_of_a_load_go_to_quarantine(spark, scratch):
    good = ",".join(["12345", "2024-09-01", "HWH", "08:00", "08:01", "5", "08:00", "08:01", "6"])
    d = write(scratch, "d.csv", HEAD, good, good, good + ",EXTRA", "12345,2024-09-01")
    r = write(scratch, "r.csv", "stnSerialNumber,trainNumber,station_code,station_name", "1,12345,HWH,Howrah", "7,12345")
    got = load_run.historical_load(spark, d, r, paths(scratch), run_id="a")
    assert {k: got[k] for k in ("received", "valid", "rejected", "distinct_valid", "inserted", "already_present")} == {
        "received": 4, "valid": 2, "rejected": 2, "distinct_valid": 1, "inserted": 1, "already_present": 0}
    q = spark.read.json(os.path.join(scratch, "quarantine", "run_id=a")).collect()
    assert sorted((x.error_codes, x.malformed_record) for x in q) == [
        ("field_count", "12345,2024-09-01"), ("field_count", good + ",EXTRA"), ("field_count", "7,12345")]
    again = load_run.historical_load(spark, d, r, paths(scratch), run_id="b")
    assert (again["inserted"], again["already_present"]) == (0, 1)


def test_files_of_different_headers_and_one_file_per_directory(spark, scratch):
    write(os.path.join(scratch, "in"), "a.csv", "stnSerialNumber,trainNumber,station_code", "1,100,A")
    write(os.path.join(scratch, "in"), "b.csv", "﻿station_code,x,trainNumber,stnSerialNumber", "B,-,101,2", "C,-,102")
    rows = files.read_route_csv(spark, os.path.join(scratch, "in"), "raw").collect()
    assert sorted((r.stnSerialNumber, r.trainNumber, r.station_code) for r in rows if r.raw is None) == [("1", "100", "A"), ("2", "101", "B")]
    with pytest.raises(files.ContractError, match="not one"):
        load_run.schedule_load(spark, os.path.join(scratch, "in"), paths(scratch), route_glob="*.csv")
    got = load_run.schedule_load(spark, os.path.join(scratch, "in"), paths(scratch), route_glob="a*.csv")
    assert got["inserted"] == 1


def test_a_source_is_read_once(spark, scratch):
    """Headers cost a few buffers of each file."""
    body = ["1,100,A" + "x" * 200] * 60_000
    for k in range(3):
        write(os.path.join(scratch, "in"), f"{k}.csv", "stnSerialNumber,trainNumber,station_code", *body)
    size = sum(os.path.getsize(os.path.join(scratch, "in", f)) for f in os.listdir(os.path.join(scratch, "in")))
    stats = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    before = stats.getLong("bytesRead")
    groups = files.header_groups(spark, os.path.join(scratch, "in"))
    heads = stats.getLong("bytesRead") - before
    assert groups == [(["stnSerialNumber", "trainNumber", "station_code"], None)]
    assert heads < size / 10
    assert files.read_route_csv(spark, os.path.join(scratch, "in")).count() == 180_000
    assert stats.getLong("bytesRead") - before < 1.3 * size


def test_schedule_quarantine_has_reasons_and_texts(spark, scratch):
    r = write(scratch, "r.csv", ROUTE_HEAD, "1,100,A,Mail,Alpha,08:00,08:05,12.5", "2,100,B,Mail,Beta,09:00,09:05,12 km",
              "x,100,C,Mail,,,,", ",,,,,,,", "3,100")
    got = load_run.schedule_load(spark, r, paths(scratch), run_id="s")
    assert (got["received"], got["valid"], got["rejected"], got["inserted"]) == (5, 1, 4, 1)
    q = {x.error_codes: json.loads(x.record) for x in spark.read.json(os.path.join(scratch, "quarantine", "run_id=s")).collect()}
    assert set(q) == {"distance_not_a_number", "station_sequence_not_positive", "field_count",
                      "train_number_missing,station_code_missing,station_sequence_not_positive"}
    assert q["distance_not_a_number"]["source_distance_text"] == "12 km"
    assert q["station_sequence_not_positive"]["source_sequence_text"] == "x"
    assert q["field_count"]["malformed_record"] == "3,100"
    row = spark.read.parquet(os.path.join(scratch, "raw", "run_id=s")).first()
    assert (row.train_name, row.station_name, row.schedule_arrival_time, row.schedule_departure_time, row.distance_km) == (
        "Mail", "Alpha", "08:00", "08:05", 12.5)


def test_stored_keys_are_not_shuffled(spark, scratch):
    h = history.KeyHistory(os.path.join(scratch, "keys"), buckets=4)
    day = dt.date(2024, 9, 1)
    rows = spark.range(400).select(F.col("id").cast("string").alias("source_record_hash"),
                                   F.date_add(F.lit(day), (F.col("id") % 4).cast("int")).alias("journey_date"))
    history.append(rows.where("id < 200"), h, "ok")
    history.append(rows.where("id < 200"), h, "ok")  # a run that was repeated
    history.append(rows.where("id >= 200"), h, "failed")
    runs = spark.createDataFrame([("ok",)], "run_id string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
        got = history.flagged(rows, h, [day, dt.date(2024, 9, 2)], F.broadcast(runs))
        plan = got._jdf.queryExecution().executedPlan().toString()
        after_join = plan[plan.index("SortMergeJoin"):]
        stored_side = after_join[after_join.index("HashAggregate"):]
        assert "Exchange hashpartitioning" not in stored_side and "Bucketed: true" in stored_side
        assert "journey_date" in stored_side[stored_side.index("PartitionFilters"):]
        assert got.where("present").count() == 100 and got.count() == 400
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_stream_dedupe_with_null_dates_over_triggers(spark, scratch):
    schema = "source_record_hash string, journey_date date, n int"
    landing = os.path.join(scratch, "landing")
    sink, checkpoint = os.path.join(scratch, "sink"), os.path.join(scratch, "ckpt")
    day = dt.date(2024, 9, 1)
    for batch in ([("h1", None, 1), ("h2", day, 1)], [("h1", None, 1), ("h3", None, 1), ("h2", day, 1)], [("h3", None, 1), ("h4", day, 1)]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(landing)
        jobs.late_correction_dedupe(spark, landing, sink, checkpoint, spark.createDataFrame([], schema).schema)
    got = spark.read.parquet(sink).collect()
    assert sorted((r.source_record_hash, r.journey_date) for r in got) == [("h1", None), ("h2", day), ("h3", None), ("h4", day)]


def test_insert_only_compares_rows_without_a_date(spark):
    df = lambda rows: spark.createDataFrame(rows, "source_record_hash string, journey_date date")
    target = df([("a", None), ("b", dt.date(2024, 9, 1))])
    batch = df([("a", None), ("b", dt.date(2024, 9, 1)), ("c", None)])
    assert [r[0] for r in tables.insert_only(target, batch, implied_by_key="journey_date").collect()] == ["c"]
