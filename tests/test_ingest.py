"""Validation, key clean-up, stop-sequence lookup, hashing, sources."""

import datetime as dt
import json
import os

import pytest

from delaylens.functions import expressions as E
from delaylens.operators import ingest
from delaylens.sources import files, payloads, provenance

EVENT_SCHEMA = ("train_number string, journey_date date, station_code string, station_sequence int, "
                "source_name string, arrival_delay_minutes double, departure_delay_minutes double, "
                "status string, source_record_hash string")


def test_normalization_upper_cases_and_keeps_null_delay(spark):
    df = spark.createDataFrame([(" 12345 ", dt.date(2024, 9, 1), "hwh", 1, "src", None, None, None, "h1")],
                               EVENT_SCHEMA)
    acc, rej = ingest.validate(df)
    r = acc.first()
    assert (r.train_number, r.station_code, r.arrival_delay_minutes) == ("12345", "HWH", None)
    assert rej.count() == 0


def test_sequence_zero_and_out_of_range_delay_are_quarantined(spark):
    df = spark.createDataFrame([
        ("12345", dt.date(2024, 9, 1), "HWH", 0, "src", 5.0, None, None, "h1"),
        ("12345", dt.date(2024, 9, 1), "HWH", 2, "src", 20000.0, None, None, "h2"),
        ("12345", dt.date(2024, 9, 1), "HWH", 3, "src", float("nan"), None, None, "h3"),
    ], EVENT_SCHEMA)
    acc, rej = ingest.validate(df)
    assert acc.count() == 0
    codes = {r.source_record_hash: list(r.errors) for r in rej.collect()}
    assert codes["h1"] == ["station_sequence_not_positive"]
    assert codes["h2"] == ["arrival_delay_out_of_range"]
    assert codes["h3"] == ["arrival_delay_out_of_range"]


def test_exact_duplicate_is_accepted_once(spark):
    row = ("12345", dt.date(2024, 9, 1), "HWH", 1, "src", 5.0, None, None, "same")
    r = ingest.preflight_counts(spark.createDataFrame([row, row], EVENT_SCHEMA)).first()
    assert (r.accepted_count, r.rejected_count) == (1, 0)


def test_normalize_key_and_optional_number(spark):
    df = spark.createDataFrame([(" 12345.0 ", " 7 ", "x"), ("abc", "", None)], "a string, b string, c string")
    out = df.select(E.normalize_key("a").alias("k"), E.optional_number("b").alias("n"),
                    E.not_a_number("c").alias("bad")).collect()
    assert [tuple(r) for r in out] == [("12345", 7.0, True), ("ABC", None, False)]


def test_minute_boundaries_and_sunday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 9, 1, 10, 59, 59), dt.datetime(2024, 9, 1, 11, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(E.minutes_between("a", "b").alias("m"), E.day_of_week_sunday_zero("a").alias("d")).first()
    assert (r.m, r.d) == (1, 0)  # 2024-09-01 is a Sunday


def test_route_lookup_hit_and_miss(spark):
    delays = spark.createDataFrame([
        ("12345", "2024-09-01", "hwh", "", "", "5", "", "", ""),
        ("12345", "2024-09-01", "ndls", "", "", "", "", "", ""),
        ("12345.0", "2024-09-01", "Howrah Jn", "", "", "1", "", "", ""),
    ], ",".join(f"{c} string" for c in files.DELAY_REQUIRED))
    routes = spark.createDataFrame([("1", "12345", "HWH", "Howrah Jn"), ("1.0", "12345", "HWH", "Howrah Jn"),
                                    ("4", "12345", "", "Other")],
                                   "stnSerialNumber string, trainNumber string, station_code string, station_name string")
    out = {r.station_code: r.station_sequence for r in ingest.attach_stop_sequence(delays, routes).collect()}
    assert out == {"HWH": 1, "NDLS": 0, "HOWRAH JN": 1}


def test_record_hash_is_order_independent_of_source_columns(spark):
    a = spark.createDataFrame([("x", 1, None)], "p string, q int, r string")
    b = a.select("r", "q", "p")
    ha = a.select(E.record_hash(*sorted(a.columns)).alias("h")).first().h
    hb = b.select(E.record_hash(*sorted(b.columns)).alias("h")).first().h
    assert ha == hb and len(ha) == 64


def test_csv_header_contract_names_missing_columns(spark, scratch):
    path = os.path.join(scratch, "bad.csv")
    with open(path, "w", encoding="utf-8-sig") as fh:
        fh.write("train_number,journey_date\n12345,2024-09-01\n")
    with pytest.raises(files.ContractError, match="station_code, station_sequence"):
        files.read_event_csv(spark, path, "src")


def test_csv_with_bom_reads_and_appends_source(spark, scratch):
    path = os.path.join(scratch, "ok.csv")
    with open(path, "w", encoding="utf-8-sig") as fh:
        fh.write("train_number,journey_date,station_code,station_sequence\n12345,2024-09-01,hwh,1\n")
    r = files.read_event_csv(spark, path, "src").first()
    assert (r.train_number, r.station_code, r.source_name) == ("12345", "hwh", "src")


def test_find_single_file(spark, scratch):
    for name in ("a.csv", "b.txt"):
        with open(os.path.join(scratch, name), "w") as fh:
            fh.write("x\n1\n")
    assert files.find_single_file(spark, scratch, "*.csv").endswith("a.csv")
    with pytest.raises(files.ContractError):
        files.find_single_file(spark, scratch, "*.nothing")


def test_provenance_gate(spark, scratch):
    docs = [{"source_name": "good", "source_url": "https://example.org/a", "license_name": "CC-BY",
             "retrieved_at": "2024-10-01T00:00:00", "coverage_description": "September stops",
             "local_processing_permitted": True},
            {"source_name": "blocked", "source_url": "https://example.org/b", "license_name": "CC-BY",
             "retrieved_at": "2024-10-01T00:00:00", "coverage_description": "September stops",
             "local_processing_permitted": False}]
    for i, d in enumerate(docs):
        with open(os.path.join(scratch, f"m{i}.json"), "w", encoding="utf-8-sig") as fh:
            json.dump(d, fh)
    manifests = provenance.read_manifests(spark, scratch)
    events = spark.createDataFrame([("good", 1), ("blocked", 2)], "source_name string, v int")
    assert [r.v for r in provenance.gate_sources(events, manifests).collect()] == [1]
    with pytest.raises(Exception):
        provenance.gate_sources(events, manifests, strict=True).collect()
    only_good = events.where("source_name = 'good'")
    assert provenance.gate_sources(only_good, manifests, strict=True).count() == 1


def test_weather_flatten_zips_arrays_and_flags_missing_daily(spark):
    good = json.dumps({"daily": {"time": ["2024-09-01", "2024-09-02"], "temperature_2m_mean": [20.5, 21.0],
                                 "precipitation_sum": [0.0, None], "rain_sum": [0.0, 0.0], "weather_code": [1, 2]}})
    df = spark.createDataFrame([(1, good), (2, json.dumps({"reason": "x"}))], "request_id int, payload string")
    out = payloads.flatten_weather(df, ["request_id"]).orderBy("request_id", "weather_date").collect()
    assert [(r.request_id, r.temperature_2m_mean, r.error is None) for r in out] == [
        (1, 20.5, True), (1, 21.0, True), (2, None, False)]


def test_live_status_flatten_null_safe(spark):
    payload = json.dumps({"data": {"trainNumber": None, "status": "x", "currentLocation": None,
                                   "nextHalt": {"stationCode": "S1", "stationName": "One"}}})
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 200, "12345", payload),
                                (2, dt.datetime(2024, 1, 1), 429, "12345", payload)],
                               "event_id long, retrieved_at timestamp_ntz, http_status int, "
                               "requested_train_number string, payload string")
    rows = payloads.flatten_live_status(df).collect()
    assert len(rows) == 1 and rows[0].train_number == "12345" and rows[0].current_station_code is None
    c = payloads.live_status_counts(df).first()
    assert (c.received, c.rejected) == (1, 1)


def test_csv_parts_with_other_column_order_quotes_and_line_ends(spark, scratch):
    parts = ["train_number,journey_date,station_code,station_sequence,status\n1,2024-09-01,HWH,1,\"a \"\"b\"\", c\"\n",
             "station_code,extra,train_number,station_sequence,journey_date\nNDLS,x,2,3,2024-09-02\n",
             "train_number,journey_date,station_code,station_sequence,status\n3,2024-09-03,BCT,4,\"two\nlines\"\n"]
    for k, text in enumerate(parts):
        with open(os.path.join(scratch, f"p{k}.csv"), "w", encoding="utf-8-sig", newline="") as fh:
            fh.write(text)
    df = files.read_csv_contract(spark, scratch, files.EVENT_REQUIRED, files.EVENT_OPTIONAL, multi_line=True)
    got = sorted((r.train_number, r.station_code, r.station_sequence, r.status) for r in df.collect())
    assert got == [("1", "HWH", "1", 'a "b", c'), ("2", "NDLS", "3", None), ("3", "BCT", "4", "two\nlines")]


def test_generic_csv_keeps_the_five_times_and_names_bad_ones(spark):
    cols = [*files.EVENT_REQUIRED, *files.EVENT_OPTIONAL, "source_name"]
    base = dict.fromkeys(cols) | {"train_number": "1", "journey_date": "2024-09-01", "station_code": "A",
                                  "station_sequence": "1", "source_name": "src", "scheduled_arrival_at": "2024-09-01 08:00:00"}
    rows = [base, base | {"actual_arrival_at": "soon"}]
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], ",".join(f"{c} string" for c in cols))
    accepted, rejected = ingest.validate(files.events_from_generic_csv(df), date_is_text=True)
    assert accepted.first().scheduled_arrival_at == dt.datetime(2024, 9, 1, 8)
    assert [r.errors for r in rejected.collect()] == [["actual_arrival_at_invalid"]]


def test_record_hash_tells_records_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("~", "x"), (None, "x"), ("-", "x"), ("1:a", ""), ("1", ":a")]
    df = spark.createDataFrame(rows, "p string, q string")
    assert df.select(E.record_hash("p", "q").alias("h")).distinct().count() == len(rows)


def test_strip_and_numbers_as_the_contract_reads_them(spark):
    df = spark.createDataFrame([("HWH\t", "5d"), (" hwh\n", "5f"), (" HWH", "1e2")], "k string, n string")
    out = df.select(E.normalize_key("k").alias("k"), E.optional_number("n").alias("n"), E.not_a_number("n").alias("bad")).collect()
    assert [tuple(r) for r in out] == [("HWH", None, True), ("HWH", None, True), ("HWH", 100.0, False)]


def test_quarantine_keeps_the_text_of_a_bad_number(spark):
    delays = spark.createDataFrame([("12345", "2024-09-01", "HWH", "", "", "abc", "", "", "")],
                                   ",".join(f"{c} string" for c in files.DELAY_REQUIRED))
    routes = spark.createDataFrame([("1", "12345", "HWH", "H")],
                                   "stnSerialNumber string, trainNumber string, station_code string, station_name string")
    _ok, rejected = ingest.validate(ingest.attach_stop_sequence(delays, routes), date_is_text=True)
    row = ingest.quarantine_records(rejected).first()
    record = json.loads(row.record)
    assert record["source_arrival_delay_text"] == "abc" and "arrival_delay_not_a_number" not in record
    assert row.errors == ["arrival_delay_not_a_number"]


def test_train_numbers_are_listed_when_wrong(spark):
    df = spark.createDataFrame([("12345 ",), ("12x",), ("99999",)], "t string")
    valid, invalid = ingest.train_numbers(df, "t")
    assert sorted(r[0] for r in valid.collect()) == ["12345", "99999"] and [r[0] for r in invalid.collect()] == ["12x"]
    with pytest.raises(Exception, match="12x"):
        ingest.train_numbers(df, "t", strict=True)
    with pytest.raises(Exception, match="no train number"):
        ingest.train_numbers(df.limit(0), "t", strict=True)


def test_latest_weather_payload_holds(spark):
    from delaylens.operators.enrich import daily_weather
    d = dt.date(2024, 9, 1)
    rows = spark.createDataFrame([(1, "A", d, 20.0, 5.0, 1, None), (2, "A", d, 21.0, 5.0, 2, None), (3, "A", None, None, None, None, "x")],
                                 "request_id long, station_code string, weather_date date, temperature_2m_mean double, "
                                 "precipitation_sum double, weather_code int, error string")
    assert [tuple(r) for r in daily_weather(rows).collect()] == [("A", d, 21.0, 5.0, 2)]
