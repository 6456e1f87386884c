"""Steps that move each row once: bucketed tables, moved stages, packed keys, landings without a shuffle."""

import datetime as dt
import os

from pyspark.sql import functions as F

from delaylens.operators import tables

DAY = dt.date(2024, 9, 1)


def test_packed_keys_come_back(spark):
    texts = ["0f" * 32, "AB12", "abc", "", None, "é|1", "ab", "00", "\x01"]
    df = spark.createDataFrame([(t,) for t in texts], "source_record_hash string")
    assert sorted(map(repr, df.collect())) == sorted(map(repr, tables.dealt(df, "source_record_hash").collect()))
    assert df.select(F.length(tables.packed("source_record_hash"))).first()[0] == 33


def test_a_staged_upsert_is_moved_not_copied(spark, scratch):
    root, stage = os.path.join(scratch, "t"), os.path.join(scratch, "stage")
    df = lambda rows: spark.createDataFrame(rows, "k int, v int, d date")
    tables.upsert_partitions(spark, root, stage + "/0", df([(1, 1, DAY), (2, 1, None)]), df([(1, 1, DAY), (2, 1, None)]), ["k", "d"], "d")
    touched = df([(1, 0, DAY), (3, 0, dt.date(2024, 9, 2))])
    for _ in range(2):  # a replay after all of it was moved changes nothing
        tables.upsert_partitions(spark, root, stage + "/1", df([(3, 3, dt.date(2024, 9, 2))]), touched, ["k", "d"], "d")
        assert sorted(tuple(r) for r in spark.read.parquet(root).select("k", "v").collect()) == [(2, 1), (3, 3)]
        assert not [f for _, _, fs in os.walk(stage) for f in fs if f.startswith("part-")]


def test_bucketed_rows_are_joined_where_they_lie(spark, scratch):
    schema = spark.createDataFrame([], "h string, k string, d date").schema
    t = tables.Bucketed(os.path.join(scratch, "t"), schema, "k", ("d",))
    rows = spark.createDataFrame([(f"h{i}", f"k{i % 7}", DAY if i % 3 else None) for i in range(50)], schema)
    t.store(t.dealt(rows))
    assert sorted(map(repr, t.read(spark).collect())) == sorted(map(repr, rows.collect()))
    assert t.read(spark, "d", [None]).count() == 17
    with tables.session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", **tables._CO_LOCATED):
        kept = t.dealt(rows.select("k", "h")).join(t.read(spark), ["k", "h"], "left_anti")
        assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def _load(spark, scratch, run_id, delays, routes):
    from delaylens.plans import load_run
    head = "train,date,station,sch_arr,act_arr,arr_delay,sch_dep,act_dep,dep_delay"
    for name, lines in (("d.csv", [head, *delays]), ("r.csv", ["stnSerialNumber,trainNumber,station_code,station_name", *routes])):
        with open(os.path.join(scratch, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    paths = load_run.LoadPaths(*[os.path.join(scratch, x) for x in ("raw", "quarantine", "audit")])
    got = load_run.historical_load(spark, os.path.join(scratch, "d.csv"), os.path.join(scratch, "r.csv"), paths, run_id=run_id)
    return paths, [got[k] for k in ("received", "valid", "rejected", "distinct_valid", "inserted", "already_present")]


def test_a_load_deals_its_rows_once(spark, scratch):
    """All that a run writes lies in buckets of the train, which a train with odd spelling shares."""
    row = "{},2024-09-0{},{},08:00,08:01,{},08:00,08:01,6".format
    delays = [row(t, d, "HWH", 5) for t in ("100", "101 .0", "102") for d in (1, 2)] * 2 + [row("", 1, "HWH", k) for k in range(40)]
    routes = ["1,100,HWH,Howrah", "2,101 .0,HWH,Howrah", "3,102,X,HWH"]
    paths, got = _load(spark, scratch, "a", delays, routes)
    assert got == [52, 12, 40, 6, 6, 0]
    assert _load(spark, scratch, "b", delays + [row("100", 3, "HWH", 5)], routes)[1] == [53, 13, 40, 7, 1, 6]
    raw = spark.read.parquet(os.path.join(paths.raw_root, "run_id=a"))
    assert sorted({(r.train_number, r.station_sequence) for r in raw.collect()}) == [("100", 1), ("101", 2), ("102", 3)]
    from delaylens.operators import history
    table = tables.Bucketed(os.path.join(paths.raw_root, "run_id=a"), raw.schema, "train_number", ("journey_date",))
    runs = F.broadcast(spark.createDataFrame([("a",)], "run_id string"))
    with tables.session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", **tables._CO_LOCATED):
        known = history.flagged(table.read(spark), paths.keys, [DAY, dt.date(2024, 9, 2)], runs)
        assert "Exchange hashpartitioning" not in known._jdf.queryExecution().executedPlan().toString()
        assert known.where("present").count() == 6


def test_rows_without_a_train_are_spread(spark):
    from delaylens.operators import ingest
    names = ["train", "date", "station", "sch_arr", "act_arr", "arr_delay", "sch_dep", "act_dep", "dep_delay"]
    delays = spark.createDataFrame([(None, "2024-09-01", f"S{k}", *[None] * 6) for k in range(200)], ", ".join(f"{c} string" for c in names))
    routes = spark.createDataFrame([("1", "", "S1", "S1")], "stnSerialNumber string, trainNumber string, station_code string, station_name string")
    rows = ingest.attach_stop_sequence(delays, routes, deal_to=4)
    assert rows.where((F.col("train_number") == "") & (F.col("station_sequence") == 0)).count() == 200
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() == 4


def test_a_payload_is_parsed_once(spark):
    from delaylens.sources import payloads
    rows = spark.createDataFrame([(200, "1", '{"data":{"trainNumber":"7","status":"late","delayMinutes":3}}', DAY)],
                                 "http_status int, requested_train_number string, payload string, retrieved_at date")
    flat = payloads.flatten_live_status(rows)
    assert (flat.first().train_number, flat.first().journey_status, flat.first().delay_minutes) == ("7", "late", 3.0)
    assert flat._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_the_last_weather_is_whole_and_aggregated_by_hash(spark):
    from delaylens.operators import enrich
    rows = spark.createDataFrame([(1, "A", DAY, 9.0, 8.0, 7, None), (2, "A", DAY, None, 1.0, None, None), (3, "A", DAY, 5.0, 5.0, 5, "x")],
                                 "request_id long, station_code string, weather_date date, temperature_2m_mean double, "
                                 "precipitation_sum double, weather_code int, error string")
    daily = enrich.daily_weather(rows)
    assert [tuple(r) for r in daily.collect()] == [("A", DAY, None, 1.0, None)]
    assert "SortAggregate" not in daily._jdf.queryExecution().executedPlan().toString()


def test_the_shared_fact_is_written_without_the_hash(spark, scratch):
    from delaylens.plans import queries_model
    assert "source_record_hash" not in queries_model._shared_fact(spark, "/root/testdata/sf0.001").columns
    for day in ("2024-09-01", tables.NULL_PARTITION):
        os.makedirs(os.path.join(scratch, f"journey_date={day}"))
    assert tables.existing_dates(spark, scratch, "journey_date", [DAY, dt.date(2024, 9, 2), None]) == [DAY, None]


def test_an_incremental_batch_lies_as_the_fact_does(spark, scratch):
    """Raw rows are dealt once, by the train; the batch is stored and joined with the fact where it lies."""
    from delaylens.operators.marts import FACT_COLUMNS
    from delaylens.plans.model_build import STOP_KEY, Models, incremental_fact_batch
    day = lambda d: dt.datetime(2024, 9, d)
    rows = [(f"t{k % 5}", DAY + dt.timedelta(k % 3), f"S{k % 4}", k % 4, day(1), day(2), float(k), "x", f"{k:064x}", day(1 + k % 20)) for k in range(200)]
    raw = spark.createDataFrame(rows, "train_number string, journey_date date, station_code string, station_sequence int, scheduled_arrival_at "
                                "timestamp_ntz, actual_arrival_at timestamp_ntz, arrival_delay_minutes double, status string, "
                                "source_record_hash string, ingested_at timestamp_ntz")
    old = Models(raw.where(F.col("ingested_at") < F.lit("2024-09-12").cast("timestamp_ntz"))).fact_station_arrival
    table = tables.Bucketed(os.path.join(scratch, "t"), old.schema, "train_number", ("journey_date",))
    table.store(table.dealt(old))
    batch = incremental_fact_batch(raw, table.read(spark), table=table)
    want = sorted(map(repr, incremental_fact_batch(raw, old).select(*FACT_COLUMNS).collect()))
    with tables.session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false", **tables._CO_LOCATED):
        plan = batch._jdf.queryExecution().executedPlan().toString()
        wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
        assert len(wide) == 3 and sum("hashpartitioning(train_number" in x and "journey_date" not in x.split(")")[0] for x in wide) == 2
    stored = tables.Bucketed(os.path.join(scratch, "b"), table.schema, table.key, table.partitions)
    stored.store(batch, table.buckets(spark))
    assert sorted(map(repr, stored.read(spark).select(*FACT_COLUMNS).collect())) == want and want
    tables.upsert_partitions(spark, table.root, os.path.join(scratch, "stage"), stored.read(spark), stored.read(spark).select(*STOP_KEY),
                             STOP_KEY, "journey_date", table)
    full = Models(raw).fact_station_arrival
    drop = "previous_station_arrival_delay_minutes"
    assert sorted(map(repr, table.read(spark).drop(drop).collect())) == sorted(map(repr, full.drop(drop).select(*table.read(spark).drop(drop).columns).collect()))


def _models(spark, n):
    from delaylens.plans.model_build import Models
    at = lambda d: dt.datetime(2024, 9, d)
    events = [(f"t{k % 5}", DAY + dt.timedelta(k % 3), f"S{k % 4}", k % 4, at(1), at(2), float(k), "x", f"{k:064x}", at(1 + k % 20)) for k in range(n)]
    stops = [(f"t{k % 5}", f"n{k % 2}", f"S{k % 4}", f"Station {k % 4}", k % 4, f"{k:064x}", at(1 + k % 20)) for k in range(n)]
    schema = ("train_number string, journey_date date, station_code string, station_sequence int, scheduled_arrival_at timestamp_ntz, "
              "actual_arrival_at timestamp_ntz, arrival_delay_minutes double, status string, source_record_hash string, ingested_at timestamp_ntz")
    plan = ("train_number string, train_name string, station_code string, station_name string, station_sequence int, "
            "source_record_hash string, ingested_at timestamp_ntz")
    schedule = spark.createDataFrame(stops, plan).withColumns({c: F.lit(None).cast("string") for c in (
        "train_type", "source_station_code", "destination_station_code", "schedule_arrival_time", "schedule_departure_time",
        "journey_day_number", "distance_km", "source_name")})
    return Models(spark.createDataFrame(events, schema), schedule)


def test_a_model_build_deals_running_events_once(spark, scratch):
    """Two shuffles of whole rows, one for each raw table; views are counted in the tasks that write the fact."""
    from delaylens.plans.model_build import MATERIALIZATION, materialize
    base = f"{spark.sparkContext.getCheckpointDir()}/delaylens".removeprefix("file:")
    shared = lambda: set(os.listdir(base) if os.path.isdir(base) else [])
    for n in (300, 0):
        root, m = os.path.join(scratch, str(n)), _models(spark, n)
        before = shared()
        got = {r.model: (r.materialization, r.rows) for r in materialize(spark, m, root).collect()}
        assert got == {name: (kind, getattr(m, name).count()) for name, kind in MATERIALIZATION.items()}
        fact = spark.read.schema(m.fact_station_arrival.schema).parquet(f"{root}/fact_station_arrival")
        assert sorted(map(repr, fact.collect())) == sorted(map(repr, m.fact_station_arrival.select(*fact.columns).collect()))
        assert [x.rsplit("-", 1)[0] for x in shared() - before] == ["stg_train_schedule"]
        if n:
            assert sorted(x for x in os.listdir(f"{root}/delay_features") if "=" in x) == [f"journey_date={DAY + dt.timedelta(k)}" for k in range(3)]
    rows = _models(spark, 300)
    rows.for_writing = True
    for df in (rows.fact_station_arrival, rows.stg_train_schedule):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange ") == 1
    assert "Exchange rangepartitioning(journey_date" in rows.fact_station_arrival._jdf.queryExecution().executedPlan().toString()
