"""Table writes (idempotent merge/upsert, incremental window), reconciliation, leakage, streaming."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from delaylens.operators import quality, tables
from delaylens.sources import fixtures
from delaylens.streaming import jobs

SMOKE = "/root/testdata/sf0.001"


def test_insert_only_merge_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1)], "source_record_hash string, v int")
    batch = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "source_record_hash string, v int")
    once = tables.merge_insert_only(target, batch)
    twice = tables.merge_insert_only(once, batch)
    assert sorted(once.collect()) == sorted(twice.collect()) and once.count() == 2


def test_upsert_replaces_whole_rows_and_is_idempotent(spark):
    keys = ["k1", "k2"]
    target = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "k1 int, k2 string, v double")
    batch = spark.createDataFrame([(2, "y", 20.0), (3, "z", 3.0)], "k1 int, k2 string, v double")
    once = tables.upsert(target, batch, keys)
    assert sorted(tuple(r) for r in once.collect()) == [(1, "x", 1.0), (2, "y", 20.0), (3, "z", 3.0)]
    assert sorted(once.collect()) == sorted(tables.upsert(once, batch, keys).collect())


def test_watermark_start(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 3, 12),), (None,)], "w timestamp_ntz")
    got = [r.s for r in df.select(tables.extraction_start(F.col("w"), 48).alias("s")).collect()]
    assert got == [dt.datetime(2025, 1, 1, 12), None]
    with pytest.raises(ValueError):
        tables.extraction_start(F.col("w"), -1)


def test_incremental_window_uses_target_max(spark):
    target = spark.createDataFrame([(dt.datetime(2025, 1, 3, 12),)], "ingested_at timestamp_ntz")
    batch = spark.createDataFrame([(dt.datetime(2025, 1, 1, 11),), (dt.datetime(2025, 1, 1, 12),)],
                                  "ingested_at timestamp_ntz")
    assert tables.incremental_window(batch, target).count() == 1
    empty = spark.createDataFrame([], "ingested_at timestamp_ntz")
    assert tables.incremental_window(batch, empty).count() == 2


def test_appended_batches_are_read_by_date(spark, scratch):
    root = os.path.join(scratch, "t")
    schema = "k int, d date"
    day = lambda n: dt.date(2024, 9, n)
    tables.append_batch(spark.createDataFrame([(1, day(1)), (2, day(2))], schema), root, "d", 0)
    for _ in range(2):  # a retry replaces its own rows only
        tables.append_batch(spark.createDataFrame([(3, day(2)), (4, day(3))], schema), root, "d", 1)
    rows = tables.read_dates(spark, root, spark.createDataFrame([], schema).schema, "d", [day(2), day(9)])
    assert sorted(r.k for r in rows.collect()) == [2, 3]
    assert all("d=2024-09-02" in f for f in rows.inputFiles())
    assert spark.read.parquet(root).count() == 4


def test_reconciliation_flags(spark):
    counts = spark.createDataFrame([(10, 7, 7, 7, 2, 1)], "source_count long, raw_count long, staging_count long, "
                                   "mart_count long, rejected_count long, duplicate_count long")
    r = quality.reconcile_counts(counts).first()
    assert r.accounted_for and r.transformations_complete
    bad = spark.createDataFrame([(10, -1, 7, 7, 2, 1)], counts.schema)
    with pytest.raises(Exception):
        quality.reconcile_counts(bad).collect()


def test_leakage_guard(spark):
    t = dt.datetime(2024, 9, 1, 10)
    df = spark.createDataFrame([(t, t), (t + dt.timedelta(seconds=1), t), (None, t)],
                               "observed timestamp_ntz, predicted timestamp_ntz")
    assert quality.leakage_violations(df, "observed", "predicted").count() == 1
    with pytest.raises(Exception):
        quality.leakage_violations(df, "observed", "predicted", strict=True).collect()
    ok = df.where("observed IS NULL OR observed <= predicted")
    assert quality.leakage_violations(ok, "observed", "predicted", strict=True).count() == 0


def test_stream_dedupe_keeps_first_seen_rows_however_late(spark, scratch):
    schema = "source_record_hash string, journey_date date"
    land = os.path.join(scratch, "land")
    day = dt.date(2024, 9, 10)
    spark.createDataFrame([("a", day), ("a", day), ("b", day)], schema).coalesce(1).write.parquet(land + "/1")
    sink, ck = os.path.join(scratch, "sink"), os.path.join(scratch, "ck")
    st = spark.createDataFrame([], schema).schema
    jobs.late_correction_dedupe(spark, land + "/*", sink, ck, st)
    # Second arrival: a repeat, a new row, a new row of a day long past.
    spark.createDataFrame([("a", day), ("c", day), ("d", day - dt.timedelta(days=30))], schema) \
        .coalesce(1).write.parquet(land + "/2")
    jobs.late_correction_dedupe(spark, land + "/*", sink, ck, st)
    got = sorted(r.source_record_hash for r in spark.read.parquet(sink).collect())
    assert got == ["a", "b", "c", "d"]


def test_fixture_running_raw_has_duplicates_and_rejects(spark):
    raw = fixtures.load(spark, SMOKE, "running_raw")
    n = raw.count()
    assert n > raw.select("source_record_hash").distinct().count()
    assert raw.where("station_sequence = 0").count() > 0


def _fact_rows(df, drop=()):
    from delaylens.operators.marts import FACT_COLUMNS
    cols = [c for c in FACT_COLUMNS if c not in drop]
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("refresh", [True, False])
def test_incremental_runs_equal_full_rebuild(spark, refresh):
    """SURVEY 7.4: loads applied in ingestion order, each an incremental run + upsert, end
    equal to a full rebuild; the default may differ only in the previous-stop delay."""
    from delaylens.plans.model_build import Models, incremental_fact_batch, raw_running_from_fixture
    raw = tables.materialized(raw_running_from_fixture(spark, SMOKE), "t")
    cuts = ["1995-06-01", "1997-01-01", "1998-06-01", "2100-01-01"]
    loaded = raw.where(F.col("ingested_at") < F.lit(cuts[0]).cast("timestamp_ntz"))
    target = tables.materialized(Models(loaded).fact_station_arrival, "t")
    for cut in cuts[1:]:
        loaded = raw.where(F.col("ingested_at") < F.lit(cut).cast("timestamp_ntz"))
        batch = incremental_fact_batch(loaded, target, refresh_journeys=refresh)
        keys = ["train_number", "journey_date", "station_code", "station_sequence"]
        target = tables.materialized(tables.upsert(target, batch, keys), "t")
    full = Models(raw).fact_station_arrival
    drop = () if refresh else ("previous_station_arrival_delay_minutes",)
    assert _fact_rows(target, drop) == _fact_rows(full, drop)


def test_watchlist_range_check_and_scale_conf(spark):
    from delaylens.operators import kpi
    from delaylens.session import scale_conf
    fact = spark.createDataFrame([("1", dt.date(2024, 9, 1))], "train_number string, journey_date date")
    with pytest.raises(ValueError):
        kpi.watchlist_top_k(fact, "2024-10-01", "2024-09-01")
    conf = scale_conf(100 * 1024 ** 4, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600


def test_checks_find_violations(spark):
    t = dt.datetime(2024, 9, 1)
    rows = spark.createDataFrame([("1", 1, t, t), (None, 0, t, None), ("2", -1, None, None)],
                                 "k string, station_sequence int, actual_arrival_at timestamp, scheduled_arrival_at timestamp")
    assert quality.not_null_failures(rows, "m", ["k"]).first().failed_count == 1
    assert quality.actual_without_schedule(rows).count() == 1 and quality.nonpositive_sequence(rows).count() == 2


def test_fact_has_one_exchange_and_medians_no_percentile(spark):
    from delaylens.plans.model_build import from_fixtures
    m = from_fixtures(spark, SMOKE)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(m.fact_station_arrival).count("Exchange hashpartitioning") == 1
    for df in (m.mart_station_delay, m.mart_train_punctuality):
        assert "percentile(" not in plan(df) and " median(" not in plan(df)


def test_previous_stop_median_of_even_and_odd_counts(spark):
    from delaylens.operators.marts import delay_summary
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 9.0), ("b", 5.0), ("b", 7.0), ("b", 8.0), ("c", 3.0), ("c", 6.0)],
                                 "k string, arrival_delay_minutes double")
    assert {r.k: r.median for r in delay_summary(rows, "k").collect()} == {"a": 2.0, "b": 7.0, "c": 4.5}
