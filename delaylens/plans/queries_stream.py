"""Registered queries: the Structured Streaming jobs, checked on their final tables."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from delaylens.operators.marts import FACT_COLUMNS
from delaylens.plans import load_run
from delaylens.plans.catalog import register
from delaylens.plans.oracle_views import oracle
from delaylens.plans.queries_ingest import HASHED_COLS, HASHED_SQL, SNAP_SQL
from delaylens.session import scratch_path
from delaylens.sources import fixtures
from delaylens.streaming import jobs


def _landing(spark, df, name, files, triggers):
    """The landed files, their schema, and how many of them one of ``triggers`` takes."""
    landing = jobs.land(df, scratch_path(spark, f"landing-{name}"), files)
    return landing, df.schema, jobs.per_trigger(spark, landing, triggers)


@register("stream_snapshot_archive", oracle(SNAP_SQL + "SELECT DISTINCT * FROM snap_h", "snapshot_payload"),
          "R1 S4 K1")
def q_stream_snapshot_archive(spark, sf_dir):
    landing, schema, some = _landing(spark, fixtures.load(spark, sf_dir, "snapshot_payload"), "snapshots", 8, 4)
    archive = scratch_path(spark, "snapshot_archive")
    jobs.snapshot_archive(spark, landing, archive, scratch_path(spark, "ckpt-archive"), schema, max_files=some)
    return spark.read.parquet(archive).drop("batch_id", "retrieved_date")


@register("stream_dedupe", oracle(f"SELECT DISTINCT {HASHED_SQL} FROM running_raw", "running_raw"), "R2 P14")
def q_stream_dedupe(spark, sf_dir):
    landing, schema, some = _landing(spark, fixtures.load(spark, sf_dir, "running_raw"), "dedupe", 4, 4)
    sink = scratch_path(spark, "dedupe_sink")
    jobs.late_correction_dedupe(spark, landing, sink, scratch_path(spark, "ckpt-dedupe"), schema, max_files=some)
    return spark.read.parquet(sink).select(*HASHED_COLS)


@register("stream_fact_upsert", oracle("SELECT * FROM fact", "fact"), "R3 K2 T14")
def q_stream_fact_upsert(spark, sf_dir):
    landing, schema, some = _landing(spark, fixtures.load(spark, sf_dir, "running_raw"), "upsert", 6, 3)
    fact_root = scratch_path(spark, "fact_stream")
    jobs.fact_upsert(spark, landing, scratch_path(spark, "raw_stream"), fact_root, scratch_path(spark, "stage"),
                     scratch_path(spark, "ckpt-upsert"), schema, max_files=some)
    return spark.read.parquet(fact_root).select(*FACT_COLUMNS)


@register("stream_daily_trend", oracle("""
SELECT journey_date, count(*) AS observations, round(avg(arrival_delay_minutes), 6) AS average_delay_minutes,
       round(median(arrival_delay_minutes), 6) AS median_delay_minutes
FROM observed GROUP BY journey_date""", "observed"), "R4 A7")
def q_stream_daily_trend(spark, sf_dir):
    landing, schema, some = _landing(spark, fixtures.load(spark, sf_dir, "running_raw"), "trend", 6, 3)
    out = scratch_path(spark, "daily_trend_stream")
    jobs.daily_trend_stream(spark, landing, scratch_path(spark, "raw_trend"), scratch_path(spark, "fact_trend"),
                            scratch_path(spark, "stage_trend"), out, scratch_path(spark, "ckpt-trend"), schema, max_files=some)
    return spark.read.parquet(out).select("journey_date", F.col("observations").cast("long").alias("observations"),
                                          "average_delay_minutes", "median_delay_minutes")


@register("archive_audit", oracle(SNAP_SQL + """
SELECT 4 AS runs, 1 AS failures, CAST(count_if(http_status = 200) AS BIGINT) AS received,
       CAST(count_if(http_status <> 200) AS BIGINT) AS rejected,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM snap_h)) AS inserted FROM snapshot_payload""", "snapshot_payload"), "K4 R1 T20")
def q_archive_audit(spark, sf_dir):
    """Four triggers; the second fails before it stores its rows, and is replayed when the job is
    started again."""
    landing, schema, some = _landing(spark, fixtures.load(spark, sf_dir, "snapshot_payload"), "audited-snapshots", 8, 4)
    paths = load_run.LoadPaths("", "", scratch_path(spark, "archive-audit"))
    archive, checkpoint = scratch_path(spark, "audited-archive"), scratch_path(spark, "ckpt-audited")
    failures = []

    def fail_once(batch_id: int) -> None:
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("the store is away")

    run = lambda: jobs.snapshot_archive(spark, landing, archive, checkpoint, schema, max_files=some, audit=paths, before_store=fail_once)
    try:
        run()
    except StreamingQueryException:
        run()
    events = spark.read.schema(load_run.AUDIT_SCHEMA).parquet(paths.audit_root)
    failed = events.agg(F.count_if(F.col("status") == "failed").cast("int")).scalar()
    done = load_run.read_audit(spark, paths.audit_root).where(F.col("status") == "succeeded")
    return done.agg(F.count(F.lit(1)).cast("int").alias("runs"), failed.alias("failures"),
                    F.sum("records_received").alias("received"), F.sum("records_rejected").alias("rejected"),
                    F.sum("records_inserted").alias("inserted"))
