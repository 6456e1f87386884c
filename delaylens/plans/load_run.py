"""Historical load job (the CSV -> raw load) with quarantine, idempotent merge and run audit.

Graph: delay + route CSV (S2, S3, S9) -> stop-sequence lookup (J1) -> rule check (P6)
materialized once -> content hash (P7) -> quarantine JSON lines (K3) | accepted rows, one per hash
(W4) -> insert-only append to the raw table (K1) -> counters (A10) -> run audit (K4). The delay rows
are dealt once, by train; every table of the run lies in buckets of it.

Rows are counted in the passes that write them (``Observation``, in the task that writes, so a
repeated task counts once); stored keys are compared through ``operators.history`` (J2).

Raw table layout: ``<raw_root>/run_id=<id>/`` holds the rows a run inserted. A run's rows
become visible only when its audit status is ``succeeded`` (readers semi-join on the audit),
so a failed or re-tried run never exposes half-written rows and a daily load appends without
rewriting the table. Source time strings are kept as strings, never turned into timestamps
(P20).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.functions import expressions as E
from delaylens.operators import history, ingest, tables
from delaylens.session import scratch_path
from delaylens.sources import files

PIPELINE_NAME = "delaylens"
DATASET = "train_running_events"
# Canonical columns of a loaded delay record, sorted by name, hashed for idempotency.
LOAD_HASH_COLUMNS = sorted(["train_number", "journey_date_text", "station_code", "station_sequence",
                            "arrival_delay_minutes", "departure_delay_minutes", "status", "source_name",
                            "source_scheduled_arrival_time", "source_actual_arrival_time",
                            "source_scheduled_departure_time", "source_actual_departure_time"])

AUDIT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("pipeline_name", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("event_at", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("records_received", T.LongType()),
    T.StructField("records_valid", T.LongType()),
    T.StructField("records_rejected", T.LongType()),
    T.StructField("records_distinct_valid", T.LongType()),
    T.StructField("records_inserted", T.LongType()),
    T.StructField("records_already_present", T.LongType()),
    T.StructField("error_message", T.StringType()),
])


@dataclass(frozen=True)
class LoadPaths:
    raw_root: str
    quarantine_root: str
    audit_root: str

    @property
    def keys(self) -> history.KeyHistory:
        """The stored keys of the raw table."""
        return history.KeyHistory(f"{self.raw_root.rstrip('/')}_keys", within="train_number")


# --------------------------------------------------------------------------- K4 audit
def audit_event(spark: SparkSession, paths: LoadPaths, run_id: str, source_name: str, status: str,
                counters: dict | None = None, error: str | None = None, dataset: str = DATASET) -> None:
    """Append one status event for a run (append-only; latest event per run wins on read)."""
    c = counters or {}
    row = (run_id, PIPELINE_NAME, dataset, source_name, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
           status, c.get("received"), c.get("valid"), c.get("rejected"), c.get("distinct_valid"),
           c.get("inserted"), c.get("already_present"), error)
    spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(paths.audit_root)


def read_audit(spark: SparkSession, audit_root: str) -> DataFrame:
    """Latest status event per run, with its start time (first event)."""
    ev = spark.read.schema(AUDIT_SCHEMA).parquet(audit_root)
    return ev.groupBy("run_id").agg(
        F.min("event_at").alias("started_at"),
        F.max("event_at").alias("completed_at"),
        F.max_by(F.struct(*[c for c in AUDIT_SCHEMA.fieldNames() if c not in ("run_id", "event_at")]),
                 "event_at").alias("last"),
    ).select("run_id", "started_at", "completed_at", "last.*")


def read_raw(spark: SparkSession, paths: LoadPaths, schema: T.StructType) -> DataFrame:
    """Raw rows of succeeded runs only."""
    if not _exists(spark, paths.raw_root):
        return spark.createDataFrame([], schema)
    ok = read_audit(spark, paths.audit_root).where(F.col("status") == "succeeded").select("run_id")
    raw = spark.read.schema(T.StructType(schema.fields + [T.StructField("run_id", T.StringType())])) \
                    .parquet(paths.raw_root)
    return raw.join(ok, "run_id", "left_semi").drop("run_id")


def succeeded_runs(spark: SparkSession, audit_root: str) -> DataFrame:
    return read_audit(spark, audit_root).where(F.col("status") == "succeeded").select("run_id")


def counts(seen: Observation, *names: str) -> dict:
    """What a write has counted; a plan without rows may count nothing at all."""
    return {n: 0 for n in names} | {k: v or 0 for k, v in seen.get.items()}


def _checked_counts() -> list:
    return [F.count(F.lit(1)).alias("received"), F.count_if("rules_ok").alias("valid"), F.count_if(~F.col("rules_ok")).alias("rejected")]


_NO_ROWS = {"received": 0, "valid": 0, "rejected": 0, "distinct_valid": 0, "already_present": 0}


_exists = tables.path_exists


# --------------------------------------------------------------------------- the job
def prepare(delays: DataFrame, routes: DataFrame, source_name: str, deal_to: int | None = None) -> DataFrame:
    """J1 + P6: canonical records with the failed-rule array."""
    return ingest.with_rule_check(ingest.attach_stop_sequence(delays, routes, source_name, deal_to), date_is_text=True)


def hashed(records: DataFrame) -> DataFrame:
    """Canonical records with their hash. Half of a record's bytes, it is made where it is needed."""
    return records.withColumn("source_record_hash", E.record_hash(*LOAD_HASH_COLUMNS))


def historical_load(spark: SparkSession, delay_path: str, route_path: str, paths: LoadPaths,
                    source_name: str = "delay_csv_feed", run_id: str | None = None,
                    delay_glob: str | None = None, route_glob: str | None = None) -> dict:
    """Run one load; returns the counters (one small row brought to the driver).

    With a glob the path is a directory that holds exactly one such file (S9). Rows with a wrong number
    of fields are rejected with their raw line; a route row of that kind is no lookup row and goes to
    quarantine as well, but isn't counted.
    """
    run_id = run_id or str(uuid.uuid4())
    audit_event(spark, paths, run_id, source_name, "running")
    counters = None  # whatever a failed run has counted is kept
    try:
        delay_path = files.find_single_file(spark, delay_path, delay_glob) if delay_glob else delay_path
        route_path = files.find_single_file(spark, route_path, route_glob) if route_glob else route_path
        delays = files.read_delay_csv(spark, delay_path, files.MALFORMED)
        routes = files.read_route_csv(spark, route_path, files.MALFORMED)
        good_routes = routes.where(F.col(files.MALFORMED).isNull()).drop(files.MALFORMED)
        # Materialized once in the shared checkpoint folder: quarantine and accepted rows read it, and
        # the CSVs are parsed and joined a single time. The rows are dealt by train, once: look-up, hash
        # and stored keys name it, so all that follows works where they lie.
        seen, buckets = Observation(), paths.keys.table.buckets(spark)
        prepared = prepare(delays, good_routes, source_name, buckets).observe(seen, *_checked_counts())
        table = tables.Bucketed(scratch_path(spark, "load-checked"), prepared.schema, ingest.DEAL, ("rules_ok",))
        table.store(prepared, buckets)
        counters = _NO_ROWS | counts(seen)
        checked = hashed(table.read(spark))

        bad_routes = routes.where(F.col(files.MALFORMED).isNotNull()).withColumn("errors", F.array(F.lit(files.FIELD_COUNT)))
        rejected = ingest.quarantine_records(checked.where(~F.col("rules_ok")).drop(ingest.DEAL)).unionByName(
            ingest.quarantine_records(bad_routes, [files.MALFORMED]), allowMissingColumns=True)
        rejected.write.mode("overwrite").option("compression", "gzip").json(f"{paths.quarantine_root}/run_id={run_id}")

        accepted = ingest.normalize_accepted(checked.where(F.col("rules_ok")).drop("errors", "rules_ok", files.MALFORMED)) \
                         .drop("arrival_delay_not_a_number", "departure_delay_not_a_number") \
                         .withColumn("train_number", F.col(ingest.DEAL)).drop(ingest.DEAL)  # equal for accepted rows
        # The hash covers the journey date: only the stored keys of this load's dates are read. Rows
        # are counted behind the last exchange, in the task that writes them.
        days = tables.dates(accepted, "journey_date")
        runs = F.broadcast(succeeded_runs(spark, paths.audit_root))  # a row per load
        known = history.flagged(ingest.dedupe_by_hash(accepted, within="train_number"), paths.keys, days, runs)
        stored = Observation()
        rows = known.observe(stored, F.count(F.lit(1)).alias("distinct_valid"), F.count_if("present").alias("already_present"))
        new = rows.where(~F.col("present")).drop("present")
        target = tables.Bucketed(f"{paths.raw_root}/run_id={run_id}", new.schema, "train_number", ("journey_date",))
        tables.remove_folder(spark, target.root)  # of an earlier attempt
        target.store(new, buckets)
        counters |= counts(stored)
        counters["inserted"] = counters["distinct_valid"] - counters["already_present"]
        if counters["inserted"]:
            history.append(target.read(spark), paths.keys, run_id)
        audit_event(spark, paths, run_id, source_name, "succeeded", counters)
        return {"run_id": run_id, **counters}
    except Exception as exc:  # noqa: BLE001 - recorded, then re-raised
        audit_event(spark, paths, run_id, source_name, "failed", counters=counters, error=str(exc))
        raise


# --------------------------------------------------------------------------- schedule load
SCHEDULE_DATASET = "train_schedule_stops"
SCHEDULE_HASH_COLUMNS = sorted(["train_number", "train_name", "station_code", "station_name", "station_sequence",
                                "schedule_arrival_time", "schedule_departure_time", "distance_km", "source_name"])


def schedule_stops(routes: DataFrame, source_name: str) -> DataFrame:
    """Route CSV rows -> typed schedule stops with their hash (T10: the content alone, not the load
    time). ``errors`` names what is wrong: a train, a station and a positive sequence are needed, a
    distance must be a number, and a row of a wrong number of fields is judged by that alone."""
    sequence = E.sequence_from_text("stnSerialNumber")
    typed = routes.select(
        E.normalize_key("trainNumber").alias("train_number"), E.blank_to_null("trainName").alias("train_name"),
        F.lit(None).cast("string").alias("train_type"), F.lit(None).cast("string").alias("source_station_code"),
        F.lit(None).cast("string").alias("destination_station_code"),
        E.normalize_key("station_code").alias("station_code"), E.blank_to_null("station_name").alias("station_name"),
        sequence.alias("station_sequence"), E.blank_to_null("arrivalTime").alias("schedule_arrival_time"),
        E.blank_to_null("departureTime").alias("schedule_departure_time"),
        F.lit(None).cast("int").alias("journey_day_number"), E.optional_number("distance").alias("distance_km"),
        F.lit(source_name).alias("source_name"), E.not_a_number("distance").alias("distance_not_a_number"),
        F.col("stnSerialNumber").alias("source_sequence_text"), F.col("distance").alias("source_distance_text"),
        *[c for c in (files.MALFORMED,) if c in routes.columns])
    faults = [("train_number_missing", F.col("train_number") == ""), ("station_code_missing", F.col("station_code") == ""),
              ("station_sequence_not_positive", ~F.coalesce(F.col("station_sequence") > 0, F.lit(False))),
              ("distance_not_a_number", F.col("distance_not_a_number"))]
    errors = F.array_compact(F.array(*[F.when(cond, F.lit(code)) for code, cond in faults]))
    if files.MALFORMED in routes.columns:
        errors = F.when(F.col(files.MALFORMED).isNull(), errors).otherwise(F.array(F.lit(files.FIELD_COUNT)))
    return typed.withColumn("source_record_hash", E.record_hash(*SCHEDULE_HASH_COLUMNS)).withColumn("errors", errors) \
        .withColumn("rules_ok", F.size("errors") == 0)


#: Columns of the check alone, not of a schedule stop.
_SCHEDULE_CHECK = ("errors", "rules_ok", "distance_not_a_number", "source_sequence_text", "source_distance_text", files.MALFORMED)


def schedule_load(spark: SparkSession, route_path: str, paths: LoadPaths, source_name: str = "route_csv_feed",
                  run_id: str | None = None, route_glob: str | None = None) -> dict:
    """Route CSV -> schedule table: insert-only by hash, quarantine with reasons and the texts as they
    came, audit. Returns the counters. With a glob the path is a directory of exactly one such file."""
    run_id = run_id or str(uuid.uuid4())
    audit_event(spark, paths, run_id, source_name, "running", dataset=SCHEDULE_DATASET)
    counters = None
    try:
        route_path = files.find_single_file(spark, route_path, route_glob) if route_glob else route_path
        routes = files.read_route_csv(spark, route_path, files.MALFORMED)
        checked = tables.materialized(schedule_stops(routes, source_name), "schedule-checked")
        ingest.quarantine_records(checked.where(~F.col("rules_ok"))).write.mode("overwrite") \
            .json(f"{paths.quarantine_root}/run_id={run_id}")
        loaded_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        accepted = checked.where("rules_ok").drop(*_SCHEDULE_CHECK).withColumn("ingested_at", F.lit(loaded_at).cast("timestamp_ntz"))
        target = read_raw(spark, paths, accepted.schema)
        counters = ingest.load_counters(checked, target).first().asDict()
        tables.insert_only(target, accepted).write.mode("overwrite").parquet(f"{paths.raw_root}/run_id={run_id}")
        audit_event(spark, paths, run_id, source_name, "succeeded", counters, dataset=SCHEDULE_DATASET)
        return {"run_id": run_id, **counters}
    except Exception as exc:  # noqa: BLE001 - recorded, then re-raised
        audit_event(spark, paths, run_id, source_name, "failed", counters, str(exc), SCHEDULE_DATASET)
        raise


# Microsecond timestamps in exported JSON (the default format keeps milliseconds only).
JSON_TIME_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                     "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def export_snapshot(df: DataFrame, path: str) -> str:
    """K7: a small aggregate (e.g. the network overview) exported as one JSON document."""
    df.coalesce(1).write.mode("overwrite").options(**JSON_TIME_OPTIONS).json(path)
    return path


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**JSON_TIME_OPTIONS).json(path)
