"""Registered queries: sources, key clean-up, validation, lookup, hashing, loads and table writes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.functions import expressions as E
from delaylens.operators import ingest, kpi, tables
from delaylens.plans.catalog import register
from delaylens.plans.model_build import Models, raw_running_from_fixture
from delaylens.plans.oracle_views import oracle
from delaylens.session import scratch_path
from delaylens.sources import files, fixtures, payloads, provenance

# Scenario parameter: the previous load holds the rows ingested before this instant.
PREVIOUS_LOAD_CUTOFF = "1998-01-01 00:00:00"
CSV_SOURCE = "synthetic_csv"
HASHED_COLS = ["train_number", "journey_date", "station_code", "station_sequence", "arrival_delay_minutes",
               "departure_delay_minutes", "status", "source_record_hash"]
HASHED_SQL = ", ".join(HASHED_COLS)


def hash_sql(values: list[str]) -> str:
    """P7 in DuckDB: every value as length:text, nulls as a dash."""
    texts = [f"CAST({v} AS VARCHAR)" for v in values]
    return "sha256(concat(" + ", ".join(f"coalesce(length({t}) || ':' || {t}, '-')" for t in texts) + "))"



# ----------------------------------------------------------------------- CSV scans
GENERIC_CSV_SQL = """
SELECT train_number, CAST(journey_date AS STRING) AS journey_date,
       CASE WHEN l_orderkey % 10 = 0 THEN lower(station_code) ELSE station_code END AS station_code,
       CAST(station_sequence AS STRING) AS station_sequence,
       CAST(CAST(arrival_delay_minutes AS BIGINT) AS STRING) AS arrival_delay_minutes,
       CAST(CAST(departure_delay_minutes AS BIGINT) AS STRING) AS departure_delay_minutes,
       status
FROM running_raw"""


def _generic_csv_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixtures.load(spark, sf_dir, "running_raw")
    return raw.select(
        "train_number", F.col("journey_date").cast("string").alias("journey_date"),
        F.when(F.col("l_orderkey") % 10 == 0, F.lower("station_code")).otherwise(F.col("station_code"))
         .alias("station_code"),
        F.col("station_sequence").cast("string").alias("station_sequence"),
        F.col("arrival_delay_minutes").cast("bigint").cast("string").alias("arrival_delay_minutes"),
        F.col("departure_delay_minutes").cast("bigint").cast("string").alias("departure_delay_minutes"),
        "status",
    )


def _written_csv(spark: SparkSession, df: DataFrame, name: str) -> str:
    return files.write_csv(df, scratch_path(spark, name))


@register("scan_event_csv", oracle(f"SELECT *, '{CSV_SOURCE}' AS source_name FROM ({GENERIC_CSV_SQL}) g",
                                   "running_raw"), "S1 S8")
def q_scan_event_csv(spark, sf_dir):
    path = _written_csv(spark, _generic_csv_frame(spark, sf_dir), "event_csv")
    return files.read_event_csv(spark, path, CSV_SOURCE).select(
        *files.EVENT_REQUIRED, "arrival_delay_minutes", "departure_delay_minutes", "status", "source_name")


@register("preflight", oracle(f"""
, g AS (SELECT DISTINCT *, '{CSV_SOURCE}' AS source_name FROM ({GENERIC_CSV_SQL}) x),
t AS (SELECT *, TRY_CAST(arrival_delay_minutes AS DOUBLE) AS a, TRY_CAST(departure_delay_minutes AS DOUBLE) AS d,
             CAST(trunc(TRY_CAST(station_sequence AS DOUBLE)) AS INTEGER) AS s FROM g),
v AS (SELECT NOT ((train_number IS NULL OR length(trim(train_number)) NOT BETWEEN 1 AND 16)
             OR (journey_date IS NULL OR NOT regexp_matches(trim(journey_date), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
                 OR TRY_CAST(trim(journey_date) AS DATE) IS NULL)
             OR (station_code IS NULL OR length(trim(station_code)) NOT BETWEEN 1 AND 16)
             OR (s IS NULL OR s <= 0)
             OR (a IS NOT NULL AND NOT (a BETWEEN -1440 AND 10080))
             OR (d IS NOT NULL AND NOT (d BETWEEN -1440 AND 10080))
             OR (arrival_delay_minutes IS NOT NULL AND a IS NULL)
             OR (departure_delay_minutes IS NOT NULL AND d IS NULL)) AS ok FROM t)
SELECT CAST(count_if(ok) AS BIGINT) AS accepted_count, CAST(count_if(NOT ok) AS BIGINT) AS rejected_count FROM v
""", "running_raw"), "S1 P6 O5 T26")
def q_preflight(spark, sf_dir):
    path = _written_csv(spark, _generic_csv_frame(spark, sf_dir), "preflight_csv")
    raw = files.read_event_csv(spark, path, CSV_SOURCE)
    # The content hash is taken on the raw record, so exact duplicates go before validation.
    hashed = raw.withColumn("source_record_hash", E.record_hash(*sorted(raw.columns)))
    return ingest.preflight_counts(files.events_from_generic_csv(hashed), date_is_text=True)


DELAY_CSV_NULLIF = """
SELECT NULLIF(train, '') AS train, NULLIF(date, '') AS date, NULLIF(station, '') AS station,
       NULLIF(sch_arr, '') AS sch_arr, NULLIF(act_arr, '') AS act_arr, NULLIF(arr_delay, '') AS arr_delay,
       NULLIF(sch_dep, '') AS sch_dep, NULLIF(act_dep, '') AS act_dep, NULLIF(dep_delay, '') AS dep_delay
FROM delay_csv"""


@register("scan_delay_csv", oracle(DELAY_CSV_NULLIF, "delay_csv"), "S2 T24")
def q_scan_delay_csv(spark, sf_dir):
    path = _written_csv(spark, fixtures.load(spark, sf_dir, "delay_csv"), "delay_csv")
    return files.read_delay_csv(spark, path)


@register("scan_route_csv", oracle("""
SELECT NULLIF(stnSerialNumber, '') AS stnSerialNumber, NULLIF(trainNumber, '') AS trainNumber,
       NULLIF(station_code, '') AS station_code, CAST(NULL AS VARCHAR) AS trainName,
       NULLIF(station_name, '') AS station_name, CAST(NULL AS VARCHAR) AS arrivalTime,
       CAST(NULL AS VARCHAR) AS departureTime, NULLIF(distance, '') AS distance
FROM route_csv""", "route_csv"), "S3")
def q_scan_route_csv(spark, sf_dir):
    path = _written_csv(spark, fixtures.load(spark, sf_dir, "route_csv"), "route_csv")
    return files.read_route_csv(spark, path)


@register("scan_baseline_csv", oracle("""
SELECT journey_date, upper(train_number) AS train_number, upper(station_code) AS station_code,
       arrival_delay_minutes
FROM fact WHERE arrival_delay_minutes IS NOT NULL""", "fact"), "S7")
def q_scan_baseline_csv(spark, sf_dir):
    fact = Models(raw_running_from_fixture(spark, sf_dir)).fact_station_arrival
    # The file is written the way an export would look: lower-case codes, blank delays kept.
    export = fact.select(
        F.col("journey_date").cast("string").alias("journey_date"),
        F.lower("train_number").alias("train_number"),
        F.lower("station_code").alias("station_code"),
        F.col("arrival_delay_minutes").cast("string").alias("arrival_delay_minutes"),
    )
    path = _written_csv(spark, export, "baseline_csv")
    return files.read_baseline_csv(spark, path)


# ----------------------------------------------------------------------- key clean-up
@register("normalize_key", oracle(r"""
SELECT train, station,
       regexp_replace(upper(trim(coalesce(train, ''))), '\.0$', '') AS train_number,
       regexp_replace(upper(trim(coalesce(station, ''))), '\.0$', '') AS station_code
FROM delay_csv""", "delay_csv"), "P1 P2 P3")
def q_normalize_key(spark, sf_dir):
    d = fixtures.load(spark, sf_dir, "delay_csv")
    return d.select("train", "station", E.normalize_key("train").alias("train_number"),
                    E.normalize_key("station").alias("station_code"))


@register("optional_number", oracle("""
SELECT arr_delay, sch_arr,
       TRY_CAST(NULLIF(trim(arr_delay), '') AS DOUBLE) AS arrival_delay_minutes,
       TRY_CAST(NULLIF(trim(dep_delay), '') AS DOUBLE) AS departure_delay_minutes,
       TRY_CAST(NULLIF(trim(sch_arr), '') AS DOUBLE) AS scheduled_arrival_number,
       (NULLIF(trim(sch_arr), '') IS NOT NULL AND TRY_CAST(NULLIF(trim(sch_arr), '') AS DOUBLE) IS NULL)
           AS scheduled_arrival_not_a_number
FROM delay_csv""", "delay_csv"), "P4 P3 T18")
def q_optional_number(spark, sf_dir):
    d = fixtures.load(spark, sf_dir, "delay_csv")
    return d.select("arr_delay", "sch_arr",
                    E.optional_number("arr_delay").alias("arrival_delay_minutes"),
                    E.optional_number("dep_delay").alias("departure_delay_minutes"),
                    E.optional_number("sch_arr").alias("scheduled_arrival_number"),
                    E.not_a_number("sch_arr").alias("scheduled_arrival_not_a_number"))


@register("valid_train_numbers", oracle("""
SELECT DISTINCT trim(train) AS train_number FROM delay_csv
WHERE regexp_matches(trim(train), '^[0-9]{5}$')""", "delay_csv"), "P16")
def q_valid_train_numbers(spark, sf_dir):
    return ingest.train_numbers(fixtures.load(spark, sf_dir, "delay_csv"), "train")[0]


@register("invalid_train_numbers", oracle("""
SELECT DISTINCT trim(train) AS train_number FROM delay_csv
WHERE NOT regexp_matches(trim(train), '^[0-9]{5}$')""", "delay_csv"), "P16")
def q_invalid_train_numbers(spark, sf_dir):
    return ingest.train_numbers(fixtures.load(spark, sf_dir, "delay_csv"), "train")[1]


# ----------------------------------------------------------------------- stop-sequence lookup
LOOKUP_SQL = r"""
, route_norm AS (
  SELECT regexp_replace(upper(trim(coalesce(trainNumber, ''))), '\.0$', '') AS train_key,
         CAST(trunc(TRY_CAST(NULLIF(trim(stnSerialNumber), '') AS DOUBLE)) AS INTEGER) AS station_sequence,
         regexp_replace(upper(trim(coalesce(station_code, ''))), '\.0$', '') AS code_key,
         regexp_replace(upper(trim(coalesce(station_name, ''))), '\.0$', '') AS name_key
  FROM route_csv),
route_keys AS (
  SELECT train_key, code_key AS station_key, 0 AS match_rank, station_sequence FROM route_norm
  WHERE train_key <> '' AND station_sequence IS NOT NULL AND code_key <> ''
  UNION ALL
  SELECT train_key, name_key, 1, station_sequence FROM route_norm
  WHERE train_key <> '' AND station_sequence IS NOT NULL AND name_key <> ''),
lookup AS (
  SELECT train_key, station_key, station_sequence FROM (
    SELECT *, row_number() OVER (PARTITION BY train_key, station_key ORDER BY match_rank, station_sequence) AS rn
    FROM route_keys) x WHERE rn = 1),
delays AS (
  SELECT regexp_replace(upper(trim(coalesce(train, ''))), '\.0$', '') AS train_number,
         trim(date) AS journey_date_text,
         regexp_replace(upper(trim(coalesce(station, ''))), '\.0$', '') AS station_code,
         TRY_CAST(NULLIF(trim(arr_delay), '') AS DOUBLE) AS arrival_delay_minutes,
         TRY_CAST(NULLIF(trim(dep_delay), '') AS DOUBLE) AS departure_delay_minutes,
         NULLIF(trim(sch_arr), '') AS source_scheduled_arrival_time,
         NULLIF(trim(act_arr), '') AS source_actual_arrival_time,
         NULLIF(trim(sch_dep), '') AS source_scheduled_departure_time,
         NULLIF(trim(act_dep), '') AS source_actual_departure_time
  FROM delay_csv),
attached AS (
  SELECT d.*, coalesce(l.station_sequence, 0) AS station_sequence
  FROM delays d LEFT JOIN lookup l ON d.train_number = l.train_key AND d.station_code = l.station_key)
"""


@register("route_sequence_lookup", oracle(LOOKUP_SQL + """
SELECT train_number, journey_date_text, station_code, station_sequence, arrival_delay_minutes,
       departure_delay_minutes FROM attached""", "delay_csv", "route_csv", replace={"route_csv": "route_gaps"}), "J1 P1 P5 T7")
def q_route_sequence_lookup(spark, sf_dir):
    a = ingest.attach_stop_sequence(fixtures.load(spark, sf_dir, "delay_csv"),
                                    fixtures.load(spark, sf_dir, "route_gaps"))
    return a.select("train_number", "journey_date_text", "station_code", "station_sequence",
                    "arrival_delay_minutes", "departure_delay_minutes")


LOAD_HASH_COLS = sorted(["train_number", "journey_date_text", "station_code", "station_sequence",
                         "arrival_delay_minutes", "departure_delay_minutes", "status", "source_name",
                         "source_scheduled_arrival_time", "source_actual_arrival_time",
                         "source_scheduled_departure_time", "source_actual_departure_time"])


def _load_hash_sql() -> str:
    extra = {"status": "'observed'", "source_name": "'delay_csv_feed'"}
    return hash_sql([extra.get(c, c) for c in LOAD_HASH_COLS])


@register("quarantine_rows", oracle(LOOKUP_SQL + f"""
, hashed AS (SELECT *, {_load_hash_sql()} AS source_record_hash FROM attached)
SELECT train_number, journey_date_text, station_code, station_sequence, source_record_hash,
       concat_ws(',',
         CASE WHEN length(train_number) NOT BETWEEN 1 AND 16 THEN 'train_number_length' END,
         CASE WHEN journey_date_text IS NULL OR NOT regexp_matches(journey_date_text, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
                   OR TRY_CAST(journey_date_text AS DATE) IS NULL THEN 'journey_date_invalid' END,
         CASE WHEN length(station_code) NOT BETWEEN 1 AND 16 THEN 'station_code_length' END,
         CASE WHEN station_sequence <= 0 THEN 'station_sequence_not_positive' END,
         CASE WHEN arrival_delay_minutes IS NOT NULL AND NOT (arrival_delay_minutes BETWEEN -1440 AND 10080)
              THEN 'arrival_delay_out_of_range' END,
         CASE WHEN departure_delay_minutes IS NOT NULL AND NOT (departure_delay_minutes BETWEEN -1440 AND 10080)
              THEN 'departure_delay_out_of_range' END) AS error_codes
FROM hashed
WHERE length(train_number) NOT BETWEEN 1 AND 16 OR length(station_code) NOT BETWEEN 1 AND 16
   OR station_sequence <= 0 OR journey_date_text IS NULL
   OR NOT regexp_matches(journey_date_text, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
   OR TRY_CAST(journey_date_text AS DATE) IS NULL
   OR (arrival_delay_minutes IS NOT NULL AND NOT (arrival_delay_minutes BETWEEN -1440 AND 10080))
   OR (departure_delay_minutes IS NOT NULL AND NOT (departure_delay_minutes BETWEEN -1440 AND 10080))
""", "delay_csv", "route_csv", replace={"route_csv": "route_gaps"}), "K3 P6 J1")
def q_quarantine_rows(spark, sf_dir):
    a = ingest.attach_stop_sequence(fixtures.load(spark, sf_dir, "delay_csv"),
                                    fixtures.load(spark, sf_dir, "route_gaps"))
    a = a.withColumn("source_record_hash", E.record_hash(*LOAD_HASH_COLS))
    _accepted, rejected = ingest.validate(a, date_is_text=True)
    q = ingest.quarantine_records(rejected)
    return q.select("train_number", "journey_date_text", "station_code", "station_sequence",
                    "source_record_hash", "error_codes")


# ----------------------------------------------------------------------- validation (P6), hash
@register("validate_accepted", oracle("SELECT * FROM running_accepted", "running_accepted"), "P6 P2")
def q_validate_accepted(spark, sf_dir):
    return raw_running_from_fixture(spark, sf_dir)


@register("validate_rejected", oracle("""
SELECT train_number, journey_date, station_code, station_sequence, arrival_delay_minutes,
       departure_delay_minutes, source_record_hash, error_codes FROM running_rejected""", "running_rejected"),
          "P6 K3")
def q_validate_rejected(spark, sf_dir):
    _a, rejected = ingest.validate(fixtures.load(spark, sf_dir, "running_raw"))
    return rejected.select("train_number", "journey_date", "station_code", "station_sequence",
                           "arrival_delay_minutes", "departure_delay_minutes", "source_record_hash",
                           F.concat_ws(",", "errors").alias("error_codes"))


EVENT_HASH_PRESENT = ["actual_arrival_at", "arrival_delay_minutes", "departure_delay_minutes", "journey_date",
                      "scheduled_arrival_at", "source_name", "station_code", "station_sequence", "status",
                      "train_number"]


@register("record_hash", oracle(
    "SELECT train_number, journey_date, station_code, station_sequence, "
    + hash_sql([c if c in EVENT_HASH_PRESENT else "NULL" for c in ingest.CANONICAL_EVENT_COLUMNS])
    + " AS content_hash FROM running_accepted", "running_accepted"), "P7 T6 T12")
def q_record_hash(spark, sf_dir):
    acc = raw_running_from_fixture(spark, sf_dir)
    cols = [F.col(c) if c in acc.columns else F.lit(None) for c in ingest.CANONICAL_EVENT_COLUMNS]
    return acc.select("train_number", "journey_date", "station_code", "station_sequence",
                      E.record_hash(*cols).alias("content_hash"))


@register("exact_dedupe", oracle(f"SELECT DISTINCT {HASHED_SQL} FROM running_raw", "running_raw"), "O5")
def q_exact_dedupe(spark, sf_dir):
    return ingest.exact_dedupe(fixtures.load(spark, sf_dir, "running_raw")).select(*HASHED_COLS)


@register("dedupe_by_hash", oracle(f"""
SELECT {HASHED_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY source_record_hash
                               ORDER BY train_number, journey_date, station_sequence) AS rn
  FROM running_accepted) x WHERE rn = 1""", "running_accepted"), "W4")
def q_dedupe_by_hash(spark, sf_dir):
    return ingest.dedupe_by_hash(raw_running_from_fixture(spark, sf_dir)).select(*HASHED_COLS)


# ----------------------------------------------------------------------- loads
def _previous_load(accepted: DataFrame) -> DataFrame:
    return ingest.exact_dedupe(accepted.where(F.col("ingested_at") < F.lit(PREVIOUS_LOAD_CUTOFF).cast("timestamp_ntz")))


PREV_SQL = f"""
, prev AS (SELECT DISTINCT {HASHED_SQL} FROM running_accepted
           WHERE ingested_at < TIMESTAMP '{PREVIOUS_LOAD_CUTOFF}')"""


@register("load_counters", oracle(PREV_SQL + """
, dv AS (SELECT DISTINCT source_record_hash FROM running_accepted)
SELECT (SELECT count(*) FROM running_raw) AS received,
       (SELECT count(*) FROM running_accepted) AS valid,
       (SELECT count(*) FROM running_rejected) AS rejected,
       (SELECT count(*) FROM dv) AS distinct_valid,
       (SELECT count(*) FROM dv WHERE source_record_hash NOT IN (SELECT source_record_hash FROM prev)) AS inserted,
       (SELECT count(*) FROM dv WHERE source_record_hash IN (SELECT source_record_hash FROM prev)) AS already_present
""", "running_raw", "running_accepted", "running_rejected"), "A10 J2 T26")
def q_load_counters(spark, sf_dir):
    raw = fixtures.load(spark, sf_dir, "running_raw")
    checked = ingest.with_rule_check(raw)
    target = _previous_load(raw_running_from_fixture(spark, sf_dir))
    return ingest.load_counters(checked, target)


def _merged_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = raw_running_from_fixture(spark, sf_dir).select(*HASHED_COLS, "ingested_at")
    root = scratch_path(spark, "raw_running_events")
    cutoff = F.lit(PREVIOUS_LOAD_CUTOFF).cast("timestamp_ntz")
    days = tables.dates(accepted, "journey_date")
    tables.append_new(None, accepted.where(F.col("ingested_at") < cutoff), root, "journey_date", 0)  # the previous load
    present = tables.read_dates(spark, root, accepted.schema, "journey_date", days)
    tables.append_new(present, accepted, root, "journey_date", 1)
    return spark.read.parquet(root).select(*HASHED_COLS)


@register("merge_insert_only", oracle(PREV_SQL + f"""
SELECT * FROM prev
UNION ALL
SELECT {HASHED_SQL} FROM (SELECT DISTINCT {HASHED_SQL} FROM running_accepted) b
WHERE source_record_hash NOT IN (SELECT source_record_hash FROM prev)""", "running_accepted"), "K1 J3 K5")
def q_merge_insert_only(spark, sf_dir):
    return _merged_raw(spark, sf_dir)


@register("reconcile_raw", oracle(f"""
, raw AS (SELECT DISTINCT {HASHED_SQL} FROM running_accepted)
SELECT count(*) AS raw_rows, count(DISTINCT source_record_hash) AS distinct_hashes,
       min(journey_date) AS first_journey_date, max(journey_date) AS last_journey_date,
       count(*) = count(DISTINCT source_record_hash) AS duplicate_free
FROM raw""", "running_accepted"), "A11")
def q_reconcile_raw(spark, sf_dir):
    raw = _merged_raw(spark, sf_dir)
    return raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_distinct("source_record_hash").alias("distinct_hashes"),
        F.min("journey_date").alias("first_journey_date"),
        F.max("journey_date").alias("last_journey_date"),
    ).withColumn("duplicate_free", F.col("raw_rows") == F.col("distinct_hashes"))


@register("reconcile_layers", oracle("""
, c AS (SELECT (SELECT count(*) FROM running_raw) AS source_count,
               (SELECT count(DISTINCT source_record_hash) FROM running_accepted) AS raw_count,
               (SELECT count(*) FROM running_rejected) AS rejected_count,
               (SELECT count(*) FROM running_accepted) - (SELECT count(DISTINCT source_record_hash) FROM running_accepted)
                   AS duplicate_count,
               (SELECT count(*) FROM stg_train_running) AS staging_count,
               (SELECT count(*) FROM fact) AS mart_count)
SELECT *, source_count = raw_count + rejected_count + duplicate_count AS accounted_for,
       staging_count >= mart_count AS transformations_complete FROM c""",
                                     "running_raw", "running_accepted", "running_rejected", "stg_train_running",
                                     "fact"), "A12")
def q_reconcile_layers(spark, sf_dir):
    raw = fixtures.load(spark, sf_dir, "running_raw")
    checked = ingest.with_rule_check(raw)
    m = Models(raw_running_from_fixture(spark, sf_dir))
    from delaylens.operators.quality import reconcile_layers
    return reconcile_layers(source=raw, checked=checked, staging=m.stg_train_running,
                            mart=m.fact_station_arrival)


@register("schema_evolution_union", oracle(LOOKUP_SQL + """
SELECT train_number, journey_date, station_code, station_sequence, arrival_delay_minutes, source_name
FROM running_accepted
UNION ALL BY NAME
SELECT train_number, TRY_CAST(journey_date_text AS DATE) AS journey_date, station_code, station_sequence,
       arrival_delay_minutes, 'delay_csv_feed' AS source_name, source_scheduled_arrival_time,
       source_actual_arrival_time
FROM attached""", "running_accepted", "delay_csv", "route_csv"), "K8")
def q_schema_evolution_union(spark, sf_dir):
    old = raw_running_from_fixture(spark, sf_dir).select(
        "train_number", "journey_date", "station_code", "station_sequence", "arrival_delay_minutes", "source_name")
    a = ingest.attach_stop_sequence(fixtures.load(spark, sf_dir, "delay_csv"),
                                    fixtures.load(spark, sf_dir, "route_csv"))
    new = a.select("train_number", F.col("journey_date_text").try_cast("date").alias("journey_date"),
                   "station_code", "station_sequence", "arrival_delay_minutes", "source_name",
                   "source_scheduled_arrival_time", "source_actual_arrival_time")
    return tables.evolve_union(old, new)


# ----------------------------------------------------------------------- provenance gate
MANIFESTS = [
    {"source_name": "synthetic_lineitem", "source_url": "https://example.org/data/lineitem",
     "license_name": "CC-BY-4.0", "retrieved_at": "2024-10-02T08:00:00",
     "coverage_description": "September 2024 station stops", "local_processing_permitted": True},
    {"source_name": "restricted_feed", "source_url": "https://example.org/data/restricted",
     "license_name": "proprietary", "retrieved_at": "2024-10-02T08:00:00",
     "coverage_description": "September 2024 station stops", "local_processing_permitted": False},
    {"source_name": "tiny_feed", "source_url": "https://example.org/data/tiny",
     "license_name": "CC0", "retrieved_at": "2024-10-02T08:00:00",
     "coverage_description": "short", "local_processing_permitted": True},
]
FEED_SQL = """
SELECT train_number, journey_date, station_code, station_sequence,
       CASE l_orderkey % 4 WHEN 0 THEN 'restricted_feed' WHEN 1 THEN 'tiny_feed' ELSE source_name END AS source_name
FROM running_raw"""


@register("provenance_gate", oracle(f"""
, m AS (SELECT * FROM (VALUES {", ".join(
    f"('{m['source_name']}', '{m['source_url']}', '{m['license_name']}', '{m['coverage_description']}', "
    f"{str(m['local_processing_permitted']).upper()})" for m in MANIFESTS)})
        t(source_name, source_url, license_name, coverage_description, permitted)),
ok AS (SELECT source_name FROM m WHERE length(source_name) >= 3 AND length(license_name) >= 3
       AND length(coverage_description) >= 10 AND permitted)
SELECT * FROM ({FEED_SQL}) f WHERE source_name IN (SELECT source_name FROM ok)""", "running_raw"), "S6")
def q_provenance_gate(spark, sf_dir):
    path = scratch_path(spark, "manifests")
    spark.createDataFrame([(json.dumps(m),) for m in MANIFESTS], "value string").coalesce(1).write.text(path)
    manifests = provenance.read_manifests(spark, path)
    raw = fixtures.load(spark, sf_dir, "running_raw")
    feed = raw.select("train_number", "journey_date", "station_code", "station_sequence",
                      F.when(F.col("l_orderkey") % 4 == 0, "restricted_feed")
                       .when(F.col("l_orderkey") % 4 == 1, "tiny_feed")
                       .otherwise(F.col("source_name")).alias("source_name"))
    return provenance.gate_sources(feed, manifests)


# ----------------------------------------------------------------------- live status archive
SNAP_SQL = """
, snap AS (
  SELECT coalesce(json_extract_string(payload, '$.data.trainNumber'), requested_train_number) AS train_number,
         TRY_CAST(json_extract_string(payload, '$.data.startDate') AS DATE) AS journey_date,
         json_extract_string(payload, '$.data.lastUpdatedAt') AS provider_updated_at,
         json_extract_string(payload, '$.data.status') AS journey_status,
         TRY_CAST(json_extract_string(payload, '$.data.delayMinutes') AS DOUBLE) AS delay_minutes,
         json_extract_string(payload, '$.data.currentLocation.stationCode') AS current_station_code,
         json_extract_string(payload, '$.data.nextHalt.stationCode') AS next_station_code,
         json_extract_string(payload, '$.data.nextHalt.stationName') AS next_station_name,
         CAST(retrieved_at AS TIMESTAMP) AS retrieved_at
  FROM snapshot_payload WHERE http_status = 200),
snap_h AS (
  SELECT *, """ + hash_sql(["current_station_code", "delay_minutes", "journey_date", "journey_status", "next_station_code",
                            "next_station_name", "provider_updated_at", "strftime(retrieved_at, '%Y-%m-%d %H:%M:%S.%f')",
                            "train_number"]) + """ AS source_record_hash
  FROM snap)
"""


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.flatten_live_status(fixtures.load(spark, sf_dir, "snapshot_payload"))


@register("snapshot_flatten", oracle(SNAP_SQL + "SELECT * FROM snap_h", "snapshot_payload"), "S4 P7 T11 T20")
def q_snapshot_flatten(spark, sf_dir):
    return snapshots(spark, sf_dir)


@register("archive_summary", oracle(SNAP_SQL + """
, archive AS (SELECT DISTINCT * FROM snap_h)
SELECT count(*) AS snapshots, count(DISTINCT train_number) AS trains, min(retrieved_at) AS first_retrieved_at,
       max(retrieved_at) AS latest_retrieved_at, round(avg(delay_minutes), 6) AS average_delay_minutes
FROM archive""", "snapshot_payload"), "A9 K1")
def q_archive_summary(spark, sf_dir):
    archive = tables.insert_only(spark.createDataFrame([], snapshots(spark, sf_dir).schema),
                                 snapshots(spark, sf_dir))
    return kpi.archive_summary(archive)


# ----------------------------------------------------------------------- weather
WEATHER_SQL = """
, wp AS (SELECT request_id, station_code, payload,
                json_extract(payload, '$.daily') IS NULL AS missing FROM weather_payload),
wf AS (
  SELECT request_id, station_code, CAST(NULL AS VARCHAR) AS error,
         TRY_CAST(unnest(CAST(json_extract(payload, '$.daily.time') AS VARCHAR[])) AS DATE) AS weather_date,
         unnest(CAST(json_extract(payload, '$.daily.temperature_2m_mean') AS DOUBLE[])) AS temperature_2m_mean,
         unnest(CAST(json_extract(payload, '$.daily.precipitation_sum') AS DOUBLE[])) AS precipitation_sum,
         unnest(CAST(json_extract(payload, '$.daily.rain_sum') AS DOUBLE[])) AS rain_sum,
         unnest(CAST(json_extract(payload, '$.daily.weather_code') AS INTEGER[])) AS weather_code
  FROM wp WHERE NOT missing
  UNION ALL
  SELECT request_id, station_code, 'response lacks daily weather data', NULL, NULL, NULL, NULL, NULL
  FROM wp WHERE missing)
"""


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.flatten_weather(fixtures.load(spark, sf_dir, "weather_payload"), ["request_id", "station_code"])


@register("weather_flatten", oracle(WEATHER_SQL + "SELECT * FROM wf", "weather_payload"), "S5")
def q_weather_flatten(spark, sf_dir):
    return weather_rows(spark, sf_dir)


# ----------------------------------------------------------------------- historical load job
LOAD_VALID_SQL = LOOKUP_SQL + f"""
, hashed AS (SELECT *, {_load_hash_sql()} AS source_record_hash FROM attached),
lc AS (SELECT *, NOT (length(train_number) NOT BETWEEN 1 AND 16 OR length(station_code) NOT BETWEEN 1 AND 16
                  OR station_sequence <= 0 OR journey_date_text IS NULL
                  OR NOT regexp_matches(journey_date_text, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
                  OR TRY_CAST(journey_date_text AS DATE) IS NULL
                  OR (arrival_delay_minutes IS NOT NULL AND NOT (arrival_delay_minutes BETWEEN -1440 AND 10080))
                  OR (departure_delay_minutes IS NOT NULL AND NOT (departure_delay_minutes BETWEEN -1440 AND 10080)))
                  AS ok FROM hashed),
c AS (SELECT count(*) AS received, count_if(ok) AS valid, count_if(NOT ok) AS rejected,
             count(DISTINCT CASE WHEN ok THEN source_record_hash END) AS distinct_valid FROM lc)
"""


@register("historical_load", oracle(LOAD_VALID_SQL + """
SELECT 'run-1' AS run_id, 'succeeded' AS status, received AS records_received, valid AS records_valid,
       rejected AS records_rejected, distinct_valid AS records_distinct_valid, distinct_valid AS records_inserted,
       CAST(0 AS BIGINT) AS records_already_present FROM c
UNION ALL
SELECT 'run-2', 'succeeded', received, valid, rejected, distinct_valid, CAST(0 AS BIGINT), distinct_valid FROM c""",
                                    "delay_csv", "route_csv", replace={"route_csv": "route_gaps"}), "K4 K1 K3 A10 J1 J2 S2 S3 P20 W4")
def q_historical_load(spark, sf_dir):
    from delaylens.plans import load_run
    landing = scratch_path(spark, "delay_landing")
    files.write_csv(fixtures.load(spark, sf_dir, "delay_csv"), f"{landing}/delays", "gzip")
    files.write_csv(fixtures.load(spark, sf_dir, "route_gaps"), f"{landing}/routes", "gzip")
    delay_path, route_path = f"{landing}/delays", f"{landing}/routes"
    paths = load_run.LoadPaths(scratch_path(spark, "raw_running"), scratch_path(spark, "quarantine"),
                               scratch_path(spark, "ingestion_audit"))
    load_run.historical_load(spark, delay_path, route_path, paths, run_id="run-1")
    load_run.historical_load(spark, delay_path, route_path, paths, run_id="run-2")  # re-run inserts nothing
    audit = load_run.read_audit(spark, paths.audit_root)
    return audit.select("run_id", "status", "records_received", "records_valid", "records_rejected",
                        F.col("records_distinct_valid"), "records_inserted", "records_already_present")


SCHEDULE_SQL = r"""
, typed AS (
  SELECT regexp_replace(upper(trim(coalesce(trainNumber, ''))), '\.0$', '') AS train_number,
         regexp_replace(upper(trim(coalesce(station_code, ''))), '\.0$', '') AS station_code,
         NULLIF(trim(station_name), '') AS station_name, TRY_CAST(stnSerialNumber AS INTEGER) AS station_sequence,
         TRY_CAST(NULLIF(distance, '') AS DOUBLE) AS distance_km FROM route_csv),
fine AS (SELECT DISTINCT * FROM typed WHERE train_number <> '' AND station_code <> '' AND station_sequence > 0)
"""


def _loaded_schedule(spark: SparkSession, sf_dir: str):
    """Two runs of the schedule load over the route file; returns the paths."""
    from delaylens.plans import load_run
    route_path = _written_csv(spark, fixtures.load(spark, sf_dir, "route_csv"), "routes")
    paths = load_run.LoadPaths(scratch_path(spark, "raw_schedule"), scratch_path(spark, "schedule_quarantine"),
                               scratch_path(spark, "schedule_audit"))
    for run in ("run-1", "run-2"):
        load_run.schedule_load(spark, route_path, paths, run_id=run)
    return paths


@register("schedule_load", oracle(SCHEDULE_SQL + """
, c AS (SELECT (SELECT count(*) FROM typed) AS received,
               (SELECT count(*) FROM typed WHERE train_number <> '' AND station_code <> '' AND station_sequence > 0) AS valid,
               (SELECT count(*) FROM fine) AS distinct_valid)
SELECT 'run-1' AS run_id, 'train_schedule_stops' AS dataset, 'succeeded' AS status, received AS records_received,
       valid AS records_valid, received - valid AS records_rejected, distinct_valid AS records_distinct_valid,
       distinct_valid AS records_inserted, CAST(0 AS BIGINT) AS records_already_present FROM c
UNION ALL
SELECT 'run-2', 'train_schedule_stops', 'succeeded', received, valid, received - valid, distinct_valid, CAST(0 AS BIGINT),
       distinct_valid FROM c""", "route_csv"), "K1 K4 S3 T10")
def q_schedule_load(spark, sf_dir):
    from delaylens.plans import load_run
    audit = load_run.read_audit(spark, _loaded_schedule(spark, sf_dir).audit_root)
    return audit.select("run_id", "dataset", "status", "records_received", "records_valid", "records_rejected",
                        "records_distinct_valid", "records_inserted", "records_already_present")


@register("schedule_dimensions", oracle(SCHEDULE_SQL + """
SELECT train_number, station_code, station_sequence, CAST(CAST(distance_km AS DECIMAL(12,2)) AS DOUBLE) AS distance_km,
       'route_csv_feed' AS source_name FROM fine""", "route_csv"), "K1 O6 W2")
def q_schedule_dimensions(spark, sf_dir):
    from delaylens.operators import marts, staging
    from delaylens.plans import load_run
    paths = _loaded_schedule(spark, sf_dir)
    schema = spark.read.parquet(paths.raw_root).drop("run_id").schema
    stops = marts.dim_route_stop(staging.stg_train_schedule(load_run.read_raw(spark, paths, schema)))
    return stops.select("train_number", "station_code", "station_sequence", "distance_km", "source_name")


def _network_overview_oracle() -> str:
    from delaylens.plans.queries_core import NETWORK_OVERVIEW_ORACLE
    return NETWORK_OVERVIEW_ORACLE


@register("dashboard_snapshot", _network_overview_oracle(), "K7 A1")
def q_dashboard_snapshot(spark, sf_dir):
    from delaylens.operators import kpi as kpi_ops
    from delaylens.plans import load_run
    from delaylens.plans.model_build import from_fixtures
    m = from_fixtures(spark, sf_dir)
    overview = kpi_ops.network_overview(m.fact_station_arrival, m.dim_station,
                                        fixtures.load(spark, sf_dir, "ingestion_audit"), "synthetic_events")
    path = load_run.export_snapshot(overview, scratch_path(spark, "dashboard_snapshot"))
    return load_run.read_snapshot(spark, path, overview.schema)


@register("archive_counters", oracle("""
SELECT CAST(count_if(http_status = 200) AS BIGINT) AS received, CAST(count_if(http_status <> 200) AS BIGINT) AS rejected
FROM snapshot_payload""", "snapshot_payload"), "S4 T20")
def q_archive_counters(spark, sf_dir):
    return payloads.live_status_counts(fixtures.load(spark, sf_dir, "snapshot_payload"))
