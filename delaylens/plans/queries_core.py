"""Registered queries: staging, intermediate, fact, features, dimensions, marts and KPIs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.operators import kpi, marts
from delaylens.plans.catalog import register
from delaylens.plans.model_build import from_fixtures
from delaylens.plans.oracle_views import oracle
from delaylens.sources import fixtures

# Scenario parameters of the fixture run (not data filters): the audit source of the
# synthetic load, the watchlist month and an id that is known not to exist.
AUDIT_SOURCE = "synthetic_events"
RUNNING_DATASET = "train_running_events"
WATCH_START, WATCH_END = "2024-09-01", "2024-10-01"
UNKNOWN_TRAIN = "99999"

STG_COLS = ("train_number, journey_date, station_code, station_sequence, scheduled_arrival_at, "
            "actual_arrival_at, scheduled_departure_at, actual_departure_at, arrival_delay_minutes, "
            "departure_delay_minutes, journey_status, source_record_hash, ingested_at")


# ----------------------------------------------------------------------- staging / intermediate
@register("stg_train_running", oracle(f"SELECT {STG_COLS} FROM stg_train_running", "stg_train_running"),
          "W1 P8 P19 P2 P6")
def q_stg_train_running(spark, sf_dir):
    return from_fixtures(spark, sf_dir).stg_train_running


@register("stg_train_schedule", oracle("SELECT * FROM stg_train_schedule", "stg_train_schedule"), "W2 P8")
def q_stg_train_schedule(spark, sf_dir):
    return from_fixtures(spark, sf_dir).stg_train_schedule


@register("int_running_enriched", oracle("""
SELECT train_number, journey_date, station_code, station_sequence, arrival_delay_minutes,
       previous_station_arrival_delay_minutes, derived_arrival_delay_minutes
FROM int_running""", "int_running"), "W5 T8 T13")
def q_int_running_enriched(spark, sf_dir):
    return from_fixtures(spark, sf_dir).int_train_running_enriched.select(
        "train_number", "journey_date", "station_code", "station_sequence", "arrival_delay_minutes",
        "previous_station_arrival_delay_minutes", "derived_arrival_delay_minutes")


@register("derived_delay", oracle("""
SELECT train_number, journey_date, station_code, station_sequence, scheduled_arrival_at, actual_arrival_at,
       derived_arrival_delay_minutes
FROM int_running WHERE derived_arrival_delay_minutes IS NOT NULL""", "int_running"), "P9 T1")
def q_derived_delay(spark, sf_dir):
    return from_fixtures(spark, sf_dir).int_train_running_enriched.where(
        F.col("derived_arrival_delay_minutes").isNotNull()).select(
        "train_number", "journey_date", "station_code", "station_sequence", "scheduled_arrival_at",
        "actual_arrival_at", "derived_arrival_delay_minutes")


# ----------------------------------------------------------------------- fact / features
@register("fact_station_arrival", oracle("SELECT * FROM fact", "fact"), "P10 K5")
def q_fact(spark, sf_dir):
    return from_fixtures(spark, sf_dir).fact_station_arrival


@register("delay_features", oracle("SELECT * FROM features", "features"), "M9 P13 T2")
def q_features(spark, sf_dir):
    return from_fixtures(spark, sf_dir).delay_features


# ----------------------------------------------------------------------- dimensions
@register("dim_route_stop", oracle("SELECT * FROM dim_route_stop", "dim_route_stop"), "O6")
def q_dim_route_stop(spark, sf_dir):
    return from_fixtures(spark, sf_dir).dim_route_stop


@register("dim_station", oracle("SELECT * FROM dim_station", "dim_station"), "W3 T5")
def q_dim_station(spark, sf_dir):
    return from_fixtures(spark, sf_dir).dim_station


@register("dim_train", oracle("SELECT * FROM dim_train", "dim_train"), "O4 T9")
def q_dim_train(spark, sf_dir):
    return from_fixtures(spark, sf_dir).dim_train


# ----------------------------------------------------------------------- marts
MEASURES_SQL = """
       count(*) AS station_stop_observations,
       round(avg(arrival_delay_minutes), 6) AS average_arrival_delay_minutes,
       round(median(arrival_delay_minutes), 6) AS median_arrival_delay_minutes,
       round(avg(CASE WHEN arrival_delay_minutes <= 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS on_time_or_early_percent"""


@register("station_delay", oracle(f"""
SELECT station_code, {MEASURES_SQL}
FROM observed GROUP BY station_code""", "observed"), "A2 P11")
def q_station_delay(spark, sf_dir):
    return from_fixtures(spark, sf_dir).mart_station_delay


@register("train_punctuality", oracle(f"""
SELECT train_number, {MEASURES_SQL},
       round(avg(CASE WHEN arrival_delay_minutes > 60 THEN 1.0 ELSE 0.0 END) * 100, 6) AS major_delay_percent
FROM observed GROUP BY train_number""", "observed"), "A3 P11")
def q_train_punctuality(spark, sf_dir):
    return from_fixtures(spark, sf_dir).mart_train_punctuality


@register("prediction_accuracy", oracle("""
SELECT model_name, model_version,
       CAST(count_if(actual_arrival_delay_minutes IS NOT NULL) AS BIGINT) AS evaluated_prediction_count,
       round(avg(absolute_error_minutes), 6) AS mae_minutes,
       round(sqrt(avg(power(actual_arrival_delay_minutes - predicted_arrival_delay_minutes, 2))), 6) AS rmse_minutes
FROM prediction GROUP BY model_name, model_version""", "prediction"), "A4")
def q_prediction_accuracy(spark, sf_dir):
    return marts.mart_prediction_accuracy(fixtures.load(spark, sf_dir, "prediction"))


# ----------------------------------------------------------------------- KPIs
NETWORK_OVERVIEW_ORACLE = oracle(f"""
SELECT CASE WHEN count(*) > 0 THEN 'ready' ELSE 'awaiting_approved_source' END AS state,
       CAST(count(DISTINCT (train_number, journey_date)) AS BIGINT) AS journeys_analysed,
       (SELECT count(*) FROM dim_station) AS stations,
       round(avg(arrival_delay_minutes), 6) AS average_arrival_delay_minutes,
       round(median(arrival_delay_minutes), 6) AS median_arrival_delay_minutes,
       round(avg(CASE WHEN arrival_delay_minutes <= 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS on_time_or_early_percent,
       count(*) AS station_stop_observations,
       min(journey_date) AS coverage_start_date, max(journey_date) AS coverage_end_date,
       (SELECT max(completed_at) FROM ingestion_audit
         WHERE status = 'succeeded' AND source_name = '{AUDIT_SOURCE}') AS last_successful_pipeline_at
FROM observed""", "observed", "dim_station", "ingestion_audit")


@register("network_overview", NETWORK_OVERVIEW_ORACLE, "A1 A16 A17 P21")
def q_network_overview(spark, sf_dir):
    m = from_fixtures(spark, sf_dir)
    return kpi.network_overview(m.fact_station_arrival, m.dim_station,
                                fixtures.load(spark, sf_dir, "ingestion_audit"), AUDIT_SOURCE)


@register("delay_distribution", oracle("""
SELECT CASE WHEN arrival_delay_minutes <= 0 THEN 'On time / early'
            WHEN arrival_delay_minutes <= 15 THEN '1–15 min'
            WHEN arrival_delay_minutes <= 30 THEN '16–30 min'
            WHEN arrival_delay_minutes <= 60 THEN '31–60 min'
            ELSE '60+ min' END AS label,
       CAST(CASE WHEN arrival_delay_minutes <= 0 THEN 1 WHEN arrival_delay_minutes <= 15 THEN 2
            WHEN arrival_delay_minutes <= 30 THEN 3 WHEN arrival_delay_minutes <= 60 THEN 4
            ELSE 5 END AS INTEGER) AS band_order,
       count(*) AS observations
FROM observed GROUP BY 1, 2 ORDER BY band_order""", "observed"), "A5 P12 O3")
def q_delay_distribution(spark, sf_dir):
    return kpi.delay_distribution(from_fixtures(spark, sf_dir).fact_station_arrival)


@register("station_hotspots", oracle("""
SELECT station_code, observations, round(a, 6) AS average_delay_minutes, round(m, 6) AS median_delay_minutes,
       round(o, 6) AS on_time_percent
FROM (SELECT station_code, count(*) AS observations, avg(arrival_delay_minutes) AS a,
             median(arrival_delay_minutes) AS m,
             avg(CASE WHEN arrival_delay_minutes <= 0 THEN 1.0 ELSE 0.0 END) * 100 AS o
      FROM observed GROUP BY station_code HAVING count(*) >= 30) t
ORDER BY a DESC, observations DESC, station_code LIMIT 10""", "observed"), "A6 O1")
def q_station_hotspots(spark, sf_dir):
    return kpi.station_hotspots(from_fixtures(spark, sf_dir).fact_station_arrival, kpi.HOTSPOT_DEFAULT_LIMIT)


@register("daily_trend", oracle("""
SELECT journey_date, count(*) AS observations, round(avg(arrival_delay_minutes), 6) AS average_delay_minutes,
       round(median(arrival_delay_minutes), 6) AS median_delay_minutes
FROM observed GROUP BY journey_date ORDER BY journey_date""", "observed"), "A7 O3")
def q_daily_trend(spark, sf_dir):
    return kpi.daily_trend(from_fixtures(spark, sf_dir).fact_station_arrival)


WATCHLIST_SQL = f"""
SELECT train_number, count(*) AS observations FROM fact
WHERE journey_date >= DATE '{WATCH_START}' AND journey_date < DATE '{WATCH_END}'
GROUP BY train_number ORDER BY observations DESC, train_number LIMIT 5"""


@register("watchlist_top_k", oracle(WATCHLIST_SQL, "fact"), "A14 P17 O1")
def q_watchlist(spark, sf_dir):
    return kpi.watchlist_top_k(from_fixtures(spark, sf_dir).fact_station_arrival, WATCH_START, WATCH_END,
                               strict=True)


@register("train_profile", oracle(f"""
, requests AS (SELECT train_number FROM ({WATCHLIST_SQL}) w UNION SELECT '{UNKNOWN_TRAIN}'),
agg AS (SELECT train_number, CAST(count(DISTINCT journey_date) AS BIGINT) AS journeys, count(*) AS observations,
               round(avg(arrival_delay_minutes), 6) AS average_delay_minutes,
               round(median(arrival_delay_minutes), 6) AS median_delay_minutes,
               round(avg(CASE WHEN arrival_delay_minutes <= 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS on_time_percent
        FROM observed WHERE train_number IN (SELECT train_number FROM requests) GROUP BY train_number)
SELECT CASE WHEN a.observations > 0 THEN 'ready' ELSE 'not_found' END AS state, r.train_number,
       a.journeys, a.observations, a.average_delay_minutes, a.median_delay_minutes, a.on_time_percent
FROM requests r LEFT JOIN agg a ON r.train_number = a.train_number""", "fact", "observed"), "A8 P21")
def q_train_profile(spark, sf_dir):
    fact = from_fixtures(spark, sf_dir).fact_station_arrival
    watch = kpi.watchlist_top_k(fact, WATCH_START, WATCH_END).select("train_number")
    requests = watch.unionByName(spark.range(1).select(F.lit(UNKNOWN_TRAIN).alias("train_number")))
    return kpi.train_profile(fact, requests)


ENVELOPE_SQL = f"""
, last AS (SELECT max(completed_at) AS finished FROM ingestion_audit WHERE status = 'succeeded' AND source_name = '{AUDIT_SOURCE}'),
k(kpi, state) AS (
  SELECT 'network_overview', CASE WHEN count(*) > 0 THEN 'ready' ELSE 'awaiting_approved_source' END FROM observed
  UNION ALL SELECT 'delay_distribution', CASE WHEN count(*) > 0 THEN 'ready' ELSE 'awaiting_approved_source' END FROM observed
  UNION ALL SELECT 'station_hotspots', CASE WHEN max(n) >= 30 THEN 'ready' ELSE 'awaiting_approved_source' END
            FROM (SELECT count(*) AS n FROM observed GROUP BY station_code)
  UNION ALL SELECT 'daily_trend', CASE WHEN count(*) > 0 THEN 'ready' ELSE 'awaiting_approved_source' END FROM observed
  UNION ALL SELECT 'train_profile', CASE WHEN count(*) > 0 THEN 'ready' ELSE 'not_found' END
            FROM observed WHERE train_number = '{UNKNOWN_TRAIN}'
  UNION ALL SELECT 'watchlist', CASE WHEN count(*) > 0 THEN 'ready' ELSE 'awaiting_approved_source' END
            FROM fact WHERE journey_date >= DATE '2030-01-01' AND journey_date < DATE '2030-02-01'
  UNION ALL SELECT 'pipeline_health', CASE WHEN count(*) > 0 THEN 'ready' ELSE 'awaiting_approved_source' END
            FROM ingestion_audit WHERE dataset = '{RUNNING_DATASET}' AND source_name = '{AUDIT_SOURCE}'
  UNION ALL SELECT 'prediction_summary', 'not_evaluated')
SELECT kpi, state, CASE state WHEN 'ready' THEN 'the figures cover all loaded events'
         WHEN 'awaiting_approved_source' THEN 'no approved source has been loaded for this yet'
         WHEN 'not_found' THEN 'no observed stop of this train'
         ELSE 'no chronological evaluation has been run yet' END AS message, finished AS last_successful_pipeline_at
FROM k, last"""


@register("kpi_envelopes", oracle(ENVELOPE_SQL, "fact", "observed", "ingestion_audit"), "P21 A16")
def q_kpi_envelopes(spark, sf_dir):
    """The envelope of all eight KPIs; an unknown train, a month without events and an evaluation
    that has not been run show the states other than ready."""
    m = from_fixtures(spark, sf_dir).materialized("fact_station_arrival")
    fact, audit = m.fact_station_arrival, fixtures.load(spark, sf_dir, "ingestion_audit")
    unknown = spark.range(1).select(F.lit(UNKNOWN_TRAIN).alias("train_number"))
    never = spark.createDataFrame([], "model_name string, evaluation_rows long, mae double, rmse double, baseline_mae double, "
                                      "accepted_for_prediction boolean, evaluated_at timestamp_ntz, model_version string")
    rows = {
        "network_overview": kpi.network_overview(fact, m.dim_station, audit, AUDIT_SOURCE),
        "delay_distribution": kpi.delay_distribution(fact),
        "station_hotspots": kpi.station_hotspots(fact),
        "daily_trend": kpi.daily_trend(fact),
        "train_profile": kpi.train_profile(fact, unknown),
        "watchlist": kpi.watchlist_top_k(fact, "2030-01-01", "2030-02-01"),
        "pipeline_health": kpi.pipeline_health(audit, RUNNING_DATASET, AUDIT_SOURCE),
        "prediction_summary": kpi.prediction_summary(never),
    }
    return reduce(DataFrame.unionByName, [kpi.envelope(n, df, audit, AUDIT_SOURCE) for n, df in rows.items()])


@register("pipeline_health", oracle(f"""
SELECT 'ready' AS state, status AS last_run_status, CAST(records_received AS BIGINT) AS records_received,
       CAST(records_rejected AS BIGINT) AS records_rejected, completed_at
FROM ingestion_audit WHERE dataset = '{RUNNING_DATASET}' AND source_name = '{AUDIT_SOURCE}'
ORDER BY started_at DESC, run_id DESC LIMIT 1""", "ingestion_audit"), "A13 O2 T21")
def q_pipeline_health(spark, sf_dir):
    return kpi.pipeline_health(fixtures.load(spark, sf_dir, "ingestion_audit"), RUNNING_DATASET, AUDIT_SOURCE)


@register("last_successful_run", oracle(f"""
SELECT max(completed_at) AS last_successful_pipeline_at FROM ingestion_audit
WHERE status = 'succeeded' AND source_name = '{AUDIT_SOURCE}'""", "ingestion_audit"), "A16 O2")
def q_last_successful_run(spark, sf_dir):
    return kpi.last_successful_run(fixtures.load(spark, sf_dir, "ingestion_audit"), AUDIT_SOURCE)





@register("model_build", oracle("""
SELECT 'stg_train_running' AS model, 'view' AS materialization, (SELECT count(*) FROM stg_train_running) AS rows
UNION ALL SELECT 'stg_train_schedule', 'view', (SELECT count(*) FROM stg_train_schedule)
UNION ALL SELECT 'int_train_running_enriched', 'view', (SELECT count(*) FROM int_running)
UNION ALL SELECT 'dim_train', 'table', (SELECT count(*) FROM dim_train)
UNION ALL SELECT 'dim_station', 'table', (SELECT count(*) FROM dim_station)
UNION ALL SELECT 'dim_route_stop', 'table', (SELECT count(*) FROM dim_route_stop)
UNION ALL SELECT 'fact_station_arrival', 'incremental', (SELECT count(*) FROM fact)
UNION ALL SELECT 'delay_features', 'incremental', (SELECT count(*) FROM features)
UNION ALL SELECT 'mart_station_delay', 'table', (SELECT count(DISTINCT station_code) FROM observed)
UNION ALL SELECT 'mart_train_punctuality', 'table', (SELECT count(DISTINCT train_number) FROM observed)""",
                                "stg_train_running", "stg_train_schedule", "int_running", "dim_train", "dim_station",
                                "dim_route_stop", "fact", "features", "observed"), "K5 K8")
def q_model_build(spark, sf_dir):
    from delaylens.plans.model_build import materialize
    from delaylens.session import scratch_path
    return materialize(spark, from_fixtures(spark, sf_dir), scratch_path(spark, "models"))
