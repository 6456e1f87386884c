"""Registered queries: data-quality tests, report, leakage guard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from delaylens.operators import ingest, quality, tables
from delaylens.plans.catalog import register
from delaylens.plans.model_build import from_fixtures
from delaylens.plans.oracle_views import UNVALIDATED, oracle
from delaylens.session import scratch_path
from delaylens.sources import fixtures


#: What several tests of the whole report read: both stagings, and of the fact the tested columns.
_SHARED = {"stg_train_running": None, "stg_train_schedule": None, "fact_station_arrival": ["train_number", "journey_date", "station_code", "station_sequence"]}


def _models(spark, sf_dir, schedule="schedule_raw", written=None):
    """Models over the rows as they come, so that the tests find what validation removes.

    ``written`` names models that several tests read, with the columns they need (None: all): these
    are computed once and written. All others are read by one test each and stay lazy.
    """
    m = from_fixtures(spark, sf_dir, schedule, validated=False)
    for name, columns in (written or {}).items():
        df = getattr(m, name)
        m.__dict__[name] = tables.materialized(df.select(*columns) if columns else df, name)
    return {
        "stg_train_running": m.stg_train_running,
        "raw_train_running_events": ingest.exact_dedupe(m.raw_running),
        "dim_train": m.dim_train,
        "dim_station": m.dim_station,
        "dim_route_stop": m.dim_route_stop,
        "fact_station_arrival": m.fact_station_arrival,
    }


ORACLE_MODELS = {
    "stg_train_running": "stg_train_running",
    "raw_train_running_events": "(SELECT * FROM running_accepted QUALIFY row_number() OVER "
                                "(PARTITION BY source_record_hash) = 1)",
    "dim_train": "dim_train",
    "dim_station": "dim_station",
    "dim_route_stop": "dim_route_stop",
    "fact_station_arrival": "fact",
}


def _not_null_sql() -> str:
    parts = []
    for model, cols in quality.NOT_NULL_COLUMNS.items():
        for c in cols:
            parts.append(f"SELECT 'not_null_{model}_{c}' AS test_name, "
                         f"CAST(count_if({c} IS NULL) AS BIGINT) AS failed_count FROM {ORACLE_MODELS[model]}")
    return "\nUNION ALL\n".join(parts)


def _unique_sql(items: dict, prefix_one: str = "unique_", prefix_many: str = "unique_combination_") -> str:
    parts = []
    for model, cols in items.items():
        cols = [cols] if isinstance(cols, str) else cols
        name = (prefix_one if len(cols) == 1 else prefix_many) + model + "_" + "_".join(cols)
        parts.append(f"SELECT '{name}' AS test_name, CAST(count(*) AS BIGINT) AS failed_count FROM "
                     f"(SELECT {', '.join(cols)} FROM {ORACLE_MODELS[model]} GROUP BY ALL HAVING count(*) > 1) d")
    return "\nUNION ALL\n".join(parts)


SINGULAR_SQL = """
SELECT 'assert_actual_arrival_has_schedule' AS test_name, CAST(count(*) AS BIGINT) AS failed_count
FROM stg_train_running WHERE actual_arrival_at IS NOT NULL AND scheduled_arrival_at IS NULL
UNION ALL
SELECT 'assert_positive_station_sequence', CAST(count(*) AS BIGINT) FROM stg_train_running WHERE station_sequence <= 0
UNION ALL
SELECT 'assert_running_fact_references_schedule_stop', CAST(count(*) AS BIGINT)
FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dim_route_stop s WHERE f.train_number = s.train_number
    AND f.station_code = s.station_code AND f.station_sequence = s.station_sequence)"""

ALL_VIEWS = ("stg_train_running", "running_accepted", "dim_train", "dim_station", "dim_route_stop", "fact")


@register("dq_not_null", oracle(_not_null_sql(), *ALL_VIEWS, replace=UNVALIDATED), "Q1")
def q_dq_not_null(spark, sf_dir):
    ms = _models(spark, sf_dir)
    from functools import reduce
    from pyspark.sql import DataFrame
    return reduce(DataFrame.unionByName, [quality.not_null_failures(ms[m], m, cols)
                                          for m, cols in quality.NOT_NULL_COLUMNS.items()])


@register("dq_unique", oracle(_unique_sql(quality.UNIQUE_COLUMNS), *ALL_VIEWS, replace=UNVALIDATED), "Q2 T9")
def q_dq_unique(spark, sf_dir):
    ms = _models(spark, sf_dir)
    from functools import reduce
    from pyspark.sql import DataFrame
    return reduce(DataFrame.unionByName, [quality.unique_failures(ms[m], m, [c])
                                          for m, c in quality.UNIQUE_COLUMNS.items()])


@register("dq_unique_combination", oracle(_unique_sql(quality.UNIQUE_COMBINATIONS), *ALL_VIEWS, replace=UNVALIDATED), "Q3")
def q_dq_unique_combination(spark, sf_dir):
    ms = _models(spark, sf_dir)
    from functools import reduce
    from pyspark.sql import DataFrame
    return reduce(DataFrame.unionByName, [quality.unique_failures(ms[m], m, cols)
                                          for m, cols in quality.UNIQUE_COMBINATIONS.items()])


@register("dq_actual_without_schedule", oracle("""
SELECT train_number, journey_date, station_code, station_sequence FROM stg_train_running
WHERE actual_arrival_at IS NOT NULL AND scheduled_arrival_at IS NULL""", "stg_train_running", replace=UNVALIDATED), "Q4")
def q_dq_actual_without_schedule(spark, sf_dir):
    return quality.actual_without_schedule(from_fixtures(spark, sf_dir, validated=False).stg_train_running).select(
        "train_number", "journey_date", "station_code", "station_sequence")


@register("dq_nonpositive_sequence", oracle("""
SELECT train_number, journey_date, station_code, station_sequence FROM stg_train_running
WHERE station_sequence <= 0""", "stg_train_running", replace=UNVALIDATED), "Q5")
def q_dq_nonpositive_sequence(spark, sf_dir):
    return quality.nonpositive_sequence(from_fixtures(spark, sf_dir, validated=False).stg_train_running).select(
        "train_number", "journey_date", "station_code", "station_sequence")


@register("dq_fact_without_schedule", oracle("""
SELECT f.train_number, f.journey_date, f.station_code, f.station_sequence FROM fact f
LEFT JOIN dim_route_stop s ON f.train_number = s.train_number AND f.station_code = s.station_code
     AND f.station_sequence = s.station_sequence
WHERE s.train_number IS NULL""", "fact", "dim_route_stop",
          replace={"schedule_raw": "schedule_gaps"}), "Q6 J4")
def q_dq_fact_without_schedule(spark, sf_dir):
    m = from_fixtures(spark, sf_dir, "schedule_gaps")
    return quality.fact_without_schedule(m.fact_station_arrival, m.dim_route_stop).select(
        "train_number", "journey_date", "station_code", "station_sequence")


@register("dq_report", oracle(f"""
, r AS ({_not_null_sql()}
UNION ALL
{_unique_sql(quality.UNIQUE_COLUMNS)}
UNION ALL
{_unique_sql(quality.UNIQUE_COMBINATIONS)}
UNION ALL
{SINGULAR_SQL})
SELECT test_name, 'error' AS severity, failed_count,
       CASE WHEN failed_count = 0 THEN 'pass' ELSE 'fail' END AS status FROM r""", *ALL_VIEWS,
                              replace=UNVALIDATED | {"schedule_raw": "schedule_gaps"}), "Q7")
def q_dq_report(spark, sf_dir):
    return quality.quality_report(_models(spark, sf_dir, "schedule_gaps", _SHARED))


def _dated_sql() -> str:
    parts, keys = [], "train_number, journey_date, station_code, station_sequence"
    for model, view in (("stg_train_running", "stg_train_running"), ("fact_station_arrival", "fact")):
        for c in quality.NOT_NULL_COLUMNS[model]:
            if c != "journey_date":
                parts.append(f"SELECT journey_date, 'not_null_{model}_{c}' AS test_name, count_if({c} IS NULL) AS n FROM {view} GROUP BY 1")
        parts.append(f"SELECT journey_date, 'unique_combination_{model}_{keys.replace(', ', '_')}', count_if(k > 1) FROM "
                     f"(SELECT {keys}, count(*) AS k FROM {view} GROUP BY ALL) GROUP BY 1")
    parts.append("SELECT journey_date, 'assert_actual_arrival_has_schedule', "
                 "count_if(actual_arrival_at IS NOT NULL AND scheduled_arrival_at IS NULL) FROM stg_train_running GROUP BY 1")
    parts.append("SELECT journey_date, 'assert_positive_station_sequence', count_if(station_sequence <= 0) FROM stg_train_running GROUP BY 1")
    parts.append("""SELECT f.journey_date, 'assert_running_fact_references_schedule_stop', count_if(s.train_number IS NULL)
FROM fact f LEFT JOIN (SELECT DISTINCT train_number, station_code, station_sequence FROM dim_route_stop) s
  ON f.train_number = s.train_number AND f.station_code = s.station_code AND f.station_sequence = s.station_sequence GROUP BY 1""")
    return "\nUNION ALL\n".join(parts)


#: Dates that each run of the audited checks has touched.
AUDITED_RUNS = {"first": [dt.date(2024, 9, d) for d in range(1, 16)], "second": [dt.date(2024, 9, 10), dt.date(2024, 9, 20)]}


@register("dq_audit", oracle(f"""
, r AS ({_dated_sql()}),
runs AS (SELECT 'first' AS run_id, unnest(range(DATE '2024-09-01', DATE '2024-09-16', INTERVAL 1 DAY))::DATE AS journey_date
         UNION ALL SELECT 'second', unnest([DATE '2024-09-10', DATE '2024-09-20']))
SELECT run_id, journey_date, test_name, n AS failed_row_count, CASE WHEN n = 0 THEN 'pass' ELSE 'fail' END AS status
FROM r JOIN runs USING (journey_date)""", *ALL_VIEWS, replace=UNVALIDATED | {"schedule_raw": "schedule_gaps"}), "Q7 Q1 Q3 Q4 Q5 Q6")
def q_dq_audit(spark, sf_dir):
    """Two runs append the results of the dates they touched; the second is repeated."""
    models = _models(spark, sf_dir, "schedule_gaps", _SHARED)
    root = scratch_path(spark, "quality-audit")
    for run in ("first", "second", "second"):
        quality.append_results(quality.dated_report(models, AUDITED_RUNS[run]), root, run, dt.datetime(2024, 10, 1))
    return spark.read.parquet(root).select("run_id", "journey_date", "test_name", "failed_row_count", "status")


@register("reconciliation_audit", oracle("""
, c AS (SELECT (SELECT count(*) FROM running_raw) AS source_count,
               (SELECT count(DISTINCT source_record_hash) FROM running_accepted) AS raw_count,
               (SELECT count(*) FROM running_rejected) AS rejected_count,
               (SELECT count(*) FROM running_accepted) - (SELECT count(DISTINCT source_record_hash) FROM running_accepted)
                   AS duplicate_count,
               (SELECT count(*) FROM stg_train_running) AS staging_count, (SELECT count(*) FROM fact) AS mart_count)
SELECT 'run-1/running_events' AS reconciliation_id, 'run-1' AS run_id, 'running_events' AS dataset, source_count, raw_count,
       staging_count, mart_count, rejected_count, duplicate_count,
       CASE WHEN source_count = raw_count + rejected_count + duplicate_count AND staging_count >= mart_count THEN 'pass'
            ELSE 'fail' END AS status FROM c""", "running_raw", "running_accepted", "running_rejected", "stg_train_running", "fact"), "A12")
def q_reconciliation_audit(spark, sf_dir):
    raw = fixtures.load(spark, sf_dir, "running_raw")
    checked = ingest.with_rule_check(raw)
    m = from_fixtures(spark, sf_dir)
    counts = quality.reconcile_layers(source=raw, checked=checked, staging=m.stg_train_running, mart=m.fact_station_arrival)
    root = scratch_path(spark, "reconciliation-audit")
    quality.append_reconciliation(counts, root, "run-1", "running_events", dt.datetime(2024, 10, 1))
    return spark.read.parquet(root).drop("reconciled_at")


@register("leakage_violations", oracle("""
SELECT train_number, journey_date, station_code, station_sequence, scheduled_arrival_at AS prediction_at,
       feature_observed_at
FROM (SELECT *, lag(actual_arrival_at) OVER (PARTITION BY train_number, journey_date
                                             ORDER BY station_sequence, station_code) AS feature_observed_at
      FROM fact) f
WHERE feature_observed_at IS NOT NULL AND feature_observed_at > scheduled_arrival_at""", "fact"), "P18")
def q_leakage_violations(spark, sf_dir):
    fact = from_fixtures(spark, sf_dir).fact_station_arrival
    # The previous stop's actual arrival is the observation time of the previous-stop feature.
    w = Window.partitionBy("train_number", "journey_date").orderBy("station_sequence", "station_code")
    feats = fact.select("train_number", "journey_date", "station_code", "station_sequence",
                        F.col("scheduled_arrival_at").alias("prediction_at"),
                        F.lag("actual_arrival_at").over(w).alias("feature_observed_at"))
    return quality.leakage_violations(feats, "feature_observed_at", "prediction_at")
