"""Registered queries: baseline model, splits, history, predictions, weather, incremental writes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from delaylens.functions import expressions as E
from delaylens.operators import baseline, tables
from delaylens.plans.catalog import register
from delaylens.plans.model_build import Models, from_fixtures, raw_running_from_fixture
from delaylens.plans.oracle_views import oracle
from delaylens.plans.queries_ingest import PREVIOUS_LOAD_CUTOFF, WEATHER_SQL, weather_rows
from delaylens.session import scratch_path

STOP_KEYS = ["train_number", "journey_date", "station_code", "station_sequence"]
SPLIT_ORDER = ["scheduled_arrival_at", "train_number", "journey_date", "station_code", "station_sequence"]
ROW_ORDER = ["journey_date", "train_number", "station_code", "station_sequence"]


def _for_predictions(fact):
    """The columns that splits, means, predictions and their actuals read, written. Without the hash, which
    is most of a fact row's bytes."""
    return tables.materialized(fact.select(*STOP_KEYS, "scheduled_arrival_at", "actual_arrival_at", "arrival_delay_minutes",
                                           "previous_station_arrival_delay_minutes"), "fact_station_arrival")


def _shared_fact(spark, sf_dir):
    """The fact for jobs that read it several times (date list, training part, holdout):
    computed once and checkpointed, so the model pipeline does not run per use."""
    return _for_predictions(from_fixtures(spark, sf_dir).fact_station_arrival)


def _observations(spark, sf_dir):
    fact = from_fixtures(spark, sf_dir).fact_station_arrival
    return fact.where(F.col("arrival_delay_minutes").isNotNull())


# ----------------------------------------------------------------------- splits
@register("chronological_split", oracle("""
, o AS (SELECT *, row_number() OVER (ORDER BY scheduled_arrival_at NULLS FIRST, train_number, journey_date,
                                              station_code, station_sequence) - 1 AS position,
               count(*) OVER () AS n FROM observed)
SELECT train_number, journey_date, station_code, station_sequence, position,
       CASE WHEN position < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
            WHEN position < floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'validation'
            ELSE 'test' END AS split
FROM o""", "observed"), "M1 W6 T23")
def q_chronological_split(spark, sf_dir):
    obs = _observations(spark, sf_dir).select(*STOP_KEYS, "scheduled_arrival_at")
    return baseline.chronological_split(obs, SPLIT_ORDER).select(*STOP_KEYS, "position", "split")


HOLDOUT_ROW_SQL = """
, o AS (SELECT *, row_number() OVER (ORDER BY journey_date, train_number, station_code, station_sequence) - 1
                  AS position, count(*) OVER () AS n FROM observed),
h AS (SELECT *, CASE WHEN position < greatest(1, floor(n * CAST(0.8 AS DOUBLE))) THEN 'train' ELSE 'test' END
                AS split FROM o)
"""


@register("holdout_by_row", oracle(HOLDOUT_ROW_SQL + """
SELECT train_number, journey_date, station_code, station_sequence, arrival_delay_minutes, split FROM h""",
                                   "observed"), "M2 W6")
def q_holdout_by_row(spark, sf_dir):
    obs = _observations(spark, sf_dir).select(*STOP_KEYS, "arrival_delay_minutes")
    return baseline.holdout_by_row(obs, ROW_ORDER).select(*STOP_KEYS, "arrival_delay_minutes", "split")


HOLDOUT_DATE_SQL = """
, start AS (SELECT d[greatest(1, CAST(floor(len(d) * CAST(0.8 AS DOUBLE)) AS INT)) + 1] AS test_start
           FROM (SELECT list_sort(list_distinct(list(journey_date))) AS d FROM observed)),
labelled AS (SELECT o.*, o.journey_date < start.test_start AS seen FROM observed o, start),
training AS (SELECT * EXCLUDE (seen) FROM labelled WHERE seen),
holdout AS (SELECT * EXCLUDE (seen) FROM labelled WHERE NOT seen),
means AS (SELECT train_number, station_code, avg(arrival_delay_minutes) AS prediction, count(*) AS observations
          FROM training GROUP BY ALL),
gm AS (SELECT avg(arrival_delay_minutes) FILTER (seen) AS global_mean FROM labelled),
scored AS (SELECT h.*, coalesce((SELECT avg(t.arrival_delay_minutes) FROM training t WHERE t.train_number = h.train_number
                                 AND t.station_code = h.station_code), (SELECT global_mean FROM gm)) AS prediction,
                  (SELECT global_mean FROM gm) AS global_mean FROM holdout h)
"""


@register("holdout_by_date", oracle(HOLDOUT_DATE_SQL + """
SELECT (SELECT test_start FROM start) AS test_start_date,
       (SELECT count(*) FROM training) AS training_rows, (SELECT count(*) FROM holdout) AS holdout_rows""",
                                    "observed"), "M3 A15")
def q_holdout_by_date(spark, sf_dir):
    fact = _shared_fact(spark, sf_dir)
    obs = fact.where(F.col("arrival_delay_minutes").isNotNull())
    start = baseline.holdout_start(fact)
    return spark.range(1).select(
        start.alias("test_start_date"),
        obs.where(F.col("journey_date") < start).agg(F.count(F.lit(1))).scalar().alias("training_rows"),
        obs.where(F.col("journey_date") >= start).agg(F.count(F.lit(1))).scalar().alias("holdout_rows"),
    )


# ----------------------------------------------------------------------- fit, predict, evaluate (M4-M8)
@register("baseline_fit", oracle(HOLDOUT_DATE_SQL + """
SELECT m.train_number, m.station_code, round(m.prediction, 6) AS prediction, m.observations,
       round(g.global_mean, 6) AS global_mean
FROM means m CROSS JOIN gm g""", "observed"), "M4")
def q_baseline_fit(spark, sf_dir):
    fact = _shared_fact(spark, sf_dir)
    obs = fact.where(F.col("arrival_delay_minutes").isNotNull())
    train = obs.where(F.col("journey_date") < baseline.holdout_start(fact))
    means, g = baseline.fit_means(train)
    return means.select("train_number", "station_code", E.round6(F.col("prediction")).alias("prediction"),
                        "observations", E.round6(g.select("global_mean").scalar()).alias("global_mean"))


@register("baseline_predict", oracle(HOLDOUT_DATE_SQL + """
SELECT train_number, journey_date, station_code, station_sequence, arrival_delay_minutes,
       round(prediction, 6) AS prediction FROM scored""", "observed"), "M5 J5 J6")
def q_baseline_predict(spark, sf_dir):
    fact = _shared_fact(spark, sf_dir)
    obs = fact.where(F.col("arrival_delay_minutes").isNotNull())
    start = baseline.holdout_start(fact)
    means, g = baseline.fit_means(obs.where(F.col("journey_date") < start))
    scored = baseline.predict(obs.where(F.col("journey_date") >= start), means, g)
    return scored.select(*STOP_KEYS, "arrival_delay_minutes", E.round6(F.col("prediction")).alias("prediction"))


EVAL_SQL = """
SELECT 'train_station_historical_mean' AS model_name, count(*) AS evaluation_rows,
       round(avg(abs(arrival_delay_minutes - prediction)), 6) AS mae,
       round(sqrt(avg(power(arrival_delay_minutes - prediction, 2))), 6) AS rmse,
       round(avg(abs(arrival_delay_minutes - global_mean)), 6) AS baseline_mae,
       coalesce(avg(abs(arrival_delay_minutes - prediction)) < avg(abs(arrival_delay_minutes - global_mean)), false)
           AS accepted_for_prediction
FROM scored"""


@register("baseline_evaluate", oracle(HOLDOUT_DATE_SQL + EVAL_SQL, "observed"), "M6 M7")
def q_baseline_evaluate(spark, sf_dir):
    return baseline.evaluate_holdout_by_date(_shared_fact(spark, sf_dir))


@register("model_evaluation_audit", oracle(HOLDOUT_DATE_SQL + f"""
SELECT e.*, '{baseline.MODEL_VERSION}' AS model_version, (SELECT test_start FROM start) AS test_start_date
FROM ({EVAL_SQL}) e""", "observed"), "K6 A16")
def q_model_evaluation_audit(spark, sf_dir):
    fact = _shared_fact(spark, sf_dir)
    row = baseline.evaluate_holdout_by_date(fact).select(
        "*", F.lit(baseline.MODEL_VERSION).alias("model_version"),
        baseline.holdout_start(fact).alias("test_start_date"))
    root = scratch_path(spark, "model_evaluation_audit")
    row.write.mode("append").parquet(root)  # the audit table is append-only: one row per evaluation
    return spark.read.parquet(root)


@register("prediction_summary", oracle(HOLDOUT_DATE_SQL + HOLDOUT_ROW_SQL + f"""
, tr AS (SELECT * FROM h WHERE split = 'train'), te AS (SELECT * FROM h WHERE split = 'test'),
means2 AS (SELECT train_number, station_code, avg(arrival_delay_minutes) AS prediction FROM tr GROUP BY 1, 2),
gm2 AS (SELECT avg(arrival_delay_minutes) AS global_mean FROM tr),
scored2 AS (SELECT t.*, coalesce(m.prediction, g.global_mean) AS prediction, g.global_mean
            FROM te t CROSS JOIN gm2 g
            LEFT JOIN means2 m ON t.train_number = m.train_number AND t.station_code = m.station_code)
SELECT 'ready' AS state, e.model_name, e.evaluation_rows, e.mae, e.rmse, e.baseline_mae, e.accepted_for_prediction
FROM ({EVAL_SQL.replace("FROM scored", "FROM scored2")}) e""", "observed"), "A16 P21 K6")
def q_prediction_summary(spark, sf_dir):
    """Two evaluations appended to the audit in turn (by date, then by row); the summary shows
    the newest. ``evaluated_at`` is when the row was written, so it is left out of the result."""
    fact = _shared_fact(spark, sf_dir)
    root = scratch_path(spark, "evaluation_audit")
    by_date = baseline.evaluate_holdout_by_date(fact).select(
        "*", F.lit("chronological_v1").alias("model_version"), F.localtimestamp().alias("evaluated_at"))
    by_date.write.mode("append").parquet(root)
    obs = fact.where(F.col("arrival_delay_minutes").isNotNull()).select(*STOP_KEYS, "arrival_delay_minutes")
    split = baseline.holdout_by_row(obs, ROW_ORDER)
    means, g = baseline.fit_means(split.where("split = 'train'"))
    by_row = baseline.evaluate(baseline.predict(split.where("split = 'test'"), means, g)).select(
        "*", F.lit("holdout_by_row_v1").alias("model_version"), F.localtimestamp().alias("evaluated_at"))
    by_row.write.mode("append").parquet(root)
    from delaylens.operators import kpi
    return kpi.prediction_summary(spark.read.parquet(root)).drop("last_successful_pipeline_at")


@register("baseline_report", oracle(HOLDOUT_ROW_SQL + """
, tr AS (SELECT * FROM h WHERE split = 'train'), te AS (SELECT * FROM h WHERE split = 'test'),
means AS (SELECT train_number, station_code, avg(arrival_delay_minutes) AS prediction FROM tr GROUP BY 1, 2),
gm AS (SELECT avg(arrival_delay_minutes) AS global_mean FROM tr),
scored AS (SELECT t.*, coalesce(m.prediction, g.global_mean) AS prediction, g.global_mean
           FROM te t CROSS JOIN gm g
           LEFT JOIN means m ON t.train_number = m.train_number AND t.station_code = m.station_code)
SELECT 'train_station_historical_mean' AS model_name, (SELECT count(*) FROM tr) AS train_rows,
       count(*) AS test_rows,
       round(avg(abs(arrival_delay_minutes - prediction)), 6) AS mae,
       round(sqrt(avg(power(arrival_delay_minutes - prediction, 2))), 6) AS rmse,
       round(avg(abs(arrival_delay_minutes - global_mean)), 6) AS global_mean_mae,
       avg(abs(arrival_delay_minutes - prediction)) < avg(abs(arrival_delay_minutes - global_mean))
           AS improves_on_global_mean
FROM scored""", "observed"), "M8 M2 M4 M5 M7")
def q_baseline_report(spark, sf_dir):
    obs = _observations(spark, sf_dir).select(*STOP_KEYS, "arrival_delay_minutes")
    split = baseline.holdout_by_row(obs, ROW_ORDER)
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    means, g = baseline.fit_means(train)
    ev = baseline.evaluate(baseline.predict(test, means, g))
    return ev.select(
        "model_name",
        train.agg(F.count(F.lit(1)).cast("long")).scalar().alias("train_rows"),
        F.col("evaluation_rows").alias("test_rows"),
        "mae", "rmse", F.col("baseline_mae").alias("global_mean_mae"),
        F.col("accepted_for_prediction").alias("improves_on_global_mean"),
    )


# ----------------------------------------------------------------------- history
@register("expanding_history", oracle("""
, daily AS (SELECT train_number, station_code, journey_date, sum(arrival_delay_minutes) AS s, count(*) AS observations
            FROM observed GROUP BY 1, 2, 3)
SELECT train_number, station_code, journey_date, observations,
       CAST(sum(observations) OVER w AS BIGINT) AS history_observations,
       round(sum(s) OVER w / sum(observations) OVER w, 6) AS historical_mean_delay_minutes
FROM daily
WINDOW w AS (PARTITION BY train_number, station_code ORDER BY CAST(journey_date - DATE '1970-01-01' AS BIGINT)
             RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", "observed"), "W7")
def q_expanding_history(spark, sf_dir):
    return baseline.expanding_history(from_fixtures(spark, sf_dir).fact_station_arrival)


# ----------------------------------------------------------------------- predictions
PRED_SQL = HOLDOUT_DATE_SQL + """
, preds AS (SELECT 'train_station_historical_mean' AS model_name, 'chronological_v1' AS model_version,
                   s.train_number, s.journey_date, s.station_code, s.station_sequence,
                   f.scheduled_arrival_at AS prediction_at, s.prediction AS predicted_arrival_delay_minutes,
                   f.previous_station_arrival_delay_minutes,
                   lag(f.actual_arrival_at) OVER (PARTITION BY f.train_number, f.journey_date
                                                  ORDER BY f.station_sequence, f.station_code) AS feature_freshness_at
            FROM fact f JOIN scored s ON f.train_number = s.train_number AND f.journey_date = s.journey_date
                 AND f.station_code = s.station_code AND f.station_sequence = s.station_sequence),
attached AS (SELECT p.*, f.arrival_delay_minutes AS actual_arrival_delay_minutes,
                    abs(f.arrival_delay_minutes - p.predicted_arrival_delay_minutes) AS absolute_error_minutes
             FROM preds p LEFT JOIN fact f ON p.train_number = f.train_number AND p.journey_date = f.journey_date
                  AND p.station_code = f.station_code AND p.station_sequence = f.station_sequence)
"""


def stored_predictions(spark, sf_dir):
    """Predictions as stored before actuals exist: holdout stops scored by the fitted means."""
    fact = _shared_fact(spark, sf_dir)
    obs = fact.where(F.col("arrival_delay_minutes").isNotNull())
    start = baseline.holdout_start(fact)
    means, g = baseline.fit_means(obs.where(F.col("journey_date") < start))
    w = Window.partitionBy("train_number", "journey_date").orderBy("station_sequence", "station_code")
    with_fresh = fact.select(*STOP_KEYS, "scheduled_arrival_at", "previous_station_arrival_delay_minutes",
                             F.lag("actual_arrival_at").over(w).alias("feature_freshness_at"))
    holdout = with_fresh.join(obs.where(F.col("journey_date") >= start).select(*STOP_KEYS), STOP_KEYS, "left_semi")
    scored = baseline.predict(holdout, means, g)
    preds = scored.select(
        F.lit(baseline.MODEL_NAME).alias("model_name"), F.lit(baseline.MODEL_VERSION).alias("model_version"),
        *STOP_KEYS, F.col("scheduled_arrival_at").alias("prediction_at"),
        F.col("prediction").alias("predicted_arrival_delay_minutes"),
        "previous_station_arrival_delay_minutes", "feature_freshness_at")
    return preds, fact


@register("prediction_actuals", oracle(PRED_SQL + """
SELECT model_name, model_version, train_number, journey_date, station_code, station_sequence,
       round(predicted_arrival_delay_minutes, 6) AS predicted_arrival_delay_minutes,
       actual_arrival_delay_minutes, round(absolute_error_minutes, 6) AS absolute_error_minutes
FROM attached""", "observed", "fact"), "J8")
def q_prediction_actuals(spark, sf_dir):
    preds, fact = stored_predictions(spark, sf_dir)
    a = baseline.attach_actuals(preds, fact)
    return a.select("model_name", "model_version", *STOP_KEYS,
                    E.round6(F.col("predicted_arrival_delay_minutes")).alias("predicted_arrival_delay_minutes"),
                    "actual_arrival_delay_minutes",
                    E.round6(F.col("absolute_error_minutes")).alias("absolute_error_minutes"))


@register("prediction_monitoring", oracle(PRED_SQL + """
SELECT model_name, model_version, CAST(prediction_at AS DATE) AS prediction_date, count(*) AS prediction_count,
       round(avg(CASE WHEN previous_station_arrival_delay_minutes IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6)
           AS previous_delay_null_percent,
       max(date_diff('minute', feature_freshness_at, prediction_at)) AS max_feature_age_minutes,
       count(actual_arrival_delay_minutes) AS evaluated_prediction_count,
       round(avg(abs(actual_arrival_delay_minutes - predicted_arrival_delay_minutes)), 6) AS mae_minutes,
       round(sqrt(avg(power(actual_arrival_delay_minutes - predicted_arrival_delay_minutes, 2))), 6) AS rmse_minutes
FROM attached GROUP BY 1, 2, 3""", "observed", "fact"), "A18")
def q_prediction_monitoring(spark, sf_dir):
    preds, fact = stored_predictions(spark, sf_dir)
    return baseline.prediction_monitoring(baseline.attach_actuals(preds, fact))


# ----------------------------------------------------------------------- weather enrichment
@register("weather_enrichment", oracle(WEATHER_SQL + """
, wd AS (SELECT station_code, weather_date, round(temperature_2m_mean, 6) AS temperature_2m_mean,
                round(precipitation_sum, 6) AS precipitation_sum, weather_code
         FROM wf WHERE error IS NULL QUALIFY row_number() OVER (PARTITION BY station_code, weather_date
                                                               ORDER BY request_id DESC) = 1)
SELECT f.train_number, f.journey_date, f.station_code, f.station_sequence, w.weather_date,
       CASE WHEN CAST(w.weather_date + 1 AS TIMESTAMP) <= f.scheduled_arrival_at THEN w.temperature_2m_mean END
           AS temperature_2m_mean,
       CASE WHEN CAST(w.weather_date + 1 AS TIMESTAMP) <= f.scheduled_arrival_at THEN w.precipitation_sum END
           AS precipitation_sum,
       CASE WHEN CAST(w.weather_date + 1 AS TIMESTAMP) <= f.scheduled_arrival_at THEN w.weather_code END
           AS weather_code
FROM fact f LEFT JOIN wd w ON f.station_code = w.station_code AND w.weather_date = f.journey_date - 1""",
                                       "weather_payload", "fact"), "J7 P18 S5")
def q_weather_enrichment(spark, sf_dir):
    from delaylens.operators.enrich import daily_weather, enrich_with_weather
    fact = from_fixtures(spark, sf_dir).fact_station_arrival
    return enrich_with_weather(fact, daily_weather(weather_rows(spark, sf_dir)), lag_days=1)


# ----------------------------------------------------------------------- incremental
INCR_SQL = f"""
, old_acc AS (SELECT * FROM running_accepted WHERE ingested_at < TIMESTAMP '{PREVIOUS_LOAD_CUTOFF}'),
old_stg AS (SELECT * EXCLUDE (rn) FROM (
   SELECT train_number, journey_date, station_code, station_sequence, scheduled_arrival_at, actual_arrival_at,
          CAST(CAST(arrival_delay_minutes AS DECIMAL(12,2)) AS DOUBLE) AS arrival_delay_minutes,
          source_record_hash, ingested_at,
          row_number() OVER (PARTITION BY train_number, journey_date, station_code, station_sequence
                             ORDER BY ingested_at DESC NULLS FIRST, source_record_hash DESC NULLS FIRST) AS rn
   FROM old_acc) x WHERE rn = 1),
old_fact AS (SELECT train_number, journey_date, station_code, station_sequence, source_record_hash, ingested_at,
                    lag(arrival_delay_minutes) OVER (PARTITION BY train_number, journey_date
                        ORDER BY station_sequence, station_code) AS previous_station_arrival_delay_minutes,
                    coalesce(arrival_delay_minutes, CASE WHEN actual_arrival_at IS NOT NULL AND scheduled_arrival_at IS NOT NULL
                        THEN CAST(date_diff('minute', date_trunc('minute', scheduled_arrival_at),
                                            date_trunc('minute', actual_arrival_at)) AS DOUBLE) END) AS arrival_delay_minutes
             FROM old_stg),
bound AS (SELECT coalesce(max(ingested_at), TIMESTAMP '1900-01-01') - INTERVAL 48 HOUR AS b FROM old_fact),
batch AS (SELECT train_number, journey_date, station_code, station_sequence, source_record_hash, ingested_at,
                 previous_station_arrival_delay_minutes, arrival_delay_minutes
          FROM fact WHERE ingested_at >= (SELECT b FROM bound))
"""
UPSERT_COLS = ["train_number", "journey_date", "station_code", "station_sequence", "source_record_hash",
               "ingested_at", "previous_station_arrival_delay_minutes", "arrival_delay_minutes"]


def _old_and_new_fact(spark, sf_dir):
    accepted = raw_running_from_fixture(spark, sf_dir)
    old = Models(accepted.where(F.col("ingested_at") < F.lit(PREVIOUS_LOAD_CUTOFF).cast("timestamp_ntz")))
    new = Models(accepted)
    return old.fact_station_arrival.select(*UPSERT_COLS), new.fact_station_arrival.select(*UPSERT_COLS)


@register("incremental_window", oracle(INCR_SQL + "SELECT * FROM batch", "running_accepted", "fact"), "P15 P14")
def q_incremental_window(spark, sf_dir):
    old, new = _old_and_new_fact(spark, sf_dir)
    return tables.incremental_window(new, old)


@register("upsert_fact", oracle(INCR_SQL + """
SELECT o.train_number, o.journey_date, o.station_code, o.station_sequence, o.source_record_hash, o.ingested_at,
       o.previous_station_arrival_delay_minutes, o.arrival_delay_minutes
FROM old_fact o WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.train_number = o.train_number
     AND b.journey_date = o.journey_date AND b.station_code = o.station_code AND b.station_sequence = o.station_sequence)
UNION ALL
SELECT * FROM batch""", "running_accepted", "fact"), "K2 R3 T14")
def q_upsert_fact(spark, sf_dir):
    from delaylens.plans.model_build import incremental_fact_batch
    accepted = raw_running_from_fixture(spark, sf_dir)
    root = scratch_path(spark, "fact_station_arrival")
    old = accepted.where(F.col("ingested_at") < F.lit(PREVIOUS_LOAD_CUTOFF).cast("timestamp_ntz"))
    table = tables.Bucketed(root, Models(old).fact_station_arrival.schema, "train_number", ("journey_date",))
    table.store(Models(table.dealt(old), dealt=True).fact_station_arrival)
    # Only journeys with a raw record in the 48 h window are rebuilt; only their dates are rewritten.
    stored = tables.Bucketed(scratch_path(spark, "fact-batch"), table.schema, table.key, table.partitions)
    stored.store(incremental_fact_batch(accepted, table.read(spark), table=table), table.buckets(spark))
    batch = stored.read(spark)
    tables.upsert_partitions(spark, root, scratch_path(spark, "fact_stage"), batch, batch.select(*STOP_KEYS),
                             STOP_KEYS, "journey_date", table)
    return spark.read.parquet(root).select(*UPSERT_COLS)


