"""Registered queries: incremental runs in several batches, equal to the full build."""

from __future__ import annotations

from pyspark.sql import functions as F

from delaylens.operators import tables
from delaylens.plans import incremental as I
from delaylens.plans.catalog import register
from delaylens.plans.model_build import from_fixtures, raw_running_from_fixture
from delaylens.plans.oracle_views import oracle
from delaylens.plans.queries_model import PRED_SQL, STOP_KEYS, stored_predictions
from delaylens.session import scratch_path
from delaylens.functions import expressions as E

#: Ends of the batches by load time; what comes later is the last batch.
BATCH_ENDS = ["1995-01-01 00:00:00", "1997-06-01 00:00:00"]


def _batches(spark, sf_dir):
    rows = raw_running_from_fixture(spark, sf_dir)  # a batch reads its own load times only
    at = sum((F.when(F.col("ingested_at") >= F.lit(end).cast("timestamp_ntz"), 1).otherwise(0) for end in BATCH_ENDS), F.lit(0))
    return [rows.where(at == k) for k in range(len(BATCH_ENDS) + 1)]


def _fed(spark, sf_dir, consume):
    t = I.IncrementalTables(scratch_path(spark, "incremental"), buckets=8)
    for k, batch in enumerate(_batches(spark, sf_dir)):
        consume(t, I.apply_batch(spark, t, batch, k), k)
    return t


@register("incremental_features", oracle("SELECT * FROM features", "features"), "K5 M9 T14")
def q_incremental_features(spark, sf_dir):
    t = _fed(spark, sf_dir, lambda t, feed, k: I.update_features(spark, t, feed, k))
    return spark.read.parquet(t.path("features"))


def _mart(spark, sf_dir, key, *columns):
    t = _fed(spark, sf_dir, lambda t, feed, k: I.update_mart(spark, t, feed, key, k))
    return spark.read.parquet(t.path(f"mart_{key}")).select(key, *columns)


_MEASURES = ["station_stop_observations", "average_arrival_delay_minutes", "median_arrival_delay_minutes", "on_time_or_early_percent"]
_MEASURES_SQL = """count(*) AS station_stop_observations, round(avg(arrival_delay_minutes), 6) AS average_arrival_delay_minutes,
       round(median(arrival_delay_minutes), 6) AS median_arrival_delay_minutes,
       round(avg(CASE WHEN arrival_delay_minutes <= 0 THEN 1.0 ELSE 0.0 END) * 100, 6) AS on_time_or_early_percent"""


@register("incremental_station_delay", oracle(f"SELECT station_code, {_MEASURES_SQL} FROM observed GROUP BY station_code", "observed"),
          "K5 A2")
def q_incremental_station_delay(spark, sf_dir):
    return _mart(spark, sf_dir, "station_code", *_MEASURES)


@register("incremental_train_punctuality", oracle(f"""
SELECT train_number, {_MEASURES_SQL},
       round(avg(CASE WHEN arrival_delay_minutes > 60 THEN 1.0 ELSE 0.0 END) * 100, 6) AS major_delay_percent
FROM observed GROUP BY train_number""", "observed"), "K5 A3")
def q_incremental_train_punctuality(spark, sf_dir):
    return _mart(spark, sf_dir, "train_number", *_MEASURES, "major_delay_percent")


@register("incremental_daily_trend", oracle("""
SELECT journey_date, count(*) AS observations, round(avg(arrival_delay_minutes), 6) AS average_delay_minutes,
       round(median(arrival_delay_minutes), 6) AS median_delay_minutes FROM observed GROUP BY journey_date""", "observed"), "K5 A7")
def q_incremental_daily_trend(spark, sf_dir):
    return _mart(spark, sf_dir, "journey_date", F.col("station_stop_observations").alias("observations"),
                 F.col("average_arrival_delay_minutes").alias("average_delay_minutes"),
                 F.col("median_arrival_delay_minutes").alias("median_delay_minutes"))


@register("carried_history", oracle("""
, daily AS (SELECT train_number, station_code, journey_date, sum(arrival_delay_minutes) AS s, count(*) AS observations
            FROM observed GROUP BY 1, 2, 3)
SELECT train_number, station_code, journey_date, observations,
       CAST(sum(observations) OVER w AS BIGINT) AS history_observations,
       round(sum(s) OVER w / sum(observations) OVER w, 6) AS historical_mean_delay_minutes
FROM daily
WINDOW w AS (PARTITION BY train_number, station_code ORDER BY CAST(journey_date - DATE '1970-01-01' AS BIGINT)
             RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", "observed"), "K5 W7")
def q_carried_history(spark, sf_dir):
    """Six runs of five days each."""
    fact = from_fixtures(spark, sf_dir).fact_station_arrival.select("train_number", "station_code", "journey_date", "arrival_delay_minutes")
    fact = tables.materialized(fact, "history-fact")
    t = I.IncrementalTables(scratch_path(spark, "history"), buckets=8)
    for k in range(6):
        five = F.floor((F.dayofmonth("journey_date") - 1) / 5) == k
        I.carry_history(spark, t, fact.where(five), k)
    return spark.read.parquet(t.path("history"))


@register("late_actuals", oracle(PRED_SQL + """
SELECT model_name, model_version, train_number, journey_date, station_code, station_sequence,
       round(predicted_arrival_delay_minutes, 6) AS predicted_arrival_delay_minutes,
       actual_arrival_delay_minutes, round(absolute_error_minutes, 6) AS absolute_error_minutes
FROM attached""", "observed", "fact"), "J8 K5")
def q_late_actuals(spark, sf_dir):
    """Predictions are stored open; three batches of facts close them."""
    predictions, fact = stored_predictions(spark, sf_dir)
    t = I.IncrementalTables(scratch_path(spark, "late-actuals"), buckets=8)
    I.open_predictions(predictions, t, 0)
    for k in range(3):
        feed = fact.where(F.pmod(F.hash("train_number", "journey_date"), F.lit(3)) == k).withColumn("change", F.lit(1))
        I.close_predictions(spark, t, feed, k, predictions.schema)
    return I.evaluated_predictions(spark, t, predictions.schema).select(
        "model_name", "model_version", *STOP_KEYS, E.round6(F.col("predicted_arrival_delay_minutes")).alias("predicted_arrival_delay_minutes"),
        "actual_arrival_delay_minutes", E.round6(F.col("absolute_error_minutes")).alias("absolute_error_minutes"))
