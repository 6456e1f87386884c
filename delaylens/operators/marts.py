"""Dimensions, the station-arrival fact, the feature table and the analytics marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylens.functions import expressions as E

FACT_COLUMNS = [
    "train_number", "journey_date", "station_code", "station_sequence",
    "scheduled_arrival_at", "actual_arrival_at", "scheduled_departure_at", "actual_departure_at",
    "arrival_delay_minutes", "departure_delay_minutes", "previous_station_arrival_delay_minutes",
    "journey_status", "source_record_hash", "ingested_at",
]


# --------------------------------------------------------------------------- facts
def fact_station_arrival(enriched: DataFrame) -> DataFrame:
    """P10: reported delay, else the derived one. Full-refresh form; see tables.upsert for K2."""
    return enriched.select(
        *FACT_COLUMNS[:8],
        F.coalesce("arrival_delay_minutes", "derived_arrival_delay_minutes").alias("arrival_delay_minutes"),
        *FACT_COLUMNS[9:],
    )


def delay_features(fact: DataFrame) -> DataFrame:
    """M9: prediction-time features per stop (Sunday = 0 day of week)."""
    return fact.select(
        "train_number", "journey_date", "station_code", "station_sequence",
        F.col("scheduled_arrival_at").alias("prediction_at"),
        "previous_station_arrival_delay_minutes",
        E.day_of_week_sunday_zero("scheduled_arrival_at").alias("scheduled_arrival_day_of_week"),
        F.hour("scheduled_arrival_at").alias("scheduled_arrival_hour"),
        F.col("arrival_delay_minutes").alias("target_arrival_delay_minutes"),
    )


# --------------------------------------------------------------------------- dimensions
def dim_route_stop(stg_schedule: DataFrame) -> DataFrame:
    """Schedule projection."""
    return stg_schedule.select(
        "train_number", "station_code", "station_sequence", "journey_day_number", "distance_km",
        "schedule_arrival_time", "schedule_departure_time", "source_name",
        F.col("ingested_at").alias("record_updated_at"),
    )


def dim_station(stg_schedule: DataFrame) -> DataFrame:
    """One row per station: named rows first, then newest, then name ascending."""
    w = Window.partitionBy("station_code").orderBy(
        F.col("station_name").isNotNull().desc(),
        F.col("ingested_at").desc_nulls_first(),
        F.col("station_name").asc_nulls_last(),
    )
    return stg_schedule.select(
        "station_code", "station_name", "source_name",
        F.col("ingested_at").alias("record_updated_at"),
        F.row_number().over(w).alias("_rn"),
    ).where("_rn = 1").drop("_rn")


def dim_train(stg_schedule: DataFrame, latest_only: bool = False) -> DataFrame:
    """Distinct train attributes. ``latest_only`` keeps the newest row per train."""
    out = stg_schedule.select(
        "train_number", "train_name", "train_type",
        F.col("source_station_code").alias("origin_station_code"),
        "destination_station_code", "source_name",
        F.col("ingested_at").alias("record_updated_at"),
    ).distinct()
    if latest_only:
        w = Window.partitionBy("train_number").orderBy(F.col("record_updated_at").desc_nulls_first(),
                                                       F.col("train_name").asc_nulls_last())
        out = out.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    return out


# --------------------------------------------------------------------------- marts
def delay_summary(rows: DataFrame, *keys: str) -> DataFrame:
    """Per key: observations, exact mean and median delay, on-time and major-delay shares (%).

    Rows are first counted by (key, delay value), spread over all tasks with map-side counting, so a
    busy key meets in one task only as its distinct delays. The median is read off the running
    counts: the mean of the values that hold the two middle places.
    """
    hist = rows.groupBy(*keys, F.col("arrival_delay_minutes").cast("double").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    return summary_of_counts(hist, *keys)


def summary_of_counts(hist: DataFrame, *keys: str) -> DataFrame:
    """``delay_summary`` from the counts (``_n``) of each key's delay values (``_d``)."""
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("_d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = hist.withColumn("_to", F.sum("_n").over(upto)).withColumn("_all", F.sum("_n").over(whole))
    middle = lambda place: F.min(F.when(F.col("_to") > place, F.col("_d")))
    share = lambda cond: F.sum(F.when(cond, F.col("_n")).otherwise(0)) / F.sum("_n") * 100.0
    return placed.groupBy(*keys).agg(
        F.sum("_n").cast("long").alias("observations"),
        (F.sum(F.col("_d") * F.col("_n")) / F.sum("_n")).alias("mean"),
        ((middle(F.floor((F.col("_all") - 1) / 2)) + middle(F.floor(F.col("_all") / 2))) / 2).alias("median"),
        share(F.col("_d") <= E.ON_TIME_MAX_MINUTES).alias("on_time"),
        share(F.col("_d") > E.MAJOR_DELAY_MINUTES).alias("major"),
    )


def delay_measures() -> list:
    return [
        F.col("observations").alias("station_stop_observations"),
        E.round6(F.col("mean")).alias("average_arrival_delay_minutes"),
        E.round6(F.col("median")).alias("median_arrival_delay_minutes"),
        E.round6(F.col("on_time")).alias("on_time_or_early_percent"),
    ]


def observed(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("arrival_delay_minutes").isNotNull())


def mart_station_delay(fact: DataFrame) -> DataFrame:
    """A2: per station: observations, mean, exact median, on-time-or-early %."""
    return delay_summary(observed(fact), "station_code").select("station_code", *delay_measures())


def mart_train_punctuality(fact: DataFrame) -> DataFrame:
    """A3: per train: A2's measures plus the major-delay (> 60 min) share."""
    return delay_summary(observed(fact), "train_number").select(
        "train_number", *delay_measures(), E.round6(F.col("major")).alias("major_delay_percent"))


def mart_prediction_accuracy(predictions: DataFrame) -> DataFrame:
    """A4: per model and version: evaluated count, MAE, RMSE (nulls ignored)."""
    err = F.col("actual_arrival_delay_minutes") - F.col("predicted_arrival_delay_minutes")
    return predictions.groupBy("model_name", "model_version").agg(
        F.count_if(F.col("actual_arrival_delay_minutes").isNotNull()).cast("long").alias("evaluated_prediction_count"),
        E.round6(F.avg("absolute_error_minutes")).alias("mae_minutes"),
        E.round6(F.sqrt(F.avg(F.pow(err, 2)))).alias("rmse_minutes"),
    )
