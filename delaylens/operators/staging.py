"""Staging and intermediate models: latest record per natural key, previous-stop delay, derived delay."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylens.functions import expressions as E
from delaylens.operators import tables

RUNNING_KEY = ["train_number", "journey_date", "station_code", "station_sequence"]
SCHEDULE_KEY = ["train_number", "station_code", "station_sequence"]
JOURNEY_KEY = ["train_number", "journey_date"]


def latest_per_key(df: DataFrame, keys: list[str],
                   order_by: tuple[str, ...] = ("ingested_at", "source_record_hash")) -> DataFrame:
    """``row_number() over (partition by keys order by ... desc) = 1``.

    Nulls sort as the largest value (the warehouse rule), hence ``desc_nulls_first``.
    Catalyst turns the filter into a WindowGroupLimit whose partial step keeps one row per
    key in every map task before the shuffle, so a key with many corrections is collapsed
    early instead of landing whole in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order_by])
    return df.withColumn("_row_number", F.row_number().over(w)) \
             .where(F.col("_row_number") == 1).drop("_row_number")


def _ts(c: str, df: DataFrame):
    return (F.col(c) if c in df.columns else F.lit(None)).cast("timestamp_ntz").alias(c)


def _delay(c: str, df: DataFrame):
    # number(12,2) at rest, carried as double so aggregates stay double.
    return (F.col(c) if c in df.columns else F.lit(None)).try_cast("decimal(12,2)").cast("double").alias(c)


def stg_train_running(raw: DataFrame, dealt: bool = False, by_date: bool = False) -> DataFrame:
    """Typed raw running events, latest record per (train, date, station, sequence).

    ``dealt``: the rows of a journey lie in one task already (a table in buckets of the train).
    ``by_date``: rows are dealt in ranges of date and train, so a task holds few dates, for a write partitioned by them.
    """
    typed = raw.select(
        F.col("train_number").cast("string").alias("train_number"),
        F.col("journey_date").cast("date").alias("journey_date"),
        F.col("station_code").cast("string").alias("station_code"),
        F.col("station_sequence").cast("int").alias("station_sequence"),
        _ts("scheduled_arrival_at", raw),
        _ts("actual_arrival_at", raw),
        _ts("scheduled_departure_at", raw),
        _ts("actual_departure_at", raw),
        _delay("arrival_delay_minutes", raw),
        _delay("departure_delay_minutes", raw),
        F.col("status").cast("string").alias("journey_status"),
        "source_record_hash",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
    )
    # Dealt by journey, which serves this window and that of the previous stop (W5) alike.
    if by_date:
        typed = tables.dealt(typed, "journey_date", "train_number", ranges=True)
    elif not dealt:
        typed = tables.dealt(typed, *JOURNEY_KEY)
    return latest_per_key(typed, RUNNING_KEY)


def stg_train_schedule(raw: DataFrame, packed: bool = False) -> DataFrame:
    """Typed raw schedule stops, latest record per (train, station, sequence).

    ``packed``: the hash travels as bytes; a key's records are then collapsed in its task only.
    """
    typed = raw.select(
        F.col("train_number").cast("string").alias("train_number"),
        F.col("train_name").cast("string").alias("train_name"),
        F.col("train_type").cast("string").alias("train_type"),
        F.col("source_station_code").cast("string").alias("source_station_code"),
        F.col("destination_station_code").cast("string").alias("destination_station_code"),
        F.col("station_code").cast("string").alias("station_code"),
        F.col("station_name").cast("string").alias("station_name"),
        F.col("station_sequence").cast("int").alias("station_sequence"),
        F.col("schedule_arrival_time").cast("string").alias("schedule_arrival_time"),
        F.col("schedule_departure_time").cast("string").alias("schedule_departure_time"),
        F.col("journey_day_number").cast("int").alias("journey_day_number"),
        F.col("distance_km").try_cast("decimal(12,2)").cast("double").alias("distance_km"),
        "source_name",
        "source_record_hash",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
    )
    return latest_per_key(tables.dealt(typed, *SCHEDULE_KEY) if packed else typed, SCHEDULE_KEY)


def int_train_running_enriched(stg: DataFrame) -> DataFrame:
    """W5 + P9: previous stop's reported delay within the journey, and the derived delay.

    ``lag`` runs over (train, date) ordered by sequence with station code as tie-break (two
    stations may share a sequence). After W1 a journey holds one row per stop, so a window
    partition is bounded by the stops of one journey.
    """
    w = Window.partitionBy(*JOURNEY_KEY).orderBy(F.col("station_sequence").asc_nulls_last(),
                                                 F.col("station_code").asc_nulls_last())
    return stg.select(
        "*",
        F.lag("arrival_delay_minutes").over(w).alias("previous_station_arrival_delay_minutes"),
        F.when(F.col("actual_arrival_at").isNotNull() & F.col("scheduled_arrival_at").isNotNull(),
               E.minutes_between("scheduled_arrival_at", "actual_arrival_at").cast("double"))
         .alias("derived_arrival_delay_minutes"),
    )
