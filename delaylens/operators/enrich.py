"""Weather enrichment (J7): daily station weather joined to stops, only when it was available
at prediction time (leakage rule of P18)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.functions import expressions as E


def daily_weather(rows: DataFrame) -> DataFrame:
    """One row per (station, day) from flattened payload rows (error rows left out).

    Several payloads may cover the same station-day: the one requested last holds, whole. Each measure is
    picked on its own, since numbers are aggregated by hash and a struct of them by sorting all rows; all see
    the same rows in the same order, so of several with the last number they pick the same one.
    """
    latest = rows.where(F.col("error").isNull()).groupBy("station_code", "weather_date").agg(
        *[F.max_by(c, "request_id").alias(c) for c in ("temperature_2m_mean", "precipitation_sum", "weather_code")])
    return latest.select("station_code", "weather_date", E.round6(F.col("temperature_2m_mean")).alias("temperature_2m_mean"),
                         E.round6(F.col("precipitation_sum")).alias("precipitation_sum"), "weather_code")


def enrich_with_weather(fact: DataFrame, weather: DataFrame, lag_days: int = 1) -> DataFrame:
    """Stops + the weather of ``journey_date - lag_days`` at the stop's station.

    A day's weather is complete at the end of that day; features are nulled when that moment
    is after the stop's prediction time (scheduled arrival), so ``lag_days=0`` yields no
    same-day weather and ``lag_days=1`` the last complete day. The weather side is one row per
    station-day (stations x days), joined on (station, date) without multiplying stops.
    """
    w = weather.select(F.col("station_code").alias("_w_station"), "weather_date", "temperature_2m_mean",
                       "precipitation_sum", "weather_code")
    stops = fact.select("train_number", "journey_date", "station_code", "station_sequence", "scheduled_arrival_at",
                        F.date_sub("journey_date", lag_days).alias("_weather_date"))
    joined = stops.join(w, (F.col("station_code") == F.col("_w_station"))
                        & (F.col("_weather_date") == F.col("weather_date")), "left")
    available = F.col("weather_date").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY") <= F.col("scheduled_arrival_at")
    return joined.select(
        "train_number", "journey_date", "station_code", "station_sequence", "weather_date",
        *[F.when(available, F.col(c)).alias(c) for c in ("temperature_2m_mean", "precipitation_sum", "weather_code")],
    )
