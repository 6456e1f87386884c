"""Semi-structured payloads: live status snapshots (S4) and daily weather arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.functions import expressions as E

LIVE_STATUS_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("trainNumber", T.StringType()),
        T.StructField("startDate", T.StringType()),
        T.StructField("lastUpdatedAt", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("delayMinutes", T.DoubleType()),
        T.StructField("currentLocation", T.StructType([T.StructField("stationCode", T.StringType())])),
        T.StructField("nextHalt", T.StructType([
            T.StructField("stationCode", T.StringType()),
            T.StructField("stationName", T.StringType()),
        ])),
    ])),
])

WEATHER_SCHEMA = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("daily", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m_mean", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation_sum", T.ArrayType(T.DoubleType())),
        T.StructField("rain_sum", T.ArrayType(T.DoubleType())),
        T.StructField("weather_code", T.ArrayType(T.IntegerType())),
    ])),
])

SNAPSHOT_HASH_COLUMNS = sorted([
    "train_number", "journey_date", "provider_updated_at", "journey_status", "delay_minutes",
    "current_station_code", "next_station_code", "next_station_name", "retrieved_at",
])


def flatten_live_status(payloads: DataFrame) -> DataFrame:
    """HTTP-200 payloads -> nine snapshot columns + content hash.

    Null-safe on ``currentLocation`` / ``nextHalt``; the train number falls back to the
    requested one. Non-200 responses are dropped here and counted by ``live_status_counts``.
    """
    # Parsed in a step of its own: named in each column, the payload would be parsed for each.
    ok = payloads.where(F.col("http_status") == 200).select(
        "requested_train_number", "retrieved_at", F.from_json("payload", LIVE_STATUS_SCHEMA).getField("data").alias("data"))
    p = F.col("data")
    flat = ok.select(
        F.coalesce(E.blank_to_null(p.getField("trainNumber")), F.col("requested_train_number")).alias("train_number"),
        p.getField("startDate").try_cast("date").alias("journey_date"),
        p.getField("lastUpdatedAt").alias("provider_updated_at"),
        p.getField("status").alias("journey_status"),
        p.getField("delayMinutes").alias("delay_minutes"),
        p.getField("currentLocation").getField("stationCode").alias("current_station_code"),
        p.getField("nextHalt").getField("stationCode").alias("next_station_code"),
        p.getField("nextHalt").getField("stationName").alias("next_station_name"),
        F.col("retrieved_at").cast("timestamp_ntz").alias("retrieved_at"),
    )
    # Timestamps are hashed in a fixed microsecond format (a plain cast drops trailing zeros).
    parts = [F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") if c == "retrieved_at" else F.col(c)
             for c in SNAPSHOT_HASH_COLUMNS]
    return flat.withColumn("source_record_hash", E.record_hash(*parts))


def response_counts() -> list[Column]:
    return [F.count_if(F.col("http_status") == 200).cast("long").alias("received"),
            F.count_if(F.col("http_status") != 200).cast("long").alias("rejected")]


def live_status_counts(payloads: DataFrame) -> DataFrame:
    """received = HTTP 200 responses; rejected = the others (the archive's definition, T20)."""
    return payloads.agg(*response_counts())


def flatten_weather(payloads: DataFrame, key_cols: list[str]) -> DataFrame:
    """Parallel daily arrays -> one row per day; a payload without ``daily`` is an error row.

    ``arrays_zip`` + ``inline`` keep the arrays aligned by position (generator in codegen, no
    Python). Error rows come out with ``error`` set and null measures.
    """
    parsed = payloads.select(*key_cols, F.from_json("payload", WEATHER_SCHEMA).alias("p"))
    daily = F.col("p.daily")
    zipped = F.arrays_zip(
        daily.getField("time").alias("day"),
        daily.getField("temperature_2m_mean").alias("temperature_2m_mean"),
        daily.getField("precipitation_sum").alias("precipitation_sum"),
        daily.getField("rain_sum").alias("rain_sum"),
        daily.getField("weather_code").alias("weather_code"),
    )
    # One pass: ``inline_outer`` emits a single all-null row for a payload without arrays.
    return parsed.select(
        *key_cols,
        F.when(daily.isNull(), F.lit("response lacks daily weather data")).alias("error"),
        F.inline_outer(zipped),
    ).select(
        *key_cols,
        F.col("day").try_cast("date").alias("weather_date"),
        "temperature_2m_mean", "precipitation_sum", "rain_sum", "weather_code", "error",
    )
