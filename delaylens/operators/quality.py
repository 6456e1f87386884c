"""Data-quality checks (Q1-Q7), layer reconciliation (A12) and the leakage guard.

Every check is one aggregate (or one anti join) returning failing counts, so the whole report
is a handful of scans with partial aggregation; no check collects rows to the driver.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.operators.tables import on_dates

# The declared not-null columns per model and the uniqueness keys.
NOT_NULL_COLUMNS = {
    "stg_train_running": ["train_number", "journey_date", "station_code", "station_sequence"],
    "raw_train_running_events": ["train_number", "journey_date", "station_code", "source_record_hash"],
    "dim_train": ["train_number"],
    "dim_station": ["station_code"],
    "fact_station_arrival": ["train_number", "journey_date", "station_code"],
}
UNIQUE_COLUMNS = {"dim_train": "train_number", "dim_station": "station_code"}
UNIQUE_COMBINATIONS = {
    "dim_route_stop": ["train_number", "station_code", "station_sequence"],
    "fact_station_arrival": ["train_number", "journey_date", "station_code", "station_sequence"],
}

REPORT_SCHEMA = "test_name string, severity string, failed_count long, status string"


def not_null_failures(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """Q1: one row per column with the count of nulls (one aggregate for all columns)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in columns])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(f"not_null_{model}_{c}").alias("test_name"), F.col(c).alias("failed_count"))
        for c in columns])))


def unique_failures(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """Q2/Q3: number of key values that occur more than once (partial aggregation on the key)."""
    dupes = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    name = ("unique_" if len(columns) == 1 else "unique_combination_") + model + "_" + "_".join(columns)
    return dupes.agg(F.count(F.lit(1)).cast("long").alias("failed_count")) \
                .select(F.lit(name).alias("test_name"), "failed_count")


def actual_without_schedule(stg: DataFrame) -> DataFrame:
    """Q4: staged rows with an actual arrival but no scheduled one."""
    return stg.where(F.col("actual_arrival_at").isNotNull() & F.col("scheduled_arrival_at").isNull())


def nonpositive_sequence(stg: DataFrame) -> DataFrame:
    """Q5: staged rows with sequence <= 0."""
    return stg.where(F.col("station_sequence") <= 0)


def fact_without_schedule(fact: DataFrame, route_stops: DataFrame) -> DataFrame:
    """Fact rows without a matching schedule stop (``left_anti`` on three keys)."""
    keys = ["train_number", "station_code", "station_sequence"]
    return fact.join(route_stops.select(*keys).distinct(), keys, "left_anti")


def _count(name: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).cast("long").alias("failed_count")) \
               .select(F.lit(name).alias("test_name"), "failed_count")


def quality_report(models: dict[str, DataFrame]) -> DataFrame:
    """Q7: all 20 declared tests as rows: name, severity, failed count, pass/fail."""
    parts: list[DataFrame] = []
    for model, cols in NOT_NULL_COLUMNS.items():
        parts.append(not_null_failures(models[model], model, cols))
    for model, col in UNIQUE_COLUMNS.items():
        parts.append(unique_failures(models[model], model, [col]))
    for model, cols in UNIQUE_COMBINATIONS.items():
        parts.append(unique_failures(models[model], model, cols))
    parts.append(_count("assert_actual_arrival_has_schedule", actual_without_schedule(models["stg_train_running"])))
    parts.append(_count("assert_positive_station_sequence", nonpositive_sequence(models["stg_train_running"])))
    parts.append(_count("assert_running_fact_references_schedule_stop",
                        fact_without_schedule(models["fact_station_arrival"], models["dim_route_stop"])))
    report = reduce(DataFrame.unionByName, parts)
    return report.select(
        "test_name",
        F.lit("error").alias("severity"),
        "failed_count",
        F.when(F.col("failed_count") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
    )


def reconcile_layers(source: DataFrame, checked: DataFrame, staging: DataFrame, mart: DataFrame,
                     key: str = "source_record_hash") -> DataFrame:
    """source = raw + rejected + duplicate and staging >= mart, as one row.

    Each count is its own aggregate, combined as scalar subqueries on a one-row frame (no
    join); ``assert_true`` in ``strict`` callers can fail the job on a negative count.
    """
    valid = checked.where(F.col("rules_ok"))
    src = source.agg(F.count(F.lit(1)).cast("long")).scalar()
    raw = valid.agg(F.count_distinct(key).cast("long")).scalar()
    rej = checked.where(~F.col("rules_ok")).agg(F.count(F.lit(1)).cast("long")).scalar()
    dup = valid.agg((F.count(F.lit(1)) - F.count_distinct(key)).cast("long")).scalar()
    stg = staging.agg(F.count(F.lit(1)).cast("long")).scalar()
    mrt = mart.agg(F.count(F.lit(1)).cast("long")).scalar()
    spark = SparkSession.getActiveSession()
    row = spark.range(1).select(
        src.alias("source_count"), raw.alias("raw_count"), rej.alias("rejected_count"),
        dup.alias("duplicate_count"), stg.alias("staging_count"), mrt.alias("mart_count"))
    return row.select(
        "*",
        (F.col("source_count") == F.col("raw_count") + F.col("rejected_count") + F.col("duplicate_count"))
        .alias("accounted_for"),
        (F.col("staging_count") >= F.col("mart_count")).alias("transformations_complete"),
    )


def reconcile_counts(counts: DataFrame) -> DataFrame:
    """A12 on given counters (one row): adds the two flags; a negative count fails the job."""
    cols = ["source_count", "raw_count", "staging_count", "mart_count", "rejected_count", "duplicate_count"]
    nonneg = reduce(lambda a, b: a & b, [F.col(c) >= 0 for c in cols])
    return counts.select(
        F.coalesce(F.assert_true(nonneg, F.lit("a layer has a count below zero")),
                   F.col("source_count")).alias("source_count"),
        *cols[1:],
        (F.col("source_count") == F.col("raw_count") + F.col("rejected_count") + F.col("duplicate_count"))
        .alias("accounted_for"),
        (F.col("staging_count") >= F.col("mart_count")).alias("transformations_complete"),
    )


def leakage_violations(df: DataFrame, observed_at: str | Column, prediction_at: str | Column,
                       strict: bool = False) -> DataFrame:
    """Rows whose feature was observed after the prediction time (null observed passes)."""
    obs = F.col(observed_at) if isinstance(observed_at, str) else observed_at
    pred = F.col(prediction_at) if isinstance(prediction_at, str) else prediction_at
    bad = df.where(obs.isNotNull() & (obs > pred))
    obs_name = observed_at if isinstance(observed_at, str) else "feature_observed_at"
    if strict:
        n = bad.agg(F.count(F.lit(1))).scalar()
        bad = bad.withColumn(obs_name, F.coalesce(F.assert_true(n == 0, F.lit(
            "leakage: a feature was seen later than its prediction")), obs))
    return bad


# --------------------------------------------------------------------------- audit tables
#: Models whose tests are kept per journey date, and the columns of their key tests.
DATED_KEYS = {"stg_train_running": ["train_number", "journey_date", "station_code", "station_sequence"],
              "fact_station_arrival": ["train_number", "journey_date", "station_code", "station_sequence"]}


def dated_report(models: dict[str, DataFrame], days: list) -> DataFrame:
    """Q1 and Q3 to Q6 per journey date, for the given dates only (None: rows without one): journey_date,
    test_name, severity, failed_row_count, status. Only the partitions of these dates are read; a date
    without rows in a model passes nothing there and has no row.
    """
    parts = []
    for model, keys in DATED_KEYS.items():
        rows = models[model].where(on_dates("journey_date", days))
        checks = [(f"not_null_{model}_{c}", F.col(c).isNull()) for c in NOT_NULL_COLUMNS.get(model, []) if c != "journey_date"]
        if model == "stg_train_running":
            checks += [("assert_actual_arrival_has_schedule", F.col("actual_arrival_at").isNotNull() & F.col("scheduled_arrival_at").isNull()),
                       ("assert_positive_station_sequence", F.col("station_sequence") <= 0)]
        counts = rows.groupBy("journey_date").agg(*[F.count_if(cond).cast("long").alias(name) for name, cond in checks])
        parts.append(counts.select("journey_date", F.inline(F.array(*[
            F.struct(F.lit(name).alias("test_name"), F.col(name).alias("failed_row_count")) for name, _ in checks]))))
        repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).groupBy("journey_date").agg(
            F.count_if(F.col("_n") > 1).cast("long").alias("failed_row_count"))
        parts.append(repeated.select("journey_date", F.lit("unique_combination_" + model + "_" + "_".join(keys)).alias("test_name"),
                                     "failed_row_count"))
    fact = models["fact_station_arrival"].where(on_dates("journey_date", days))
    stops = models["dim_route_stop"].select("train_number", "station_code", "station_sequence").distinct().withColumn("_stop", F.lit(True))
    orphans = fact.join(stops, ["train_number", "station_code", "station_sequence"], "left").groupBy("journey_date").agg(
        F.count_if(F.col("_stop").isNull()).cast("long").alias("failed_row_count"))
    parts.append(orphans.select("journey_date", F.lit("assert_running_fact_references_schedule_stop").alias("test_name"), "failed_row_count"))
    return reduce(DataFrame.unionByName, parts).select(
        "journey_date", "test_name", F.lit("error").alias("severity"), "failed_row_count",
        F.when(F.col("failed_row_count") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))


def append_results(report: DataFrame, root: str, run_id: str, checked_at: dt.datetime) -> None:
    """Append a run's results to the quality audit: quality_check_id, checked_at and the report's
    columns in the run's own partition, which a repeated run replaces."""
    name = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("journey_date", "test_name") if c in report.columns]
    rows = report.select(F.concat_ws("/", F.lit(run_id), *name).alias("quality_check_id"), "*",
                         F.lit(checked_at).cast("timestamp_ntz").alias("checked_at"), F.lit(run_id).alias("run_id"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(root)


def append_reconciliation(counts: DataFrame, root: str, run_id: str, dataset: str, reconciled_at: dt.datetime) -> None:
    """Append a run's layer counts (A12) and their status to the reconciliation audit."""
    ok = F.col("accounted_for") & F.col("transformations_complete")
    rows = counts.select(F.lit(f"{run_id}/{dataset}").alias("reconciliation_id"), F.lit(dataset).alias("dataset"), "source_count",
                         "raw_count", "staging_count", "mart_count", "rejected_count", "duplicate_count",
                         F.when(ok, F.lit("pass")).otherwise(F.lit("fail")).alias("status"),
                         F.lit(reconciled_at).cast("timestamp_ntz").alias("reconciled_at"), F.lit(run_id).alias("run_id"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(root)
