"""Model build graph: raw -> staging -> intermediate -> dimensions / fact / features / marts.

Each model is a lazy DataFrame, so Catalyst plans staging + intermediate + fact + a mart as
one query (views inline, filters and column pruning reach the scan). ``materialize`` writes a
model as a table version when a job wants to cut lineage.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from delaylens.operators import ingest, marts, staging, tables
from delaylens.plans.load_run import counts
from delaylens.sources import fixtures


@dataclass
class Models:
    raw_running: DataFrame
    raw_schedule: DataFrame | None = None
    #: The raw rows of a journey lie in one task already.
    dealt: bool = False
    #: Rows are dealt for writing every model: running events in ranges of date and train, keys as bytes.
    for_writing: bool = False

    @cached_property
    def stg_train_running(self) -> DataFrame:
        return staging.stg_train_running(self.raw_running, self.dealt, self.for_writing)

    @cached_property
    def int_train_running_enriched(self) -> DataFrame:
        return staging.int_train_running_enriched(self.stg_train_running)

    @cached_property
    def fact_station_arrival(self) -> DataFrame:
        return marts.fact_station_arrival(self.int_train_running_enriched)

    @cached_property
    def delay_features(self) -> DataFrame:
        return marts.delay_features(self.fact_station_arrival)

    @cached_property
    def stg_train_schedule(self) -> DataFrame:
        if self.raw_schedule is None:
            raise ValueError("no raw schedule given")
        return staging.stg_train_schedule(self.raw_schedule, self.for_writing)

    @cached_property
    def dim_route_stop(self) -> DataFrame:
        return marts.dim_route_stop(self.stg_train_schedule)

    @cached_property
    def dim_station(self) -> DataFrame:
        return marts.dim_station(self.stg_train_schedule)

    @cached_property
    def dim_train(self) -> DataFrame:
        return marts.dim_train(self.stg_train_schedule)

    @cached_property
    def mart_station_delay(self) -> DataFrame:
        return marts.mart_station_delay(self.fact_station_arrival)

    @cached_property
    def mart_train_punctuality(self) -> DataFrame:
        return marts.mart_train_punctuality(self.fact_station_arrival)

    def materialized(self, *names: str) -> "Models":
        """Write the named models (in order) as Parquet and use the written copies from here on.

        For jobs that read a model several times (the data tests, the holdout evaluation):
        the model is computed once, written below the shared checkpoint folder (lineage cut, so
        a lost executor re-reads it instead of re-running the scan and the windows), and the
        models built on it are derived from the written copy.
        """
        for name in names:
            self.__dict__[name] = tables.materialized(getattr(self, name), name)
        return self


def raw_running_from_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw running-event table for a fixture load: the rows that pass the contract.

    Exact duplicates stay in (the raw table's hash de-duplication is the load's K1 step); the
    staging model's latest-per-key selection collapses them anyway, so the model path skips
    the extra shuffle on the hash.
    """
    accepted, _rejected = ingest.validate(fixtures.load(spark, sf_dir, "running_raw"))
    return accepted


def from_fixtures(spark: SparkSession, sf_dir: str, schedule: str = "schedule_raw", validated: bool = True) -> Models:
    """Models over the fixtures; unvalidated raw rows are for the checks that look for their faults."""
    return Models(
        raw_running=raw_running_from_fixture(spark, sf_dir) if validated else fixtures.load(spark, sf_dir, "running_raw"),
        raw_schedule=fixtures.load(spark, sf_dir, schedule),
    )


# Materialization of each model (K5): views stay lazy, tables are written, the fact and the
# features are incremental (upserted by key, partitioned by journey date).
MATERIALIZATION = {
    "stg_train_running": "view",
    "stg_train_schedule": "view",
    "int_train_running_enriched": "view",
    "dim_train": "table",
    "dim_station": "table",
    "dim_route_stop": "table",
    "fact_station_arrival": "incremental",
    "delay_features": "incremental",
    "mart_station_delay": "table",
    "mart_train_punctuality": "table",
}


def materialize(spark: SparkSession, models: Models, root: str) -> DataFrame:
    """Write every table / incremental model under ``root`` and report rows per model.

    The fact is written first (partitioned by journey date) and the models built on it
    (features, marts) are read back from the written fact, so lineage is cut at the fact and a
    lost executor recomputes from the written table, not from the raw scan. Running events are dealt
    once, in ranges of date and train, which serve the windows and the write alike; the views between
    them and the fact are counted in the tasks that write it. The schedule's staging, which every
    dimension reads, is written once. Returns (model, materialization, rows).
    """
    base = root.rstrip("/")
    models = Models(models.raw_running, models.raw_schedule, for_writing=True)
    # No dimension reads the hash, which chooses the latest record.
    models.__dict__["stg_train_schedule"] = tables.materialized(models.stg_train_schedule.drop("source_record_hash"), "stg_train_schedule")
    passed = {name: Observation() for name in ("stg_train_running", "int_train_running_enriched")}
    for name, seen in passed.items():
        models.__dict__[name] = getattr(models, name).observe(seen, F.count(F.lit(1)).alias("rows"))

    def write(df: DataFrame, name: str, *partition_cols: str) -> DataFrame:
        # A task holds few dates, each with a writer of its own; rows are sorted by date only where there are more.
        with tables.session_conf(spark, spark__sql__maxConcurrentOutputFileWriters="8"):
            tables.write(df, f"{base}/{name}", *partition_cols)
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    models.__dict__["fact_station_arrival"] = write(models.fact_station_arrival, "fact_station_arrival", "journey_date")
    parts = []
    for name, kind in MATERIALIZATION.items():
        if name in passed:
            rows = spark.range(1).select(F.lit(counts(passed[name], "rows")["rows"]).cast("long").alias("rows"))
        else:
            df = getattr(models, name)
            if kind != "view" and name != "fact_station_arrival":
                df = write(df, name, *["journey_date"][: "journey_date" in df.columns and kind == "incremental"])
            rows = df.agg(F.count(F.lit(1)).cast("long").alias("rows"))
        parts.append(rows.select(F.lit(name).alias("model"), F.lit(kind).alias("materialization"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


JOURNEY_KEY = ["train_number", "journey_date"]
STOP_KEY = ["train_number", "journey_date", "station_code", "station_sequence"]


def incremental_fact_batch(raw: DataFrame, target: DataFrame, refresh_journeys: bool = False,
                           overlap_hours: int = 48, table: tables.Bucketed | None = None) -> DataFrame:
    """One incremental run of the fact model: the rows to upsert into ``target``.

    The warehouse run recomputes the fact over all staging and keeps rows with
    ``ingested_at >= max(target.ingested_at) - 48 h``. Such a row's journey has a raw record in
    that window, and staging / previous-stop delay partition within a journey, so only those
    journeys are rebuilt here (raw semi-joined to the touched journeys): a daily run costs
    the touched journeys, not the whole history, and gives the same rows.

    ``refresh_journeys`` re-emits every stop of a touched journey, so a late correction also
    refreshes the next stop's previous-stop delay (T14); the default keeps the warehouse rule.

    With ``table`` (``target`` in buckets of the train) raw rows are dealt once, as its rows lie, and so the batch
    lies too; it should be stored in such a table.
    """
    recent = tables.incremental_window(raw, target, "ingested_at", overlap_hours)
    touched = recent.select(*JOURNEY_KEY).distinct()
    if table:
        raw, touched = table.dealt(raw), table.dealt(touched)
    rebuilt = Models(raw.join(touched, JOURNEY_KEY, "left_semi"), dealt=table is not None).fact_station_arrival
    if refresh_journeys:
        return rebuilt
    return tables.incremental_window(rebuilt, target, "ingested_at", overlap_hours)
