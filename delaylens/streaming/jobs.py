"""Structured Streaming forms of the incremental jobs.

All jobs read a landing folder of Parquet files with the file source, so they run as
continuous jobs (processing-time trigger) or as catch-up jobs (``availableNow``). Sinks are
idempotent per micro-batch id, so a batch replayed after a failure rewrites exactly what it
wrote before:

- R1 snapshot archive: each batch is flattened, de-duplicated against earlier batches by
  content hash (K1), and written to its own partitions.
- R2 late corrections: rows whose content hash was never seen before are kept, however late they
  come; repeats are dropped against the stored rows of the batch's dates.
- R3 fact upsert: the batch's accepted rows go to the raw table (K1); every journey (train,
  date) the batch touches is rebuilt from the raw table and upserted into the fact table,
  partitioned by journey date, rewriting only the touched date partitions (staged first, so
  a replay copies the same staged rows).
- R4 daily trend: R3's fact, with the trend of the touched dates computed anew after each batch, so
  a corrected stop counts once, with its latest record.

A batch is read from its landed files. Its dates (one row per calendar day) name the folders of the stored
tables that are listed and read. R3's raw and fact tables lie in buckets of the train, so a row is shuffled
once, on its way to the raw table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.operators import ingest, kpi, tables
from delaylens.plans import incremental, load_run
from delaylens.sources import payloads

JOURNEY_KEY = ["train_number", "journey_date"]


def land(df: DataFrame, path: str, files: int) -> str:
    """Write ``df`` into a landing folder (fixture arrival), ``files`` files from every task that has as many
    rows: each task deals its rows round to its own files, so none is shuffled and no file grows with the table."""
    arrival = F.pmod(F.monotonically_increasing_id(), F.lit(files)).alias("_arrival")
    with tables.session_conf(df.sparkSession, spark__sql__maxConcurrentOutputFileWriters=str(files)):
        df.select("*", arrival).write.mode("errorifexists").option("compression", "zstd").partitionBy("_arrival").parquet(path)
    return f"{path}/_arrival=*"


def per_trigger(spark: SparkSession, landing: str, triggers: int) -> int:
    """How many of a landing's files make up that many triggers."""
    return max(1, -(-len(tables.folder_names(spark, f"{landing}/part-*")) // triggers))


def _stream(spark: SparkSession, landing: str, schema: T.StructType, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(landing)


def _run(writer, checkpoint: str, available_now: bool = True):
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
    return q


def _earlier(spark: SparkSession, root: str, schema: T.StructType, date_col: str, days: list, batch_id: int) -> DataFrame:
    """Rows that batches before this one stored for the given dates."""
    rows = tables.read_dates(spark, root, T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())]), date_col, days)
    return rows.where(F.col("batch_id") < batch_id).drop("batch_id")


def _store_new(spark: SparkSession, batch: DataFrame, root: str, date_col: str, batch_id: int,
               key: str = "source_record_hash") -> list:
    """K1 for a batch: append the rows whose key no earlier batch has stored. Returns the batch's dates."""
    days = tables.dates(batch, date_col)
    present = _earlier(spark, root, batch.schema, date_col, days, batch_id)
    tables.append_new(present, batch, root, date_col, batch_id, key)
    return days


# --------------------------------------------------------------------------- R1
ARCHIVE_DATASET = "live_status_snapshots"


def snapshot_archive(spark: SparkSession, landing: str, archive: str, checkpoint: str,
                     landing_schema: T.StructType, max_files: int | None = None,
                     available_now: bool = True, audit: load_run.LoadPaths | None = None,
                     source_name: str = "live_status_feed", before_store=None):
    """Arriving status payload files -> flatten (S4) -> hash -> insert-only append (K1).

    With ``audit`` every micro-batch is a run there (K4): ``running``, then ``succeeded`` with what was
    received (HTTP 200), rejected (other responses, T20), valid, distinct, inserted and already present,
    or ``failed`` with its message; a batch that is replayed after a failure goes on as the same run.
    ``before_store(batch_id)`` is called between counting and storing.
    """
    stream = _stream(spark, landing, landing_schema, max_files)

    def archive_batch(batch: DataFrame, batch_id: int) -> None:
        run_id, counters = f"archive-{batch_id}", None

        def tell(status: str, error: str | None = None) -> None:
            if audit:
                load_run.audit_event(spark, audit, run_id, source_name, status, counters, error, ARCHIVE_DATASET)

        tell("running")
        try:
            # The hash covers retrieved_at: earlier snapshots of the same retrieval days are enough.
            seen = Observation()  # counted in the pass that writes the flat rows
            rows = batch.observe(seen, *payloads.response_counts()) if audit else batch
            flat = payloads.flatten_live_status(rows).withColumn("retrieved_date", F.to_date("retrieved_at"))
            flat = tables.materialized(flat, "snapshot-batch")
            if audit:
                counters = load_run.counts(seen, "received", "rejected")
                counters["valid"] = counters["received"]
                counters["distinct_valid"] = flat.select(tables.packed("source_record_hash")).distinct().count()
            if before_store:
                before_store(batch_id)
            days = _store_new(spark, flat, archive, "retrieved_date", batch_id)
            if audit:
                schema = T.StructType([*flat.schema.fields, T.StructField("batch_id", T.LongType())])
                stored = tables.read_dates(spark, archive, schema, "retrieved_date", days)
                counters["inserted"] = stored.where(F.col("batch_id") == batch_id).count()
                counters["already_present"] = counters["distinct_valid"] - counters["inserted"]
            tell("succeeded")
        except Exception as exc:
            tell("failed", str(exc))
            raise

    return _run(stream.writeStream.foreachBatch(archive_batch), checkpoint, available_now)


# --------------------------------------------------------------------------- R2
def late_correction_dedupe(spark: SparkSession, landing: str, sink: str, checkpoint: str,
                           landing_schema: T.StructType, date_col: str = "journey_date",
                           key: str = "source_record_hash", max_files: int | None = None,
                           available_now: bool = True):
    """R2: the first row of every content hash; a new hash is kept however late it comes.

    ``date_col`` is a date the hash covers; rows without it are stored under the null date and
    compared there.
    """
    stream = _stream(spark, landing, landing_schema, max_files)

    def dedupe_batch(batch: DataFrame, batch_id: int) -> None:
        _store_new(spark, batch, sink, date_col, batch_id, key)

    return _run(stream.writeStream.foreachBatch(dedupe_batch), checkpoint, available_now)


# --------------------------------------------------------------------------- R3
def fact_upsert(spark: SparkSession, landing: str, raw_root: str, fact_root: str, stage_root: str,
                checkpoint: str, landing_schema: T.StructType, max_files: int | None = None,
                available_now: bool = True, after=None):
    """Incremental fact maintenance, one upsert per micro-batch (idempotent by batch id).

    ``after(fact, days, batch_id)`` is called with the fact rows of the dates a batch has touched.
    """
    stream = _stream(spark, landing, landing_schema, max_files)
    checked = ingest.with_rule_check(stream)
    accepted = ingest.normalize_accepted(checked.where(F.col("rules_ok")).drop("errors", "rules_ok"))

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        touched = tables.materialized(batch.select(*JOURNEY_KEY).distinct(), "upsert-journeys")
        days = tables.dates(touched, "journey_date")
        raw = incremental.raw_table(raw_root, batch)
        incremental.store_new_rows(spark, raw, batch, days, batch_id)
        rebuilt = incremental.rebuilt_fact(spark, raw, touched, days, batch_id)
        fact = tables.Bucketed(fact_root, rebuilt.schema, "train_number", ("journey_date",))
        tables.upsert_partitions(spark, fact_root, f"{stage_root}/batch_id={batch_id}", rebuilt, fact.dealt(touched),
                                 JOURNEY_KEY, "journey_date", fact)
        tables.release(spark)
        if after:
            after(tables.read_dates(spark, fact_root, rebuilt.schema, "journey_date", days), days, batch_id)

    return _run(accepted.writeStream.foreachBatch(upsert_batch), checkpoint, available_now)


# --------------------------------------------------------------------------- R4
def daily_trend_stream(spark: SparkSession, landing: str, raw_root: str, fact_root: str, stage_root: str, out: str,
                       checkpoint: str, landing_schema: T.StructType, max_files: int | None = None,
                       available_now: bool = True):
    """A7 kept up to date from raw events: the trend of each touched date is replaced.
    """

    def replace_trend(fact: DataFrame, days: list, batch_id: int) -> None:
        trend = kpi.daily_trend(fact)
        trend.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("journey_date").parquet(out)

    return fact_upsert(spark, landing, raw_root, fact_root, stage_root, checkpoint, landing_schema, max_files,
                       available_now, replace_trend)
