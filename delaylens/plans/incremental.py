"""Incremental runs of the fact and of what depends on it (K5).

A batch of accepted rows goes to the raw table (K1); the journeys it touches are rebuilt and upserted
into the fact (K2). Before that the difference between old and new fact rows is written as the
batch's *change feed* (a fact row and +1 or -1), from which the dependent tables follow, each
rewriting only what the batch touches:

- features (M9): the stops of the feed;
- marts (A2, A3, A7): a histogram (key, delay, count) per mart, changed by the feed's counts; means,
  medians and shares of the touched keys are read off it, so no mart looks at fact rows again;
- carried history (W7): sum and count per (train, station) up to a day, joined by new days only;
- open predictions (J8): closed by the first batch that brings their actual delay.

Tables keyed by a hash lie in buckets of the key, which are their partitions. Every step writes to a
stage named by the batch first and repeats only the copy when the batch is replayed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.functions import expressions as E
from delaylens.operators import marts, tables
from delaylens.operators.marts import FACT_COLUMNS
from delaylens.plans.model_build import JOURNEY_KEY, STOP_KEY, Models


@dataclass(frozen=True)
class IncrementalTables:
    """Folders of the tables below ``root``. ``buckets`` is fixed once they have rows."""

    root: str
    buckets: int = 32

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def stage(self, name: str, batch_id: int) -> str:
        return self.path(f"stages/{name}/batch_id={batch_id}")


def _staged(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``df`` as a first attempt of the batch has written it, or written now."""
    if not tables.path_exists(spark, f"{path}/_SUCCESS"):
        tables.write(df, path)
    return spark.read.schema(df.schema).parquet(path)


def _bucket(t: IncrementalTables, *keys: str):
    return F.pmod(F.hash(*keys), F.lit(t.buckets)).alias("bucket")


# --------------------------------------------------------------------------- fact and its feed
def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """The fact rows that differ: those of ``old`` alone with change -1, those of ``new`` alone with +1.

    Both hold a stop once; they are joined by stop (fact rows name a train), which leaves rows in buckets
    of the train where they are."""
    row = F.struct(*FACT_COLUMNS)
    was = old.select(*[F.col(k).alias(f"o_{k}") for k in STOP_KEY], row.alias("o"))
    now = new.select(*[F.col(k).alias(f"n_{k}") for k in STOP_KEY], row.alias("n"))
    same = reduce(lambda a, b: a & b, [F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in STOP_KEY[1:]],
                  F.col("o_train_number") == F.col("n_train_number"))
    both = was.join(now, same, "full_outer").where(~F.col("o").eqNullSafe(F.col("n")))
    held = F.filter(F.array(F.struct(F.col("o").alias("row"), F.lit(-1).alias("change")),
                            F.struct(F.col("n").alias("row"), F.lit(1).alias("change"))), lambda x: x["row"].isNotNull())
    return both.select(F.inline(held)).select("row.*", "change")


def _by_train(path: str, schema: T.StructType, *partitions: str) -> tables.Bucketed:
    return tables.Bucketed(path, schema, "train_number", partitions)


def store_new_rows(spark: SparkSession, table: tables.Bucketed, batch: DataFrame, days: list, batch_id: int,
                   key: str = "source_record_hash") -> None:
    """K1 into a table in buckets of the train, which the key covers like the date: of the batch's rows, dealt
    once, those whose key no earlier batch has stored for these dates, one per key."""
    stored = table.read(spark, "journey_date", days).where(F.col("batch_id") < batch_id).select(table.key, key)
    new = table.dealt(batch).dropDuplicates([table.key, key]).join(stored, [table.key, key], "left_anti")
    table.store(new.withColumn("batch_id", F.lit(batch_id).cast("long")))


def raw_table(path: str, batch: DataFrame) -> tables.Bucketed:
    schema = T.StructType([*batch.schema.fields, T.StructField("batch_id", T.LongType())])
    return _by_train(path, schema, "journey_date", "batch_id")


def rebuilt_fact(spark: SparkSession, raw: tables.Bucketed, touched: DataFrame, days: list, batch_id: int) -> DataFrame:
    """The fact rows of the touched journeys, from the raw rows up to a batch, where they lie."""
    rows = raw.read(spark, "journey_date", days).where(F.col("batch_id") <= batch_id).drop("batch_id")
    return Models(rows.join(raw.dealt(touched), JOURNEY_KEY, "left_semi"), dealt=True).fact_station_arrival


def apply_batch(spark: SparkSession, t: IncrementalTables, batch: DataFrame, batch_id: int) -> DataFrame:
    """K1 and K2 for a batch of accepted rows; returns its change feed, written.

    Raw rows, fact, feed and features lie in buckets of the train, so a row is dealt once, on its way to
    the raw table."""
    touched = tables.materialized(batch.select(*JOURNEY_KEY).distinct(), "incremental-journeys")
    days = tables.dates(touched, "journey_date")
    raw = raw_table(t.path("raw"), batch)
    store_new_rows(spark, raw, batch, days, batch_id)
    rebuilt = rebuilt_fact(spark, raw, touched, days, batch_id)
    fact = _by_train(t.path("fact"), rebuilt.schema, "journey_date")
    before = fact.read(spark, "journey_date", days).join(fact.dealt(touched), JOURNEY_KEY, "left_semi")
    feed = _staged_feed(spark, t, changes(before, rebuilt), batch_id)
    _upsert_stops(spark, t, "fact", feed.where(F.col("change") > 0).drop("change"), feed, batch_id)
    tables.release(spark)
    return feed


def _staged_feed(spark: SparkSession, t: IncrementalTables, feed: DataFrame, batch_id: int) -> DataFrame:
    """The feed as a first attempt of the batch has written it, or written now, in buckets of the train."""
    path = t.path(f"feed/batch_id={batch_id}")
    table = _by_train(path, feed.schema, "journey_date")
    if not tables.path_exists(spark, f"{path}/_complete"):
        tables.remove_folder(spark, path)
        table.store(feed)
        tables.make_folder(spark, f"{path}/_complete")
    return table.read(spark)


def _upsert_stops(spark: SparkSession, t: IncrementalTables, name: str, rows: DataFrame, feed: DataFrame, batch_id: int) -> None:
    table = _by_train(t.path(name), rows.schema, "journey_date")
    tables.upsert_partitions(spark, table.root, t.stage(name, batch_id), rows, feed.select(*STOP_KEY).distinct(),
                             STOP_KEY, "journey_date", table)


# --------------------------------------------------------------------------- features (M9)
def update_features(spark: SparkSession, t: IncrementalTables, feed: DataFrame, batch_id: int) -> None:
    """The feature rows of the feed's stops; a stop that left the fact leaves the features."""
    _upsert_stops(spark, t, "features", marts.delay_features(feed.where(F.col("change") > 0)), feed, batch_id)


# --------------------------------------------------------------------------- marts
def update_mart(spark: SparkSession, t: IncrementalTables, feed: DataFrame, key: str, batch_id: int) -> None:
    """The histogram of ``key`` changed by the feed, then the measures of the touched keys."""
    counts = (feed.where(F.col("arrival_delay_minutes").isNotNull())
              .groupBy(key, F.col("arrival_delay_minutes").cast("double").alias("_d")).agg(F.sum("change").alias("_n"))
              .where(F.col("_n") != 0).select(_bucket(t, key), key, "_d", "_n"))
    counts = _staged(spark, counts, t.stage(f"{key}-counts", batch_id))
    touched = tables.materialized(counts.select("bucket", key).distinct(), "mart-keys")
    buckets = tables.dates(touched, "bucket")
    keys = ["bucket", key]

    def of_touched(name: str, schema: T.StructType) -> DataFrame:
        rows = tables.read_dates(spark, t.path(name), schema, "bucket", buckets)
        return rows.join(touched, tables.matching(rows, touched, keys), "left_semi")

    hist = of_touched(f"histogram_{key}", counts.schema).unionByName(counts).groupBy(*keys, "_d").agg(F.sum("_n").alias("_n")) \
        .where(F.col("_n") != 0).select(*counts.columns)
    tables.upsert_partitions(spark, t.path(f"histogram_{key}"), t.stage(f"{key}-histogram", batch_id), hist, touched, keys, "bucket")
    mart = marts.summary_of_counts(of_touched(f"histogram_{key}", counts.schema), *keys)
    mart = mart.select(*keys, *marts.delay_measures(), E.round6(F.col("major")).alias("major_delay_percent"))
    tables.upsert_partitions(spark, t.path(f"mart_{key}"), t.stage(f"{key}-mart", batch_id), mart, touched, keys, "bucket")


# --------------------------------------------------------------------------- carried history
_PAIR = ["train_number", "station_code"]


def carry_history(spark: SparkSession, t: IncrementalTables, facts: DataFrame, batch_id: int) -> None:
    """History rows of new days from the carried sums, which then take the days in.

    ``facts`` are all fact rows of days later than every day carried so far; a day that is not later is
    an error, since sums that hold it can't be told apart (rebuild from the fact then).
    """
    d = F.col("arrival_delay_minutes").cast("double")
    daily = facts.where(d.isNotNull()).groupBy(*_PAIR, "journey_date").agg(
        F.sum(d).alias("_sum"), F.count(F.lit(1)).alias("_n")).select(_bucket(t, *_PAIR), "*")
    daily = _staged(spark, daily, t.stage("history-days", batch_id))
    state_stage = t.stage("history-state", batch_id)
    days = tables.dates(daily, "journey_date")
    if not days:
        return
    schema = T.StructType([*[f for f in daily.schema.fields if f.name != "journey_date"], T.StructField("through", T.DateType())])
    touched = tables.materialized(daily.select("bucket", *_PAIR).distinct(), "history-pairs")
    state = tables.read_dates(spark, t.path("history_state"), schema, "bucket", tables.dates(touched, "bucket"))
    keys = ["bucket", *_PAIR]
    if not tables.path_exists(spark, f"{state_stage}/_complete"):  # else the state holds these days already
        last = state.agg(F.max("through")).first()[0]
        if last is not None and days[0] <= last:
            raise ValueError(f"{days[0]} is not later than {last}, which the history holds")
        carried = state.select(*[F.col(k).alias(f"s_{k}") for k in keys], F.col("_sum").alias("s_sum"), F.col("_n").alias("s_n"))
        joined = daily.join(carried, [daily[k].eqNullSafe(carried[f"s_{k}"]) for k in keys], "left")
        upto = Window.partitionBy(*keys).orderBy(F.unix_date("journey_date")).rangeBetween(Window.unboundedPreceding, -1)
        total = lambda state_col, col: F.when(
            F.col(state_col).isNull() & F.sum(col).over(upto).isNull(), None).otherwise(
            F.coalesce(state_col, F.lit(0)) + F.coalesce(F.sum(col).over(upto), F.lit(0)))
        rows = joined.select(*_PAIR, "journey_date", F.col("_n").cast("long").alias("observations"),
                             total("s_n", "_n").cast("long").alias("history_observations"),
                             E.round6(total("s_sum", "_sum") / total("s_n", "_n")).alias("historical_mean_delay_minutes"))
        tables.write(tables.rebalanced(rows, "journey_date"), t.path("history"), "journey_date")
    current = state.join(touched, tables.matching(state, touched, keys), "left_semi")
    sums = daily.withColumnRenamed("journey_date", "through").select(*schema.fieldNames()).unionByName(current)
    rebuilt = sums.groupBy(*keys).agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), F.max("through").alias("through"))
    tables.upsert_partitions(spark, t.path("history_state"), state_stage, rebuilt, touched, keys, "bucket")


# --------------------------------------------------------------------------- late actuals
def open_predictions(predictions: DataFrame, t: IncrementalTables, batch_id: int) -> None:
    """Store predictions whose actual delay isn't known yet."""
    tables.write(tables.rebalanced(predictions.withColumn("made_by", F.lit(batch_id).cast("long")), "journey_date"),
                 t.path("predictions"), "journey_date", "made_by")


def close_predictions(spark: SparkSession, t: IncrementalTables, feed: DataFrame, batch_id: int, schema: T.StructType) -> None:
    """Close the open predictions of the feed's stops that have an actual delay now, each once.

    A prediction that an earlier batch has closed keeps that batch's actual; ``predictions`` and
    ``closed`` are append-only, and only the feed's dates are read of both.
    """
    actual = feed.where((F.col("change") > 0) & F.col("arrival_delay_minutes").isNotNull()) \
        .select(*STOP_KEY, F.col("arrival_delay_minutes").alias("actual_arrival_delay_minutes"))
    # Only the dates that have predictions: the other rows of the feed aren't joined.
    days = tables.existing_dates(spark, t.path("predictions"), "journey_date", tables.dates(actual, "journey_date"))
    actual = actual.where(tables.on_dates("journey_date", days))
    made = tables.read_dates(spark, t.path("predictions"), schema, "journey_date", days)
    error = F.abs(F.col("actual_arrival_delay_minutes") - F.col("predicted_arrival_delay_minutes"))
    found = made.join(actual, STOP_KEY).withColumn("absolute_error_minutes", error)
    key = ["model_name", "model_version", *STOP_KEY]
    stored = T.StructType([*found.schema.fields, T.StructField("batch_id", T.LongType())])
    done = tables.read_dates(spark, t.path("closed"), stored, "journey_date", days).where(F.col("batch_id") < batch_id)
    new = found.join(done.select(*key), key, "left_anti")
    tables.append_batch(new, t.path("closed"), "journey_date", batch_id)


def evaluated_predictions(spark: SparkSession, t: IncrementalTables, schema: T.StructType) -> DataFrame:
    """All predictions, with actual delay and error where a batch has closed them."""
    made = spark.read.schema(schema).parquet(t.path("predictions"))
    key = ["model_name", "model_version", *STOP_KEY]
    closed = T.StructType([f for f in schema.fields if f.name in key] + [
        T.StructField("actual_arrival_delay_minutes", T.DoubleType()), T.StructField("absolute_error_minutes", T.DoubleType())])
    if not tables.path_exists(spark, t.path("closed")):
        return made.withColumns({f.name: F.lit(None).cast("double") for f in closed.fields[-2:]})
    return made.join(spark.read.schema(closed).parquet(t.path("closed")), key, "left")
