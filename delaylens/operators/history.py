"""Keys of an append-only table, stored so that a batch is compared without shuffling the history
(K1, J2).

The keys lie in a table partitioned by date and bucketed by key: a look-up reads the batch's dates
only, and joins bucket by bucket, so the batch is dealt to the buckets and the stored side stays
where it is. Every row names the run that stored it; runs that didn't succeed don't count.

With ``within``, a column that the key covers, the table lies in buckets of that column instead, and
a batch that was dealt by it for other reasons isn't shuffled for the look-up either.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.operators import tables


@dataclass(frozen=True)
class KeyHistory:
    """The folder of the keys. ``buckets`` is fixed once a history has rows: about as many as a date's
    keys fill files of a useful size."""

    root: str
    key: str = "source_record_hash"
    date_col: str = "journey_date"
    run_col: str = "run_id"
    buckets: int = 16
    within: str | None = None

    @property
    def table(self) -> tables.Bucketed:
        """The keys in buckets of ``within``, a run's in its own partitions; as many buckets as its first write found."""
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (self.key, self.within, self.run_col)])
        return tables.Bucketed(self.root, schema.add(self.date_col, T.DateType()), self.within, (self.date_col, self.run_col))

    @property
    def name(self) -> str:
        return f"key_history_{zlib.crc32(self.root.encode()):08x}"


def open_history(spark: SparkSession, history: KeyHistory) -> None:
    """Make the stored keys known to this session, dates that other sessions have added included."""
    if not spark.catalog.tableExists(history.name):
        spark.sql(f"CREATE TABLE {history.name} (`{history.key}` STRING, `{history.run_col}` STRING, `{history.date_col}` DATE) "
                  f"USING parquet PARTITIONED BY (`{history.date_col}`) CLUSTERED BY (`{history.key}`) INTO {history.buckets} BUCKETS "
                  f"LOCATION '{history.root}'")
    if tables.path_exists(spark, history.root):
        spark.sql(f"ALTER TABLE {history.name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(history.name)


def append(rows: DataFrame, history: KeyHistory, run_id: str) -> None:
    """Store the keys of rows that a run has written. Each task writes few buckets of few dates."""
    spark = rows.sparkSession
    if history.within:  # the rows lie as the table's do
        history.table.store(rows.select(history.key, history.within, F.lit(run_id).alias(history.run_col), history.date_col))
        return
    open_history(spark, history)
    keys = rows.select(history.key, F.lit(run_id).alias(history.run_col), history.date_col)
    dealt = keys.repartition(history.date_col, F.pmod(F.hash(history.key), F.lit(history.buckets)))
    dealt.write.insertInto(history.name)


def _key(history: KeyHistory) -> list[str]:
    return [history.within, history.key] if history.within else [history.key]


def stored(spark: SparkSession, history: KeyHistory, days: list, runs: DataFrame) -> DataFrame:
    """One row per key that a run of ``runs`` has stored under one of the dates."""
    if history.within:
        keys = history.table.read(spark, history.date_col, days)
    else:
        open_history(spark, history)
        keys = spark.table(history.name).where(tables.on_dates(history.date_col, days))
    return keys.join(runs.select(history.run_col), history.run_col, "left_semi").select(*_key(history)).distinct()


def flagged(batch: DataFrame, history: KeyHistory, days: list, runs: DataFrame, out: str = "present") -> DataFrame:
    """``batch`` (unique on the key) with a boolean: whether the history holds its key."""
    found = stored(batch.sparkSession, history, days, runs).withColumn(out, F.lit(True))
    return batch.join(found, _key(history), "left").withColumn(out, F.coalesce(out, F.lit(False)))
