"""Table writes: insert-only merge (K1), keyed upsert (K2), additive schema (K8), incremental
window (P14/P15).

An append-only table is a folder partitioned by date, then by batch: a batch writes its own
partitions, so a retry rewrites what it wrote before and nothing else, and a reader of a few dates
lists the folders of those dates only. No path is overwritten while it is read (T25).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.session import scratch_path

#: How the folder of the null partition is named.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

DEFAULT_OVERLAP_HOURS = 48
FLOOR_TIMESTAMP = "1900-01-01 00:00:00"


def rebalanced(df: DataFrame, *cols: str) -> DataFrame:
    """Before a write partitioned by ``cols``: group rows by those columns so each task writes
    few partition folders (no small-file explosion), with AQE splitting a hot value across
    tasks and merging small ones (the ``rebalance`` hint), so one busy day never lands whole in
    one task."""
    return df.hint("rebalance", *cols)


@contextmanager
def session_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Settings (``__`` for the dots) of the jobs inside; what was set before holds again afterwards."""
    names = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def release(spark: SparkSession) -> None:
    """Shuffle files of what no one refers to any more go now, not when the driver's memory next fills."""
    spark.sparkContext._jvm.System.gc()


def write(df: DataFrame, path: str, *partition_cols: str) -> None:
    """Replace what ``path`` holds (of a partitioned table: in the partitions of ``df``). zstd halves the
    hex digits of the keys, which the default codec leaves as they are."""
    w: DataFrameWriter = df.write.mode("overwrite").option("compression", "zstd")
    if partition_cols:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    w.parquet(path)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --------------------------------------------------------------------------- bucketed tables
#: Rows that lie in buckets of one column are joined and grouped there by that column and others; generated
#: methods too long to be compiled aren't used (see session.DEFAULT_CONF).
_CO_LOCATED = {"spark__sql__requireAllClusterKeysForCoPartition": "false", "spark__sql__codegen__hugeMethodLimit": "8000",
               "spark__sql__sources__bucketing__autoBucketedScan__enabled": "false"}


@dataclass(frozen=True)
class Bucketed:
    """A table whose rows lie in buckets of ``key`` within its partitions: what groups or joins its rows by
    the key, alone or with other columns, shuffles none of them. The number of buckets is fixed by the first
    write (by default the session's shuffle partitions) and kept beside the rows."""

    root: str
    schema: T.StructType
    key: str
    partitions: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [c for c in self.schema.fieldNames() if c not in self.partitions] + list(self.partitions)

    def buckets(self, spark: SparkSession) -> int:
        kept = folder_names(spark, f"{self.root.rstrip('/')}/_buckets_*")
        if kept:
            return int(kept[0].rsplit("_", 1)[1])
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        make_folder(spark, f"{self.root.rstrip('/')}/_buckets_{n}")
        return n

    def opened(self, spark: SparkSession, buckets: int | None = None) -> str:
        """The table's name in this session, partitions that others have added or removed included."""
        name = f"bucketed_{zlib.crc32(self.root.rstrip('/').encode()):08x}"
        if not spark.catalog.tableExists(name):
            n = buckets or self.buckets(spark)
            make_folder(spark, self.root)
            columns = ", ".join(f"`{c}` {self.schema[c].dataType.simpleString()}" for c in self.columns)
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd') "
                      f"PARTITIONED BY ({', '.join(self.partitions)}) CLUSTERED BY (`{self.key}`) INTO {n} BUCKETS LOCATION '{self.root}'")
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.catalog.refreshTable(name)
        return name

    def read(self, spark: SparkSession, date_col: str | None = None, days: list | None = None) -> DataFrame:
        rows = spark.table(self.opened(spark)).select(*self.schema.fieldNames())
        return rows if date_col is None else rows.where(on_dates(date_col, days))

    def dealt(self, df: DataFrame) -> DataFrame:
        """``df`` dealt as the table's rows lie, for a join with them or a write."""
        return dealt(df, self.key, n=self.buckets(df.sparkSession))

    def store(self, df: DataFrame, buckets: int | None = None) -> None:
        """Replace the partitions of ``df``, which lies as the table's rows do."""
        name = self.opened(df.sparkSession, buckets)
        with session_conf(df.sparkSession, **_CO_LOCATED, spark__sql__sources__partitionOverwriteMode="dynamic"):
            df.select(*self.columns).write.insertInto(name, overwrite=True)


# --------------------------------------------------------------------------- keys on the way
def packed(key: str) -> Column:
    """A text key as bytes, for a shuffle: pairs of lower-case hex digits take one byte, other texts are
    kept as they are; the first byte tells which. Equal texts, and only they, are equal. Null stays null."""
    raw = F.unhex(key)
    return F.when(F.lower(F.hex(raw)) == F.col(key), F.concat(F.lit(b"\x01"), raw)) \
        .otherwise(F.concat(F.lit(b"\x00"), F.encode(key, "UTF-8"))).alias(key)


def unpacked(key: str) -> Column:
    """The text that ``packed`` has packed."""
    rest = F.substring(key, 2, 2**31 - 1)
    return F.when(F.substring(key, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(F.decode(rest, "UTF-8")).alias(key)


def dealt(df: DataFrame, *by: str, n: int | None = None, key: str = "source_record_hash", ranges: bool = False) -> DataFrame:
    """``df`` dealt to tasks by ``by``, by hash or in ``ranges``; its text key travels packed."""
    to = [*([n] if n else []), *[F.col(c) for c in by]]
    deal = lambda x: x.repartitionByRange(*to) if ranges else x.repartition(*to)
    if key not in df.columns or not isinstance(df.schema[key].dataType, T.StringType):
        return deal(df)
    return deal(df.withColumn(key, packed(key))).withColumn(key, unpacked(key))


# --------------------------------------------------------------------------- dated tables
def dates(df: DataFrame, date_col: str) -> list:
    """The distinct dates of a batch, null (last) among them: one row per calendar day at most."""
    return sorted((r[0] for r in df.select(date_col).distinct().collect()), key=lambda d: (d is None, d))


def on_dates(date_col: str, days: list) -> Column:
    """Rows of the given dates; None stands for the rows without one."""
    found = F.col(date_col).isin([d for d in days if d is not None])
    return found | F.col(date_col).isNull() if None in days else found


def matching(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equal keys, null being equal to null."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def append_batch(df: DataFrame, root: str, date_col: str, batch_id: int) -> None:
    """Write a batch into its partitions ``date_col=<date>/batch_id=<id>``, replacing only those."""
    write(rebalanced(df.withColumn("batch_id", F.lit(batch_id).cast("long")), date_col), root, date_col, "batch_id")


def _date_folder(root: str, date_col: str, day) -> str:
    return f"{root.rstrip('/')}/{date_col}={NULL_PARTITION if day is None else day}"


def existing_dates(spark: SparkSession, root: str, date_col: str, days: list) -> list:
    """Those of the dates that the table has a folder for."""
    return [d for d in days if path_exists(spark, _date_folder(root, date_col, d))]


def read_dates(spark: SparkSession, root: str, schema: T.StructType, date_col: str, days: list) -> DataFrame:
    """Rows of the given dates (None: those without one): only their folders are listed and read.
    Columns as in ``schema``."""
    found = [_date_folder(root, date_col, d) for d in existing_dates(spark, root, date_col, days)]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*found)


# --------------------------------------------------------------------------- K1
def insert_only(target: DataFrame, batch: DataFrame, key: str = "source_record_hash",
                implied_by_key: str | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (one per key). Re-running adds nothing.

    ``dropDuplicates`` collapses repeated keys map-side; the ``left_anti`` join against the
    target's key column is a shuffle on the key (AQE broadcasts the smaller side when small).

    ``implied_by_key`` names a date column that the key determines (the content hash covers the
    journey date, so equal hashes have equal dates). The target is then narrowed to the batch's
    dates by a literal filter, which prunes its partitions; the batch is read for that first, so it
    should be materialized. Rows without a date are compared with each other. Null keys are new.
    """
    batch = batch.dropDuplicates([key])
    if implied_by_key:
        target = target.where(on_dates(implied_by_key, dates(batch, implied_by_key)))
    return batch.join(target.select(key), key, "left_anti")


def append_new(present: DataFrame | None, batch: DataFrame, root: str, date_col: str, batch_id: int,
               key: str = "source_record_hash") -> None:
    """``insert_only`` and ``append_batch`` in one shuffle, for a key that determines ``date_col``: rows are
    dealt by slots of a date, which serve the comparison and the write alike. Null keys are one row."""
    spark = batch.sparkSession
    per_date = max(1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")) // 32)
    slot = F.when(F.col(key).isNull(), F.lit(0)).otherwise(
        F.pmod(F.hash(date_col), F.lit(1 << 20)) * per_date + F.pmod(F.xxhash64(key), F.lit(per_date)).cast("int"))
    new = dealt(batch.withColumn("_slot", slot), "_slot", key=key).dropDuplicates(["_slot", key])
    if present is not None:
        stored = dealt(present.select(key, slot.alias("_slot")), "_slot", key=key)
        new = new.join(stored, ["_slot", key], "left_anti")
    with session_conf(spark, **_CO_LOCATED):
        write(new.drop("_slot").withColumn("batch_id", F.lit(batch_id).cast("long")), root, date_col, "batch_id")


def merge_insert_only(target: DataFrame, batch: DataFrame, key: str = "source_record_hash",
                      implied_by_key: str | None = None) -> DataFrame:
    """The target after the merge: target rows plus the new ones (by column name)."""
    return target.unionByName(insert_only(target, batch, key, implied_by_key), allowMissingColumns=True)


# --------------------------------------------------------------------------- K2
def upsert(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Whole-row replacement by composite key: untouched target rows + every batch row.

    ``batch`` must be unique on ``keys`` (the staging model guarantees it).
    """
    kept = target.join(batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def upsert_partitions(spark: SparkSession, root: str, stage: str, rebuilt: DataFrame, touched: DataFrame,
                      keys: list[str], partition_col: str, bucketed: Bucketed | None = None) -> None:
    """K2 at scale: rewrite only the ``partition_col`` partitions a batch touches.

    ``rebuilt`` holds the new rows of every touched group (``touched``: distinct group keys,
    which include ``partition_col``). Step 1 writes the full new content of the touched
    partitions (rebuilt rows + untouched groups of those partitions, the only ones that are listed
    and read) under ``stage``, laid out as the table; step 2 moves the staged partitions into the table;
    a touched partition without rows in the stage is removed. Every row is written once. A retry finds
    the stage complete and moves what hasn't been moved yet, so the table is never rebuilt from a
    half-replaced partition. With ``bucketed`` (the table at ``root``) no
    stored row is shuffled; ``rebuilt`` and ``touched`` should lie as its rows do.
    """
    part = lambda d: f"{partition_col}={NULL_PARTITION if d is None else d}"
    touched_parts = dates(touched, partition_col)
    if not path_exists(spark, f"{stage}/_complete"):
        remove_folder(spark, stage)
        if bucketed:
            current = bucketed.read(spark, partition_col, touched_parts)
            same = (current[bucketed.key] == touched[bucketed.key]) & matching(current, touched, [k for k in keys if k != bucketed.key])
            rows = rebuilt.unionByName(current.join(touched, same, "left_anti").select(*rebuilt.columns))
            Bucketed(stage, bucketed.schema, bucketed.key, bucketed.partitions).store(rows, bucketed.buckets(spark))
        else:
            current = read_dates(spark, root, rebuilt.schema, partition_col, touched_parts)
            kept = current.join(touched, matching(current, touched, keys), "left_anti")
            write(rebalanced(rebuilt.unionByName(kept.select(*rebuilt.columns)), partition_col), stage, partition_col)
        staged = set(folder_names(spark, f"{stage}/{partition_col}=*"))
        for d in touched_parts:
            if part(d) not in staged:
                make_folder(spark, f"{stage}/_emptied/{part(d)}")
        make_folder(spark, f"{stage}/_complete")
    make_folder(spark, root)
    emptied = set(folder_names(spark, f"{stage}/_emptied/*"))
    for d in touched_parts:
        if part(d) in emptied or path_exists(spark, f"{stage}/{part(d)}"):
            remove_folder(spark, f"{root.rstrip('/')}/{part(d)}")
        if path_exists(spark, f"{stage}/{part(d)}"):
            move_folder(spark, f"{stage}/{part(d)}", f"{root.rstrip('/')}/{part(d)}")


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.mkdirs(p)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _file_system(spark, source)
    if not fs.rename(p, _file_system(spark, target)[1]):
        raise OSError(f"{source} can't be moved to {target}")


def folder_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of what lies under a path pattern, sorted."""
    fs, p = _file_system(spark, pattern)
    return sorted(f.getPath().getName() for f in fs.globStatus(p) or [])


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


# --------------------------------------------------------------------------- P14 / P15
def extraction_start(watermark: Column, overlap_hours: int = DEFAULT_OVERLAP_HOURS) -> Column:
    """Watermark minus the overlap; a null watermark stays null."""
    if overlap_hours < 0:
        raise ValueError("the overlap can't be less than zero hours")
    return watermark - F.make_dt_interval(F.lit(0), F.lit(overlap_hours))


def incremental_window(batch: DataFrame, target: DataFrame, column: str = "ingested_at",
                       overlap_hours: int = DEFAULT_OVERLAP_HOURS) -> DataFrame:
    """Rows of ``batch`` with ``column >= max(target.column) - overlap`` (floor 1900-01-01).

    The bound is a scalar subquery (one aggregate over the target's column, min/max from
    Parquet footers where possible), evaluated once and used as a pushed-down filter.
    """
    if overlap_hours < 0:
        raise ValueError("the overlap can't be less than zero hours")
    high = target.agg(F.coalesce(F.max(column).cast("timestamp_ntz"),
                                 F.lit(FLOOR_TIMESTAMP).cast("timestamp_ntz")).alias("m"))
    bound = high.select(extraction_start(F.col("m"), overlap_hours)).scalar()
    return batch.where(F.col(column) >= bound)


# --------------------------------------------------------------------------- K8
def evolve_union(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Additive schema change: columns new on either side are added with nulls."""
    return existing.unionByName(incoming, allowMissingColumns=True)
