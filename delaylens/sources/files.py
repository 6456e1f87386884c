"""CSV sources with header contracts (S1, S2, S3, S7) and single-file discovery."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.functions import expressions as E

# Fixed header contracts of the source layouts.
EVENT_REQUIRED = ["train_number", "journey_date", "station_code", "station_sequence"]
DELAY_REQUIRED = ["train", "date", "station", "sch_arr", "act_arr", "arr_delay", "sch_dep", "act_dep", "dep_delay"]
ROUTE_REQUIRED = ["stnSerialNumber", "trainNumber", "station_code"]
ROUTE_OPTIONAL = ["trainName", "station_name", "arrivalTime", "departureTime", "distance"]
BASELINE_REQUIRED = ["journey_date", "train_number", "station_code", "arrival_delay_minutes"]
BASELINE_MIN_ROWS = 10

# A quote inside a quoted field is doubled; every file's header is checked against the schema.
CSV_READ_OPTIONS = {"header": "true", "encoding": "UTF-8", "mode": "PERMISSIVE", "escape": '"', "enforceSchema": "false"}
# Writing keeps whitespace as is (Spark trims by default on write) so a round trip is exact.
CSV_WRITE_OPTIONS = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


class ContractError(ValueError):
    pass


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file in any store that Spark reads: one block of it is opened."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        reader = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        return jvm.java.io.BufferedReader(reader).readLine()
    finally:
        stream.close()


def header_groups(spark: SparkSession, path: str) -> list[tuple[list[str], list[str] | None]]:
    """(columns, files) for each different header among the files of a CSV source.

    The driver, whose scan lists the files anyway, opens the first block of each, several at a time;
    no data is read. Where all files have one header, which is the rule, no file is named (None): the
    scan takes the path.
    """
    names = sorted(spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(16) as pool:
        lines = list(pool.map(lambda name: first_line(spark, name), names))
    files_of: dict[str, list[str]] = {}
    for name, line in zip(names, lines):
        if line is not None:  # an empty file has no header
            files_of.setdefault(line, []).append(name)
    columns = lambda header: [c.strip() for c in next(csv.reader([header.lstrip("\ufeff")]))]
    return [(columns(h), None if len(files_of) == 1 else files_of[h]) for h in sorted(files_of)]


#: Reason of a row with more or fewer fields than its file's header.
FIELD_COUNT = "field_count"


def read_csv_contract(spark: SparkSession, path: str, required: list[str], optional: list[str] | None = None,
                      label: str = "file", multi_line: bool = False, malformed: str | None = None) -> DataFrame:
    """All-string read with an explicit schema after checking every file's header.

    A missing required column fails the scan and names the columns (sorted). Files may have their
    columns in different order, and optional columns may be absent from some (nulls then); other
    columns are ignored. A UTF-8 BOM on the header is dropped. ``multi_line`` is for feeds with line
    ends inside quoted fields; it makes each file the work of one task.

    A row with more or fewer fields than its header fails the scan, unless ``malformed`` names a column
    for the raw line of such rows (null in all others); a load sends them to quarantine.
    """
    groups = header_groups(spark, path)
    for header, _files in groups or [([], [])]:
        if missing := sorted(set(required) - set(header)):
            raise ContractError(f"{label}: no column {', '.join(missing)}")
    wanted = list(required) + [c for c in (optional or []) if c not in required]
    parts = []
    for header, names in groups:
        raw = "_raw_line"
        while raw in header:
            raw += "_"
        # Without pruning of columns, since the number of fields shows in whole rows only.
        reader = spark.read.options(**CSV_READ_OPTIONS).option("multiLine", multi_line).option("columnPruning", "false")
        reader = reader.option("columnNameOfCorruptRecord", raw) if malformed else reader.option("mode", "FAILFAST")
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*header, *([raw] if malformed else [])]])
        df = reader.schema(schema).csv(path if names is None else names)
        columns = [(F.col(f"`{c}`") if c in header else F.lit(None).cast("string")).alias(c) for c in wanted]
        parts.append(df.select(*columns, *([F.col(raw).alias(malformed)] if malformed else [])))
    return reduce(DataFrame.unionByName, parts)


#: Name of the column for raw lines in the readers of the load jobs.
MALFORMED = "malformed_record"


EVENT_TIMES = ["source_observed_at", "scheduled_arrival_at", "actual_arrival_at", "scheduled_departure_at",
               "actual_departure_at"]
EVENT_OPTIONAL = ["scheduled_arrival_at", "actual_arrival_at", "scheduled_departure_at", "actual_departure_at",
                  "arrival_delay_minutes", "departure_delay_minutes", "status", "source_observed_at"]


def read_event_csv(spark: SparkSession, path: str, source_name: str, malformed: str | None = None) -> DataFrame:
    """Generic running-event CSV; appends ``source_name``."""
    df = read_csv_contract(spark, path, EVENT_REQUIRED, EVENT_OPTIONAL, "historical file", malformed=malformed)
    return df.withColumn("source_name", F.lit(source_name))


def read_delay_csv(spark: SparkSession, path: str, malformed: str | None = None) -> DataFrame:
    """Delay CSV, nine required string columns."""
    return read_csv_contract(spark, path, DELAY_REQUIRED, None, "delay file", malformed=malformed)


def read_route_csv(spark: SparkSession, path: str, malformed: str | None = None) -> DataFrame:
    """S3: route CSV, three required columns plus the optional schedule columns."""
    return read_csv_contract(spark, path, ROUTE_REQUIRED, ROUTE_OPTIONAL, "route file", malformed=malformed)


def read_baseline_csv(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Baseline observations: blank delays dropped, keys upper-cased, at least 10 rows.

    The row-count check runs inside the plan (``assert_true`` on a scalar count), so the
    job fails on executors without collecting anything.
    """
    df = read_csv_contract(spark, path, BASELINE_REQUIRED, None, "baseline file")
    obs = df.where(E.blank_to_null("arrival_delay_minutes").isNotNull()).select(
        E.strip("journey_date").try_cast("date").alias("journey_date"),
        F.upper("train_number").alias("train_number"),
        F.upper("station_code").alias("station_code"),
        F.col("arrival_delay_minutes").cast("double").alias("arrival_delay_minutes"),
    )
    if strict:
        n = obs.agg(F.count(F.lit(1))).scalar()
        obs = obs.withColumn("arrival_delay_minutes", E.guard(
            "arrival_delay_minutes", n >= BASELINE_MIN_ROWS,
            f"a baseline needs {BASELINE_MIN_ROWS} observed delays or more"))
    return obs


def events_from_generic_csv(df: DataFrame) -> DataFrame:
    """Typed canonical record from the all-string generic CSV (blank -> null; bad numbers -> null)."""
    return df.select(
        E.blank_to_null("train_number").alias("train_number"),
        E.blank_to_null("journey_date").alias("journey_date_text"),
        E.blank_to_null("station_code").alias("station_code"),
        E.sequence_from_text("station_sequence").alias("station_sequence"),
        E.optional_number("arrival_delay_minutes").alias("arrival_delay_minutes"),
        E.optional_number("departure_delay_minutes").alias("departure_delay_minutes"),
        E.not_a_number("arrival_delay_minutes").alias("arrival_delay_not_a_number"),
        E.not_a_number("departure_delay_minutes").alias("departure_delay_not_a_number"),
        *[E.blank_to_null(c).try_cast("timestamp_ntz").alias(c) for c in EVENT_TIMES],
        F.array_compact(F.array(*[F.when(E.blank_to_null(c).isNotNull() & E.blank_to_null(c).try_cast("timestamp_ntz").isNull(),
                                         F.lit(f"{c}_invalid")) for c in EVENT_TIMES])).alias("invalid_times"),
        E.blank_to_null("status").alias("status"),
        "source_name",
        *[c for c in ("source_record_hash", MALFORMED) if c in df.columns],
    )


def write_csv(df: DataFrame, path: str, compression: str = "none") -> str:
    """Compressed files can't be split: they end after so many rows."""
    options = CSV_WRITE_OPTIONS | ({} if compression == "none" else {"compression": compression, "maxRecordsPerFile": "500000"})
    df.write.mode("errorifexists").options(**options).csv(path)
    return path


def find_single_file(spark: SparkSession, directory: str, glob: str) -> str:
    """Exactly one file matching ``glob`` under ``directory`` (recursive), else an error.

    Uses the file index listing of a lazy scan (``inputFiles``), no data is read.
    """
    files = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true") \
                      .text(directory).inputFiles()
    if len(files) != 1:
        raise ContractError(f"{glob} names {len(files)} files under {directory}, not one")
    return files[0]
