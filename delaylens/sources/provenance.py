"""Provenance gate (S6): only sources whose manifest permits local processing are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed manifest rules: minimum lengths of name, license and coverage text.
NAME_MIN = 3
LICENSE_MIN = 3
COVERAGE_MIN = 10
HTTP_URL_PATTERN = r"^https?://[^\s/$.?#][^\s]*$"

MANIFEST_SCHEMA = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("license_name", T.StringType()),
    T.StructField("retrieved_at", T.StringType()),
    T.StructField("coverage_description", T.StringType()),
    T.StructField("local_processing_permitted", T.BooleanType()),
    T.StructField("automated_access_permitted", T.BooleanType()),
    T.StructField("raw_redistribution_permitted", T.BooleanType()),
])


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per file (a BOM is tolerated), explicit schema."""
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(path)


def check_manifests(manifests: DataFrame) -> DataFrame:
    """Adds ``manifest_valid`` and ``ingestible`` (valid and local processing permitted)."""
    valid = (
        (F.length(F.coalesce("source_name", F.lit(""))) >= NAME_MIN)
        & (F.length(F.coalesce("license_name", F.lit(""))) >= LICENSE_MIN)
        & (F.length(F.coalesce("coverage_description", F.lit(""))) >= COVERAGE_MIN)
        & F.coalesce(F.col("source_url").rlike(HTTP_URL_PATTERN), F.lit(False))
        & F.col("retrieved_at").try_cast("timestamp").isNotNull()
        & F.col("local_processing_permitted").isNotNull()
    )
    return manifests.select(
        "*",
        valid.alias("manifest_valid"),
        (valid & F.coalesce("local_processing_permitted", F.lit(False))).alias("ingestible"),
    )


def gate_sources(events: DataFrame, manifests: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of ``events`` whose ``source_name`` has an ingestible manifest.

    A ``left_semi`` join on source name: the manifest side is a handful of rows, so the
    planner broadcasts it and the event side is never shuffled. ``strict`` fails the job when
    any event row's source is not ingestible (a job that reads such rows stops).
    """
    allowed = check_manifests(manifests).where("ingestible").select("source_name").distinct()
    gated = events.join(allowed, "source_name", "left_semi")
    if strict:
        blocked = events.join(allowed, "source_name", "left_anti").agg(F.count(F.lit(1))).scalar()
        gated = gated.withColumn("source_name", F.coalesce(
            F.assert_true(blocked == 0, F.lit("not approved: the events hold a source without a manifest that permits processing")), F.col("source_name")))
    return gated
