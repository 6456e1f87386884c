"""Dashboard KPI queries over the fact table (and the audit / archive tables).

All are aggregates with partial (map-side) aggregation; the results are tiny. Exact medians are read
off counts per delay value (``marts.delay_summary``), so no group's rows meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.functions import expressions as E
from delaylens.operators.marts import delay_summary, observed


def _delay():
    return F.col("arrival_delay_minutes").cast("double")

# Fixed values of the dashboard: minimum observations for a hotspot, default and allowed
# hotspot count, watchlist size, and the status-envelope states.
HOTSPOT_MIN_OBSERVATIONS = 30
HOTSPOT_DEFAULT_LIMIT = 10
HOTSPOT_MAX_LIMIT = 25
WATCHLIST_SIZE = 5
STATE_READY = "ready"
STATE_NOT_FOUND = "not_found"
STATE_NOT_EVALUATED = "not_evaluated"
STATE_AWAITING = "awaiting_approved_source"


def last_successful_run(audit: DataFrame, source_name: str) -> DataFrame:
    """Completion time of the newest succeeded run of a source (one row, may be null)."""
    return audit.where((F.col("status") == "succeeded") & (F.col("source_name") == source_name)) \
                .agg(F.max("completed_at").alias("last_successful_pipeline_at"))


def network_overview(fact: DataFrame, dim_station: DataFrame, audit: DataFrame, source_name: str) -> DataFrame:
    """A1 + A17 + A16: one row of network KPIs.

    Journeys are counted apart from the delays, and the delays from counts per value; the station
    count, the journeys and the last successful run are scalar subqueries, so no join is planned.
    """
    o = observed(fact)
    journeys = o.select("train_number", "journey_date").distinct().agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.min("journey_date").alias("first"), F.max("journey_date").alias("last"))).scalar()
    delays = delay_summary(o).withColumn("j", journeys)
    known = F.coalesce(F.col("observations"), F.lit(0))
    return delays.select(
        F.when(known > 0, F.lit(STATE_READY)).otherwise(F.lit(STATE_AWAITING)).alias("state"),
        F.col("j.n").cast("long").alias("journeys_analysed"),
        dim_station.agg(F.count(F.lit(1)).cast("long")).scalar().alias("stations"),
        E.round6(F.col("mean")).alias("average_arrival_delay_minutes"),
        E.round6(F.col("median")).alias("median_arrival_delay_minutes"),
        E.round6(F.col("on_time")).alias("on_time_or_early_percent"),
        known.cast("long").alias("station_stop_observations"),
        F.col("j.first").alias("coverage_start_date"), F.col("j.last").alias("coverage_end_date"),
        last_successful_run(audit, source_name).scalar().alias("last_successful_pipeline_at"),
    )


def delay_distribution(fact: DataFrame) -> DataFrame:
    """A5 + P12: observations per delay band, in band order."""
    delay = _delay()
    return observed(fact).groupBy(
        E.delay_band_label(delay).alias("label"),
        E.delay_band_order(delay).alias("band_order"),
    ).agg(F.count(F.lit(1)).alias("observations")).orderBy("band_order")


def station_hotspots(fact: DataFrame, limit: int = HOTSPOT_DEFAULT_LIMIT) -> DataFrame:
    """Stations with >= 30 observations, top ``limit`` by mean delay (ties: count, code)."""
    if not 1 <= limit <= HOTSPOT_MAX_LIMIT:
        raise ValueError(f"limit must be within 1..{HOTSPOT_MAX_LIMIT}")
    agg = delay_summary(observed(fact), "station_code").where(F.col("observations") >= HOTSPOT_MIN_OBSERVATIONS)
    top = agg.orderBy(F.col("mean").desc(), F.col("observations").desc(), F.col("station_code").asc()) \
             .limit(limit)
    return top.select(
        "station_code", "observations",
        E.round6(F.col("mean")).alias("average_delay_minutes"),
        E.round6(F.col("median")).alias("median_delay_minutes"),
        E.round6(F.col("on_time")).alias("on_time_percent"),
    )


def daily_trend(fact: DataFrame) -> DataFrame:
    """Per journey date: observations, mean and median delay."""
    return delay_summary(observed(fact), "journey_date").select(
        "journey_date", "observations",
        E.round6(F.col("mean")).alias("average_delay_minutes"),
        E.round6(F.col("median")).alias("median_delay_minutes"),
    ).orderBy("journey_date")


def train_profile(fact: DataFrame, requests: DataFrame) -> DataFrame:
    """A8 + P21: one profile row per requested train number, with its status envelope state.

    ``requests`` holds the asked-for train numbers (one column ``train_number``; a request is
    a handful of ids). The fact is semi-joined to the requests before aggregating, so only
    requested trains are aggregated; unknown trains come back as ``not_found`` with null
    metrics (never invented zeros).
    """
    delay = _delay()
    req = requests.select(F.col("train_number").cast("string")).distinct()
    rows = observed(fact).join(req, "train_number", "left_semi")
    agg = rows.groupBy("train_number").agg(
        F.count_distinct("journey_date").cast("long").alias("journeys"),
        F.count(F.lit(1)).cast("long").alias("observations"),
        E.round6(F.avg(delay)).alias("average_delay_minutes"),
        E.round6(F.median(delay)).alias("median_delay_minutes"),
        E.round6(E.percent_where(delay <= E.ON_TIME_MAX_MINUTES)).alias("on_time_percent"),
    )
    out = req.join(agg, "train_number", "left")
    found = F.col("observations").isNotNull() & (F.col("observations") > 0)
    return out.select(
        F.when(found, F.lit(STATE_READY)).otherwise(F.lit(STATE_NOT_FOUND)).alias("state"),
        "train_number", "journeys", "observations", "average_delay_minutes",
        "median_delay_minutes", "on_time_percent",
    )


def watchlist_top_k(fact: DataFrame, start_date: str, end_date: str, k: int = WATCHLIST_SIZE,
                    strict: bool = False) -> DataFrame:
    """A14 + P17: top ``k`` trains by observations in [start, end), ties by train number."""
    if start_date >= end_date:
        raise ValueError("the range ends before it starts")
    rows = fact.where((F.col("journey_date") >= F.lit(start_date).cast("date")) &
                      (F.col("journey_date") < F.lit(end_date).cast("date")))
    top = rows.groupBy("train_number").agg(F.count(F.lit(1)).cast("long").alias("observations")) \
              .orderBy(F.col("observations").desc(), F.col("train_number").asc()).limit(k)
    if strict:
        # Fail the job (not the driver) when fewer than k trains exist.
        n = top.agg(F.count(F.lit(1))).scalar()
        top = top.withColumn("train_number", E.guard("train_number", n == k, f"expected {k} watchlist trains"))
    return top


def archive_summary(snapshots: DataFrame) -> DataFrame:
    """Snapshots, distinct trains, first and latest retrieval, mean delay."""
    return snapshots.agg(
        F.count(F.lit(1)).cast("long").alias("snapshots"),
        F.count_distinct("train_number").cast("long").alias("trains"),
        F.min("retrieved_at").alias("first_retrieved_at"),
        F.max("retrieved_at").alias("latest_retrieved_at"),
        E.round6(F.avg(F.col("delay_minutes").cast("double"))).alias("average_delay_minutes"),
    )


def pipeline_health(audit: DataFrame, dataset: str, source_name: str) -> DataFrame:
    """Newest run (by start) of a dataset and source with its counters; without any run, one
    row whose state says so.

    The newest row is found with ``max_by`` (a partial aggregate) instead of a sort.
    """
    rows = audit.where((F.col("dataset") == dataset) & (F.col("source_name") == source_name))
    newest = rows.agg(F.max_by(F.struct("status", "records_received", "records_rejected", "completed_at"),
                               F.struct("started_at", "run_id")).alias("r"),
                      F.count(F.lit(1)).alias("_n"))
    return newest.select(
        F.when(F.col("_n") > 0, F.lit(STATE_READY)).otherwise(F.lit(STATE_AWAITING)).alias("state"),
        F.col("r.status").alias("last_run_status"),
        F.col("r.records_received").cast("long").alias("records_received"),
        F.col("r.records_rejected").cast("long").alias("records_rejected"),
        F.col("r.completed_at").alias("completed_at"),
    )


def prediction_summary(evaluation_audit: DataFrame) -> DataFrame:
    """A16 + P21: the newest chronological evaluation, or a ``not_evaluated`` row with null
    metrics when the audit is empty. Newest by ``evaluated_at`` via ``max_by`` (no sort)."""
    cols = ["model_name", "evaluation_rows", "mae", "rmse", "baseline_mae", "accepted_for_prediction"]
    newest = evaluation_audit.agg(
        F.max_by(F.struct(*cols), F.struct("evaluated_at", "model_version")).alias("r"),
        F.max("evaluated_at").alias("evaluated_at"),
        F.count(F.lit(1)).alias("_n"),
    )
    return newest.select(
        F.when(F.col("_n") > 0, F.lit(STATE_READY)).otherwise(F.lit(STATE_NOT_EVALUATED)).alias("state"),
        *[F.col(f"r.{c}").alias(c) for c in cols],
        F.col("evaluated_at").alias("last_successful_pipeline_at"),
    )


# --------------------------------------------------------------------------- P21
STATE_MESSAGES = {
    STATE_READY: "the figures cover all loaded events",
    STATE_AWAITING: "no approved source has been loaded for this yet",
    STATE_NOT_FOUND: "no observed stop of this train",
    STATE_NOT_EVALUATED: "no chronological evaluation has been run yet",
}


def envelope(name: str, rows: DataFrame, audit: DataFrame, source_name: str) -> DataFrame:
    """One row about a KPI: its state, what that means, and the last successful run.

    KPIs with a state of their own (one row, or one per asked-for train) pass it on; a KPI that is a
    set of rows is ready as soon as it has one.
    """
    if "state" in rows.columns:
        state = rows.agg(F.coalesce(F.max("state"), F.lit(STATE_AWAITING)).alias("state"))
    else:
        state = rows.limit(1).agg(F.when(F.count(F.lit(1)) > 0, F.lit(STATE_READY)).otherwise(F.lit(STATE_AWAITING)).alias("state"))
    message = F.create_map(*[F.lit(x) for pair in STATE_MESSAGES.items() for x in pair])[F.col("state")]
    return state.select(F.lit(name).alias("kpi"), "state", message.alias("message"),
                        last_successful_run(audit, source_name).scalar().alias("last_successful_pipeline_at"))
