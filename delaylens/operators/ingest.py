"""Ingest operators: stop-sequence lookup, validation split, quarantine, de-duplication, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.functions import expressions as E
from delaylens.functions.rules import failed_rules, rules_pass, running_event_rules
from delaylens.operators import tables
from delaylens.sources.files import FIELD_COUNT, MALFORMED

# Canonical column list of a running event, sorted by name, used for the record hash.
CANONICAL_EVENT_COLUMNS = sorted([
    "train_number", "journey_date", "station_code", "station_sequence", "source_name",
    "scheduled_arrival_at", "actual_arrival_at", "scheduled_departure_at", "actual_departure_at",
    "arrival_delay_minutes", "departure_delay_minutes", "status",
])


# --------------------------------------------------------------------------- J1
def route_lookup(routes: DataFrame) -> DataFrame:
    """Route CSV rows -> one (train_key, station_key, station_sequence) row per lookup key.

    A stop is findable by its code and by its name. Rows with a blank train, blank or
    non-numeric serial are skipped. When several rows give the same key, a code match wins
    over a name match, then the lowest sequence (chosen rule: Spark has no file order).
    Resolved with a partial-aggregating ``min`` over a struct, so a hot key is reduced
    map-side before the shuffle.
    """
    r = routes.select(
        E.normalize_key("trainNumber").alias("train_key"),
        E.sequence_from_text("stnSerialNumber").alias("station_sequence"),
        E.normalize_key("station_code").alias("code_key"),
        E.normalize_key("station_name").alias("name_key"),
    ).where((F.col("train_key") != "") & F.col("station_sequence").isNotNull())
    keyed = r.select(
        "train_key", "station_sequence",
        F.explode(F.array(
            F.struct(F.col("code_key").alias("station_key"), F.lit(0).alias("match_rank")),
            F.struct(F.col("name_key").alias("station_key"), F.lit(1).alias("match_rank")),
        )).alias("k"),
    ).select("train_key", "station_sequence", "k.station_key", "k.match_rank") \
     .where(F.col("station_key") != "")
    best = keyed.groupBy("train_key", "station_key").agg(
        F.min(F.struct("match_rank", "station_sequence")).alias("best"))
    return best.select("train_key", "station_key", F.col("best.station_sequence").alias("station_sequence"))


#: The column by which a load deals its rows.
DEAL = "deal_key"


def _deal_key(train: Column, *rest: str) -> Column:
    """The train as it is stored. Rows without one, which match nothing, are spread by the ``rest``."""
    stored = E.normalize_id(train)
    return F.when(stored == "", F.concat(F.lit(" "), F.xxhash64(*rest).cast("string"))).otherwise(stored) if rest else stored


def attach_stop_sequence(delays: DataFrame, routes: DataFrame, source_name: str = "delay_csv_feed",
                         deal_to: int | None = None) -> DataFrame:
    """Delay CSV rows -> canonical running-event records with a stop sequence (0 on a miss).

    A left join on (train, station) keys against a lookup holding one row per key, so no
    delay row is ever multiplied. The join strategy is left to AQE: the lookup is broadcast
    when its runtime size is under the broadcast threshold, else sort-merge.

    With ``deal_to`` the rows, as the file has them, are dealt to that many tasks by train, for the
    lookup and for what follows; the column ``DEAL`` is kept.
    """
    lookup, dealt = route_lookup(routes), []
    if deal_to:
        dealt = [DEAL]
        delays = delays.withColumn(DEAL, _deal_key(E.normalize_key("train"), *delays.columns)).repartition(deal_to, DEAL)
        lookup = lookup.withColumn(DEAL, _deal_key(F.col("train_key"))).repartition(deal_to, DEAL)
    d = delays.select(
        *dealt,
        E.normalize_key("train").alias("train_number"),
        E.strip("date").alias("journey_date_text"),
        E.normalize_key("station").alias("station_code"),
        E.optional_number("arr_delay").alias("arrival_delay_minutes"),
        E.optional_number("dep_delay").alias("departure_delay_minutes"),
        E.not_a_number("arr_delay").alias("arrival_delay_not_a_number"),
        E.not_a_number("dep_delay").alias("departure_delay_not_a_number"),
        F.col("arr_delay").alias("source_arrival_delay_text"),
        F.col("dep_delay").alias("source_departure_delay_text"),
        *[c for c in (MALFORMED,) if c in delays.columns],
        E.blank_to_null("sch_arr").alias("source_scheduled_arrival_time"),
        E.blank_to_null("act_arr").alias("source_actual_arrival_time"),
        E.blank_to_null("sch_dep").alias("source_scheduled_departure_time"),
        E.blank_to_null("act_dep").alias("source_actual_departure_time"),
    )
    joined = d.join(
        lookup,
        [*[d[c] == lookup[c] for c in dealt], d.train_number == lookup.train_key, d.station_code == lookup.station_key],
        "left",
    )
    ts_null = F.lit(None).cast("timestamp_ntz")
    return joined.select(
        "train_number",
        "journey_date_text",
        "station_code",
        F.coalesce(F.col("station_sequence"), F.lit(0)).alias("station_sequence"),
        ts_null.alias("scheduled_arrival_at"),
        ts_null.alias("actual_arrival_at"),
        ts_null.alias("scheduled_departure_at"),
        ts_null.alias("actual_departure_at"),
        "arrival_delay_minutes",
        "departure_delay_minutes",
        "arrival_delay_not_a_number",
        "departure_delay_not_a_number",
        F.lit("observed").alias("status"),
        F.lit(source_name).alias("source_name"),
        "source_scheduled_arrival_time",
        "source_actual_arrival_time",
        "source_scheduled_departure_time",
        "source_actual_departure_time",
        "source_arrival_delay_text",
        "source_departure_delay_text",
        *[c for c in (MALFORMED,) if c in delays.columns],
        *[d[c] for c in dealt],
    )


# --------------------------------------------------------------------------- P6
def with_rule_check(df: DataFrame, date_is_text: bool = False) -> DataFrame:
    """Adds ``errors``: array of failed rule codes (empty = valid). One narrow projection."""
    rules = running_event_rules(date_is_text=date_is_text)
    if "arrival_delay_not_a_number" in df.columns:
        rules += [
            ("arrival_delay_not_a_number", F.col("arrival_delay_not_a_number")),
            ("departure_delay_not_a_number", F.col("departure_delay_not_a_number")),
        ]
    ok, errors = rules_pass(rules), failed_rules(rules)
    if "invalid_times" in df.columns:  # names of the contract's timestamps that don't parse
        ok, errors = ok & (F.size("invalid_times") == 0), F.concat(errors, F.col("invalid_times"))
    if MALFORMED in df.columns:  # of a row with a wrong number of fields, no field is judged
        whole = F.col(MALFORMED).isNull()
        ok, errors = whole & ok, F.when(whole, errors).otherwise(F.array(F.lit(FIELD_COUNT)))
    return df.withColumn("rules_ok", ok).withColumn("errors", errors)


def normalize_accepted(df: DataFrame) -> DataFrame:
    """Contract normalization of accepted rows: strip strings, upper-case identifiers."""
    out = df.withColumn("train_number", E.normalize_id("train_number")) \
            .withColumn("station_code", E.normalize_id("station_code")) \
            .withColumn("source_name", E.strip("source_name"))
    if "status" in df.columns:
        out = out.withColumn("status", E.strip("status"))
    if "journey_date_text" in df.columns:
        out = out.withColumn("journey_date", E.strip("journey_date_text").try_cast("date")) \
                 .drop("journey_date_text")
    return out


def validate(df: DataFrame, date_is_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split into (accepted, rejected). Rejected rows keep the record and an ``errors`` array.

    Both outputs derive from one checked projection; a job that writes both materializes it
    once (see ``plans.load_run``) instead of scanning the source twice.
    """
    checked = with_rule_check(df, date_is_text=date_is_text)
    accepted = normalize_accepted(checked.where(F.col("rules_ok")).drop("errors", "rules_ok"))
    rejected = checked.where(~F.col("rules_ok")).drop("rules_ok")
    return accepted, rejected


# --------------------------------------------------------------------------- K3
def quarantine_records(rejected: DataFrame, hash_columns: list[str] | None = None) -> DataFrame:
    """Quarantine rows: the whole record as JSON (texts as they came), the failed rule codes and the
    record hash; the checks' own columns are left out."""
    record_cols = [c for c in rejected.columns if c not in ("errors", "rules_ok") and not c.endswith("_not_a_number")]
    hash_columns = hash_columns or sorted(c for c in record_cols if c in CANONICAL_EVENT_COLUMNS)
    out = rejected.select(
        F.to_json(F.struct(*record_cols), {"ignoreNullFields": "false"}).alias("record"),
        F.col("errors"),
        F.concat_ws(",", "errors").alias("error_codes"),
        (F.col("source_record_hash") if "source_record_hash" in record_cols
         else E.record_hash(*hash_columns)).alias("source_record_hash"),
        *[c for c in record_cols if c != "source_record_hash"],
    )
    return out


# --------------------------------------------------------------------------- O5 / W4
def exact_dedupe(df: DataFrame, key: str = "source_record_hash") -> DataFrame:
    """One row per content hash. Equal hashes mean equal rows, so any survivor is right;
    ``dropDuplicates`` aggregates partially map-side, so a hot hash is collapsed before the shuffle."""
    if df.schema[key].dataType.typeName() != "string":
        return df.dropDuplicates([key])
    return df.withColumn(key, tables.packed(key)).dropDuplicates([key]).withColumn(key, tables.unpacked(key))


def dedupe_by_hash(df: DataFrame, key: str = "source_record_hash",
                   order: tuple[str, ...] = ("train_number", "journey_date", "station_sequence"),
                   within: str | None = None) -> DataFrame:
    """QUALIFY row_number() over (partition by hash order by ...) = 1, deterministic survivor.
    ``within``: a column that the hash covers, by which the rows lie already."""
    w = Window.partitionBy(*([within] if within else []), key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


# --------------------------------------------------------------------------- A10 / J2
def load_counters(checked: DataFrame, target: DataFrame, key: str = "source_record_hash") -> DataFrame:
    """received, valid, rejected, distinct_valid, inserted, already_present for one load.

    ``checked`` carries the ``errors`` array. Counting is one aggregate over the batch plus a
    semi join of the distinct valid hashes to the target: no accumulators (unsafe on retry),
    and no driver-side loop.
    """
    totals = checked.agg(
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("rules_ok")).alias("valid"),
        F.count_if(~F.col("rules_ok")).alias("rejected"),
    )
    # Distinct valid hashes, and those of them that the target holds: a semi join, which takes a target
    # with repeated keys as it is.
    distinct_valid = checked.where(F.col("rules_ok")).select(key).distinct()
    known = distinct_valid.join(target.select(key), key, "left_semi")
    n_distinct = distinct_valid.agg(F.count(F.lit(1)).cast("long")).scalar()
    n_known = known.agg(F.count(F.lit(1)).cast("long")).scalar()
    # One-row aggregates combined as scalar subqueries (no join).
    return totals.select(
        F.col("received").cast("long"),
        F.col("valid").cast("long"),
        F.col("rejected").cast("long"),
        n_distinct.alias("distinct_valid"), (n_distinct - n_known).alias("inserted"), n_known.alias("already_present"),
    )


def preflight_counts(events: DataFrame, date_is_text: bool = False) -> DataFrame:
    """Dry run: exact duplicates removed first, then validated; accepted/rejected counts."""
    deduped = exact_dedupe(events)
    checked = with_rule_check(deduped, date_is_text=date_is_text)
    return checked.agg(
        F.count_if(F.col("rules_ok")).cast("long").alias("accepted_count"),
        F.count_if(~F.col("rules_ok")).cast("long").alias("rejected_count"),
    )


# --------------------------------------------------------------------------- P16
def train_numbers(requests: DataFrame, column: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Distinct requested train numbers as (valid, invalid); valid are exactly five digits.

    ``strict`` stops with the list of the invalid ones, or if none is given.
    """
    given = requests.select(E.strip(column).alias("train_number")).distinct()
    fits = F.coalesce(F.col("train_number").rlike(E.FIVE_DIGIT_TRAIN_PATTERN), F.lit(False))
    valid, invalid = given.where(fits), given.where(~fits)
    if strict:
        # A request names a handful of trains; what is wrong with it is told whole.
        state = given.agg(F.count(F.lit(1)).alias("n"), F.concat_ws(", ", F.sort_array(F.collect_list(
            F.when(~fits, F.coalesce("train_number", F.lit("(null)")))))).alias("bad"))
        state.select(F.when(F.col("n") == 0, F.raise_error(F.lit("no train number is given")))
                     .when(F.col("bad") != "", F.raise_error(F.concat(F.lit("train numbers need five digits: "), "bad")))).first()
    return valid, invalid
