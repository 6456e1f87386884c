"""DuckDB SQL of the model layers, used to build the independent oracle of every query.

The oracle is written from the model definitions in plain SQL (windows, joins, aggregates);
it shares nothing with the Spark code except the fixture text. ``with_views`` emits a
``WITH`` clause holding the fixtures and layers a query needs, in dependency order.
"""

from __future__ import annotations

from delaylens.sources.fixtures import FIXTURE_SQL, fixture_sql

# name -> (dependencies, body)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def view(name: str, deps: tuple[str, ...], body: str) -> None:
    VIEWS[name] = (deps, body)


# ----------------------------------------------------------------------- validation
RUNNING_RULES_SQL = """
  (train_number IS NULL OR length(trim(train_number)) NOT BETWEEN 1 AND 16) AS f_train,
  (journey_date IS NULL) AS f_date,
  (station_code IS NULL OR length(trim(station_code)) NOT BETWEEN 1 AND 16) AS f_station,
  (station_sequence IS NULL OR station_sequence <= 0) AS f_sequence,
  (source_name IS NULL OR length(trim(source_name)) NOT BETWEEN 1 AND 100) AS f_source,
  (arrival_delay_minutes IS NOT NULL AND NOT (arrival_delay_minutes BETWEEN -1440 AND 10080)) AS f_arr,
  (departure_delay_minutes IS NOT NULL AND NOT (departure_delay_minutes BETWEEN -1440 AND 10080)) AS f_dep
"""

view("running_checked", ("running_raw",), f"""
SELECT *, {RUNNING_RULES_SQL} FROM running_raw
""")

view("running_accepted", ("running_checked",), """
SELECT upper(trim(train_number)) AS train_number, journey_date, upper(trim(station_code)) AS station_code,
       station_sequence, scheduled_arrival_at, actual_arrival_at, arrival_delay_minutes,
       departure_delay_minutes, trim(status) AS status, trim(source_name) AS source_name, ingested_at,
       l_orderkey, source_record_hash
FROM running_checked
WHERE NOT (f_train OR f_date OR f_station OR f_sequence OR f_source OR f_arr OR f_dep)
""")

view("running_rejected", ("running_checked",), """
SELECT *, concat_ws(',',
         CASE WHEN f_train THEN 'train_number_length' END,
         CASE WHEN f_date THEN 'journey_date_invalid' END,
         CASE WHEN f_station THEN 'station_code_length' END,
         CASE WHEN f_sequence THEN 'station_sequence_not_positive' END,
         CASE WHEN f_source THEN 'source_name_length' END,
         CASE WHEN f_arr THEN 'arrival_delay_out_of_range' END,
         CASE WHEN f_dep THEN 'departure_delay_out_of_range' END) AS error_codes
FROM running_checked
WHERE f_train OR f_date OR f_station OR f_sequence OR f_source OR f_arr OR f_dep
""")

# ----------------------------------------------------------------------- staging
view("stg_train_running", ("running_accepted",), """
SELECT * EXCLUDE (rn) FROM (
  SELECT CAST(train_number AS VARCHAR) AS train_number,
         CAST(journey_date AS DATE) AS journey_date,
         CAST(station_code AS VARCHAR) AS station_code,
         CAST(station_sequence AS INTEGER) AS station_sequence,
         CAST(scheduled_arrival_at AS TIMESTAMP) AS scheduled_arrival_at,
         CAST(actual_arrival_at AS TIMESTAMP) AS actual_arrival_at,
         CAST(NULL AS TIMESTAMP) AS scheduled_departure_at,
         CAST(NULL AS TIMESTAMP) AS actual_departure_at,
         CAST(CAST(arrival_delay_minutes AS DECIMAL(12,2)) AS DOUBLE) AS arrival_delay_minutes,
         CAST(CAST(departure_delay_minutes AS DECIMAL(12,2)) AS DOUBLE) AS departure_delay_minutes,
         CAST(status AS VARCHAR) AS journey_status,
         source_record_hash,
         CAST(ingested_at AS TIMESTAMP) AS ingested_at,
         row_number() OVER (PARTITION BY train_number, journey_date, station_code, station_sequence
                            ORDER BY ingested_at DESC NULLS FIRST, source_record_hash DESC NULLS FIRST) AS rn
  FROM running_accepted) t
WHERE rn = 1
""")

view("stg_train_schedule", ("schedule_raw",), """
SELECT * EXCLUDE (rn) FROM (
  SELECT CAST(train_number AS VARCHAR) AS train_number, CAST(train_name AS VARCHAR) AS train_name,
         CAST(train_type AS VARCHAR) AS train_type,
         CAST(source_station_code AS VARCHAR) AS source_station_code,
         CAST(destination_station_code AS VARCHAR) AS destination_station_code,
         CAST(station_code AS VARCHAR) AS station_code, CAST(station_name AS VARCHAR) AS station_name,
         CAST(station_sequence AS INTEGER) AS station_sequence,
         CAST(schedule_arrival_time AS VARCHAR) AS schedule_arrival_time,
         CAST(schedule_departure_time AS VARCHAR) AS schedule_departure_time,
         CAST(journey_day_number AS INTEGER) AS journey_day_number,
         CAST(CAST(distance_km AS DECIMAL(12,2)) AS DOUBLE) AS distance_km,
         source_name, source_record_hash, CAST(ingested_at AS TIMESTAMP) AS ingested_at,
         row_number() OVER (PARTITION BY train_number, station_code, station_sequence
                            ORDER BY ingested_at DESC NULLS FIRST, source_record_hash DESC NULLS FIRST) AS rn
  FROM schedule_raw) t
WHERE rn = 1
""")

# ----------------------------------------------------------------------- intermediate
view("int_running", ("stg_train_running",), """
SELECT *,
       lag(arrival_delay_minutes) OVER (PARTITION BY train_number, journey_date
                                        ORDER BY station_sequence, station_code) AS previous_station_arrival_delay_minutes,
       CASE WHEN actual_arrival_at IS NOT NULL AND scheduled_arrival_at IS NOT NULL
            THEN CAST(date_diff('minute', date_trunc('minute', scheduled_arrival_at),
                                date_trunc('minute', actual_arrival_at)) AS DOUBLE) END AS derived_arrival_delay_minutes
FROM stg_train_running
""")

# ----------------------------------------------------------------------- fact, features, dims
FACT_SELECT = """
  train_number, journey_date, station_code, station_sequence,
  scheduled_arrival_at, actual_arrival_at, scheduled_departure_at, actual_departure_at,
  coalesce(arrival_delay_minutes, derived_arrival_delay_minutes) AS arrival_delay_minutes,
  departure_delay_minutes, previous_station_arrival_delay_minutes, journey_status,
  source_record_hash, ingested_at
"""

view("fact", ("int_running",), f"SELECT {FACT_SELECT} FROM int_running")

view("observed", ("fact",), "SELECT * FROM fact WHERE arrival_delay_minutes IS NOT NULL")

view("features", ("fact",), """
SELECT train_number, journey_date, station_code, station_sequence,
       scheduled_arrival_at AS prediction_at,
       previous_station_arrival_delay_minutes,
       CAST(dayofweek(scheduled_arrival_at) AS INTEGER) AS scheduled_arrival_day_of_week,
       CAST(hour(scheduled_arrival_at) AS INTEGER) AS scheduled_arrival_hour,
       arrival_delay_minutes AS target_arrival_delay_minutes
FROM fact
""")

view("dim_route_stop", ("stg_train_schedule",), """
SELECT train_number, station_code, station_sequence, journey_day_number, distance_km,
       schedule_arrival_time, schedule_departure_time, source_name, ingested_at AS record_updated_at
FROM stg_train_schedule
""")

view("dim_station", ("stg_train_schedule",), """
SELECT station_code, station_name, source_name, record_updated_at FROM (
  SELECT station_code, station_name, source_name, ingested_at AS record_updated_at,
         row_number() OVER (PARTITION BY station_code
                            ORDER BY (station_name IS NOT NULL) DESC, ingested_at DESC NULLS FIRST,
                                     station_name ASC NULLS LAST) AS rn
  FROM stg_train_schedule) t
WHERE rn = 1
""")

view("dim_train", ("stg_train_schedule",), """
SELECT DISTINCT train_number, train_name, train_type, source_station_code AS origin_station_code,
       destination_station_code, source_name, ingested_at AS record_updated_at
FROM stg_train_schedule
""")


def _resolve(names: tuple[str, ...], out: list[str]) -> None:
    for n in names:
        if n in out:
            continue
        if n in VIEWS:
            _resolve(VIEWS[n][0], out)
        elif n not in FIXTURE_SQL:
            raise KeyError(n)
        if n not in out:
            out.append(n)


#: The raw rows as they come, for checks that look for what validation would have removed.
UNVALIDATED = {"running_accepted": """
SELECT train_number, journey_date, station_code, station_sequence, scheduled_arrival_at, actual_arrival_at,
       arrival_delay_minutes, departure_delay_minutes, status, source_name, ingested_at, l_orderkey, source_record_hash
FROM running_raw"""}


def with_views(*names: str, replace: dict[str, str] | None = None) -> str:
    """``WITH`` clause for the named views/fixtures and everything they depend on.

    ``replace`` gives a view or fixture the body of another fixture, or a body of its own.
    """
    order: list[str] = []
    _resolve(tuple(names), order)
    replace = replace or {}
    parts = []
    for n in order:
        name = replace.get(n, n)
        body = fixture_sql(name, "duckdb") if name in FIXTURE_SQL else VIEWS[name][1] if name in VIEWS else name
        parts.append(f"{n} AS (\n{body.strip()}\n)")
    return "WITH " + ",\n".join(parts) + "\n"


def oracle(query: str, *names: str, replace: dict[str, str] | None = None) -> str:
    return with_views(*names, replace=replace) + query.strip()
