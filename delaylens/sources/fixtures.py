"""Domain tables derived from the driver's synthetic parquet tables (FIXTURES.md part B).

Each fixture is written once as SQL for both engines. Markers are replaced per dialect:

- ``@TS@``                    TIMESTAMP_NTZ (Spark) / TIMESTAMP (DuckDB)
- ``@SHA@(`` ... ``@SHA2@)``  ``sha2(..., 256)`` (Spark) / ``sha256(...)`` (DuckDB)
- ``@COPIES@``                every 50th order's rows twice (a generator, so that it is one scan)
- ``{lineitem}`` etc.         a parquet path (Spark) / the pre-registered view (DuckDB)

The fixtures only reshape the driver tables into the transit schemas; every operator that is
checked runs on top of them, in DataFrame code on the Spark side and in plain SQL in the oracle.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("lineitem", "supplier", "events")

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["running_raw"] = """
WITH base AS (
  SELECT CAST(10000 + l_suppkey AS STRING) AS train_number,
         DATE '2024-09-01' + CAST(l_orderkey % 30 AS INT) AS journey_date,
         CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE concat('S', CAST(l_partkey % 40 AS STRING)) END AS station_code,
         CAST(CASE WHEN l_partkey % 97 = 0 THEN 0 ELSE l_linenumber END AS INT) AS station_sequence,
         CASE WHEN l_tax = 0.0 THEN NULL WHEN l_partkey % 89 = 0 THEN 20000.0
              ELSE l_quantity * 3 - 40 END AS arrival_delay_minutes,
         CASE WHEN l_discount = 0.0 THEN NULL ELSE l_quantity * 3 - 38 END AS departure_delay_minutes,
         CAST(l_quantity AS INT) * 3 - 40 AS true_delay,
         l_returnflag AS status,
         'synthetic_lineitem' AS source_name,
         CAST(l_shipdate AS @TS@) AS ingested_at,
         l_orderkey, l_partkey
  FROM {lineitem}),
timed AS (
  SELECT *,
         CASE WHEN l_partkey % 83 = 0 THEN NULL
              ELSE CAST(journey_date AS @TS@) + (station_sequence * 2820 + 59) * INTERVAL '1' SECOND END AS scheduled_arrival_at,
         CASE WHEN l_partkey % 5 = 0 THEN NULL
              ELSE CAST(journey_date AS @TS@) + (station_sequence * 2820 + 59 + true_delay * 60 + 2) * INTERVAL '1' SECOND
         END AS actual_arrival_at
  FROM base),
hashed AS (
  SELECT train_number, journey_date, station_code, station_sequence,
         scheduled_arrival_at, actual_arrival_at,
         arrival_delay_minutes, departure_delay_minutes, status, source_name, ingested_at, l_orderkey,
         @SHA@(concat_ws('|', train_number, CAST(journey_date AS STRING), station_code,
               CAST(station_sequence AS STRING),
               coalesce(CAST(CAST(arrival_delay_minutes AS BIGINT) AS STRING), '~'),
               coalesce(CAST(CAST(departure_delay_minutes AS BIGINT) AS STRING), '~'),
               status, CAST(CAST(ingested_at AS DATE) AS STRING))@SHA2@) AS source_record_hash
  FROM timed)
SELECT hashed.* FROM hashed @COPIES@
"""

FIXTURE_SQL["schedule_raw"] = """
SELECT CAST(10000 + l_suppkey AS STRING) AS train_number,
       s_name AS train_name,
       CAST(NULL AS STRING) AS train_type,
       CAST(NULL AS STRING) AS source_station_code,
       CAST(NULL AS STRING) AS destination_station_code,
       concat('S', CAST(l_partkey % 40 AS STRING)) AS station_code,
       CASE WHEN l_partkey % 7 = 0 THEN NULL
            ELSE concat('Station ', CAST(l_partkey % 40 AS STRING),
                        CASE WHEN l_partkey % 3 = 0 THEN ' Jn' ELSE '' END) END AS station_name,
       l_linenumber AS station_sequence,
       concat(lpad(CAST(l_linenumber AS STRING), 2, '0'), ':15') AS schedule_arrival_time,
       concat(lpad(CAST(l_linenumber AS STRING), 2, '0'), ':20') AS schedule_departure_time,
       CAST(NULL AS INT) AS journey_day_number,
       CAST((l_partkey % 40) * 12.5 AS DOUBLE) AS distance_km,
       'synthetic_lineitem' AS source_name,
       CAST(l_shipdate AS @TS@) AS ingested_at,
       @SHA@(concat_ws('|', CAST(l_suppkey AS STRING), CAST(l_partkey AS STRING),
             CAST(l_linenumber AS STRING), CAST(CAST(l_shipdate AS DATE) AS STRING))@SHA2@) AS source_record_hash
FROM {lineitem} JOIN {supplier} ON l_suppkey = s_suppkey
"""

# The schedule with one stop in 53 under another code, for the checks that look for orphans.
FIXTURE_SQL["schedule_gaps"] = FIXTURE_SQL["schedule_raw"].replace(
    "concat('S', CAST(l_partkey % 40 AS STRING)) AS station_code",
    "concat(CASE WHEN l_partkey % 53 = 0 THEN 'X' ELSE 'S' END, CAST(l_partkey % 40 AS STRING)) AS station_code")

FIXTURE_SQL["delay_csv"] = """
SELECT concat(CAST(10000 + l_suppkey AS STRING), CASE WHEN l_orderkey % 3 = 0 THEN '.0' ELSE '' END) AS train,
       CAST(DATE '2024-09-01' + CAST(l_orderkey % 30 AS INT) AS STRING) AS date,
       concat(' s', CAST(l_partkey % 40 AS STRING), ' ') AS station,
       '08:00 AM' AS sch_arr,
       CASE WHEN l_tax = 0.0 THEN '' ELSE '08:01 AM' END AS act_arr,
       CASE WHEN l_tax = 0.0 THEN '' ELSE CAST(CAST(l_quantity AS INT) * 3 - 40 AS STRING) END AS arr_delay,
       '08:00 AM' AS sch_dep,
       '08:01 AM' AS act_dep,
       CASE WHEN l_discount = 0.0 THEN '' ELSE CAST(CAST(l_quantity AS INT) * 3 - 38 AS STRING) END AS dep_delay
FROM {lineitem}
"""

FIXTURE_SQL["route_csv"] = """
SELECT CAST(min(l_linenumber) AS STRING) AS stnSerialNumber,
       CAST(10000 + l_suppkey AS STRING) AS trainNumber,
       CASE WHEN l_partkey % 40 % 9 = 0 THEN '' ELSE concat('S', CAST(l_partkey % 40 AS STRING)) END AS station_code,
       concat('S', CAST(l_partkey % 40 AS STRING)) AS station_name,
       CAST((l_partkey % 40) * 12 AS STRING) AS distance
FROM {lineitem}
GROUP BY l_suppkey, l_partkey % 40
"""

# The route file with station 39 under another code and name, for lookups that miss.
FIXTURE_SQL["route_gaps"] = FIXTURE_SQL["route_csv"].replace(
    "concat('S', CAST(l_partkey % 40 AS STRING))",
    "concat(CASE WHEN l_partkey % 40 = 39 THEN 'X' ELSE 'S' END, CAST(l_partkey % 40 AS STRING))")

FIXTURE_SQL["snapshot_payload"] = """
SELECT event_id, ts AS retrieved_at,
       CAST(CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN 429 ELSE 200 END AS INT) AS http_status,
       CAST(10000 + user_id AS STRING) AS requested_train_number,
       concat('{"data":{"trainNumber":',
              CASE WHEN event_id % 11 = 0 THEN 'null' ELSE concat('"', CAST(10000 + user_id AS STRING), '"') END,
              ',"startDate":"', CAST(CAST(ts AS DATE) AS STRING),
              '","status":"', event_type,
              '","delayMinutes":', CASE WHEN event_id % 13 = 0 THEN 'null' ELSE CAST(event_id % 120 AS STRING) END,
              ',"currentLocation":', CASE WHEN event_id % 7 = 0 THEN 'null'
                  ELSE concat('{"stationCode":"S', CAST(user_id % 40 AS STRING), '"}') END,
              ',"nextHalt":{"stationCode":"S', CAST((user_id + 1) % 40 AS STRING),
              '","stationName":"Station ', CAST((user_id + 1) % 40 AS STRING), '"}}}') AS payload
FROM {events}
"""

FIXTURE_SQL["prediction"] = """
SELECT concat('model_', CAST(l_linenumber % 2 AS STRING)) AS model_name,
       concat('v', CAST(l_linenumber % 3 AS STRING)) AS model_version,
       CAST(l_quantity * 3 - 40 + (l_partkey % 11) - 5 AS DOUBLE) AS predicted_arrival_delay_minutes,
       CASE WHEN l_tax = 0.0 THEN NULL ELSE l_quantity * 3 - 40 END AS actual_arrival_delay_minutes,
       CASE WHEN l_tax = 0.0 THEN NULL ELSE CAST(abs((l_partkey % 11) - 5) AS DOUBLE) END AS absolute_error_minutes
FROM {lineitem}
"""

FIXTURE_SQL["ingestion_audit"] = """
SELECT concat(CAST(CAST(ts AS DATE) AS STRING), '-', event_type) AS run_id,
       CASE WHEN event_type IN ('view', 'error') THEN 'train_running_events' ELSE 'train_schedule_stops' END AS dataset,
       'synthetic_events' AS source_name,
       min(ts) AS started_at, max(ts) AS completed_at,
       count(*) AS records_received,
       CAST(sum(CASE WHEN value < 1 THEN 1 ELSE 0 END) AS BIGINT) AS records_rejected,
       CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS status
FROM {events}
GROUP BY CAST(ts AS DATE), event_type
"""

# Weather payloads in the archive-API shape (parallel daily arrays), one per event row:
# station from the user, a two-day window inside September 2024, and every 17th payload
# without its "daily" object (an error row). Derived from `events`, so it grows with it.
FIXTURE_SQL["weather_payload"] = """
SELECT event_id AS request_id,
       concat('S', CAST(user_id % 40 AS STRING)) AS station_code,
       CASE WHEN event_id % 17 = 0 THEN '{"latitude":22.5,"reason":"no data"}'
       ELSE concat('{"latitude":22.5,"daily":{"time":["',
              CAST(DATE '2024-09-01' + CAST(event_id % 30 AS INT) AS STRING), '","',
              CAST(DATE '2024-09-01' + CAST(event_id % 30 + 1 AS INT) AS STRING), '"],',
              '"temperature_2m_mean":[', CAST(20 + user_id % 15 AS STRING), '.5,',
                  CAST(21 + user_id % 15 AS STRING), '.25],',
              '"precipitation_sum":[', CAST(event_id % 9 AS STRING), '.0,',
                  CASE WHEN event_id % 4 = 0 THEN 'null' ELSE CAST(event_id % 5 AS STRING) END, '],',
              '"rain_sum":[', CAST(event_id % 7 AS STRING), '.0,0.0],',
              '"weather_code":[', CAST(user_id % 4 AS STRING), ',', CAST(event_id % 3 AS STRING), ']}}')
       END AS payload
FROM {events}
"""

_TABLE_RE = re.compile(r"\{(\w+)\}")


def _view_name(sf_dir: str, table: str) -> str:
    return f"dl_{table}_{zlib.crc32(sf_dir.rstrip('/').encode()):08x}"


def fixture_sql(name: str, dialect: str, sf_dir: str | None = None) -> str:
    """Fixture SQL for ``dialect`` in {"spark", "duckdb"}."""
    sql = FIXTURE_SQL[name]
    if dialect == "spark":
        if sf_dir is None:
            raise ValueError("spark fixtures need sf_dir")
        sql = sql.replace("@COPIES@", "LATERAL VIEW explode(CASE WHEN l_orderkey % 50 = 0 THEN array(1, 2) "
                          "ELSE array(1) END) copies AS copy")
        sql = sql.replace("@TS@", "TIMESTAMP_NTZ").replace("@SHA@(", "sha2(").replace("@SHA2@)", ", 256)")
        return _TABLE_RE.sub(lambda m: _view_name(sf_dir, m.group(1)), sql)
    if dialect == "duckdb":
        sql = sql.replace("@COPIES@", ", unnest(CASE WHEN l_orderkey % 50 = 0 THEN [1, 2] ELSE [1] END) AS copies(copy)")
        sql = sql.replace("@TS@", "TIMESTAMP").replace("@SHA@(", "sha256(").replace("@SHA2@)", ")")
        return _TABLE_RE.sub(lambda m: m.group(1), sql)
    raise ValueError(f"unknown dialect {dialect!r}")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture as a lazy DataFrame over the parquet files of ``sf_dir``."""
    for table in _TABLE_RE.findall(FIXTURE_SQL[name]):
        view = _view_name(sf_dir, table)
        if not spark.catalog.tableExists(view):
            spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet").createOrReplaceTempView(view)
    return spark.sql(fixture_sql(name, "spark", sf_dir))


def oracle_ctes(*names: str) -> str:
    """``WITH`` clause defining the named fixtures for a DuckDB oracle query."""
    return "WITH " + ",\n".join(f"{n} AS ({fixture_sql(n, 'duckdb')})" for n in names)
