"""The SQL counterpart of each registered query, over the same tables.

The SQL starts from the tables, not from the logs, so encoding, parsing and transformation are
checked as one.
"""

from __future__ import annotations

from millrace.schemas import CUSTOMERS_TOPIC, DRIVERS_TOPIC, TRIPS_TOPIC
from millrace.workload.queries import AS_OF_MS, INTERVAL, NOW, SPOT_CHECK_NAME

_CHANGES = f"""
changes AS (
  SELECT '{CUSTOMERS_TOPIC}' AS topic, 0 AS "partition", c_custkey AS "offset",
         TIMESTAMP '1970-01-01' AS kafka_timestamp, 'r' AS op, CAST(0 AS BIGINT) AS ts_ms,
         CAST(0 AS BIGINT) AS lsn, c_custkey AS id, c_name AS name,
         lower(c_mktsegment) || '@example.com' AS email, 'NATION_' || c_nationkey AS country
  FROM customer
  UNION ALL
  SELECT '{CUSTOMERS_TOPIC}', 1, o_orderkey, o_orderdate,
         CASE WHEN o_orderstatus = 'P' THEN 'd' ELSE 'u' END, epoch_us(o_orderdate) // 1000,
         o_orderkey + 1, o_custkey,
         printf('Customer#%09d', o_custkey),
         lower(substr(o_orderpriority, 3)) || '@example.com', 'NATION_' || (o_orderkey % 25)
  FROM orders
),
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, lsn DESC) AS newest
    FROM changes
  ) WHERE newest = 1
),
customers AS (SELECT id, name, email, country FROM latest WHERE op <> 'd')
"""

_JSON = (
    "'{\"id\":' || id || ',\"name\":\"' || name || '\",\"email\":\"' || email || "
    "'\",\"country\":\"' || country || '\"}'"
)


def _drivers(until: str = "TRUE", driver: str = "user_id") -> str:
    return f"""
driver_changes AS (
  SELECT '{DRIVERS_TOPIC}' AS topic, 0 AS "partition", event_id AS "offset", ts,
         CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op,
         epoch_us(ts) // 1000 AS ts_ms, event_id AS lsn, {driver} AS id,
         'driver_' || ({driver}) AS name, 'LIC' || event_id AS license_number, value AS rating,
         event_type AS city, value > 10 AS active
  FROM events WHERE {until}
),
drivers AS (
  SELECT id, name, license_number, rating, city, active FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, lsn DESC) AS newest
    FROM driver_changes
  ) WHERE newest = 1 AND op <> 'd'
)
"""


def _raw_trips(place: str = "l_partkey % 30") -> str:
    return f"""
raw_trips AS (
  SELECT *, l_shipdate + to_hours(l_orderkey % 24) + to_minutes(l_linenumber * 7) AS pickup
  FROM lineitem
),
trips AS (
  SELECT CAST(l_suppkey % 2 + 1 AS VARCHAR) AS vendor_id, pickup AS pickup_datetime,
         pickup + to_minutes(CAST(l_quantity AS INTEGER)) AS dropoff_datetime,
         l_linenumber AS passenger_count, l_quantity / 2 AS trip_distance,
         CAST({place} AS INTEGER) AS pulocation_id,
         CAST(l_suppkey % 30 AS INTEGER) AS dolocation_id,
         l_extendedprice / 1000 - 5 AS fare_amount, CAST(0.5 AS DOUBLE) AS extra,
         CAST(0.5 AS DOUBLE) AS mta_tax, l_discount * 100 AS tip_amount,
         l_tax * 100 AS tolls_amount, CAST(1 AS DOUBLE) AS improvement_surcharge,
         l_extendedprice / 1000 AS total_amount, CAST(2.5 AS DOUBLE) AS congestion_surcharge,
         CAST(NULL AS DOUBLE) AS airport_fee, l_partkey, l_suppkey
  FROM raw_trips
),
clean AS (SELECT * FROM trips WHERE fare_amount > 0),
picked AS (
  SELECT clean.*, n_name AS pickup_zone
  FROM clean LEFT JOIN nation ON pulocation_id = n_nationkey
)
"""


_RAW_TRIPS = _raw_trips()

_CLEAN_COLUMNS = (
    "vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, "
    "pulocation_id, dolocation_id, fare_amount, extra, mta_tax, tip_amount, tolls_amount, "
    "improvement_surcharge, total_amount, congestion_surcharge, airport_fee"
)


def _cents(column: str, over: str) -> str:
    """The sum of a positive column in millionths, over a count, to the cent."""
    total = f"sum(CAST(round({column} * 1000000) AS BIGINT))"
    return f"CAST((2 * {total} + 10000 * {over}) // (20000 * {over}) AS DOUBLE) / 100"


def _stats(grain: str, where: str = "TRUE") -> str:
    return f"""
  SELECT pickup_zone, CAST(date_trunc('{grain}', pickup_datetime) AS TIMESTAMP) AS pickup_{grain},
         count(*) AS total_trips, {_cents("fare_amount", "count(*)")} AS avg_fare,
         {_cents("trip_distance", "count(*)")} AS avg_distance,
         {_cents("total_amount", "1")} AS total_revenue
  FROM picked WHERE pickup_zone IS NOT NULL AND {where}
  GROUP BY pickup_zone, date_trunc('{grain}', pickup_datetime)
"""


_CUSTOMER_ROWS = f"WITH {_CHANGES} SELECT * FROM customers"
_DRIVER_ROWS = f"WITH {_drivers()} SELECT * FROM drivers"
_HOURLY = f"WITH {_RAW_TRIPS} {_stats('hour')}"
_BRONZE_IDS = (
    f'WITH {_CHANGES} SELECT topic, "partition", "offset", op, CAST(ts_ms AS VARCHAR) AS ts_ms, '
    "CAST(lsn AS VARCHAR) AS lsn FROM changes"
)

ORACLES: dict[str, str] = {
    "cdc_parse": f"""
WITH {_CHANGES}
SELECT topic, "partition", "offset", kafka_timestamp, op, CAST(ts_ms AS VARCHAR) AS ts_ms,
       CAST(lsn AS VARCHAR) AS lsn, CASE WHEN op <> 'r' THEN {_JSON} END AS before_json,
       CASE WHEN op <> 'd' THEN {_JSON} END AS after_json
FROM changes""",
    "cdc_key": f"""
WITH {_drivers()}
SELECT topic, "offset", id AS primary_key, ts_ms AS change_ts, lsn AS change_lsn
FROM driver_changes""",
    "cdc_latest": f"""
WITH {_CHANGES}
SELECT topic, id AS primary_key, op, ts_ms AS change_ts, lsn AS change_lsn, "partition", "offset"
FROM latest""",
    "cdc_customers": _CUSTOMER_ROWS,
    "cdc_drivers": _DRIVER_ROWS,
    "cdc_two_topics": f"""
WITH {_CHANGES}, {_drivers()}
SELECT id, name FROM customers UNION ALL SELECT id, name FROM drivers""",
    "cdc_topic_word": _CUSTOMER_ROWS,
    "cdc_replayed": _CUSTOMER_ROWS,
    "cdc_as_of": f"WITH {_drivers(f'epoch_us(ts) // 1000 <= {AS_OF_MS}')} SELECT * FROM drivers",
    "cdc_incremental": _DRIVER_ROWS,
    "cdc_hot_driver": (
        "WITH "
        + _drivers(driver="CASE WHEN event_type IN ('click', 'signup') THEN 7 ELSE user_id END")
        + "SELECT * FROM drivers"
    ),
    "cdc_op_counts": f"WITH {_CHANGES} SELECT op, count(*) AS events FROM changes GROUP BY op",
    "cdc_rejects": """
SELECT CASE event_type WHEN 'click' THEN 'not_utf8' WHEN 'view' THEN 'no_value'
       ELSE 'no_key' END AS reason, count(*) AS messages
FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1""",
    "spot_check": f"WITH {_CHANGES} SELECT * FROM customers WHERE name = '{SPOT_CHECK_NAME}'",
    "trip_parse": f"""
WITH {_RAW_TRIPS}
SELECT vendor_id AS "VendorID", strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S') AS pickup_datetime,
       strftime(dropoff_datetime, '%Y-%m-%dT%H:%M:%S') AS dropoff_datetime,
       CAST(passenger_count AS DOUBLE) AS passenger_count, trip_distance,
       CAST(pulocation_id AS DOUBLE) AS "PULocationID",
       CAST(dolocation_id AS DOUBLE) AS "DOLocationID", fare_amount, extra, mta_tax, tip_amount,
       tolls_amount, improvement_surcharge, total_amount, congestion_surcharge,
       airport_fee AS "Airport_fee"
FROM trips""",
    "trip_clean": f"WITH {_RAW_TRIPS} SELECT {_CLEAN_COLUMNS} FROM clean",
    "trip_enrich": f"""
WITH {_RAW_TRIPS}
SELECT {_CLEAN_COLUMNS}, pickup_zone, n_name AS dropoff_zone
FROM picked LEFT JOIN nation ON dolocation_id = n_nationkey""",
    "trip_enrich_parts": f"""
WITH {_RAW_TRIPS}
SELECT CAST(l_partkey AS INTEGER) AS pulocation_id, CAST(l_suppkey AS INTEGER) AS dolocation_id,
       fare_amount, pu.p_name AS pickup_zone, d.p_name AS dropoff_zone
FROM clean LEFT JOIN part AS pu ON l_partkey = pu.p_partkey
LEFT JOIN part AS d ON l_suppkey = d.p_partkey""",
    "trip_zone_unmatched": f"""
WITH {_RAW_TRIPS}
SELECT pulocation_id, count(*) AS trips FROM picked WHERE pickup_zone IS NULL
GROUP BY pulocation_id""",
    "rejects": f"""
WITH {_RAW_TRIPS}
SELECT reject_reason, count(*) AS trips FROM (
  SELECT CASE WHEN l_linenumber = 2 THEN 'pickup_missing'
              WHEN l_linenumber = 1 THEN 'pickup_unreadable'
              WHEN l_returnflag = 'R' THEN 'fare_unreadable'
              WHEN l_extendedprice / 1000 - 5 <= 0 THEN 'fare_not_positive' END AS reject_reason
  FROM lineitem
) WHERE reject_reason IS NOT NULL GROUP BY reject_reason""",
    "zone_key_dups": """
SELECT s_nationkey AS "LocationID", count(*) AS copies FROM supplier
WHERE s_nationkey IS NOT NULL GROUP BY s_nationkey HAVING count(*) > 1""",
    "line_key_dups": """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "gold_hourly": _HOURLY,
    "gold_daily": f"WITH {_RAW_TRIPS} {_stats('day')}",
    "gold_hot_zone": (
        "WITH "
        + _raw_trips("CASE WHEN l_linenumber <= 3 THEN 7 ELSE l_partkey % 30 END")
        + _stats("hour")
    ),
    "gold_top10": f"""
SELECT * FROM ({_HOURLY}) ORDER BY pickup_hour DESC, total_trips DESC, pickup_zone LIMIT 10""",
    "backfill_interval": f"""
WITH {_RAW_TRIPS} {_stats('hour', f"pickup_datetime >= TIMESTAMP '{INTERVAL[0]}' "
                                  f"AND pickup_datetime < TIMESTAMP '{INTERVAL[1]}'")}""",
    "backfill_month": _HOURLY,
    "counts": f"""
WITH {_CHANGES}, {_drivers()}
SELECT 'customers' AS table_name, count(*) AS row_count FROM customers
UNION ALL SELECT 'drivers', count(*) FROM drivers""",
    "reconcile": f"""
WITH {_CHANGES},
source AS (
  SELECT c_custkey AS id, c_name AS name,
         lower(c_mktsegment) || '@example.com' AS email, 'NATION_' || c_nationkey AS country
  FROM customer WHERE c_acctbal >= 0
)
SELECT CASE WHEN m.id IS NULL THEN 'missing' WHEN s.id IS NULL THEN 'extra'
            WHEN m.name IS DISTINCT FROM s.name OR m.email IS DISTINCT FROM s.email
                 OR m.country IS DISTINCT FROM s.country THEN 'changed' ELSE 'ok' END AS status,
       count(*) AS key_count
FROM customers AS m FULL OUTER JOIN source AS s ON m.id = s.id GROUP BY 1""",
    "repeat_difference": f"""
WITH {_CHANGES}, twice AS (
  SELECT id, name, email, country FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts_ms DESC, lsn DESC) AS newest
    FROM (SELECT * FROM changes UNION ALL SELECT * FROM changes)
  ) WHERE newest = 1 AND op <> 'd'
),
odd AS (
  (SELECT * FROM customers EXCEPT ALL SELECT * FROM twice)
  UNION ALL (SELECT * FROM twice EXCEPT ALL SELECT * FROM customers)
)
SELECT (SELECT count(*) FROM odd) AS differing_rows, (SELECT count(*) FROM customers) AS compared_rows,
       (SELECT count(DISTINCT country) FROM odd) AS differing_parts""",
    "replayed_messages": f"""
WITH {_drivers()}
SELECT topic, "partition", "offset", CAST(ts AS TIMESTAMP) AS kafka_timestamp, op,
       CAST(ts_ms AS VARCHAR) AS ts_ms, CAST(lsn AS VARCHAR) AS lsn
FROM driver_changes""",
    "whole_run_statistics": _HOURLY,
    "snapshot_difference": """
SELECT order_key, CAST(sum(sign) AS BIGINT) AS surplus FROM (
  SELECT o_orderkey AS order_key, 1 AS sign FROM orders
  UNION ALL SELECT l_orderkey, -1 FROM lineitem
) GROUP BY order_key HAVING sum(sign) <> 0""",
    "freshness": f"""
SELECT event_type AS topic, max(ts) AS newest,
       CAST(floor(epoch_us(TIMESTAMP '{NOW}' - max(ts)) / 1000000) AS BIGINT) AS lag_seconds,
       CAST(floor(epoch_us(TIMESTAMP '{NOW}' - max(ts)) / 1000000) AS BIGINT) <= 600 AS is_fresh
FROM events GROUP BY event_type""",
    "ingest_replayed": f"""
WITH {_CHANGES}
SELECT topic, "partition", max("offset") AS high_water, count(*) AS messages
FROM changes GROUP BY topic, "partition\"""",
    "ingest_twice": _BRONZE_IDS,
    "ingest_in_order": f"""
WITH {_drivers()}
SELECT topic, "partition", "offset", op, CAST(ts_ms AS VARCHAR) AS ts_ms,
       CAST(lsn AS VARCHAR) AS lsn
FROM driver_changes""",
    "stream_bronze": _BRONZE_IDS,
    "stream_mirror": _DRIVER_ROWS,
    "time_travel": _CUSTOMER_ROWS,
    "whole_run": f"""
WITH {_CHANGES}, {_drivers()}, {_RAW_TRIPS}, hourly AS ({_stats('hour')})
SELECT 'bronze_cdc_events' AS table_name,
       (SELECT count(*) FROM changes) + (SELECT count(*) FROM driver_changes) AS row_count
UNION ALL SELECT 'bronze_taxi_trips', count(*) FROM lineitem
UNION ALL SELECT 'silver_customers', count(*) FROM customers
UNION ALL SELECT 'silver_drivers', count(*) FROM drivers
UNION ALL SELECT 'silver_taxi_trips', count(*) FROM clean
UNION ALL SELECT 'gold_taxi_aggregates', count(*) FROM hourly""",
    "checkpointed_run": _HOURLY,
    "incremental_replayed": _HOURLY,
    "backfill_run": f"""
WITH {_RAW_TRIPS} {_stats('hour', f"NOT (pickup_datetime >= TIMESTAMP '{INTERVAL[0]}' "
                                  f"AND pickup_datetime < TIMESTAMP '{INTERVAL[1]}')")}""",
    "silent_topics": f"""
WITH seen AS (
  SELECT '{CUSTOMERS_TOPIC}' AS topic, max(o_orderdate) AS newest FROM orders
  UNION ALL SELECT '{DRIVERS_TOPIC}', max(ts) FROM events
  UNION ALL SELECT '{TRIPS_TOPIC}', max(l_shipdate) FROM lineitem
  UNION ALL SELECT 'silent', NULL
),
aged AS (
  SELECT topic, CAST(newest AS TIMESTAMP) AS newest,
         CAST(floor(epoch_us(TIMESTAMP '{NOW}' - newest) / 1000000) AS BIGINT) AS lag_seconds
  FROM seen
)
SELECT topic, newest, lag_seconds, false AS is_fresh FROM aged
WHERE lag_seconds IS NULL OR lag_seconds > 600""",
    "version_history": f"""
WITH {_CHANGES}
SELECT CAST(1 AS BIGINT) AS version, 'overwrite' AS operation, count(*) AS row_count
FROM customers
UNION ALL
SELECT 2, 'overwrite', count(*) FROM customers WHERE country < 'NATION_2'
UNION ALL
SELECT 3, 'rollback', count(*) FROM customers""",
    "log_intervals": f"""
WITH {_CHANGES},
marked AS (
  SELECT topic, "partition", "offset",
         "offset" - row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS island
  FROM (SELECT DISTINCT topic, "partition", "offset" FROM changes)
)
SELECT topic, "partition", min("offset") AS first, max("offset") AS last
FROM marked GROUP BY topic, "partition", island""",
    "ingest_gaps": f"""
WITH {_CHANGES}
SELECT topic, "partition", "offset", op, CAST(ts_ms AS VARCHAR) AS ts_ms, CAST(lsn AS VARCHAR) AS lsn,
       CAST(CASE WHEN kafka_timestamp >= TIMESTAMP '1996-01-01' AND "offset" % 7 < 5 THEN 1
            WHEN kafka_timestamp >= TIMESTAMP '1996-01-01' OR "offset" % 3 = 0 THEN 2 ELSE 3 END AS BIGINT) AS load
FROM changes""",
    "statistics_by_load": _HOURLY,
    "stream_replayed": _BRONZE_IDS,
    "closed_hours": f"""
WITH {_RAW_TRIPS},
hourly AS ({_stats('hour')}),
reached AS (SELECT max(pickup_datetime) - INTERVAL 2 HOUR AS mark FROM picked WHERE pickup_zone IS NOT NULL),
first_mark AS (
  SELECT max(pickup_datetime) - INTERVAL 2 HOUR AS mark FROM picked
  WHERE pickup_zone IS NOT NULL AND pickup_datetime < TIMESTAMP '{INTERVAL[1]}'
    AND (pickup_datetime >= TIMESTAMP '{INTERVAL[0]}' OR pulocation_id % 5 <> 0)
),
late AS (
  SELECT pickup_zone, date_trunc('hour', pickup_datetime) AS pickup_hour, count(*) AS n
  FROM picked, first_mark
  WHERE pickup_zone IS NOT NULL AND pulocation_id % 5 = 0 AND pickup_datetime < TIMESTAMP '{INTERVAL[0]}'
    AND date_trunc('hour', pickup_datetime) + INTERVAL 1 HOUR <= mark
  GROUP BY ALL
)
SELECT h.*, coalesce(n, 0) AS late_trips
FROM hourly h CROSS JOIN reached LEFT JOIN late USING (pickup_zone, pickup_hour)
WHERE pickup_hour + INTERVAL 1 HOUR <= mark""",
    "trip_enrich_hot": f"""
WITH {_raw_trips("CASE WHEN l_linenumber <= 2 THEN 7 WHEN l_linenumber > 3 THEN l_partkey END")}
SELECT pulocation_id, CAST(l_suppkey AS INTEGER) AS dolocation_id, fare_amount,
       pu.p_name AS pickup_zone, d.p_name AS dropoff_zone
FROM clean LEFT JOIN part AS pu ON pulocation_id = pu.p_partkey
LEFT JOIN part AS d ON l_suppkey = d.p_partkey""",
    "touched_buckets": _DRIVER_ROWS,
    "stored_mirror": _DRIVER_ROWS,
    "run_rejects": f"""
WITH {_CHANGES}, {_drivers()},
messages AS (
  SELECT topic, kafka_timestamp AS sent, false AS unpaid FROM changes
  UNION ALL SELECT topic, ts, false FROM driver_changes
  UNION ALL SELECT '{TRIPS_TOPIC}', l_shipdate, l_extendedprice / 1000 - 5 <= 0 FROM lineitem
),
spoiled AS (SELECT *, day(sent) AS d, topic = '{TRIPS_TOPIC}' AS trip, month(sent) % 2 = 0 AS repaired FROM messages),
judged AS (
  SELECT topic, repaired, d BETWEEN 11 AND 13 AS broken, unpaid,
    CASE WHEN d BETWEEN 11 AND 13 AND trip THEN 'no_fields' WHEN d = 11 THEN 'not_utf8'
         WHEN d = 12 THEN 'no_value' WHEN d = 13 THEN 'no_key' WHEN unpaid THEN 'fare_not_positive' END AS first
  FROM spoiled
),
followed AS (
  SELECT topic, first,
    CASE WHEN repaired AND broken THEN CASE WHEN unpaid THEN 'fare_not_positive' END ELSE first END AS last
  FROM judged WHERE first IS NOT NULL
),
found AS (SELECT topic, first AS reason, count(*) AS found FROM followed GROUP BY ALL),
still AS (SELECT topic, last AS reason, count(*) AS n FROM followed WHERE last IS NOT NULL GROUP BY ALL)
SELECT topic, reason, found, coalesce(n, 0) AS "left" FROM found LEFT JOIN still USING (topic, reason)""",
    "redriven_tables": _HOURLY,
    "backfill_loads": f"SELECT *, CAST(0 AS BIGINT) AS spoiled_rows FROM ({_HOURLY})",
    "backfill_taken_back": _HOURLY,
    "cdc_history": f"""
WITH {_drivers()},
ordered AS (
  SELECT *, coalesce(lead(ts_ms) OVER (PARTITION BY id ORDER BY ts_ms, lsn), 9223372036854775807) AS valid_to
  FROM driver_changes
)
SELECT id AS primary_key, topic, ts_ms AS valid_from, valid_to, op, ts_ms AS change_ts, lsn AS change_lsn,
       "partition", "offset"
FROM ordered WHERE ts_ms < valid_to""",
    "cdc_history_as_of": f"WITH {_drivers(f'epoch_us(ts) // 1000 <= {AS_OF_MS}')} SELECT * FROM drivers",
}
ORACLES["reconcile_buckets"] = ORACLES["reconcile"].replace("count(*) AS key_count", "count(*)::BIGINT AS key_count")
ORACLES["fingerprints"] = f"""
WITH {_CHANGES},
source AS (
  SELECT c_custkey AS id, c_name AS name,
         lower(c_mktsegment) || '@example.com' AS email, 'NATION_' || c_nationkey AS country
  FROM customer WHERE c_acctbal >= 0
),
counted AS (
  SELECT country, count(*) FILTER (side = 1) AS first_rows, count(*) FILTER (side = 2) AS second_rows
  FROM (SELECT *, 1 AS side FROM customers UNION ALL SELECT *, 2 FROM source) GROUP BY country
),
odd AS (
  SELECT DISTINCT country FROM (
    (SELECT * FROM customers EXCEPT ALL SELECT * FROM source)
    UNION ALL (SELECT * FROM source EXCEPT ALL SELECT * FROM customers))
)
SELECT country AS part, first_rows, second_rows FROM counted JOIN odd USING (country)"""
