"""Independent DuckDB SQL for every registered query (the correctness oracle).

The statements run on the raw test tables (pre-registered as views), so the
adapters of :mod:`strata.sources.fixtures` are restated here in SQL: the
oracle shares no code with the Spark side.
"""

from __future__ import annotations

LO, HI = "1998-01-01", "1999-01-01"

BRONZE_TRIPS = """
li AS (
  SELECT *,
    (l_orderkey*7919 + l_partkey*10473 + l_linenumber*613) % 86400 AS sod,
    (l_partkey*13 + l_suppkey*97 + l_linenumber*101) % 22500 AS tt,
    (l_partkey*31 + l_suppkey*17) % 1200 AS wt
  FROM lineitem),
bronze_trips AS (
  SELECT
    l_shipdate + to_seconds(sod - wt) AS request_datetime,
    l_shipdate + to_seconds(sod) AS pickup_datetime,
    l_shipdate + to_seconds(sod + tt) AS dropoff_datetime,
    l_suppkey % 27 AS PULocationID,
    l_partkey % 27 AS DOLocationID,
    l_quantity * 4.1e0 AS trip_miles,
    tt AS trip_time,
    l_extendedprice / 1000e0 - 2e0 AS base_passenger_fare,
    l_tax * 10e0 AS tolls,
    l_extendedprice * 0.00003e0 AS bcf,
    l_extendedprice * 0.00008875e0 AS sales_tax,
    CASE WHEN l_linenumber % 2 = 0 THEN 2.75e0 ELSE 0e0 END AS congestion_surcharge,
    CASE WHEN l_suppkey % 10 = 0 THEN 2.5e0 WHEN l_suppkey % 10 = 1 THEN NULL ELSE 0e0 END AS airport_fee,
    l_discount * l_quantity AS tips,
    l_extendedprice * 0.00075e0 AS driver_pay,
    CASE WHEN l_returnflag <> 'N' THEN 'Y' ELSE 'N' END AS shared_request_flag,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS shared_match_flag,
    CASE WHEN l_linenumber = 7 THEN 'Y' ELSE 'N' END AS access_a_ride_flag,
    CASE WHEN l_linenumber = 6 THEN 'Y' ELSE 'N' END AS wav_request_flag
  FROM li)"""

ZONES = """
zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone,
         'zone-' || CAST(n_regionkey AS VARCHAR) AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

WINDOW_PRED = (f"pickup_datetime >= TIMESTAMP '{LO}' AND pickup_datetime < TIMESTAMP '{HI}'")
QUALITY_PRED = (WINDOW_PRED + " AND base_passenger_fare > 0 AND trip_miles BETWEEN 0 AND 200"
                " AND trip_time BETWEEN 0 AND 21600")


def _uid(col: str) -> str:
    v = f"TRY_CAST(CAST({col} AS VARCHAR) AS INTEGER)"
    return f"CASE WHEN {v} BETWEEN 0 AND 65535 THEN {v} END"


def _clean_cte(minute_fn: str, strict_ids: bool = False) -> str:
    pu = "CAST(PULocationID AS SMALLINT)" if strict_ids else _uid('PULocationID')
    do = "CAST(DOLocationID AS SMALLINT)" if strict_ids else _uid('DOLocationID')
    minutes = "SMALLINT" if strict_ids else "INTEGER"
    return f"""
clean AS (
  SELECT
    pickup_datetime AS pickup_at,
    dropoff_datetime AS dropoff_at,
    {pu} AS pickup_location_id,
    {do} AS dropoff_location_id,
    CAST(trip_miles AS FLOAT) AS trip_miles,
    CAST(base_passenger_fare AS FLOAT) AS base_fare,
    CAST(tips AS FLOAT) AS tips,
    CAST(congestion_surcharge AS FLOAT) AS congestion_surcharge,
    CAST(driver_pay AS FLOAT) AS driver_pay,
    shared_request_flag = 'Y' AS shared_requested,
    shared_match_flag = 'Y' AS shared_matched,
    access_a_ride_flag = 'Y' AS access_a_ride,
    wav_request_flag = 'Y' AS wav_requested,
    CAST({minute_fn}('minute', request_datetime, pickup_datetime) AS {minutes}) AS waiting_minutes,
    CAST({minute_fn}('minute', pickup_datetime, dropoff_datetime) AS {minutes}) AS trip_minutes,
    CAST(base_passenger_fare + tolls + bcf + sales_tax + congestion_surcharge + airport_fee + tips
         AS FLOAT) AS total_amount,
    CASE WHEN base_passenger_fare > 0 THEN CAST(driver_pay / base_passenger_fare * 100 AS FLOAT)
         ELSE CAST(0 AS FLOAT) END AS driver_pct_of_fare
  FROM bronze_trips
  WHERE {QUALITY_PRED})"""


CLEAN = _clean_cte("date_diff")
CLEAN_ELAPSED = _clean_cte("date_sub")
CLEAN_MIRROR = _clean_cte("date_sub", strict_ids=True)

ENRICHED = """
enriched AS (
  SELECT t.pickup_at, t.dropoff_at, t.waiting_minutes, t.trip_minutes, t.trip_miles, t.base_fare,
         t.tips, t.driver_pay, t.total_amount, t.driver_pct_of_fare, t.shared_requested,
         t.shared_matched, t.wav_requested, t.access_a_ride,
         pu.Borough AS pickup_borough, pu.Zone AS pickup_zone,
         dz.Borough AS dropoff_borough, dz.Zone AS dropoff_zone
  FROM clean t
  LEFT JOIN zones pu ON pu.LocationID = t.pickup_location_id
  LEFT JOIN zones dz ON dz.LocationID = t.dropoff_location_id)"""


def _daily(quantile: str) -> str:
    q = lambda p: f"round({quantile}(CAST(total_amount AS DOUBLE), {p}), 2)"
    return f"""
daily_revenue AS (
  SELECT CAST(pickup_at AS DATE) AS trip_date,
         count(*) AS total_trips,
         round(sum(total_amount), 2) AS gross_revenue_usd,
         round(sum(driver_pay), 2) AS total_driver_pay_usd,
         round(sum(tips), 2) AS total_tips_usd,
         round(sum(congestion_surcharge), 2) AS total_congestion_usd,
         round(avg(trip_miles), 2) AS avg_trip_miles,
         round(avg(trip_minutes), 2) AS avg_trip_minutes,
         round(avg(waiting_minutes), 2) AS avg_waiting_minutes,
         {q(0.5)} AS median_fare_usd,
         {q(0.95)} AS p95_fare_usd
  FROM clean GROUP BY 1)"""


DAILY = _daily("quantile_cont")
DAILY_APPROX = _daily("quantile_disc")

HOURLY = """
hourly_demand AS (
  SELECT CAST(isodow(pickup_at) AS INTEGER) AS weekday, CAST(hour(pickup_at) AS INTEGER) AS hour_of_day,
         count(*) AS trips,
         round(avg(trip_minutes), 2) AS avg_trip_min,
         round(avg(waiting_minutes), 2) AS avg_wait_min,
         round(avg(total_amount), 2) AS avg_fare_usd,
         round(avg(driver_pay), 2) AS avg_driver_pay_usd
  FROM clean GROUP BY 1, 2)"""

PAIRS = """
borough_pairs AS (
  SELECT pickup_borough, dropoff_borough, count(*) AS trips,
         round(sum(total_amount), 2) AS revenue_usd,
         round(avg(trip_miles), 2) AS avg_miles,
         round(avg(trip_minutes), 2) AS avg_minutes,
         round(avg(total_amount), 2) AS avg_fare_usd
  FROM enriched
  WHERE pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL
  GROUP BY 1, 2)"""

DRIVER = """
driver_economics AS (
  SELECT CAST(date_trunc('month', pickup_at) AS DATE) AS month,
         count(*) AS total_trips,
         round(avg(base_fare), 2) AS avg_base_fare,
         round(avg(tips), 2) AS avg_tips,
         round(avg(driver_pay), 2) AS avg_driver_pay,
         round(avg(driver_pct_of_fare), 2) AS avg_driver_pct_of_fare,
         round(sum(driver_pay), 2) AS total_driver_pay,
         round(sum(driver_pay) / nullif(sum(trip_minutes) / 60.0e0, 0), 2) AS approx_hourly_rate_usd
  FROM clean GROUP BY 1)"""

SHARED = """
shared_vs_solo AS (
  SELECT CASE WHEN shared_matched THEN 'shared_matched'
              WHEN shared_requested THEN 'shared_unmatched' ELSE 'solo' END AS ride_type,
         count(*) AS trips,
         round(avg(total_amount), 2) AS avg_total_usd,
         round(avg(trip_miles), 2) AS avg_miles,
         round(avg(trip_minutes), 2) AS avg_minutes,
         round(avg(driver_pay), 2) AS avg_driver_pay_usd,
         round(sum(total_amount), 2) AS total_revenue_usd
  FROM clean GROUP BY 1)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


SILVER = (BRONZE_TRIPS, CLEAN)
SILVER_ENRICHED = (BRONZE_TRIPS, ZONES, CLEAN, ENRICHED)

TOP10 = "ORDER BY revenue_usd DESC, pickup_borough, dropoff_borough LIMIT 10"

BRONZE_AMOUNT = ("CAST(base_passenger_fare AS DOUBLE) + CAST(tolls AS DOUBLE) + CAST(bcf AS DOUBLE)"
                 " + CAST(sales_tax AS DOUBLE) + CAST(congestion_surcharge AS DOUBLE)"
                 " + CAST(airport_fee AS DOUBLE) + CAST(tips AS DOUBLE)")

SQL: dict[str, str] = {
    "silver_clean": with_(*SILVER) + "SELECT * FROM clean",
    "clean_elapsed_minutes": with_(BRONZE_TRIPS, CLEAN_ELAPSED) + "SELECT * FROM clean",
    "silver_enriched": with_(*SILVER_ENRICHED) + "SELECT * FROM enriched",
    "gold_daily_revenue": with_(*SILVER, DAILY) + "SELECT * FROM daily_revenue",
    "gold_daily_revenue_approx": with_(*SILVER, DAILY_APPROX) + "SELECT * FROM daily_revenue",
    "gold_hourly_demand": with_(*SILVER, HOURLY) + "SELECT * FROM hourly_demand",
    "gold_borough_pairs": with_(*SILVER_ENRICHED, PAIRS) + "SELECT * FROM borough_pairs",
    "gold_driver_economics": with_(*SILVER, DRIVER) + "SELECT * FROM driver_economics",
    "gold_shared_vs_solo": with_(*SILVER, SHARED) + "SELECT * FROM shared_vs_solo",
    "q1_bronze": with_(BRONZE_TRIPS) + f"""
SELECT CAST(pickup_datetime AS DATE) AS trip_date, count(*) AS trips,
       round(sum({BRONZE_AMOUNT}), 2) AS revenue_usd
FROM bronze_trips WHERE {WINDOW_PRED} AND base_passenger_fare > 0
GROUP BY 1 ORDER BY 1""",
    "q1_silver": with_(*SILVER) + """
SELECT CAST(pickup_at AS DATE) AS trip_date, count(*) AS trips,
       round(sum(total_amount), 2) AS revenue_usd
FROM clean GROUP BY 1 ORDER BY 1""",
    "q1_gold": with_(*SILVER, DAILY) + """
SELECT trip_date, total_trips AS trips, gross_revenue_usd AS revenue_usd
FROM daily_revenue ORDER BY trip_date""",
    "q2_bronze": with_(BRONZE_TRIPS, ZONES) + f"""
SELECT pu.Borough AS pickup_borough, dz.Borough AS dropoff_borough, count(*) AS trips,
       round(sum({BRONZE_AMOUNT}), 2) AS revenue_usd
FROM bronze_trips t
LEFT JOIN zones pu ON pu.LocationID = {_uid('t.PULocationID')}
LEFT JOIN zones dz ON dz.LocationID = {_uid('t.DOLocationID')}
WHERE {WINDOW_PRED} AND base_passenger_fare > 0
  AND pu.Borough IS NOT NULL AND dz.Borough IS NOT NULL
GROUP BY 1, 2 {TOP10}""",
    "q2_silver": with_(*SILVER_ENRICHED) + f"""
SELECT pickup_borough, dropoff_borough, count(*) AS trips, round(sum(total_amount), 2) AS revenue_usd
FROM enriched WHERE pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL
GROUP BY 1, 2 {TOP10}""",
    "q2_gold": with_(*SILVER_ENRICHED, PAIRS) + f"""
SELECT pickup_borough, dropoff_borough, trips, revenue_usd
FROM borough_pairs WHERE pickup_borough IS NOT NULL AND dropoff_borough IS NOT NULL {TOP10}""",
}


# --------------------------------------------------------------------------
# Quality
# --------------------------------------------------------------------------

_DECLARED = [  # (model cte, model name, column, test)
    ("clean", "fhvhv_trips_clean", "pickup_at", "not_null"),
    ("clean", "fhvhv_trips_clean", "dropoff_at", "not_null"),
    ("clean", "fhvhv_trips_clean", "base_fare", "not_null"),
    ("clean", "fhvhv_trips_clean", "trip_minutes", "not_null"),
    ("clean", "fhvhv_trips_clean", "total_amount", "not_null"),
    ("enriched", "fhvhv_trips_enriched", "pickup_at", "not_null"),
    ("daily_revenue", "daily_revenue", "trip_date", "not_null"),
    ("daily_revenue", "daily_revenue", "trip_date", "unique"),
    ("daily_revenue", "daily_revenue", "gross_revenue_usd", "not_null"),
    ("hourly_demand", "hourly_demand", "weekday", "not_null"),
    ("hourly_demand", "hourly_demand", "hour_of_day", "not_null"),
    ("borough_pairs", "borough_pairs", "pickup_borough", "not_null"),
    ("borough_pairs", "borough_pairs", "dropoff_borough", "not_null"),
    ("driver_economics", "driver_economics", "month", "not_null"),
    ("driver_economics", "driver_economics", "month", "unique"),
    ("shared_vs_solo", "shared_vs_solo", "ride_type", "not_null"),
    ("shared_vs_solo", "shared_vs_solo", "ride_type", "unique"),
]


def _dq_select(cte, model, col, test):
    if test == "not_null":
        f = f"(SELECT count(*) FROM {cte} WHERE {col} IS NULL)"
    else:
        f = (f"(SELECT count(*) FROM (SELECT {col} FROM {cte} WHERE {col} IS NOT NULL "
             f"GROUP BY {col} HAVING count(*) > 1))")
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, '{test}' AS test, "
            f"CAST({f} AS BIGINT) AS failures")


SQL["dq_report"] = with_(BRONZE_TRIPS, ZONES, CLEAN, ENRICHED, DAILY, HOURLY, PAIRS, DRIVER, SHARED) + \
    "SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n" + \
    "\nUNION ALL ".join(_dq_select(*t) for t in _DECLARED) + ")"

SQL["dq_relationships"] = with_(BRONZE_TRIPS, ZONES, CLEAN) + "\nUNION ALL ".join(
    f"""SELECT 'fhvhv_trips_clean' AS model, '{c}' AS column_name, 'relationships' AS test,
       failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT CAST(count(*) AS BIGINT) AS failures FROM clean
      WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT LocationID FROM zones WHERE LocationID IS NOT NULL))"""
    for c in ("pickup_location_id", "dropoff_location_id"))

_IN_WINDOW = WINDOW_PRED
SQL["rejected_rows"] = with_(BRONZE_TRIPS) + f"""
SELECT count(*) AS raw_rows,
       count(*) FILTER (WHERE coalesce({QUALITY_PRED}, false)) AS clean_rows,
       count(*) FILTER (WHERE NOT coalesce({_IN_WINDOW}, false)) AS outside_window,
       count(*) FILTER (WHERE NOT coalesce(base_passenger_fare > 0, false)) AS non_positive_fare,
       count(*) FILTER (WHERE NOT coalesce(trip_miles BETWEEN 0 AND 200, false)) AS miles_out_of_range,
       count(*) FILTER (WHERE NOT coalesce(trip_time BETWEEN 0 AND 21600, false)) AS time_out_of_range,
       count(*) - count(*) FILTER (WHERE coalesce({QUALITY_PRED}, false)) AS rejected_rows
FROM bronze_trips"""

SQL["safe_location_cast"] = with_(BRONZE_TRIPS) + "\nUNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS rows, count({_uid(c)}) AS valid,
       count(*) - count({_uid(c)}) AS nulls, min({_uid(c)}) AS min_id, max({_uid(c)}) AS max_id
FROM bronze_trips""" for c in ("PULocationID", "DOLocationID"))

# --------------------------------------------------------------------------
# Measurement history (events adapter restated)
# --------------------------------------------------------------------------

_LAYER_CASE = ("CASE event_type WHEN 'error' THEN 'bronze' WHEN 'signup' THEN 'bronze' "
               "WHEN 'click' THEN 'silver' WHEN 'view' THEN 'silver' WHEN 'purchase' THEN 'gold' END")
_QUESTION_CASE = "CASE WHEN event_id % 2 = 0 THEN 'Q1_daily_revenue' ELSE 'Q2_borough_pairs' END"
_TAG = "'tcc_bench|' || CAST(user_id % 12 AS VARCHAR) || '|' || CAST(event_id AS VARCHAR)"

RESULTS = f"""
results AS (
  SELECT 'run-' || CAST(user_id % 12 AS VARCHAR) AS run_id,
         TIMESTAMP '2024-02-01 00:00:00' + to_hours(CAST(user_id % 12 AS INTEGER)) AS captured_at,
         {_QUESTION_CASE} AS question_id, {_LAYER_CASE} AS layer,
         CAST(event_id AS INTEGER) AS iteration, value * 10e0 AS wall_ms,
         CAST(floor(value * 8e0) AS BIGINT) AS query_duration_ms,
         event_id * 10 AS read_rows, event_id * 800 AS read_bytes, event_id * 3 AS memory_usage,
         event_id % 50 AS result_rows
  FROM events)"""

CLIENT = f"""
client AS (
  SELECT 'run-' || CAST(user_id % 12 AS VARCHAR) AS run_id, {_QUESTION_CASE} AS question_id,
         {_LAYER_CASE} AS layer, CAST(event_id AS INTEGER) AS iteration, {_TAG} AS tag,
         value * 10e0 AS wall_ms, event_id % 50 AS result_rows
  FROM events)"""


def _log_part(extra, hours, where):
    return f"""SELECT {_TAG} AS log_comment, CAST(floor(value * 8e0) AS BIGINT) + {extra} AS query_duration_ms,
         event_id * 10 AS read_rows, event_id * 800 AS read_bytes, event_id * 3 AS memory_usage,
         event_id % 50 AS result_rows,
         CASE WHEN event_id % 13 = 0 THEN 'QueryStart' ELSE 'QueryFinish' END AS type,
         ts + to_hours({hours}) AS event_time
  FROM events WHERE {where}"""


ENGINE_LOG = f"""
log AS (
  {_log_part(0, 0, 'event_id % 7 <> 0')}
  UNION ALL
  {_log_part(5, 1, 'event_id % 7 <> 0 AND event_id % 11 = 0')})"""

ENRICHED_LOG = """
fin AS (
  SELECT *, row_number() OVER (PARTITION BY log_comment ORDER BY event_time DESC,
                                query_duration_ms DESC, read_rows DESC, read_bytes DESC,
                                memory_usage DESC, result_rows DESC NULLS LAST) AS rn
  FROM log WHERE type = 'QueryFinish' AND log_comment IN (SELECT tag FROM client)),
merged AS (
  SELECT c.run_id, c.question_id, c.layer, c.iteration, c.wall_ms,
         coalesce(f.query_duration_ms, 0) AS query_duration_ms, coalesce(f.read_rows, 0) AS read_rows,
         coalesce(f.read_bytes, 0) AS read_bytes, coalesce(f.memory_usage, 0) AS memory_usage,
         coalesce(f.result_rows, c.result_rows) AS result_rows
  FROM client c LEFT JOIN fin f ON f.log_comment = c.tag AND f.rn = 1)"""


def _human(x):
    units = ["B", "KiB", "MiB", "GiB", "TiB"]
    parts = []
    for i, u in enumerate(units[:-1]):
        parts.append(f"WHEN ({x}) / {float(1024 ** i)} < 1024 THEN "
                     f"format('{{:,.2f}}', ({x}) / {float(1024 ** i)}) || ' {u}'")
    return (f"CASE WHEN ({x}) IS NULL THEN NULL " + " ".join(parts) +
            f" ELSE format('{{:,.2f}}', ({x}) / {float(1024 ** 4)}) || ' TiB' END")


def _cv(sd, mean):
    return f"CASE WHEN ({mean}) IS NOT NULL AND ({mean}) <> 0 THEN ({sd}) / ({mean}) * 100 ELSE 0e0 END"


_QD = "query_duration_ms"
PER_RUN = f"""
per_run AS (
  SELECT run_id, question_id, layer, min(captured_at) AS ts, count(*) AS iters,
         round(avg({_QD}), 1) AS engine_avg, round(stddev_pop({_QD}), 1) AS engine_stddev,
         round({_cv(f'round(stddev_pop({_QD}), 1)', f'round(avg({_QD}), 1)')}, 2) AS cv_pct
  FROM results GROUP BY 1, 2, 3)"""

CROSS = f"""
cross_run AS (
  SELECT question_id, layer, count(*) AS total_samples, count(DISTINCT run_id) AS total_runs,
         round(avg({_QD}), 1) AS engine_avg, round(stddev_pop({_QD}), 1) AS engine_stddev,
         round(avg(wall_ms), 1) AS wall_avg, round(stddev_pop(wall_ms), 1) AS wall_stddev,
         min(read_rows) AS read_rows, {_human('min(read_bytes)')} AS read_bytes_h,
         round(quantile_cont(CAST({_QD} AS DOUBLE), 0.5), 1) AS engine_p50,
         round(quantile_cont(CAST({_QD} AS DOUBLE), 0.95), 1) AS engine_p95,
         round({_cv(f'round(stddev_pop({_QD}), 1)', f'round(avg({_QD}), 1)')}, 2) AS cv_pct
  FROM results GROUP BY 1, 2)"""

SUMMARY = """
summary AS (
  SELECT question_id, layer, avg(query_duration_ms) AS engine_avg, avg(wall_ms) AS wall_avg
  FROM results GROUP BY 1, 2),
base AS (
  SELECT question_id,
         max(CASE WHEN layer = 'bronze' THEN
               CASE WHEN coalesce(engine_avg, 0) <> 0 THEN engine_avg
                    WHEN coalesce(wall_avg, 0) <> 0 THEN wall_avg ELSE 1e0 END END) AS b
  FROM summary GROUP BY 1)"""

_REF = "CASE WHEN coalesce(s.engine_avg, 0) <> 0 THEN s.engine_avg ELSE s.wall_avg END"

SQL.update({
    "engine_log_enriched": with_(CLIENT, ENGINE_LOG, ENRICHED_LOG) + "SELECT * FROM merged",
    "layer_union": with_(CLIENT, ENGINE_LOG, ENRICHED_LOG) +
        "SELECT * FROM merged WHERE layer IN ('bronze', 'silver', 'gold')",
    "run_summary": with_(RESULTS) + """
SELECT question_id, layer, round(avg(wall_ms), 2) AS wall_avg, min(wall_ms) AS wall_min,
       max(wall_ms) AS wall_max, round(avg(query_duration_ms), 2) AS engine_avg,
       CAST(trunc(avg(read_bytes)) AS BIGINT) AS read_bytes, CAST(trunc(avg(read_rows)) AS BIGINT) AS read_rows,
       max(memory_usage) AS memory_peak, arg_max(result_rows, (captured_at, run_id, iteration)) AS result_rows
FROM results GROUP BY 1, 2""",
    "speedup_by_layer": with_(RESULTS, SUMMARY) + f"""
SELECT s.question_id, s.layer, round(s.engine_avg, 2) AS engine_avg, round(s.wall_avg, 2) AS wall_avg,
       round(CASE WHEN coalesce({_REF}, 0) <> 0 THEN coalesce(b.b, 1e0) / ({_REF}) ELSE 0e0 END, 2) AS speedup
FROM summary s JOIN base b USING (question_id)""",
    "per_run_stats": with_(RESULTS, PER_RUN) + "SELECT * FROM per_run",
    "latest_runs": with_(RESULTS, PER_RUN) + """
SELECT * FROM per_run WHERE run_id IN (
  SELECT run_id FROM (SELECT run_id, min(captured_at) AS run_ts FROM results GROUP BY 1)
  ORDER BY run_ts DESC, run_id DESC LIMIT 10)""",
    "cross_run_stats": with_(RESULTS, CROSS) + "SELECT * FROM cross_run",
    "cv_bands": with_(RESULTS, CROSS) + """
SELECT question_id, layer, round(cv_pct, 1) AS cv_pct,
       CASE WHEN cv_pct < 10 THEN 'consistent' WHEN cv_pct <= 20 THEN 'acceptable' ELSE 'investigate' END AS band
FROM cross_run""",
    "cv_share": with_(RESULTS, CROSS) + """
SELECT count(*) FILTER (WHERE cv_pct < 10) AS consistent_cells, count(*) AS total_cells,
       round(count(*) FILTER (WHERE cv_pct < 10) * 100.0e0 / nullif(count(*), 0), 1) AS share_pct
FROM cross_run""",
    "cell_stats": with_(RESULTS) + f"""
SELECT run_id, question_id, layer, count(*) AS n, round(avg(wall_ms), 2) AS mean_ms,
       round(quantile_cont(wall_ms, 0.5), 2) AS median_ms,
       round(coalesce(stddev_samp(wall_ms), 0), 2) AS stdev_ms,
       round(CASE WHEN count(*) > 1 THEN {_cv('coalesce(stddev_samp(wall_ms), 0)', 'avg(wall_ms)')}
             ELSE 0e0 END, 2) AS cv_pct
FROM results GROUP BY 1, 2, 3""",
    "latest_measurements": with_(RESULTS) + """
SELECT * FROM results
ORDER BY captured_at DESC, run_id DESC, question_id, layer, iteration DESC LIMIT 100""",
})

# --------------------------------------------------------------------------
# Metric rollups (events adapter restated)
# --------------------------------------------------------------------------

SAMPLES = """
samples AS (
  SELECT event_type AS metric, CAST(user_id % 5 AS VARCHAR) AS instance, ts, value, event_id AS sample_id
  FROM events)"""


def _w(seconds):
    return f"time_bucket(INTERVAL '{seconds} seconds', ts, TIMESTAMP '1970-01-01')"


def _last(seconds, src="samples", name="inst"):
    return f"""
{name} AS (
  SELECT metric, instance, {_w(seconds)} AS window_start, arg_max(value, (ts, sample_id)) AS value
  FROM {src} GROUP BY 1, 2, 3)"""


_STEP = "CASE WHEN prev IS NULL THEN NULL WHEN value >= prev THEN value - prev ELSE value END"


def _rate_cte(seconds, where, name="rates"):
    return f"""
{name}_steps AS (
  SELECT *, {_w(seconds)} AS window_start,
         lag(value) OVER (PARTITION BY metric, instance ORDER BY ts, sample_id) AS prev
  FROM samples WHERE {where}),
{name} AS (
  SELECT metric, instance, window_start,
         coalesce(sum({_STEP}), 0) AS increase,
         coalesce(sum({_STEP}), 0) / {float(seconds)} AS rate
  FROM {name}_steps GROUP BY 1, 2, 3)"""


SQL.update({
    "metric_select": with_(SAMPLES) + """
SELECT * FROM samples WHERE metric = 'click' AND regexp_full_match(instance, '[0-3]')
  AND instance <> '1' AND NOT regexp_full_match(instance, '3')""",
    "metric_instant": with_(SAMPLES, _last(3600)) + "SELECT * FROM inst",
    "metric_rate": with_(SAMPLES, _rate_cte(21600, "metric = 'click'")) + """
SELECT metric, instance, window_start, round(increase, 4) AS increase, round(rate, 8) AS rate FROM rates""",
    "metric_irate": with_(SAMPLES) + f"""
, steps AS (
  SELECT *, {_w(86400)} AS window_start,
         lag(value) OVER (PARTITION BY metric, instance, {_w(86400)} ORDER BY ts, sample_id) AS prev,
         lag(ts) OVER (PARTITION BY metric, instance, {_w(86400)} ORDER BY ts, sample_id) AS prev_ts
  FROM samples WHERE metric = 'signup'),
last AS (
  SELECT *, row_number() OVER (PARTITION BY metric, instance, window_start
                               ORDER BY ts DESC, sample_id DESC) AS rn,
         date_diff('microsecond', prev_ts, ts) / 1e6 AS dt
  FROM steps WHERE prev IS NOT NULL)
SELECT metric, instance, window_start, round(CASE WHEN dt > 0 THEN ({_STEP}) / dt END, 6) AS irate
FROM last WHERE rn = 1""",
    "metric_instant_at": with_(SAMPLES) + """
SELECT metric, instance, arg_max(value, (ts, sample_id)) AS value, max(ts) AS ts FROM samples
WHERE ts <= TIMESTAMP '2024-01-10 00:00:00' AND ts > TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 172800 SECONDS
GROUP BY 1, 2""",
    "metric_delta": with_(SAMPLES) + f"""
SELECT metric, instance, {_w(86400)} AS window_start,
       round(arg_max(value, (ts, sample_id)) - arg_min(value, (ts, sample_id)), 4) AS delta
FROM samples WHERE metric = 'purchase' GROUP BY 1, 2, 3""",
    "metric_sum_by": with_(SAMPLES, _last(3600)) + """
SELECT window_start, metric, round(sum(value), 4) AS sum_value, round(avg(value), 4) AS avg_value,
       min(value) AS min_value, count(*) AS series
FROM inst GROUP BY 1, 2""",
    "metric_min_of_avg": with_(SAMPLES, _rate_cte(21600, "regexp_full_match(metric, 'click|view')")) + """
SELECT window_start, round(min(value), 8) AS value FROM (
  SELECT window_start, instance, avg(rate) AS value FROM rates GROUP BY 1, 2)
GROUP BY 1 ORDER BY value DESC""",
    "metric_ratio": with_(SAMPLES, _last(3600)) + """
SELECT window_start, min(value) AS value FROM (
  SELECT window_start, instance,
         CASE WHEN v <> 0 THEN round(c / v, 6) WHEN c > 0 THEN 'Infinity'::DOUBLE WHEN c < 0 THEN '-Infinity'::DOUBLE
              WHEN c = 0 AND v = 0 THEN 'NaN'::DOUBLE END AS value
  FROM (SELECT window_start, instance, max(CASE WHEN metric = 'click' THEN value END) AS c,
               max(CASE WHEN metric = 'view' THEN value END) AS v
        FROM inst WHERE metric IN ('click', 'view') GROUP BY 1, 2)
  WHERE c IS NOT NULL AND v IS NOT NULL)
WHERE value IS NOT NULL GROUP BY 1""",
    "metric_vector_sum": with_(SAMPLES, _last(3600)) + """
SELECT * FROM (
  SELECT window_start, instance,
         round(max(CASE WHEN metric = 'click' THEN value END) + max(CASE WHEN metric = 'view' THEN value END)
               + max(CASE WHEN metric = 'purchase' THEN value END), 4) AS value
  FROM inst WHERE metric IN ('click', 'view', 'purchase') GROUP BY 1, 2)
WHERE value IS NOT NULL""",
    "metric_positive_count": with_(SAMPLES) + f"""
, d AS (
  SELECT metric, instance, {_w(86400)} AS window_start,
         arg_max(value, (ts, sample_id)) - arg_min(value, (ts, sample_id)) AS delta
  FROM samples WHERE metric = 'purchase' GROUP BY 1, 2, 3)
SELECT window_start, count(*) AS value FROM (
  SELECT window_start, instance, sum(delta) AS delta FROM d WHERE delta > 0 GROUP BY 1, 2)
GROUP BY 1""",
    "metric_topk": with_(SAMPLES, _rate_cte(21600, "true")) + """
SELECT window_start, metric, instance, round(value, 8) AS value FROM (
  SELECT window_start, metric, instance, sum(rate) AS value,
         row_number() OVER (PARTITION BY window_start ORDER BY sum(rate) DESC, metric, instance) AS rn
  FROM rates GROUP BY 1, 2, 3)
WHERE rn <= 5""",
})

SQL["ingest_audit"] = with_(BRONZE_TRIPS) + """
SELECT batch, rows_added, CAST(sum(rows_added) OVER (ORDER BY batch ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_rows
FROM (SELECT strftime(pickup_datetime, '%Y-%m') AS batch, count(*) AS rows_added FROM bronze_trips GROUP BY 1)"""

SQL["silver_clean_strict_ids"] = with_(BRONZE_TRIPS, CLEAN_MIRROR) + "SELECT * FROM clean"
SQL["silver_enriched_smallint_keys"] = with_(BRONZE_TRIPS, ZONES, CLEAN_MIRROR, ENRICHED.replace(
    "pu.LocationID = t.pickup_location_id", "CAST(pu.LocationID AS SMALLINT) = t.pickup_location_id").replace(
    "dz.LocationID = t.dropoff_location_id", "CAST(dz.LocationID AS SMALLINT) = t.dropoff_location_id")) + \
    "SELECT * FROM enriched"

SQL["metric_ratio_by_instance"] = with_(SAMPLES, _last(3600)) + """
SELECT window_start, instance, min(value) AS value FROM (
  SELECT window_start, instance,
         CASE WHEN v <> 0 THEN round(c / v, 6) WHEN c > 0 THEN 'Infinity'::DOUBLE WHEN c < 0 THEN '-Infinity'::DOUBLE
              WHEN c = 0 AND v = 0 THEN 'NaN'::DOUBLE END AS value
  FROM (SELECT window_start, instance, max(CASE WHEN metric = 'click' THEN value END) AS c,
               max(CASE WHEN metric = 'view' THEN value END) AS v
        FROM inst WHERE metric IN ('click', 'view') GROUP BY 1, 2)
  WHERE c IS NOT NULL AND v IS NOT NULL)
WHERE value IS NOT NULL GROUP BY 1, 2"""

_ENRICHED_SMALLINT = ENRICHED.replace(
    "pu.LocationID = t.pickup_location_id", "CAST(pu.LocationID AS SMALLINT) = t.pickup_location_id").replace(
    "dz.LocationID = t.dropoff_location_id", "CAST(dz.LocationID AS SMALLINT) = t.dropoff_location_id")
SQL["gold_daily_revenue_mirror"] = with_(BRONZE_TRIPS, CLEAN_MIRROR, DAILY_APPROX) + "SELECT * FROM daily_revenue"
SQL["gold_borough_pairs_mirror"] = with_(BRONZE_TRIPS, ZONES, CLEAN_MIRROR, _ENRICHED_SMALLINT, PAIRS) + \
    "SELECT * FROM borough_pairs"

# row counts of every table the pipeline materializes
_TABLE_COUNTS = [
    ("bronze", "fhvhv_trips", "bronze_trips"), ("bronze", "taxi_zones", "zones"),
    ("silver", "fhvhv_trips_clean", "clean"), ("gold", "borough_pairs", "borough_pairs"),
    ("gold", "daily_revenue", "daily_revenue"), ("gold", "driver_economics", "driver_economics"),
    ("gold", "hourly_demand", "hourly_demand"), ("gold", "shared_vs_solo", "shared_vs_solo"),
]
SQL["table_rows"] = with_(BRONZE_TRIPS, ZONES, CLEAN, ENRICHED, DAILY, HOURLY, PAIRS, DRIVER, SHARED) + \
    "\nUNION ALL ".join(f"SELECT '{l}' AS layer, '{t}' AS \"table\", count(*) AS rows FROM {cte}"
                        for l, t, cte in _TABLE_COUNTS)

SQL["landing_files"] = "SELECT * FROM events UNION ALL SELECT * FROM events"
SQL["landing_view"] = """
SELECT l_returnflag, l_linestatus, count(*) AS lines, max(l_shipdate) AS last_shipped FROM lineitem GROUP BY 1, 2"""
SQL["bench_tags"] = with_(RESULTS) + """
SELECT 'tcc_bench|' || run_id || '|' || question_id || '|' || layer || '|i' || iteration AS tag,
       'tcc_bench' AS prefix, run_id, question_id, layer, 'i' || iteration AS mark
FROM results"""
SQL["appended_measurements"] = with_(RESULTS) + "SELECT * EXCLUDE (captured_at) FROM results"

# --------------------------------------------------------------------------
# Stored tables: refresh, ingest, layout, incremental gold, CSV
# --------------------------------------------------------------------------

SQL["refreshed_lake"] = SQL["silver_enriched"]
SQL["yearly_ingest"] = """
SELECT * REPLACE (CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice),
       strftime(o_orderdate, '%Y') AS batch FROM orders"""
SQL["silver_layout"] = with_(*SILVER) + "SELECT 0::BIGINT AS overlaps, count(*) AS rows FROM clean"
SQL["bucketed_run_stats"] = SQL["per_run_stats"]
SQL["bucketed_engine_log"] = SQL["engine_log_enriched"]
SQL["gold_incremental_daily"] = with_(*SILVER, DAILY) + \
    "SELECT * EXCLUDE (median_fare_usd, p95_fare_usd) FROM daily_revenue"
SQL["gold_incremental_pairs"] = SQL["gold_borough_pairs"]
SQL["csv_rejects"] = """
WITH spoilt AS (
  SELECT *, CASE WHEN o_orderkey % 83 = 0 OR o_orderkey % 79 = 0 THEN 'columns'
                 WHEN o_orderkey % 101 = 0 THEN 'type:o_totalprice' WHEN o_orderkey % 97 = 0 THEN 'type:o_orderdate'
                 WHEN o_orderkey % 89 = 0 THEN 'missing:o_custkey' ELSE 'good' END AS reason FROM orders)
SELECT reason, count(*) AS rows, round(sum(CASE WHEN reason = 'good' OR reason LIKE 'missing%' THEN o_totalprice END), 2) AS price,
       count(CASE WHEN reason <> 'good' THEN 1 END) AS lines,
       max(CASE WHEN reason = 'good' OR reason LIKE 'missing%' THEN o_orderdate END) AS last_day
FROM spoilt GROUP BY 1"""
SQL["csv_view"] = """
SELECT c_nationkey, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1"""

# --------------------------------------------------------------------------
# Metrics: absent labels, and windows on a step grid
# --------------------------------------------------------------------------

_POD_MATCHERS = {
    "pod!=pod-1": "label <> 'pod-1'", "pod!~pod-[12]": "NOT regexp_full_match(label, 'pod-[12]')", "pod=": "label = ''",
    "pod=~pod-[01]|": "regexp_full_match(label, 'pod-[01]|')", "pod=~.*": "true", "pod=pod-2": "label = 'pod-2'"}
SQL["metric_absent_labels"] = """
WITH pods AS (
  SELECT metric, pod, coalesce(pod, '') AS label FROM (
    SELECT event_type AS metric, CASE WHEN user_id % 3 <> 0 THEN 'pod-' || (user_id % 4) END AS pod FROM events))
""" + "\nUNION ALL ".join(f"SELECT '{name}' AS matcher, metric, pod, count(*) AS samples FROM pods WHERE {test} GROUP BY 2, 3"
                          for name, test in _POD_MATCHERS.items())


def _step_windows(step: int, window: int, where: str) -> str:
    """Every sample once for each window (t - window, t] that holds it, with its predecessor there."""
    s, w = step * 1_000_000, window * 1_000_000
    return f"""
spread AS (
  SELECT metric, instance, ts, value, sample_id, unnest(range((us + {s - 1}) // {s}, (us + {w - 1}) // {s} + 1)) AS k
  FROM (SELECT *, epoch_us(ts) AS us FROM samples WHERE {where})),
steps AS (
  SELECT *, lag(value) OVER w AS prev, lag(ts) OVER w AS prev_ts, row_number() OVER w AS i, count(*) OVER (
    PARTITION BY metric, instance, k) AS n
  FROM spread WINDOW w AS (PARTITION BY metric, instance, k ORDER BY ts, sample_id)),
at_steps AS (
  SELECT metric, instance, make_timestamp(k * {s}) AS "at", make_timestamp(k * {s} - {w}) AS window_start,
         sum({_STEP}) AS increase, arg_max(value, i) - arg_min(value, i) AS delta,
         arg_max({_STEP}, i) AS last_step, date_diff('microsecond', arg_max(prev_ts, i), max(ts)) / 1e6 AS dt
  FROM steps WHERE n > 1 GROUP BY metric, instance, k)"""


SQL["metric_step_rate"] = with_(SAMPLES, _step_windows(3600, 21600, "metric = 'click'")) + """
SELECT metric, instance, "at", window_start, round(increase, 4) AS increase, round(increase / 21600.0, 8) AS rate FROM at_steps"""
SQL["metric_step_irate"] = with_(SAMPLES, _step_windows(14400, 36000, "metric = 'signup'")) + """
SELECT metric, instance, "at", window_start, round(CASE WHEN dt > 0 THEN last_step / dt END, 6) AS irate FROM at_steps"""
SQL["metric_step_delta"] = with_(SAMPLES, _step_windows(18000, 7200, "true")) + """
SELECT metric, instance, "at", window_start, round(delta, 4) AS delta FROM at_steps"""
SQL["metric_step_min_of_avg"] = with_(SAMPLES, _step_windows(3600, 21600, "true")) + """
SELECT window_start, round(min(value), 8) AS value FROM (
  SELECT window_start, instance, avg(increase / 21600.0) AS value FROM at_steps GROUP BY 1, 2) GROUP BY 1"""
SQL["metric_instant_range"] = with_(SAMPLES) + """
, once AS (SELECT metric, instance, ts, arg_max(value, sample_id) AS value FROM samples GROUP BY 1, 2, 3),
grid AS (
  SELECT metric, instance, make_timestamp(unnest(range(k0, k1 + 1)) * 3600000000) AS at FROM (
    SELECT metric, instance, min((epoch_us(ts) + 3599999999) // 3600000000) AS k0,
           max((epoch_us(ts) + 8999999999) // 3600000000) AS k1 FROM samples GROUP BY 1, 2))
SELECT g.metric, g.instance, g.at, s.value, s.ts
FROM grid g ASOF JOIN once s ON g.metric = s.metric AND g.instance = s.instance AND g.at >= s.ts
WHERE s.ts > g.at - INTERVAL 9000 SECONDS"""
