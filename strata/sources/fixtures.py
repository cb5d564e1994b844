"""Adapters from the shared test tables onto the trip-analytics data model.

The real inputs (monthly trip Parquet files, the zone CSV, the measurement
history and the metric samples) are not available offline, so each bronze
input is *derived by Spark* from a driver table with integer arithmetic
only.  The derivation is a projection: it keeps the input's partitioning,
adds no shuffle, and its work grows linearly with the table.

The fixed offsets below are a deterministic scramble of the TPC-H keys; the
same expressions are written in DuckDB SQL for the correctness oracle.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exprs import add_seconds

# fixed values: the adapter's scramble constants (FIXTURES.md B1)
SOD = (7919, 10473, 613, 86400)      # orderkey, partkey, linenumber multipliers; modulus
TRIP_T = (13, 97, 101, 22500)        # partkey, suppkey, linenumber multipliers; modulus
WAIT_T = (31, 17, 1200)              # partkey, suppkey multipliers; modulus
ZONE_MOD = 27                        # ids 25 and 26 have no zone
FIXTURE_WINDOW = ("1998-01-01", "1999-01-01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """bronze.fhvhv_trips shape from ``lineitem`` (one output row per input row)."""
    ok, pk, sk, ln = (F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"),
                      F.col("l_linenumber"))
    sod = (ok * SOD[0] + pk * SOD[1] + ln * SOD[2]) % SOD[3]
    tt = (pk * TRIP_T[0] + sk * TRIP_T[1] + ln * TRIP_T[2]) % TRIP_T[3]
    wt = (pk * WAIT_T[0] + sk * WAIT_T[1]) % WAIT_T[2]
    ship = F.col("l_shipdate")
    price = F.col("l_extendedprice")
    yes_no = lambda cond: F.when(cond, F.lit("Y")).otherwise(F.lit("N"))
    return lineitem.select(
        # license / base strings: present in bronze, dropped by silver
        F.concat(F.lit("HV000"), (sk % 4 + 2).cast("string")).alias("hvfhs_license_num"),
        F.concat(F.lit("B0"), F.lpad((sk % 1000).cast("string"), 4, "0")).alias("dispatching_base_num"),
        add_seconds(ship, sod - wt).alias("request_datetime"),
        add_seconds(ship, sod).alias("pickup_datetime"),
        add_seconds(ship, sod + tt).alias("dropoff_datetime"),
        (sk % ZONE_MOD).alias("PULocationID"),
        (pk % ZONE_MOD).alias("DOLocationID"),
        (F.col("l_quantity") * F.lit(4.1)).alias("trip_miles"),
        tt.alias("trip_time"),
        (price / F.lit(1000.0) - F.lit(2.0)).alias("base_passenger_fare"),
        (F.col("l_tax") * F.lit(10.0)).alias("tolls"),
        (price * F.lit(0.00003)).alias("bcf"),
        (price * F.lit(0.00008875)).alias("sales_tax"),
        F.when(ln % 2 == 0, F.lit(2.75)).otherwise(F.lit(0.0)).alias("congestion_surcharge"),
        F.when(sk % 10 == 0, F.lit(2.5)).when(sk % 10 == 1, F.lit(None).cast("double"))
         .otherwise(F.lit(0.0)).alias("airport_fee"),
        (F.col("l_discount") * F.col("l_quantity")).alias("tips"),
        (price * F.lit(0.00075)).alias("driver_pay"),
        yes_no(F.col("l_returnflag") != "N").alias("shared_request_flag"),
        yes_no((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")).alias("shared_match_flag"),
        yes_no(ln == 7).alias("access_a_ride_flag"),
        yes_no(ln == 6).alias("wav_request_flag"),
    )


def zones_from_nation(nation: DataFrame, region: DataFrame) -> DataFrame:
    """bronze.taxi_zones shape: LocationID, Borough, Zone, service_zone."""
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("int").alias("LocationID"),
                    F.col("r_name").alias("Borough"),
                    F.col("n_name").alias("Zone"),
                    F.concat(F.lit("zone-"), F.col("n_regionkey").cast("string")).alias("service_zone")))


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_lineitem(table(spark, sf_dir, "lineitem"))


def bronze_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones_from_nation(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


# --------------------------------------------------------------------------
# Measurement history and engine log (FIXTURES.md B3)
# --------------------------------------------------------------------------

# fixed values: event type -> layer, question ids, run count, base time
EVENT_LAYER = {"error": "bronze", "signup": "bronze", "click": "silver",
               "view": "silver", "purchase": "gold"}
QUESTIONS = ("Q1_daily_revenue", "Q2_borough_pairs")
RUNS = 12
HISTORY_BASE = "2024-02-01 00:00:00"


def _layer_of(event_type):
    out = None
    for et, layer in EVENT_LAYER.items():
        out = F.when(event_type == et, F.lit(layer)) if out is None else out.when(event_type == et, F.lit(layer))
    return out


def _run(events_user):
    return events_user % RUNS


def client_timings(events: DataFrame) -> DataFrame:
    """Per-iteration client measurements: ids, tag, wall time and rows seen."""
    e = events
    return e.select(
        F.concat(F.lit("run-"), _run(F.col("user_id")).cast("string")).alias("run_id"),
        F.when(F.col("event_id") % 2 == 0, F.lit(QUESTIONS[0])).otherwise(F.lit(QUESTIONS[1])).alias("question_id"),
        _layer_of(F.col("event_type")).alias("layer"),
        F.col("event_id").cast("int").alias("iteration"),
        F.concat_ws("|", F.lit("tcc_bench"), _run(F.col("user_id")).cast("string"),
                    F.col("event_id").cast("string")).alias("tag"),
        (F.col("value") * F.lit(10.0)).alias("wall_ms"),
        (F.col("event_id") % 50).alias("result_rows"),
    )


def engine_log(events: DataFrame) -> DataFrame:
    """Engine-side query log keyed by the tag: missing, duplicated (a retry an
    hour later) and unfinished ('QueryStart') entries all occur."""
    base = events.filter(F.col("event_id") % 7 != 0)
    dur = F.floor(F.col("value") * F.lit(8.0)).cast("long")
    cols = lambda extra_ms, hours: [
        F.concat_ws("|", F.lit("tcc_bench"), _run(F.col("user_id")).cast("string"),
                    F.col("event_id").cast("string")).alias("log_comment"),
        (dur + F.lit(extra_ms)).alias("query_duration_ms"),
        (F.col("event_id") * 10).alias("read_rows"),
        (F.col("event_id") * 800).alias("read_bytes"),
        (F.col("event_id") * 3).alias("memory_usage"),
        (F.col("event_id") % 50).alias("result_rows"),
        F.when(F.col("event_id") % 13 == 0, F.lit("QueryStart")).otherwise(F.lit("QueryFinish")).alias("type"),
        F.timestamp_add("HOUR", F.lit(hours), F.col("ts")).alias("event_time"),
    ]
    first = base.select(*cols(0, 0))
    retry = base.filter(F.col("event_id") % 11 == 0).select(*cols(5, 1))
    return first.unionByName(retry)


def medallion_results(events: DataFrame) -> DataFrame:
    """benchmark.medallion_results shape (already merged measurements)."""
    run = _run(F.col("user_id"))
    return events.select(
        F.concat(F.lit("run-"), run.cast("string")).alias("run_id"),
        F.timestamp_add("HOUR", run.cast("int"), F.lit(HISTORY_BASE).cast("timestamp_ntz")).alias("captured_at"),
        F.when(F.col("event_id") % 2 == 0, F.lit(QUESTIONS[0])).otherwise(F.lit(QUESTIONS[1])).alias("question_id"),
        _layer_of(F.col("event_type")).alias("layer"),
        F.col("event_id").cast("int").alias("iteration"),
        (F.col("value") * F.lit(10.0)).alias("wall_ms"),
        F.floor(F.col("value") * F.lit(8.0)).cast("long").alias("query_duration_ms"),
        (F.col("event_id") * 10).alias("read_rows"),
        (F.col("event_id") * 800).alias("read_bytes"),
        (F.col("event_id") * 3).alias("memory_usage"),
        (F.col("event_id") % 50).alias("result_rows"),
    )


# --------------------------------------------------------------------------
# Metric samples (FIXTURES.md B4)
# --------------------------------------------------------------------------

INSTANCES = 5


def metric_samples(events: DataFrame, *more: Column) -> DataFrame:
    """Long metric table: metric, instance label, ts, value, and a sample id
    that breaks timestamp ties deterministically; ``more`` labels come last."""
    return events.select(
        F.col("event_type").alias("metric"),
        (F.col("user_id") % INSTANCES).cast("string").alias("instance"),
        F.col("ts"),
        F.col("value"),
        F.col("event_id").alias("sample_id"),
        *more,
    )


def pod_samples(events: DataFrame) -> DataFrame:
    """Metric samples with a second label, which a third of the users' series lack."""
    pod = F.when(F.col("user_id") % 3 != 0, F.concat(F.lit("pod-"), (F.col("user_id") % 4).cast("string")))
    return metric_samples(events, pod.alias("pod"))
