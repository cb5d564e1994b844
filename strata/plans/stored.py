"""Registered queries that store tables on their way: refresh, ingest, append, layout and incremental gold.

Each works in a folder of its own under the session's scratch, reads the given tables whole, and returns what the stored
tables hold in the end.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from strata.operators import gold, history, incremental, silver
from strata.plans.layers import Medallion
from strata.session import scratch_path
from strata.sinks import tables
from strata.sources import batches, fixtures, landing


def _folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def refreshed_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched view of a lake whose silver table was refreshed, compacted, refreshed again and attached anew.

    The first refresh has the second dialect's minutes, so only the last one's rows are right; zones are stored as ORC.
    """
    m, root = Medallion(spark, sf_dir), _folder(spark, "lake")
    own = f"lake_{uuid.uuid4().hex}"
    tables.create_layers(spark, root, (own,))
    clean, zones = f"{own}.fhvhv_trips_clean", f"{own}.taxi_zones"
    key = gold.SORT_KEYS["fhvhv_trips_clean"]
    tables.write_table(m.bronze_zones, zones, gold.SORT_KEYS["taxi_zones"], 1, fmt="orc")
    tables.write_table(Medallion(spark, sf_dir, minute_mode="elapsed").clean, clean, key, how="local")
    tables.compact(spark, {clean: key}).collect()
    tables.write_table(m.clean, clean, key)
    tables.compact(spark, {clean: key, zones: None}).collect()
    # as another session would find it: by the folder alone
    other = f"{own}_attached"
    spark.sql(f"CREATE DATABASE {other} LOCATION '{root}/{other}'")
    for name in ("fhvhv_trips_clean", "taxi_zones"):
        tables.attach_table(spark, f"{other}.{name}", f"{root}/{own}/{name}")
    view = tables.create_catalog_view(spark, f"{other}.fhvhv_trips_enriched", silver.enriched_view_sql(
        f"{other}.fhvhv_trips_clean", f"{other}.taxi_zones"))
    return spark.table(view)


def yearly_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders, landed as one file a year, ingested, with 1997 corrected (prices doubled) and ingested again, twice."""
    land, target = _folder(spark, "landing"), f"{_folder(spark, 'ingested')}/orders"
    orders = fixtures.table(spark, sf_dir, "orders").withColumn("year", F.date_format("o_orderdate", "yyyy"))
    orders.repartition("year").write.partitionBy("year").parquet(land)
    pattern = r"/year=(\d{4})/"
    batches.ingest_batches(spark, land, target, pattern)
    corrected = orders.where("year = '1997'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    corrected.drop("year").write.mode("overwrite").parquet(f"{land}/year=1997")
    batches.ingest_batches(spark, land, target, pattern)
    batches.ingest_batches(spark, land, target, pattern)
    return spark.read.schema(f"{_ddl(orders.drop('year'))}, batch string").parquet(target)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{n} {t}" for n, t in df.dtypes)


def appended_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measurement table after an append, its repetition, and one of all rows once more under a later time."""
    results = tables.measurement_rows(fixtures.medallion_results(fixtures.table(spark, sf_dir, "events")))
    path = _folder(spark, "measurements")
    half = results.where(F.col("iteration") % 2 == 0)
    tables.append_once(half, path)
    tables.append_once(half, path)
    later = F.timestamp_add("DAY", F.lit(1), F.col("captured_at"))
    tables.append_once(results.unionByName(results.withColumn("captured_at", later)), path)
    return spark.read.schema(results.schema).parquet(path).drop("captured_at")


def silver_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the files of a range-laid silver table overlap in its key."""
    path = tables.write_path(Medallion(spark, sf_dir).clean, _folder(spark, "layout"), gold.SORT_KEYS["fhvhv_trips_clean"])
    return tables.overlapping_files(spark.read.parquet(path), "pickup_at").select("overlaps", "rows")


#: files of a bucketed measurement table
BUCKETS = 8


def bucketed(spark: SparkSession, df: DataFrame, by: list[str], sort_by: list[str]) -> DataFrame:
    name = f"bucketed_{uuid.uuid4().hex}"
    tables.write_bucketed(df, name, BUCKETS, by, sort_by, _folder(spark, name))
    return spark.table(name)


def bucketed_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-run statistics over a results table that is dealt by run and cell: no shuffle."""
    results = fixtures.medallion_results(fixtures.table(spark, sf_dir, "events"))
    return history.per_run_stats(bucketed(spark, results, ["run_id", "question_id", "layer"],
                                          gold.SORT_KEYS["medallion_results"]))


def bucketed_engine_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client measurements with their engine log, both stored by tag: neither the aggregation nor the join shuffles."""
    events = fixtures.table(spark, sf_dir, "events")
    client = bucketed(spark, fixtures.client_timings(events), ["tag"], ["tag"])
    log = bucketed(spark, fixtures.engine_log(events), ["log_comment"], ["log_comment", "event_time"])
    return history.enrich_with_engine_log(client, log)


def incremental_gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Gold from the states of quarterly refreshes, one of which is repeated."""
    m, path = Medallion(spark, sf_dir), _folder(spark, "states")
    trips = m.clean.withColumn(incremental.BATCH, F.date_format("pickup_at", "yyyy-MM"))
    for q in (1, 2, 3, 4, 3):
        incremental.write_states(trips.where(F.quarter("pickup_at") == q), m.bronze_zones, path)
    return incremental.gold_models(spark, path)


def incremental_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_gold(spark, sf_dir)["daily_revenue"].drop(*gold.FARE_PERCENTILES)


def incremental_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental_gold(spark, sf_dir)["borough_pairs"]


# ------------------------------------------------------------------------------------------------------------- CSV

# fixed values: the declared columns of the orders as CSV
ORDERS_CSV = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()), StructField("o_orderstatus", StringType()),
    StructField("o_totalprice", DoubleType()), StructField("o_orderdate", TimestampNTZType())])


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV lines of which some are spoilt by their key, read back: rows and prices by reason."""
    o = fixtures.table(spark, sf_dir, "orders").select(*ORDERS_CSV.fieldNames())
    key = F.col("o_orderkey")
    price = F.when(key % 101 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(key % 97 == 0, F.lit("yesterday")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    customer = F.when(key % 89 == 0, F.lit("")).otherwise(F.col("o_custkey").cast("string"))
    line = F.concat_ws(",", key.cast("string"), customer, F.concat(F.lit('"'), "o_orderstatus", F.lit('"')), price, day)
    line = F.when(key % 83 == 0, F.concat(line, F.lit(",left over"))).when(key % 79 == 0, key.cast("string")).otherwise(line)
    path = _folder(spark, "orders-csv")
    o.select(line).write.text(path)
    rows = landing.read_csv_checked(spark, path, ORDERS_CSV, required=("o_custkey",), header=False)
    return rows.groupBy(F.coalesce("_reason", F.lit("good")).alias("reason")).agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("price"),
        F.count("_line").alias("lines"), F.max("o_orderdate").alias("last_day"))


def csv_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate over a view on CSV files whose columns are cast where they are used."""
    path, name = _folder(spark, "customer-csv"), f"landing_customer_{uuid.uuid4().hex}"
    fixtures.table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    landing.csv_view(spark, path, name)
    return spark.sql(f"SELECT CAST(c_nationkey AS INT) AS c_nationkey, count(*) AS customers, "
                     f"round(sum(CAST(c_acctbal AS DOUBLE)), 2) AS balance FROM {name} GROUP BY 1")


def landing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate over a view on the landing files (no copy)."""
    landing.parquet_view(spark, f"{sf_dir}/lineitem.parquet", "landing_lineitem")
    return spark.table("landing_lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.max("l_shipdate").alias("last_shipped"))


#: queries that write tables when they are built
REGISTRY = {
    "refreshed_lake": refreshed_lake,
    "yearly_ingest": yearly_ingest,
    "appended_measurements": appended_measurements,
    "silver_layout": silver_layout,
    "bucketed_run_stats": bucketed_run_stats,
    "bucketed_engine_log": bucketed_engine_log,
    "gold_incremental_daily": incremental_daily,
    "gold_incremental_pairs": incremental_pairs,
    "csv_rejects": csv_rejects,
    "csv_view": csv_view,
}
