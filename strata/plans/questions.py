"""The two business questions, each answerable from any layer.

Q1 (daily trips and revenue) and Q2 (top-10 borough pairs by revenue) are
written once per layer.  Bronze recomputes from raw trips (scan + filter +
lookups), silver aggregates the clean table, gold only projects an already
aggregated table — the same answer at very different cost.

Bronze and silver filters differ on purpose: bronze applies only the time
window and the positive-fare rule, silver also has the distance and
duration ranges baked in, so their numbers are not asserted equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators.silver import DEFAULT_WINDOW, gross_amount, in_window

TOP_K = 10   # fixed value: size of the Q2 ranking


def _bronze_filter(bronze: DataFrame, window) -> DataFrame:
    return bronze.filter(in_window("pickup_datetime", window) & (F.col("base_passenger_fare") > 0))


def q1_bronze(bronze: DataFrame, window=DEFAULT_WINDOW) -> DataFrame:
    return (_bronze_filter(bronze, window)
            .groupBy(X.trip_date("pickup_datetime").alias("trip_date"))
            .agg(F.count(F.lit(1)).alias("trips"),
                 F.round(F.sum(gross_amount("double")), 2).alias("revenue_usd"))
            .orderBy("trip_date"))


def q1_silver(clean: DataFrame) -> DataFrame:
    return (clean.groupBy(X.trip_date("pickup_at").alias("trip_date"))
            .agg(F.count(F.lit(1)).alias("trips"),
                 F.round(F.sum("total_amount"), 2).alias("revenue_usd"))
            .orderBy("trip_date"))


def q1_gold(daily_revenue: DataFrame) -> DataFrame:
    return (daily_revenue.select("trip_date", F.col("total_trips").alias("trips"),
                                 F.col("gross_revenue_usd").alias("revenue_usd"))
            .orderBy("trip_date"))


def top_by_revenue(pairs: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top-k pairs by revenue; the pair names break ties so the cut is stable.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each partition
    keeps only its own top k, so no full sort happens.
    """
    return pairs.orderBy(F.col("revenue_usd").desc(), "pickup_borough", "dropoff_borough").limit(k)


def q2_bronze(bronze: DataFrame, zones: DataFrame, window=DEFAULT_WINDOW,
              k: int = TOP_K) -> DataFrame:
    z = zones.select("LocationID", "Borough")
    pu = z.select(F.col("LocationID").alias("pu_id"), F.col("Borough").alias("pickup_borough"))
    do = z.select(F.col("LocationID").alias("do_id"), F.col("Borough").alias("dropoff_borough"))
    t = (_bronze_filter(bronze, window)
         .select(X.id_cast_for(bronze, "PULocationID").alias("pu_key"),
                 X.id_cast_for(bronze, "DOLocationID").alias("do_key"),
                 gross_amount("double").alias("amount")))
    t = t.join(pu, F.col("pu_key") == F.col("pu_id"), "left")
    t = t.join(do, F.col("do_key") == F.col("do_id"), "left")
    pairs = (t.filter(F.col("pickup_borough").isNotNull() & F.col("dropoff_borough").isNotNull())
             .groupBy("pickup_borough", "dropoff_borough")
             .agg(F.count(F.lit(1)).alias("trips"), F.round(F.sum("amount"), 2).alias("revenue_usd")))
    return top_by_revenue(pairs, k)


def q2_silver(enriched: DataFrame, k: int = TOP_K) -> DataFrame:
    pairs = (enriched
             .filter(F.col("pickup_borough").isNotNull() & F.col("dropoff_borough").isNotNull())
             .groupBy("pickup_borough", "dropoff_borough")
             .agg(F.count(F.lit(1)).alias("trips"),
                  F.round(F.sum("total_amount"), 2).alias("revenue_usd")))
    return top_by_revenue(pairs, k)


def q2_gold(borough_pairs: DataFrame, k: int = TOP_K) -> DataFrame:
    pairs = (borough_pairs
             .filter(F.col("pickup_borough").isNotNull() & F.col("dropoff_borough").isNotNull())
             .select("pickup_borough", "dropoff_borough", "trips", "revenue_usd"))
    return top_by_revenue(pairs, k)


QUESTIONS = {
    "Q1_daily_revenue": {"bronze": q1_bronze, "silver": q1_silver, "gold": q1_gold},
    "Q2_top_borough_pairs_by_revenue": {"bronze": q2_bronze, "silver": q2_silver, "gold": q2_gold},
}
