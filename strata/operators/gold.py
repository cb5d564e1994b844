"""Gold layer: the five business aggregates over silver.

Each is one ``groupBy().agg`` (partial aggregation before the shuffle, final
after), so the shuffle carries one row per group per input partition, not
one row per trip.  Outputs are tiny (days, 7x24 cells, borough pairs,
months, ride types).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators.joins import join_on_keys
from strata.operators.quantiles import approx_quantiles, histogram, quantiles_from_histogram

# fixed values: the fare percentiles reported per day
FARE_PERCENTILES = {"median_fare_usd": 0.5, "p95_fare_usd": 0.95}


def _r2(c):
    return F.round(c, 2)


def daily_revenue(clean: DataFrame, percentiles: str = "exact") -> DataFrame:
    """trip_date -> volume, revenue parts, averages and fare percentiles.

    ``percentiles``: ``exact`` (interpolated, distributed histogram),
    ``approx`` (``percentile_approx`` sketch, an actual element) or ``none``
    (for readers of the other columns).
    """
    t = clean.select(X.trip_date("pickup_at").alias("trip_date"), "total_amount", "driver_pay",
                     "tips", "congestion_surcharge", "trip_miles", "trip_minutes", "waiting_minutes")
    measures = {
        "total_trips": F.count(F.lit(1)),
        "gross_revenue_usd": _r2(F.sum("total_amount")),
        "total_driver_pay_usd": _r2(F.sum("driver_pay")),
        "total_tips_usd": _r2(F.sum("tips")),
        "total_congestion_usd": _r2(F.sum("congestion_surcharge")),
        "avg_trip_miles": _r2(F.avg("trip_miles")),
        "avg_trip_minutes": _r2(F.avg("trip_minutes")),
        "avg_waiting_minutes": _r2(F.avg("waiting_minutes")),
    }
    if percentiles in ("approx", "none"):
        if percentiles == "approx":
            q = approx_quantiles("total_amount", FARE_PERCENTILES)
            measures |= {n: _r2(c) for c, n in zip(q, FARE_PERCENTILES)}
        return t.groupBy("trip_date").agg(*[c.alias(n) for n, c in measures.items()])
    if percentiles != "exact":
        raise ValueError("percentiles must be 'exact', 'approx' or 'none'")
    # the day's measures and its fare histogram come from one scan
    base, fares = histogram(t, ["trip_date"], "total_amount", measures, [c for c in t.columns if c != "trip_date"])
    qs = quantiles_from_histogram(fares, ["trip_date"], "_v", "_c", FARE_PERCENTILES)
    qs = qs.select("trip_date", *[_r2(F.col(n)).alias(n) for n in FARE_PERCENTILES])
    # one row per day on both sides; a day whose amounts are all NULL has no
    # quantile row, hence the left join
    return join_on_keys(base, qs, ["trip_date"], "left")


def hourly_demand(clean: DataFrame) -> DataFrame:
    """(ISO weekday, hour) -> trips and four averages (a 7 x 24 heatmap)."""
    return (clean.select(X.iso_weekday("pickup_at").alias("weekday"),
                         X.hour_of_day("pickup_at").alias("hour_of_day"),
                         "trip_minutes", "waiting_minutes", "total_amount", "driver_pay")
            .groupBy("weekday", "hour_of_day")
            .agg(F.count(F.lit(1)).alias("trips"),
                 _r2(F.avg("trip_minutes")).alias("avg_trip_min"),
                 _r2(F.avg("waiting_minutes")).alias("avg_wait_min"),
                 _r2(F.avg("total_amount")).alias("avg_fare_usd"),
                 _r2(F.avg("driver_pay")).alias("avg_driver_pay_usd")))


def borough_pairs(enriched: DataFrame) -> DataFrame:
    """(pickup borough, drop-off borough) -> trips, revenue and averages.

    The NOT NULL filter on the looked-up names turns both left joins of the
    enriched view into inner joins in the optimized plan.
    """
    return (enriched
            .filter(F.col("pickup_borough").isNotNull() & F.col("dropoff_borough").isNotNull())
            .groupBy("pickup_borough", "dropoff_borough")
            .agg(F.count(F.lit(1)).alias("trips"),
                 _r2(F.sum("total_amount")).alias("revenue_usd"),
                 _r2(F.avg("trip_miles")).alias("avg_miles"),
                 _r2(F.avg("trip_minutes")).alias("avg_minutes"),
                 _r2(F.avg("total_amount")).alias("avg_fare_usd")))


def driver_economics(clean: DataFrame) -> DataFrame:
    """month -> trips, averages, total pay and pay per driving hour.

    The hourly rate is a ratio of sums computed after aggregation, NULL when
    no minutes were driven.
    """
    g = (clean.select(X.month_start("pickup_at").alias("month"), "base_fare", "tips",
                      "driver_pay", "driver_pct_of_fare", "trip_minutes")
         .groupBy("month")
         .agg(F.count(F.lit(1)).alias("total_trips"),
              _r2(F.avg("base_fare")).alias("avg_base_fare"),
              _r2(F.avg("tips")).alias("avg_tips"),
              _r2(F.avg("driver_pay")).alias("avg_driver_pay"),
              _r2(F.avg("driver_pct_of_fare")).alias("avg_driver_pct_of_fare"),
              F.sum("driver_pay").alias("_pay"),
              F.sum("trip_minutes").alias("_min")))
    return g.select("month", "total_trips", "avg_base_fare", "avg_tips", "avg_driver_pay",
                    "avg_driver_pct_of_fare", _r2(F.col("_pay")).alias("total_driver_pay"),
                    _r2(X.safe_div(F.col("_pay"), F.col("_min") / F.lit(60.0)))
                    .alias("approx_hourly_rate_usd"))


def shared_vs_solo(clean: DataFrame) -> DataFrame:
    """ride type (shared_matched / shared_unmatched / solo) -> economics."""
    return (clean.select(X.ride_type("shared_matched", "shared_requested").alias("ride_type"),
                         "total_amount", "trip_miles", "trip_minutes", "driver_pay")
            .groupBy("ride_type")
            .agg(F.count(F.lit(1)).alias("trips"),
                 _r2(F.avg("total_amount")).alias("avg_total_usd"),
                 _r2(F.avg("trip_miles")).alias("avg_miles"),
                 _r2(F.avg("trip_minutes")).alias("avg_minutes"),
                 _r2(F.avg("driver_pay")).alias("avg_driver_pay_usd"),
                 _r2(F.sum("total_amount")).alias("total_revenue_usd")))


GOLD_MODELS = {
    "daily_revenue": ("clean", daily_revenue),
    "hourly_demand": ("clean", hourly_demand),
    "borough_pairs": ("enriched", borough_pairs),
    "driver_economics": ("clean", driver_economics),
    "shared_vs_solo": ("clean", shared_vs_solo),
}

# fixed values: sort key of each materialized table (data-skipping layout)
SORT_KEYS = {
    "fhvhv_trips_clean": ["pickup_at"],
    "taxi_zones": ["LocationID"],
    "daily_revenue": ["trip_date"],
    "hourly_demand": ["weekday", "hour_of_day"],
    "borough_pairs": ["pickup_borough", "dropoff_borough"],
    "driver_economics": ["month"],
    "medallion_results": ["captured_at", "question_id", "layer", "iteration"],
}


# --------------------------------------------------------------------------
# One scan for four models: grouping sets over the clean trips
# --------------------------------------------------------------------------

# each fused model and its grouping keys
FUSED_SETS = {
    "daily_revenue": ("trip_date",),
    "hourly_demand": ("weekday", "hour_of_day"),
    "driver_economics": ("month",),
    "shared_vs_solo": ("ride_type",),
}
# the model over the enriched trips, and all of them
PAIR_SET = {"borough_pairs": ("pickup_borough", "dropoff_borough")}
PAIR_MEASURES = ("total_amount", "trip_miles", "trip_minutes")
REPORT_SETS = {**FUSED_SETS, **PAIR_SET}
_SUMMED = ("total_amount", "driver_pay", "tips", "congestion_surcharge", "trip_miles",
           "trip_minutes", "waiting_minutes", "base_fare", "driver_pct_of_fare")


def set_id(own: tuple[str, ...], keys: list[str] | tuple[str, ...]) -> int:
    """``grouping_id()`` of a set among all ``keys``: bit i is 1 when key i is not grouped."""
    return sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in own)


def set_keys(sets: dict[str, tuple[str, ...]]) -> list[str]:
    """All grouping keys of some models, each once."""
    return list(dict.fromkeys(k for own in sets.values() for k in own))


def key_columns() -> dict[str, Column]:
    """The grouping keys of all gold models as expressions over the enriched trips."""
    return {"trip_date": X.trip_date("pickup_at"), "weekday": X.iso_weekday("pickup_at"),
            "hour_of_day": X.hour_of_day("pickup_at"), "month": X.month_start("pickup_at"),
            "ride_type": X.ride_type("shared_matched", "shared_requested"),
            "pickup_borough": F.col("pickup_borough"), "dropoff_borough": F.col("dropoff_borough")}


def fused_aggregates(trips: DataFrame, sets: dict[str, tuple[str, ...]] = FUSED_SETS,
                     also_by: tuple[str, ...] = (), measures: tuple[str, ...] = _SUMMED) -> DataFrame:
    """Sums and counts of every measure for all key sets in one aggregation:
    one scan of silver and one (map-side combined) shuffle instead of one of
    each per model.  Output: one row per group per set, ``_gid`` telling the
    sets apart; ``also_by`` columns are part of every set."""
    keys = set_keys(sets)
    columns = key_columns()
    t = trips.select(*also_by, *[columns[k].alias(k) for k in keys], *measures)
    # the columns of every set come first, so that they don't change the sets' numbers
    aggs = [F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("_n")]
    aggs += [F.sum(c).alias(f"_s_{c}") for c in measures]
    aggs += [F.count(c).alias(f"_c_{c}") for c in measures]
    return t.groupingSets([[*also_by, *own] for own in sets.values()], *also_by, *keys).agg(*aggs)


def _avg(c):
    # avg = sum / count of non-NULL values; NULL when there are none
    return _r2(X.safe_div(F.col(f"_s_{c}"), F.col(f"_c_{c}")))


def fare_histogram(clean: DataFrame) -> DataFrame:
    """(trip_date, _fare) -> count, behind the exact daily fare percentiles."""
    return (clean.select(X.trip_date("pickup_at").alias("trip_date"), F.col("total_amount").cast("double").alias("_fare"))
            .filter(F.col("_fare").isNotNull()).groupBy("trip_date", "_fare").agg(F.count(F.lit(1)).alias("_n")))


def models_from_fused(fused: DataFrame, hist: DataFrame | None,
                      quantiles: DataFrame | None = None) -> dict[str, DataFrame]:
    """The four models, each a filter + projection of the fused aggregate; the
    daily model joins its exact fare percentiles from the ``fare_histogram``, or
    those of ``quantiles`` (by trip_date) where there is no histogram."""
    f = {m: fused.filter(F.col("_gid") == set_id(own, set_keys(FUSED_SETS))) for m, own in FUSED_SETS.items()}
    s = lambda c: _r2(F.col(f"_s_{c}"))
    daily = f["daily_revenue"].select(
        "trip_date", F.col("_n").alias("total_trips"), s("total_amount").alias("gross_revenue_usd"),
        s("driver_pay").alias("total_driver_pay_usd"), s("tips").alias("total_tips_usd"),
        s("congestion_surcharge").alias("total_congestion_usd"), _avg("trip_miles").alias("avg_trip_miles"),
        _avg("trip_minutes").alias("avg_trip_minutes"), _avg("waiting_minutes").alias("avg_waiting_minutes"))
    if quantiles is None:
        quantiles = quantiles_from_histogram(hist, ["trip_date"], "_fare", "_n", FARE_PERCENTILES)
    qs = quantiles.select("trip_date", *[_r2(F.col(n)).alias(n) for n in FARE_PERCENTILES])
    return {
        "daily_revenue": join_on_keys(daily, qs, ["trip_date"], "left"),
        "hourly_demand": f["hourly_demand"].select(
            "weekday", "hour_of_day", F.col("_n").alias("trips"), _avg("trip_minutes").alias("avg_trip_min"),
            _avg("waiting_minutes").alias("avg_wait_min"), _avg("total_amount").alias("avg_fare_usd"),
            _avg("driver_pay").alias("avg_driver_pay_usd")),
        "driver_economics": f["driver_economics"].select(
            "month", F.col("_n").alias("total_trips"), _avg("base_fare").alias("avg_base_fare"),
            _avg("tips").alias("avg_tips"), _avg("driver_pay").alias("avg_driver_pay"),
            _avg("driver_pct_of_fare").alias("avg_driver_pct_of_fare"), s("driver_pay").alias("total_driver_pay"),
            _r2(X.safe_div(F.col("_s_driver_pay"), F.col("_s_trip_minutes") / F.lit(60.0)))
            .alias("approx_hourly_rate_usd")),
        "shared_vs_solo": f["shared_vs_solo"].select(
            "ride_type", F.col("_n").alias("trips"), _avg("total_amount").alias("avg_total_usd"),
            _avg("trip_miles").alias("avg_miles"), _avg("trip_minutes").alias("avg_minutes"),
            _avg("driver_pay").alias("avg_driver_pay_usd"), s("total_amount").alias("total_revenue_usd")),
    }


def pairs_from_fused(fused: DataFrame) -> DataFrame:
    """The borough pairs from the aggregate over ``PAIR_SET``."""
    return fused.where("pickup_borough is not null and dropoff_borough is not null").select(
        "pickup_borough", "dropoff_borough", F.col("_n").alias("trips"), _r2(F.col("_s_total_amount")).alias("revenue_usd"),
        _avg("trip_miles").alias("avg_miles"), _avg("trip_minutes").alias("avg_minutes"),
        _avg("total_amount").alias("avg_fare_usd"))
