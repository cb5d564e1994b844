"""Silver layer: typed, filtered trips and their zone-enriched view.

``clean`` is a single narrow projection + filter over the bronze scan: no
shuffle, and every predicate that refers to a raw column is pushed into the
Parquet reader.  ``enrich`` adds two lookups into the (small, size-checked)
zone dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import exprs as X

# fixed values: the reference's trip-window and quality thresholds
DEFAULT_WINDOW = ("2023-01-01", "2024-01-01")
MAX_MILES = 200
MAX_TRIP_SECONDS = 21600   # six hours

MINUTE_MODES = ("boundary", "elapsed")

FARE_PARTS = ("base_passenger_fare", "tolls", "bcf", "sales_tax",
              "congestion_surcharge", "airport_fee", "tips")


def window_bounds(window):
    lo, hi = window
    return (F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz"))


def in_window(ts, window) -> "F.Column":
    """Half-open time window [lo, hi)."""
    lo, hi = window_bounds(window)
    return (F.col(ts) >= lo) & (F.col(ts) < hi)


def gross_amount(cast_to: str | None = None):
    """NULL-propagating sum of the seven fare parts (one NULL part -> NULL)."""
    parts = [F.col(c).cast(cast_to) if cast_to else F.col(c) for c in FARE_PARTS]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def quality_predicate(window=DEFAULT_WINDOW):
    """Row-level rules of the silver layer (FLT-1..3)."""
    return (in_window("pickup_datetime", window)
            & (F.col("base_passenger_fare") > 0)
            & F.col("trip_miles").between(0, MAX_MILES)
            & F.col("trip_time").between(0, MAX_TRIP_SECONDS))


def clean(bronze: DataFrame, window=DEFAULT_WINDOW, minute_mode: str = "boundary",
          id_cast: str = "safe") -> DataFrame:
    """silver.fhvhv_trips_clean.

    ``minute_mode`` selects how minute differences are counted: ``boundary``
    (minute marks crossed) or ``elapsed`` (whole minutes elapsed).
    ``id_cast`` is ``safe`` (NULL on anything outside 0..65535) or ``strict``
    (the second dialect: ids and minutes narrowed by a SMALLINT cast that raises
    on overflow).
    """
    if minute_mode not in MINUTE_MODES:
        raise ValueError(f"minute_mode must be one of {MINUTE_MODES}")
    minutes = X.minutes_boundary if minute_mode == "boundary" else X.minutes_elapsed
    if id_cast == "safe":
        to_id, narrow = (lambda c: X.id_cast_for(bronze, c)), (lambda c: c)
    else:
        to_id, narrow = X.smallint_strict, (lambda c: c.cast("smallint"))
    return (bronze
            .filter(quality_predicate(window))
            .select(
                F.col("pickup_datetime").alias("pickup_at"),
                F.col("dropoff_datetime").alias("dropoff_at"),
                to_id("PULocationID").alias("pickup_location_id"),
                to_id("DOLocationID").alias("dropoff_location_id"),
                F.col("trip_miles").cast("float").alias("trip_miles"),
                F.col("base_passenger_fare").cast("float").alias("base_fare"),
                F.col("tips").cast("float").alias("tips"),
                F.col("congestion_surcharge").cast("float").alias("congestion_surcharge"),
                F.col("driver_pay").cast("float").alias("driver_pay"),
                X.flag_is_yes("shared_request_flag").alias("shared_requested"),
                X.flag_is_yes("shared_match_flag").alias("shared_matched"),
                X.flag_is_yes("access_a_ride_flag").alias("access_a_ride"),
                X.flag_is_yes("wav_request_flag").alias("wav_requested"),
                narrow(minutes("request_datetime", "pickup_datetime")).alias("waiting_minutes"),
                narrow(minutes("pickup_datetime", "dropoff_datetime")).alias("trip_minutes"),
                gross_amount().cast("float").alias("total_amount"),
                X.guarded_pct("driver_pay", "base_passenger_fare").alias("driver_pct_of_fare"),
            ))


ENRICHED_TRIP_COLUMNS = ("pickup_at", "dropoff_at", "waiting_minutes", "trip_minutes",
                         "trip_miles", "base_fare", "tips", "driver_pay", "total_amount",
                         "driver_pct_of_fare", "shared_requested", "shared_matched",
                         "wav_requested", "access_a_ride")


def enrich(clean_df: DataFrame, zones: DataFrame, zone_key_cast: str | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """silver.fhvhv_trips_enriched: clean trips + borough/zone names for both ends.

    Both lookups are left joins, so a trip whose id has no zone keeps NULL
    names.  ``zone_key_cast`` optionally casts the dimension key (the second
    dialect compares SMALLINT keys); ``also`` columns of the trips come last.
    """
    key = F.col("LocationID")
    if zone_key_cast:
        key = key.cast(zone_key_cast)
    z = zones.select(key.alias("LocationID"), "Borough", "Zone")
    pu = z.select(F.col("LocationID").alias("pu_id"), F.col("Borough").alias("pickup_borough"),
                  F.col("Zone").alias("pickup_zone"))
    do = z.select(F.col("LocationID").alias("do_id"), F.col("Borough").alias("dropoff_borough"),
                  F.col("Zone").alias("dropoff_zone"))
    trips = clean_df.select(*ENRICHED_TRIP_COLUMNS, *also, "pickup_location_id", "dropoff_location_id")
    out = trips.join(pu, F.col("pickup_location_id") == F.col("pu_id"), "left")
    out = out.join(do, F.col("dropoff_location_id") == F.col("do_id"), "left")
    return out.select(*ENRICHED_TRIP_COLUMNS, "pickup_borough", "pickup_zone",
                      "dropoff_borough", "dropoff_zone", *also)


def enriched_view_sql(clean_table: str, zones_table: str) -> str:
    """The enriched model over stored tables, as the definition of a catalog view."""
    trips = ", ".join(f"t.{c}" for c in ENRICHED_TRIP_COLUMNS)
    return (f"SELECT {trips}, pu.Borough AS pickup_borough, pu.Zone AS pickup_zone, "
            f"dz.Borough AS dropoff_borough, dz.Zone AS dropoff_zone FROM {clean_table} t "
            f"LEFT JOIN {zones_table} pu ON t.pickup_location_id = pu.LocationID "
            f"LEFT JOIN {zones_table} dz ON t.dropoff_location_id = dz.LocationID")
