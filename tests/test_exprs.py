"""Hand-written edge cases for the scalar expressions and silver rules."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators import silver

T = dt.datetime


def one(spark, rows, schema, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_minutes_boundary_vs_elapsed(spark):
    rows = [(T(2023, 1, 1, 10, 59, 59), T(2023, 1, 1, 11, 0, 1)),      # :59 -> :01
            (T(2023, 1, 1, 10, 0, 0), T(2023, 1, 1, 10, 0, 59)),
            (T(2023, 1, 1, 10, 5, 30), T(2023, 1, 1, 10, 2, 10))]      # end before start
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    got = df.select(X.minutes_boundary("a", "b").alias("bd"), X.minutes_elapsed("a", "b").alias("el")).collect()
    assert [(r.bd, r.el) for r in got] == [(1, 0), (0, 0), (-3, -3)]


def test_minutes_boundary_ignores_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = one(spark, [(T(2023, 3, 12, 1, 59, 30), T(2023, 3, 12, 3, 0, 30))],
                  "a timestamp_ntz, b timestamp_ntz", X.minutes_boundary("a", "b"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [61]


def test_uint16_or_null(spark):
    got = one(spark, [("abc",), ("-1",), ("70000",), ("65535",), ("0",), (None,), ("3.5",)],
              "s string", X.uint16_or_null("s"))
    assert got == [None, None, None, 65535, 0, None, None]
    fast = one(spark, [(-1,), (70000,), (65535,), (12,), (None,)], "x bigint",
               X.uint16_or_null("x", integral=True))
    assert fast == [None, None, 65535, 12, None]


def test_iso_weekday_sunday_is_7(spark):
    got = one(spark, [(T(2023, 1, 1, 12),), (T(2023, 1, 2, 0),)], "t timestamp_ntz", X.iso_weekday("t"))
    assert got == [7, 1]


def test_flags_and_ride_type(spark):
    df = spark.createDataFrame([("Y", "Y"), ("Y", "N"), ("N", "N"), (None, None)], "r string, m string")
    out = df.select(X.ride_type(X.flag_is_yes("m"), X.flag_is_yes("r")).alias("t"),
                    X.flag_is_yes("r").alias("f")).collect()
    assert [o.t for o in out] == ["shared_matched", "shared_unmatched", "solo", "solo"]
    assert out[3].f is None


def test_human_bytes(spark):
    got = one(spark, [(0,), (1023,), (1536,), (5 * 1024 ** 3,), (3 * 1024 ** 5,), (None,)], "n long",
              X.human_bytes("n"))
    assert got == ["0.00 B", "1,023.00 B", "1.50 KiB", "5.00 GiB", "3,072.00 TiB", None]


def test_cv_and_bands(spark):
    df = spark.createDataFrame([(0.0, 0.0), (5.0, 100.0), (15.0, 100.0), (30.0, 100.0), (1.0, None)],
                               "sd double, m double")
    out = df.select(X.cv_pct("sd", "m").alias("cv")).select("cv", X.cv_band("cv").alias("b")).collect()
    assert [(o.cv, o.b) for o in out] == [(0.0, "consistent"), (5.0, "consistent"),
                                          (15.0, "acceptable"), (30.0, "investigate"), (0.0, "consistent")]


def test_safe_div_and_guarded_pct(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 4.0)], "p double, w double")
    out = df.select(X.safe_div("p", "w").alias("d"), X.guarded_pct("p", "w").alias("g")).collect()
    assert out[0].d is None and out[0].g == 0.0
    assert out[1].d == 2.5 and abs(out[1].g - 250.0) < 1e-4


def test_tag_round_trip(spark):
    df = spark.createDataFrame([("r1", "Q1", "gold", 3)], "r string, q string, l string, i int")
    tag = df.select(X.bench_tag("r", "q", "l", "i").alias("t"))
    assert tag.first().t == "tcc_bench|r1|Q1|gold|i3"
    assert tag.select(X.tag_part("t", 3)).first()[0] == "gold"


def _bronze(spark, **over):
    base = dict(request_datetime=T(2023, 5, 1, 9, 58), pickup_datetime=T(2023, 5, 1, 10, 0),
                dropoff_datetime=T(2023, 5, 1, 10, 30), PULocationID=1, DOLocationID=2,
                trip_miles=5.0, trip_time=1800, base_passenger_fare=20.0, tolls=0.0, bcf=0.5,
                sales_tax=1.0, congestion_surcharge=2.75, airport_fee=0.0, tips=3.0, driver_pay=15.0,
                shared_request_flag="N", shared_match_flag="N", access_a_ride_flag="N",
                wav_request_flag="N")
    base.update(over)
    schema = ("request_datetime timestamp_ntz, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz,"
              " PULocationID bigint, DOLocationID bigint, trip_miles double, trip_time bigint,"
              " base_passenger_fare double, tolls double, bcf double, sales_tax double,"
              " congestion_surcharge double, airport_fee double, tips double, driver_pay double,"
              " shared_request_flag string, shared_match_flag string, access_a_ride_flag string,"
              " wav_request_flag string")
    return spark.createDataFrame([tuple(base.values())], schema)


def test_clean_boundaries(spark):
    keep = [dict(trip_miles=0.0), dict(trip_miles=200.0), dict(trip_time=21600), dict(trip_time=0),
            dict(pickup_datetime=T(2023, 1, 1)), dict(pickup_datetime=T(2023, 12, 31, 23, 59, 59))]
    drop = [dict(base_passenger_fare=0.0), dict(trip_miles=200.01), dict(trip_time=21601),
            dict(pickup_datetime=T(2024, 1, 1)), dict(pickup_datetime=T(2022, 12, 31, 23, 59, 59)),
            dict(base_passenger_fare=None)]
    for case in keep:
        assert silver.clean(_bronze(spark, **case)).count() == 1, case
    for case in drop:
        assert silver.clean(_bronze(spark, **case)).count() == 0, case


def test_clean_derived_columns(spark):
    r = silver.clean(_bronze(spark, airport_fee=None, request_datetime=T(2023, 5, 1, 10, 3))).first()
    assert r.total_amount is None                  # NULL part propagates
    assert r.waiting_minutes == -3                 # pickup before request stays negative
    assert r.trip_minutes == 30
    assert abs(r.driver_pct_of_fare - 75.0) < 1e-4
    r2 = silver.clean(_bronze(spark)).first()
    assert abs(r2.total_amount - 27.25) < 1e-4


def test_strict_id_cast_raises_on_overflow(spark):
    import pytest
    df = silver.clean(_bronze(spark, PULocationID=70000), id_cast="strict")
    with pytest.raises(Exception):
        df.collect()


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(-10 ** 6, 10 ** 6)), min_size=1, max_size=20))
def test_minute_boundaries_property(spark, pairs):
    base = T(1995, 1, 1)
    rows = [(base + dt.timedelta(seconds=a), base + dt.timedelta(seconds=a + d)) for a, d in pairs]
    got = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz") \
        .select(X.minutes_boundary("a", "b")).collect()
    exp = [(a + d) // 60 - a // 60 for a, d in pairs]
    assert [r[0] for r in got] == exp



def test_id_cast_for_float_ids(spark):
    df = spark.createDataFrame([(3.0,), (3.5,), (-1.0,), (70000.0,), (None,)], "x double")
    assert [r[0] for r in df.select(X.id_cast_for(df, "x")).collect()] == [3, None, None, None, None]


def test_minute_boundaries_before_1970(spark):
    rows = [(T(1969, 12, 31, 23, 59, 30), T(1970, 1, 1, 0, 0, 30)), (T(1960, 5, 5, 10, 0, 59), T(1960, 5, 5, 10, 1, 0))]
    got = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz").select(X.minutes_boundary("a", "b")).collect()
    assert [r[0] for r in got] == [1, 1]
