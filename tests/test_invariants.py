"""Cross-model invariants on sf0.01."""

from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans.layers import Medallion
from conftest import SF_MID


def test_gold_cardinalities_and_totals(spark):
    m = Medallion(spark, SF_MID)
    n_clean = m.clean.count()
    assert n_clean == 8144
    card = {name: m.gold(name).count() for name in
            ("daily_revenue", "hourly_demand", "borough_pairs", "driver_economics", "shared_vs_solo")}
    assert card == {"daily_revenue": 365, "hourly_demand": 168, "borough_pairs": 25,
                    "driver_economics": 12, "shared_vs_solo": 3}
    for name, col in [("daily_revenue", "total_trips"), ("driver_economics", "total_trips"),
                      ("shared_vs_solo", "trips"), ("hourly_demand", "trips")]:
        assert m.gold(name).agg(F.sum(col)).first()[0] == n_clean, name
    # pairs: only trips whose both ids resolve to a zone
    resolved = m.enriched.filter("pickup_borough is not null and dropoff_borough is not null").count()
    assert m.gold("borough_pairs").agg(F.sum("trips")).first()[0] == resolved


def test_declared_not_null_fails_on_purpose(spark):
    m = Medallion(spark, SF_MID)
    report = {(r.model, r.column_name, r.test): r for r in quality.run_declared_tests(m.models()).collect()}
    assert len(report) == 17
    nulls = m.clean.filter(F.col("total_amount").isNull()).count()
    bad = report[("fhvhv_trips_clean", "total_amount", "not_null")]
    assert bad.failures == nulls > 0 and bad.status == "fail"
    failing = {k for k, r in report.items() if r.status == "fail"}
    assert failing == {("fhvhv_trips_clean", "total_amount", "not_null")}


def test_rejected_rows_add_up(spark):
    m = Medallion(spark, SF_MID)
    r = quality.rejected_rows(m.bronze_trips, m.window).first()
    assert r.raw_rows == 60000 or r.raw_rows > 0
    assert r.clean_rows == m.clean.count()
    assert r.rejected_rows == r.raw_rows - r.clean_rows


def test_fused_gold_equals_per_model_functions(spark):
    from strata.operators import gold
    m = Medallion(spark, SF_MID)
    fused = gold.models_from_fused(gold.fused_aggregates(m.clean), gold.fare_histogram(m.clean))
    for name, df in fused.items():
        single = m.gold(name)
        assert df.columns == single.columns, name
        assert dict(df.dtypes) == dict(single.dtypes), name
        a, b = sorted(map(tuple, df.collect()), key=str), sorted(map(tuple, single.collect()), key=str)
        assert a == b, name
