"""Incremental gold: the merge of batch states equals the full refresh."""

import shutil

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from strata.operators import gold, incremental, quality
from strata.plans.layers import Medallion


def batched(m):
    return m.clean.withColumn("batch", F.date_format("pickup_at", "yyyy-MM"))


def test_twelve_monthly_merges_equal_the_full_refresh(spark, scratch):
    m = Medallion(spark, SF_MID)
    trips = batched(m)
    for month in range(1, 13):
        incremental.write_states(trips.where(F.col("batch") == f"1998-{month:02d}"), m.bronze_zones, scratch)
    got = incremental.gold_models(spark, scratch)
    assert set(got) == set(gold.GOLD_MODELS)
    for name, df in got.items():
        want = m.gold(name).drop(*gold.FARE_PERCENTILES)
        have = df.drop(*gold.FARE_PERCENTILES).select(want.columns)
        assert sorted(map(repr, want.collect())) == sorted(map(repr, have.collect())), name
    # the sketches: the rank of each reported fare is within the error that they promise
    fares = {}
    for r in m.clean.select(F.to_date("pickup_at").alias("d"), "total_amount").collect():
        if r.total_amount is not None:
            fares.setdefault(r.d, []).append(r.total_amount)
    for r in got["daily_revenue"].collect():
        v = np.sort(fares[r.trip_date])
        for name, p in gold.FARE_PERCENTILES.items():
            lo, hi = np.searchsorted(v, r[name] - 0.006) / len(v), np.searchsorted(v, r[name] + 0.006, "right") / len(v)
            assert lo - 0.02 - 1 / len(v) <= p <= hi + 0.02 + 1 / len(v), (r.trip_date, name)


def test_a_corrected_batch_replaces_its_states_and_old_trips_are_not_read(spark, scratch):
    m = Medallion(spark, SF_SMALL)
    path = f"{scratch}/trips"
    batched(m).write.partitionBy("batch").parquet(path)
    months = ("1998-01", "1998-02", "1998-03")
    for month in months:
        incremental.write_states(spark.read.parquet(path).where(F.col("batch") == month), m.bronze_zones, f"{scratch}/states")
    kept = spark.read.parquet(f"{path}/batch=1998-03").withColumn("batch", F.lit("1998-03")).where("trip_miles < 100").cache()
    expected = {mo: m.enriched.where(F.date_format("pickup_at", "yyyy-MM") == mo).count() for mo in months[:2]}
    expected["1998-03"] = kept.count()
    shutil.rmtree(path)         # the trips of the other batches are gone: only states are left of them
    incremental.write_states(kept, m.bronze_zones, f"{scratch}/states")
    got = {r.month.strftime("%Y-%m"): r.total_trips for r in incremental.gold_models(spark, f"{scratch}/states")["driver_economics"].collect()}
    assert got == expected


def test_the_fused_report_equals_the_tests_of_each_model(spark):
    m = Medallion(spark, SF_SMALL)
    odd = Medallion(spark, bronze_trips=m.bronze_trips.withColumn("tips", F.when(F.col("trip_miles") > 50, F.col("tips"))),
                    bronze_zones=m.bronze_zones.where("LocationID % 2 = 0"), window=m.window)
    for one in (m, odd, Medallion(spark, bronze_trips=m.bronze_trips.where("false"), bronze_zones=m.bronze_zones)):
        want = {tuple(r) for r in quality.run_declared_tests(one.models()).collect()}
        assert {tuple(r) for r in quality.fused_report(one.enriched).collect()} == want
    assert any(r[-1] == "fail" for r in want) is False
