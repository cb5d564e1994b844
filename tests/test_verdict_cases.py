"""Cases that the green rows of the oracle do not see: plan-independent quantiles, small metric changes, reads and
compaction that leave tables alone, gates between layers, stream targets."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from strata.operators import gold, metrics, quality
from strata.operators.quantiles import exact_quantiles, part_of, quantiles_from_histogram, refine
from strata.plans import pipeline
from strata.plans.layers import Medallion
from strata.sinks import tables
from strata.sources import fixtures, landing
from strata.streaming.ingest import ingest_new_files


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_quantiles_do_not_depend_on_the_plan(spark, reuse, adaptive):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 7 == 6, None).otherwise(F.col("id") % 7).alias("k"),
        F.when(F.col("id") % 11 != 0, (F.pmod(F.xxhash64("id"), F.lit(100_003)) - 30_000) / 97.0).alias("v"))
    rows = df.collect()
    old = {c: spark.conf.get(c) for c in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        got = {r.k: (r.lo, r.mid, r.hi) for r in exact_quantiles(df, ["k"], "v", {"lo": 0.0, "mid": 0.5, "hi": 0.95}).collect()}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    for k in {r.k for r in rows}:
        v = [r.v for r in rows if r.k == k and r.v is not None]
        assert np.allclose(got[k], np.quantile(v, [0, 0.5, 0.95]), rtol=1e-12), k


def test_parts_keep_the_order(spark):
    values = [float("-inf"), -1e308, -5.5, -5.4999, -1e-300, -0.0, 0.0, 1e-300, 0.3, 20.0, 20.01, 1e9, 1e308, float("inf"), float("nan")]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    for lo, hi in ((-1e308, 1e308), (-5.5, 20.01), (20.0, 20.01), (0.3, 0.3)):
        inside = df.where(f"v between {lo} and {hi} or abs(v) = double('infinity') or isnan(v)")
        got = [r.b for r in inside.select("i", part_of(F.col("v"), F.lit(lo), F.lit(hi), 64).alias("b")).orderBy("i").collect()]
        assert got == sorted(got) and got[0] == -1 and got[-2:] == [64, 65]
        assert lo == hi or got[1] == 0 and got[-3] == 63


@pytest.mark.parametrize("shape", ["narrow", "outliers", "geometric", "infinite", "repeated"])
def test_no_task_ranks_more_than_the_bound(spark, shape):
    """A hot group whose values lie close together, or far out, is split until its intervals are small."""
    i = F.col("id").cast("double")
    value = {"narrow": 1.7e9 + i * 1e-3, "outliers": F.when(i < 5, -1e300).when(i < 9, 1e300).otherwise(i * 1e-6),
             "geometric": F.pow(F.lit(1.01), i - 10_000.0) * F.when(i % 2 == 0, -1.0).otherwise(1.0),
             "infinite": F.when(i % 3 == 0, float("inf")).when(i % 3 == 1, float("-inf")).otherwise(i),
             "repeated": F.floor(i / 100) + 0.0}[shape]
    df = spark.range(20_000).select(F.when(F.col("id") % 4 == 3, 1).otherwise(0).alias("k"), value.alias("v"))
    probs, bound = {"lo": 0.0, "mid": 0.5, "p95": 0.95, "hi": 1.0}, 50
    hist = df.groupBy("k", "v").agg(F.count("*").alias("c")).cache()
    plain = hist.select(F.struct("k").alias("_k"), F.col("v").alias("_v"), F.col("c").alias("_c"))
    left = refine(plain, probs, bound, 8)
    sizes = plain.join(left, (F.col("_k") == F.col("_wk")) & (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))) \
        .groupBy("_wk", "_lo").count().agg(F.max("count")).first()[0]
    assert sizes <= bound
    got = {r.k: [r[n] for n in probs] for r in quantiles_from_histogram(hist, ["k"], "v", "c", probs, bound).collect()}
    rows = df.collect()
    for k in (0, 1):
        v = np.sort([r.v for r in rows if r.k == k])
        for p, g in zip(probs.values(), got[k]):
            at = (len(v) - 1) * p
            lo, hi = v[int(np.floor(at))], v[int(np.ceil(at))]
            assert g == lo if lo == hi else g == pytest.approx(lo + (hi - lo) * (at - np.floor(at)), rel=1e-12), (shape, k, p)


def _samples(spark, values):
    rows = [("m", "a", i * 60, v, i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "metric string, instance string, s long, value double, sample_id long").select(
        "metric", "instance", F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts"), "value", "sample_id")


def test_small_changes_survive(spark):
    s = _samples(spark, [1.0, 1.00004])
    d = metrics.compare_filter(metrics.delta(s, ["instance"], 3600), "delta", ">", 0.0).collect()
    assert len(d) == 1 and abs(d[0].delta - 4e-5) < 1e-12
    r = metrics.increase(s, ["instance"], 3600).first()
    assert abs(r.increase - 4e-5) < 1e-12 and abs(r.rate - 4e-5 / 3600) < 1e-18
    assert abs(metrics.irate(s, ["instance"], 3600).first().irate - 4e-5 / 60) < 1e-15


def test_ratio_by_zero_is_infinite(spark):
    rows = [(0, "a", "x", 1.0), (0, "a", "y", 0.0), (0, "b", "x", -1.0), (0, "b", "y", 0.0), (0, "c", "x", 0.0), (0, "c", "y", 0.0),
            (0, "d", "x", 1.0), (0, "e", "x", 6.0), (0, "e", "y", 2.0)]
    v = spark.createDataFrame(rows, "window_start int, l string, metric string, value double")
    got = {r.l: r.value for r in metrics.vector_ratio(v, "x", "y", ["l"]).collect()}
    assert got.pop("c") != got.get("c", 0) and got == {"a": float("inf"), "b": float("-inf"), "e": 3.0}


def test_latest_by_time_takes_one_row(spark):
    from strata.operators.joins import latest_per_key
    rows = [("k", "2024-01-01 00:00:00", 5, 50), ("k", "2024-01-02 00:00:00", 1, 10), ("k", "2024-01-02 00:00:00", 2, 20),
            ("j", "1969-01-02 00:00:00", 9, 90), ("j", "1968-01-02 00:00:00", 8, 80), (None, "2024-01-02 00:00:00", 3, 30)]
    df = spark.createDataFrame(rows, "k string, t string, a long, b long").withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = {r.k: (r.a, r.b) for r in latest_per_key(df, ["k"], "t", ["a", "b"]).collect()}
    assert got.pop("k") in ((1, 10), (2, 20)) and got == {"j": (9, 90), None: (3, 30)}


def test_measuring_leaves_the_catalog_alone(spark, scratch):
    tables.create_layers(spark, os.path.join(scratch, "own"))
    spark.range(7).write.mode("overwrite").saveAsTable("gold.mine_to_keep")
    before = {d.name: d.locationUri for d in spark.catalog.listDatabases()}, tables._location(spark, "gold.mine_to_keep")
    q = E.queries()
    rows, foot = q["table_rows"](spark, SF_SMALL), q["table_footprint"](spark, SF_SMALL)
    again = q["table_rows"](spark, SF_SMALL)
    assert rows.collect() == again.collect() and foot.count() == 6
    assert foot.where("rows > 0 AND bytes_on_disk > 0").count() == 6
    assert spark.table("gold.mine_to_keep").count() == 7
    assert before == ({d.name: d.locationUri for d in spark.catalog.listDatabases()}, tables._location(spark, "gold.mine_to_keep"))


def test_compaction_of_attached_tables(spark, scratch):
    root = os.path.join(scratch, "lake")
    pipeline.build(Medallion(spark, SF_SMALL), root=root, run_tests=False)
    for layer, t in pipeline.MATERIALIZED:       # as a new session would: external tables over the folder
        spark.catalog.uncacheTable(f"{layer}.{t}")
        spark.sql(f"ALTER TABLE {layer}.{t} SET TBLPROPERTIES ('EXTERNAL'='TRUE')")
    before = {t: tables.checksum(spark.table(t)) for t in pipeline.COMPACTED}
    rep = {r.table: r for r in pipeline.compact_all(spark).collect()}
    assert all(r.status == "ok" and r.files_after == 1 for r in rep.values()), rep
    assert {t: tables.checksum(spark.table(t)) for t in pipeline.COMPACTED} == before
    assert spark.table(pipeline.ENRICHED_VIEW).count() == before["silver.fhvhv_trips_clean"][0]
    # what a new session would attach
    assert tables.latest_folder(spark, f"{root}/gold/daily_revenue") != f"{root}/gold/daily_revenue"


def test_a_failing_compaction_leaves_the_table(spark, scratch, monkeypatch):
    tables.create_layers(spark, os.path.join(scratch, "layers"))
    spark.range(100).write.mode("overwrite").saveAsTable("silver.stays")
    where = tables._location(spark, "silver.stays")
    real, calls = tables.checksum, []
    monkeypatch.setattr(tables, "checksum", lambda df: (calls.append(1), real(df))[1] if len(calls) == 0 else (0, 0))
    rep = tables.compact(spark, {"silver.stays": ["id"]}).first()
    assert rep.status == "skipped" and "checksum" in rep.error
    assert tables._location(spark, "silver.stays") == where and spark.table("silver.stays").count() == 100


def test_absent_labels_count_as_empty(spark):
    s = spark.createDataFrame([("m", "a"), ("m", None), ("m", "b"), ("m", "")], "metric string, instance string")
    keep = lambda op, v: sorted((r.instance or "-") for r in metrics.select_series(s, "m", [("instance", op, v)]).collect())
    assert keep("!=", "a") == ["-", "-", "b"] and keep("!~", "a|c") == ["-", "-", "b"]
    assert keep("=", "") == ["-", "-"] and keep("=~", ".*") == ["-", "-", "a", "b"] and keep("=~", ".+") == ["a", "b"]


def test_a_failing_silver_test_leaves_gold(spark, scratch):
    root = os.path.join(scratch, "gate")
    good = fixtures.bronze_trips(spark, SF_SMALL)
    zones = fixtures.bronze_zones(spark, SF_SMALL)
    window = fixtures.FIXTURE_WINDOW
    clean = good.where("base_passenger_fare IS NOT NULL AND tips IS NOT NULL")
    pipeline.build(Medallion(spark, bronze_trips=clean, bronze_zones=zones, window=window), root=root)
    gold_before = spark.table("gold.daily_revenue").collect()
    bad = good.withColumn("tips", F.lit(None).cast("double"))
    with pytest.raises(RuntimeError, match="total_amount"):
        pipeline.build(Medallion(spark, bronze_trips=bad, bronze_zones=zones, window=window), root=root, gate=True)
    assert spark.table("gold.daily_revenue").collect() == gold_before


def test_one_pass_report_equals_the_single_checks(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (None, 3), (None, None), (4, 4)], "a int, b int")
    got = {(r.column_name, r.test): r.failures for r in
           quality.model_report(df, "m", {"a": ["not_null", "unique"], "b": ["not_null", "unique"]}).collect()}
    assert got == {("a", "not_null"): 2, ("a", "unique"): 1, ("b", "not_null"): 2, ("b", "unique"): 0}
    empty = {(r.column_name, r.test): r.failures for r in
             quality.model_report(df.where("false"), "m", {"a": ["not_null", "unique"]}).collect()}
    assert empty == {("a", "not_null"): 0, ("a", "unique"): 0}


def test_a_second_stream_target_gets_all_files(spark, scratch):
    trips = fixtures.bronze_trips(spark, SF_SMALL)
    land = os.path.join(scratch, "landing")
    for m in ("1998-01", "1998-02"):
        trips.filter(F.date_format("pickup_datetime", "yyyy-MM") == m).coalesce(1).write.parquet(f"{land}/{m}.parquet")
    n = spark.read.option("recursiveFileLookup", "true").parquet(land).count()
    for target in ("one", "two"):
        out = f"{scratch}/{target}"
        assert ingest_new_files(spark, land, out, trips.schema) == {"bronze": 1}
        assert spark.read.parquet(out).count() == n
        assert ingest_new_files(spark, land, out, trips.schema)["bronze"] <= 1
        assert spark.read.parquet(out).count() == n
    trips.limit(3).drop("tips").write.parquet(f"{land}/short.parquet")
    with pytest.raises(landing.SchemaDriftError):
        ingest_new_files(spark, land, f"{scratch}/three", trips.schema)


def test_local_layout_keeps_input_ranges(spark, scratch):
    """Silver sorted within its inputs: files of time-clustered inputs don't overlap."""
    clean = Medallion(spark, SF_SMALL).clean.repartitionByRange(6, "pickup_at")
    p = os.path.join(scratch, "silver")
    tables.layout(clean, ["pickup_at"], how="local").write.parquet(p)
    ranges = (spark.read.parquet(p).groupBy(F.col("_metadata.file_name")).agg(
        F.min("pickup_at").alias("lo"), F.max("pickup_at").alias("hi")).orderBy("lo").collect())
    assert len(ranges) > 1 and all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))
    assert set(gold.GOLD_MODELS) == set(quality.DECLARED_TESTS) - {"fhvhv_trips_clean", "fhvhv_trips_enriched"}
