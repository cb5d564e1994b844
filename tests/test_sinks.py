"""Sources and sinks: round trips, layout, compaction, append, footprint, stream."""

import os

import pytest
from pyspark.sql import functions as F

from strata.plans import pipeline
from strata.plans.layers import Medallion
from strata.sinks import footprint, tables
from strata.sources import fixtures, landing
from strata.streaming.ingest import ingest_new_files
from conftest import SF_MID, SF_SMALL


def test_zone_csv_round_trip(spark, scratch):
    zones = fixtures.bronze_zones(spark, SF_SMALL)
    p = os.path.join(scratch, "zones")
    zones.coalesce(1).write.option("header", True).csv(p)
    typed = landing.read_zones_csv(spark, p)
    assert dict(typed.dtypes)["LocationID"] == "int"
    assert sorted(typed.collect()) == sorted(zones.collect())
    untyped = landing.csv_view(spark, p, "zones_raw")
    assert dict(untyped.dtypes)["LocationID"] == "string"
    assert spark.sql("select count(*) from zones_raw").first()[0] == zones.count()


def _landing(spark, scratch, months=("1998-01", "1998-02", "1998-03")):
    trips = fixtures.bronze_trips(spark, SF_SMALL)
    paths = []
    for mth in months:
        p = os.path.join(scratch, "landing", f"trips_{mth}.parquet")
        trips.filter(F.date_format("pickup_datetime", "yyyy-MM") == mth).coalesce(1).write.parquet(p)
        paths.append(p)
    return trips, paths


def test_batch_ingest_by_name_and_audit(spark, scratch):
    trips, paths = _landing(spark, scratch)
    bronze = landing.read_trip_files(spark, paths)
    expected = trips.filter(F.date_format("pickup_datetime", "yyyy-MM").isin("1998-01", "1998-02", "1998-03"))
    assert bronze.count() == expected.count()
    audit = tables.ingest_audit(bronze).orderBy("batch").collect()
    assert len(audit) == 3 and audit[-1].total_rows == expected.count()
    assert sum(r.rows_added for r in audit) == audit[-1].total_rows


def test_schema_drift_is_refused(spark, scratch):
    trips, paths = _landing(spark, scratch, ("1998-01",))
    odd = os.path.join(scratch, "landing", "odd.parquet")
    trips.limit(5).withColumn("surprise", F.lit(1)).write.parquet(odd)
    with pytest.raises(landing.SchemaDriftError):
        landing.read_trip_files(spark, [paths[0], odd])


def test_layout_and_compaction(spark, scratch):
    tables.create_layers(spark, os.path.join(scratch, "layers"))
    clean = Medallion(spark, SF_MID).clean
    tables.write_table(clean.repartition(20), "silver.compact_me", None, 20)
    assert len(spark.table("silver.compact_me").inputFiles()) == 20
    rep = tables.compact(spark, {"silver.compact_me": ["pickup_at"], "silver.missing": None}, files=2)
    got = {r.table: r for r in rep.collect()}
    assert got["silver.compact_me"].status == "ok" and got["silver.compact_me"].files_after == 2
    assert got["silver.compact_me"].bytes_on_disk > 0
    assert got["silver.missing"].status == "skipped"
    assert spark.table("silver.compact_me").count() == clean.count()
    # each file now holds a disjoint pickup_at range
    ranges = (spark.table("silver.compact_me").groupBy(F.col("_metadata.file_name"))
              .agg(F.min("pickup_at").alias("lo"), F.max("pickup_at").alias("hi")).orderBy("lo").collect())
    assert ranges[0].hi <= ranges[1].lo


def test_compaction_sorts_no_more_in_a_task_than_its_bound(spark, scratch):
    """Rows that take next to nothing on disk: the files follow from what a task holds while it sorts one."""
    tables.create_layers(spark, os.path.join(scratch, "layers"))
    key = lambda n: (F.col("id") * 7919 % n).alias("k")
    wide = spark.range(1_300_000).select(key(1_300_000), *[F.lit(i).alias(f"c{i}") for i in range(50)])
    long = spark.range(2_000).select(key(2_000), F.repeat(F.lit("x"), 5_000).alias("s"))
    nested = spark.range(2_000).select(key(2_000), F.array_repeat(F.lit(1), 600).alias("a"))
    for name, df, bound in (("wide", wide, {}), ("long", long, {"sort_bytes": 2 << 20}), ("nested", nested, {"sort_bytes": 2 << 20})):
        tables.write_table(df, f"silver.sorts_{name}")
        want = tables.checksum(df)
        r = tables.compact(spark, {f"silver.sorts_{name}": ["k"]}, **bound).first()
        assert r.status == "ok" and r.bytes_on_disk < tables.TARGET_FILE_BYTES / 4, r
        stored = spark.table(f"silver.sorts_{name}")
        assert tables.checksum(stored) == want
        ranges = tables.file_ranges(stored, "k").orderBy("lo").collect()
        assert len(ranges) == r.files_after > 1
        assert all(a.hi < b.lo for a, b in zip(ranges, ranges[1:]))
        # the ranges come from a sample: about equal shares
        most = bound.get("sort_bytes", tables.SORT_BYTES)
        assert all(tables.bytes_in_sort(df, want[0]) * f.rows < 1.5 * most * want[0] for f in ranges)
    # where nothing is sorted, or the caller counts the files, memory doesn't matter
    assert tables.compact(spark, {"silver.sorts_long": None}, sort_bytes=2 << 20).first().files_after == 1
    assert tables.compact(spark, {"silver.sorts_long": ["k"]}, files=1, sort_bytes=2 << 20).first().files_after == 1


def test_bytes_in_a_sort_with_nulls_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, None), (2, "abc", [1]), (None, "", None)], "id long, s string, a array<int>")
    row = 8 * 4 + tables.SORT_ENTRY_BYTES
    assert tables.bytes_in_sort(df, 3) == 3 * row + 3 + 3 * len("[1]")
    assert tables.bytes_in_sort(df.select("id"), 3) == 3 * (8 * 2 + tables.SORT_ENTRY_BYTES)
    assert tables.bytes_in_sort(df.where("false"), 0) == 0


def test_append_by_name_and_default_timestamp(spark, scratch):
    tables.create_layers(spark, os.path.join(scratch, "layers"), names=("benchmark",))
    rows = fixtures.medallion_results(fixtures.table(spark, SF_SMALL, "events")).drop("captured_at")
    tables.append_measurements(spark, rows, "benchmark.medallion_results_t")
    shuffled = rows.select(*reversed(rows.columns))
    tables.append_measurements(spark, shuffled, "benchmark.medallion_results_t")
    t = spark.table("benchmark.medallion_results_t")
    assert t.count() == 2 * rows.count()
    assert t.filter(F.col("captured_at").isNull()).count() == 0
    assert t.groupBy("iteration").count().filter("count != 2").count() == 0


def test_pipeline_build_and_footprint(spark, scratch):
    m = Medallion(spark, SF_SMALL)
    b = pipeline.build(m, root=os.path.join(scratch, "wh"))
    assert b.gold("shared_vs_solo").count() == 3
    from strata.operators import quality
    lineage = {(r.model, r.column_name) for r in quality.gate(quality.run_declared_tests(m.models())).collect()}
    stored = {(f["model"], f["column_name"]) for f in b.failing_tests}
    assert ("fhvhv_trips_clean", "total_amount") in stored and stored == lineage
    fp = {(r.layer, r.table): r for r in footprint.table_footprint(spark, b.locations()).collect()}
    assert fp[("silver", "fhvhv_trips_clean")].rows == m.clean.count()
    assert fp[("bronze", "fhvhv_trips")].rows == m.bronze_trips.count()
    assert all(r.bytes_on_disk > 0 and r.compression_ratio > 0 for r in fp.values())
    before = {t: spark.table(t).count() for t in pipeline.COMPACTED}
    rep = {r.table: r for r in pipeline.compact_all(spark, files=1).collect()}
    assert set(rep) == set(pipeline.COMPACTED) and all(r.status == "ok" for r in rep.values())
    assert all(r.files_after == 1 and r.rows == before[t] for t, r in rep.items())
    assert {t: spark.table(t).count() for t in pipeline.COMPACTED} == before


def test_stream_ingest_picks_up_only_new_files(spark, scratch):
    trips, paths = _landing(spark, scratch, ("1998-01", "1998-02"))
    land = os.path.join(scratch, "landing")
    bronze_p, silver_p = os.path.join(scratch, "s_bronze"), os.path.join(scratch, "s_silver")
    ck = os.path.join(scratch, "ck")
    ingest_new_files(spark, land, bronze_p, trips.schema, ck, silver_p, fixtures.FIXTURE_WINDOW)
    n1 = spark.read.parquet(bronze_p).count()
    p3 = os.path.join(land, "trips_1998-03.parquet")
    trips.filter(F.date_format("pickup_datetime", "yyyy-MM") == "1998-03").coalesce(1).write.parquet(p3)
    ingest_new_files(spark, land, bronze_p, trips.schema, ck, silver_p, fixtures.FIXTURE_WINDOW)
    b = spark.read.parquet(bronze_p)
    assert b.count() == n1 + spark.read.parquet(p3).count()
    assert b.select("_batch").distinct().count() == 3
    s = spark.read.parquet(silver_p)
    from strata.operators import silver
    assert s.count() == silver.clean(b.drop("_batch"), fixtures.FIXTURE_WINDOW).count()
    # a re-run with nothing new (e.g. after a failure) adds nothing: the
    # checkpoint remembers which files were committed
    before_b, before_s = b.count(), s.count()
    ingest_new_files(spark, land, bronze_p, trips.schema, ck, silver_p, fixtures.FIXTURE_WINDOW)
    assert spark.read.parquet(bronze_p).count() == before_b
    assert spark.read.parquet(silver_p).count() == before_s


def test_schema_drift_type_conflict_is_refused(spark, scratch):
    trips, paths = _landing(spark, scratch, ("1998-01",))
    odd = os.path.join(scratch, "landing", "retyped.parquet")
    trips.limit(5).withColumn("trip_time", F.col("trip_time").cast("string")).write.parquet(odd)
    with pytest.raises(landing.SchemaDriftError):
        landing.read_trip_files(spark, [paths[0], odd])


def test_cli_pipeline_and_history_commands(spark, scratch, capsys):
    from strata import cli
    trips, paths = _landing(spark, scratch, ("1998-01", "1998-02"))
    zp = os.path.join(scratch, "zones")
    fixtures.bronze_zones(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(zp)
    a = cli.parser().parse_args(["pipeline", "--trips", os.path.join(scratch, "landing", "*.parquet"),
                                 "--zones", zp, "--root", os.path.join(scratch, "cli"),
                                 "--window", "1998-01-01", "1999-01-01"])
    assert cli.cmd_pipeline(spark, a) == 0
    first = capsys.readouterr().out
    assert "total_rows" in first and "silver_clean" in first   # ingest audit and step timings
    assert spark.table("gold.shared_vs_solo").count() == 3
    res = os.path.join(scratch, "results")
    fixtures.medallion_results(fixtures.table(spark, SF_SMALL, "events")).write.parquet(res)
    assert cli.cmd_history(spark, cli.parser().parse_args(["history", "--results", res])) == 0
    out = capsys.readouterr().out
    assert "consistent_cells" in out



def test_write_path_and_parquet_view(spark, scratch):
    zones = fixtures.bronze_zones(spark, SF_SMALL)
    p = tables.write_path(zones, os.path.join(scratch, "zones_pq"), ["LocationID"], files=2)
    v = landing.parquet_view(spark, p, "zones_pq_view")
    assert spark.sql("select count(*) from zones_pq_view").first()[0] == zones.count() == v.count()
    ranges = (spark.read.parquet(p).groupBy(F.col("_metadata.file_name"))
              .agg(F.min("LocationID").alias("lo"), F.max("LocationID").alias("hi")).orderBy("lo").collect())
    assert len(ranges) == 2 and ranges[0].hi < ranges[1].lo



def test_schema_drift_missing_column_is_refused(spark, scratch):
    trips, paths = _landing(spark, scratch, ("1998-01",))
    short = os.path.join(scratch, "landing", "short.parquet")
    trips.limit(5).drop("tips").write.parquet(short)
    with pytest.raises(landing.SchemaDriftError, match="lacking"):
        landing.read_trip_files(spark, [paths[0], short])



def test_footprint_of_a_lake_from_a_fresh_process(spark, scratch):
    """A new process (own catalog) attaches the lake folder and measures it."""
    import subprocess
    import sys
    from strata.plans import pipeline
    from strata.plans.layers import Medallion
    root = os.path.join(scratch, "lake")
    pipeline.build(Medallion(spark, SF_SMALL), root=root, run_tests=False)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-m", "strata", "footprint", "--root", root], cwd=repo,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "fhvhv_trips_clean" in out.stdout and "shared_vs_solo" in out.stdout
