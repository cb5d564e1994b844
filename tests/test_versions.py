"""Versions of stored tables: readers of old versions, any order of refresh, compaction and attach, failures at each step."""

import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.plans import pipeline
from strata.plans.layers import Medallion
from strata.sinks import tables, versions
from strata.sinks.versions import StaleVersionError, VersionedTable
from strata.sources import fixtures


def values(df):
    return sorted(r.id for r in df.collect())


def test_readers_of_an_old_version_finish(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t")
    t.refresh(spark.range(10))
    planned = t.read()
    t.refresh(spark.range(100, 120))
    assert values(planned) == list(range(10)) and values(t.read()) == list(range(100, 120))
    assert t.vacuum(keep=1) == [] and values(planned) == list(range(10))
    t.refresh(spark.range(5))
    assert len(t.vacuum(keep=1)) == 1 and values(t.read()) == list(range(5))
    assert [v.number for v in t.history()] == [2, 3]


@pytest.mark.parametrize("step", ["write", "check", "commit"])
def test_a_failure_at_any_step_leaves_the_old_rows(spark, scratch, monkeypatch, step):
    t = VersionedTable(spark, f"{scratch}/t")
    t.refresh(spark.range(10))
    before = versions.list_names(spark, t.root)
    bad = spark.range(20)
    check = None
    if step == "write":
        bad = bad.withColumn("id", F.raise_error(F.lit("broken row")).cast("long"))
    elif step == "check":
        def check(rows, seen):
            raise RuntimeError(f"{rows.count()} rows refused")
    else:
        monkeypatch.setattr(VersionedTable, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("store is down")))
    with pytest.raises(Exception, match="broken|refused|down"):
        t.refresh(bad, check=check)
    assert values(t.read()) == list(range(10))
    if step != "commit":      # what a dead writer staged stays until someone looks at it; it is never read
        assert versions.list_names(spark, t.root) == before


def test_a_commit_that_was_not_finished_is_not_current(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t")
    t.refresh(spark.range(10))
    fs, p = versions.hadoop_path(spark, f"{t.root}/log/00000002")
    fs.create(p, False).close()
    assert values(t.read()) == list(range(10))
    assert t.refresh(spark.range(3)).number == 3 and values(t.read()) == [0, 1, 2]


def test_a_compaction_that_lost_gives_up_and_a_refresh_goes_on(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t")
    first = t.refresh(spark.range(10))
    copy = t.stage(t.read())
    t.refresh(spark.range(3))
    with pytest.raises(StaleVersionError):
        t.commit(copy, after=first.number)
    assert t.commit(copy).number == 3


def test_metrics_are_collected_while_the_rows_are_written(spark, scratch):
    seen = {}
    df = spark.range(100).withColumn("half", F.when(F.col("id") % 2 == 0, F.col("id")))
    VersionedTable(spark, f"{scratch}/t").refresh(
        tables.layout(df, ["id"], 4), metrics={"nulls": F.count_if(F.col("half").isNull()), "n": F.count(F.lit(1))},
        check=lambda rows, m: seen.update(m))
    assert seen == {"nulls": 50, "n": 100}      # also behind a range exchange, which samples its input first


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("folder", ["lake", "my__lake"])
def test_any_order_of_refresh_compact_and_attach_gives_the_newest_rows(spark, scratch, seed, folder):
    root, pick = f"{scratch}/{folder}", random.Random(seed)
    db = f"any_{folder}_{seed}"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    tables.create_layers(spark, root, (db,))
    table, n = f"{db}.t2", 0
    tables.write_table(spark.range(1).toDF("id"), table, ["id"])
    for step in [pick.choice("rca") for _ in range(7)] + ["a"]:
        if step == "r":
            n += 1
            tables.write_table(spark.range(n, n + 50).repartition(7).toDF("id"), table, ["id"], 5)
            want = list(range(n, n + 50))
        elif step == "c":
            assert tables.compact(spark, {table: ["id"]}, files=1).first().status == "ok"
        else:
            tables.attach_table(spark, table, f"{root}/{db}/t2")
        assert values(spark.table(table)) == (want if n else [0]), step
    # a session that has only the folder
    tables.attach_table(spark, f"{db}.fresh", f"{root}/{db}/t2")
    assert values(spark.table(f"{db}.fresh")) == (want if n else [0])
    assert set(os.listdir(root)) == {db}       # nothing was written beside the lake


def test_other_columns_and_formats_replace_the_entry(spark, scratch):
    tables.create_layers(spark, scratch, ("shapes",))
    tables.write_table(spark.range(3).toDF("id"), "shapes.t")
    tables.write_table(spark.range(4).selectExpr("id", "id * 2 AS twice"), "shapes.t", fmt="orc")
    assert spark.table("shapes.t").columns == ["id", "twice"] and spark.table("shapes.t").count() == 4
    assert tables.compact(spark, {"shapes.t": ["id"]}).first().status == "ok"
    tables.attach_table(spark, "shapes.again", f"{scratch}/shapes/t")
    assert spark.table("shapes.again").count() == 4


def test_a_plain_table_gets_versions(spark, scratch):
    """A table of an earlier library: its folder serves until the first version, and goes with the second."""
    tables.create_layers(spark, scratch, ("plain",))
    spark.range(30).repartition(6).write.saveAsTable("plain.t")
    where = tables._location(spark, "plain.t")
    assert tables.compact(spark, {"plain.t": ["id"]}, files=2).first().files_after == 2
    assert versions.list_names(spark, where) != []
    tables.write_table(spark.range(9).toDF("id"), "plain.t")
    assert versions.list_names(spark, where) == [] and spark.table("plain.t").count() == 9


def test_a_build_with_tests_reads_silver_no_more_often(spark, scratch, monkeypatch):
    reads = []
    monkeypatch.setattr(pipeline.Built, "clean", property(lambda b: (reads.append(1), b.table("silver.fhvhv_trips_clean"))[1]))
    m = Medallion(spark, SF_SMALL)
    counts = []
    for run_tests in (False, True):
        reads.clear()
        b = pipeline.build(m, root=f"{scratch}/{run_tests}", run_tests=run_tests)
        counts.append(len(reads))
    assert counts[0] == counts[1] and "total_amount" in {f["column_name"] for f in b.failing_tests}


def test_a_gated_silver_refresh_keeps_the_old_silver(spark, scratch):
    good = fixtures.bronze_trips(spark, SF_SMALL)
    zones, window = fixtures.bronze_zones(spark, SF_SMALL), fixtures.FIXTURE_WINDOW
    full = good.where("base_passenger_fare IS NOT NULL AND tips IS NOT NULL AND airport_fee IS NOT NULL")
    pipeline.build(Medallion(spark, bronze_trips=full, bronze_zones=zones, window=window), root=scratch, gate=True)
    before = tables.checksum(spark.table("silver.fhvhv_trips_clean"))
    bad = good.withColumn("tips", F.lit(None).cast("double"))
    with pytest.raises(RuntimeError, match="total_amount"):
        pipeline.build(Medallion(spark, bronze_trips=bad, bronze_zones=zones, window=window), root=scratch, gate=True)
    assert tables.checksum(spark.table("silver.fhvhv_trips_clean")) == before
