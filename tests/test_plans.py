"""Physical-plan properties that matter at scale (read from explain output)."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

from strata.plans.catalog import EAGER, REGISTRY

QUERIES = {k: v for k, v in E.queries().items() if k in REGISTRY}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


# reads Parquet footers on the executors through mapInPandas, by design
FOOTER_READERS = {"table_footprint"}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in FOOTER_READERS))
def test_no_python_in_registered_queries(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in p, (name, node)
    # exact percentiles go through the histogram operator, never a buffered percentile
    assert "percentile(" not in p.lower().replace("percentile_approx(", ""), name


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_aggregates_are_hash_aggregates(spark, name):
    """No registered query sorts its rows by key just to aggregate them."""
    assert "SortAggregate" not in plan(QUERIES[name](spark, SF_SMALL)), name


def test_building_a_query_starts_no_job(spark):
    """Sizes are left to the optimizer: no eager check, no driver-side count."""
    seen = []
    for name in sorted(set(QUERIES) - EAGER):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        QUERIES[name](spark, SF_SMALL)
        # reading a file's schema is Spark's own one-task job per table; nothing else may run
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")
        info = [spark.sparkContext.statusTracker().getJobInfo(j) for j in jobs]
        stages = [spark.sparkContext.statusTracker().getStageInfo(s) for i in info if i for s in i.stageIds]
        seen += [(name, s.name) for s in stages if s and not s.name.startswith("parquet at")]
    spark.sparkContext.setJobGroup("tests", "tests")
    assert not seen


def test_measurement_layers_are_scanned_once(spark):
    p = plan(QUERIES["layer_union"](spark, SF_SMALL))
    assert p.split("\n\n")[0].count("Scan parquet") <= 3  # the fixture itself reads events for clients and log


def test_bronze_question_prunes_the_raw_scan(spark):
    p = plan(QUERIES["q1_bronze"](spark, SF_SMALL))
    scan_schema = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    for unused in ("l_returnflag", "l_linestatus"):
        assert unused not in scan_schema


def test_stored_bronze_gets_window_and_fare_pushed_to_parquet(spark, scratch):
    from strata.plans import questions as Q
    from strata.sources import fixtures
    path = scratch + "/bronze"
    fixtures.bronze_trips(spark, SF_SMALL).write.parquet(path)
    p = plan(Q.q1_bronze(spark.read.parquet(path), fixtures.FIXTURE_WINDOW))
    pushed = [line for line in p.splitlines() if line.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(pickup_datetime" in pushed and "LessThan(pickup_datetime" in pushed
    assert "GreaterThan(base_passenger_fare,0.0)" in pushed
    read = [line for line in p.splitlines() if line.startswith("ReadSchema")][0]
    assert "trip_miles" not in read and "hvfhs_license_num" not in read


def test_lookups_are_broadcast_and_outer_joins_become_inner(spark):
    p = plan(QUERIES["gold_borough_pairs"](spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") >= 2
    assert "LeftOuter" not in p
    assert "SortMergeJoin" not in p


def test_top_k_without_full_sort(spark):
    p = plan(QUERIES["q2_gold"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_local_layout_adds_no_shuffle_and_range_layout_one(spark):
    from strata.plans.layers import Medallion
    from strata.sinks.tables import layout
    clean = Medallion(spark, SF_SMALL).clean
    local, ranged = plan(layout(clean, ["pickup_at"], how="local")), plan(layout(clean, ["pickup_at"]))
    assert "Exchange" not in local and "Sort" in local
    assert "rangepartitioning" in ranged


@pytest.mark.parametrize("name", ["gold_daily_revenue", "cross_run_stats", "cell_stats", "metric_irate"])
def test_null_safe_key_joins_stay_equi_joins(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "NestedLoop" not in p and "Cartesian" not in p, name


@pytest.mark.parametrize("name", ["gold_daily_revenue", "cross_run_stats", "cell_stats"])
def test_exact_quantiles_read_their_source_once(spark, name, monkeypatch):
    """The source is read for the stored histogram alone, with one scan; what is left reads stored tables."""
    from strata.operators import quantiles
    written = []
    real = quantiles._stored
    monkeypatch.setattr(quantiles, "_stored", lambda df, table: (written.append((table, plan(df))), real(df, table))[1])
    final = plan(QUERIES[name](spark, SF_SMALL))
    made = [p for t, p in written if t == "histogram"]
    assert len(made) == 1 and sum(SF_SMALL in p for _, p in written) == 1 and SF_SMALL not in final
    tree = made[0].split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange") <= 2, tree
    assert final.split("\n\n")[0].count(" Exchange") <= 5


def test_the_data_test_report_scans_the_fact_once(spark):
    tree = plan(QUERIES["dq_report"](spark, SF_SMALL)).split("\n\n")[0]
    scans = [line for line in plan(QUERIES["dq_report"](spark, SF_SMALL)).splitlines() if "lineitem.parquet" in line]
    assert len(scans) == 1 and tree.count("SortMergeJoin") == 0


@pytest.mark.parametrize("name", ["bucketed_run_stats", "bucketed_engine_log"])
def test_bucketed_measurements_need_no_shuffle(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(QUERIES[name](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in p and "Bucketed: true" in p
