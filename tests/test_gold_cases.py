"""Gold and history edge cases on hand-made rows (FIXTURES.md §C)."""

import datetime as dt

from strata.operators import gold, history, quality
from strata.plans import questions as Q

T = dt.datetime
CLEAN = ("pickup_at timestamp_ntz, base_fare float, tips float, driver_pay float, driver_pct_of_fare float,"
         " trip_minutes int, waiting_minutes int, total_amount float, trip_miles float,"
         " congestion_surcharge float, shared_matched boolean, shared_requested boolean")


def test_month_with_zero_minutes_has_null_rate(spark):
    rows = [(T(2023, 2, 1), 10.0, 1.0, 8.0, 80.0, 0, 1, 12.0, 2.0, 0.0, False, False),
            (T(2023, 3, 1), 10.0, 1.0, 8.0, 80.0, 30, 1, 12.0, 2.0, 0.0, False, False)]
    out = {r.month.month: r for r in gold.driver_economics(spark.createDataFrame(rows, CLEAN)).collect()}
    assert out[2].approx_hourly_rate_usd is None
    assert out[3].approx_hourly_rate_usd == 16.0


def test_exact_median_interpolates(spark):
    rows = [(T(2023, 2, 1, h), 10.0, 1.0, 8.0, 80.0, 1, 1, float(v), 2.0, 0.0, False, False)
            for h, v in enumerate([1, 2, 3, 10])]
    r = gold.daily_revenue(spark.createDataFrame(rows, CLEAN)).first()
    assert r.median_fare_usd == 2.5
    assert r.p95_fare_usd == 8.95


def test_top10_tie_is_cut_deterministically(spark):
    rows = [(f"p{i:02d}", "x", 1, 100.0 if i >= 9 else 200.0 - i) for i in range(12)]
    pairs = spark.createDataFrame(rows, "pickup_borough string, dropoff_borough string, trips long, revenue_usd double")
    top = [r.pickup_borough for r in Q.top_by_revenue(pairs).collect()]
    assert top == [f"p{i:02d}" for i in range(10)]


def test_unique_check_counts_duplicated_values(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2023, 1, 1),), (dt.date(2023, 1, 2),), (None,)],
                               "trip_date date")
    assert quality.unique_failures(df, "daily_revenue", "trip_date").first().failures == 1


HIST = ("run_id string, captured_at timestamp_ntz, question_id string, layer string, iteration int,"
        " wall_ms double, query_duration_ms long, read_rows long, read_bytes long, memory_usage long,"
        " result_rows long")


def _h(run, q, layer, it, wall, eng):
    return (run, T(2024, 1, 1), q, layer, it, wall, eng, 10, 100, 5, 3)


def test_speedup_falls_back_to_wall_when_engine_is_zero(spark):
    rows = [_h("r", "Q", "bronze", 1, 100.0, 0), _h("r", "Q", "silver", 1, 50.0, 0),
            _h("r", "Q", "gold", 1, 0.0, 0)]
    s = {r.layer: r.speedup for r in history.speedup_by_layer(
        history.run_summary(spark.createDataFrame(rows, HIST))).collect()}
    assert s == {"bronze": 1.0, "silver": 2.0, "gold": 0.0}


def test_constant_cell_counts_as_consistent(spark):
    rows = [_h("r", "Q", "gold", i, 10.0, 7) for i in range(5)] + \
           [_h("r", "Q", "bronze", i, 10.0 * i, 10 * i) for i in range(1, 6)]
    cross = history.cross_run_stats(spark.createDataFrame(rows, HIST))
    bands = {r.layer: (r.cv_pct, r.band) for r in history.cv_bands(cross).collect()}
    assert bands["gold"] == (0.0, "consistent")
    share = history.cv_share(cross).first()
    assert (share.consistent_cells, share.total_cells) == (1, 2)


def test_single_sample_cell_has_zero_stdev(spark):
    rows = [_h("r", "Q", "gold", 1, 12.0, 7)]
    c = history.cell_stats(spark.createDataFrame(rows, HIST)).first()
    assert (c.n, c.stdev_ms, c.cv_pct, c.median_ms) == (1, 0.0, 0.0, 12.0)


def test_engine_log_latest_finished_entry_wins(spark):
    client = spark.createDataFrame(
        [("r", "Q", "gold", 1, "t1", 5.0, 9), ("r", "Q", "gold", 2, "t2", 6.0, 8)],
        "run_id string, question_id string, layer string, iteration int, tag string, wall_ms double,"
        " result_rows long")
    log = spark.createDataFrame(
        [("t1", 10, 1, 1, 1, 4, "QueryFinish", T(2024, 1, 1, 0)),
         ("t1", 15, 1, 1, 1, 4, "QueryFinish", T(2024, 1, 1, 1)),
         ("t2", 99, 1, 1, 1, 4, "QueryStart", T(2024, 1, 1, 2))],
        "log_comment string, query_duration_ms long, read_rows long, read_bytes long, memory_usage long,"
        " result_rows long, type string, event_time timestamp_ntz")
    out = {r.iteration: r for r in history.enrich_with_engine_log(client, log).collect()}
    assert (out[1].query_duration_ms, out[1].result_rows) == (15, 4)
    assert (out[2].query_duration_ms, out[2].result_rows) == (0, 8)


def test_evidence_document_nests_cells_and_speedups(spark, scratch):
    rows = [_h("r1", "Q1", layer, i, wall, 0) for layer, base in (("bronze", 100.0), ("silver", 50.0), ("gold", 10.0))
            for i, wall in enumerate([base, base + 2.0, base - 2.0], start=1)] + [_h("r2", "Q1", "gold", 1, 5.0, 0)]
    doc = history.evidence_document(spark.createDataFrame(rows, HIST), "r1", "spark", "fixture", 2, 3)
    d = doc.first()
    q = d.queries["Q1"]
    assert set(q.layers) == {"bronze", "silver", "gold"}
    gold_cell = q.layers["gold"]
    assert [s.client_wall_ms for s in gold_cell.samples] == [10.0, 12.0, 8.0]
    assert (gold_cell.mean_ms, gold_cell.median_ms, gold_cell.stdev_ms) == (10.0, 10.0, 2.0)
    assert abs(gold_cell.cv_pct - 20.0) < 1e-9
    assert q.speedup_gold_over_bronze == 10.0 and q.speedup_silver_over_bronze == 2.0
    doc.coalesce(1).write.json(scratch + "/evidence")
    assert spark.read.json(scratch + "/evidence").count() == 1
