"""Registry of runnable queries: name -> ``(spark, sf_dir) -> DataFrame``.

Every entry reads the given tables (or data Spark derives from them), so
its work grows with the input.  The DuckDB oracle for the same names lives
in :mod:`strata.plans.duckdb_oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators import history as H
from strata.operators import metrics as MET
from strata.operators import gold, quality, silver
from strata.operators import step_metrics as STEP
from strata.plans import questions as Q
from strata.plans import stored
from strata.plans.layers import Medallion
from strata.sinks import footprint, tables
from strata.sources import fixtures, landing

Query = Callable[[SparkSession, str], DataFrame]


def _m(spark, sf_dir, **kw) -> Medallion:
    return Medallion(spark, sf_dir, **kw)


def _gold(name, **kw) -> Query:
    return lambda spark, d: _m(spark, d).gold(name, **kw)


REGISTRY: dict[str, Query] = {
    # silver
    "silver_clean": lambda spark, d: _m(spark, d).clean,
    "clean_elapsed_minutes": lambda spark, d: _m(spark, d, minute_mode="elapsed").clean,
    "silver_enriched": lambda spark, d: _m(spark, d).enriched,
    # the second dialect: SMALLINT ids (raise on overflow), elapsed minutes,
    # SMALLINT-compared zone keys
    "silver_clean_strict_ids": lambda spark, d: silver.clean(
        _m(spark, d).bronze_trips, fixtures.FIXTURE_WINDOW, "elapsed", id_cast="strict"),
    "silver_enriched_smallint_keys": lambda spark, d: silver.enrich(
        silver.clean(_m(spark, d).bronze_trips, fixtures.FIXTURE_WINDOW, "elapsed", id_cast="strict"),
        _m(spark, d).bronze_zones, zone_key_cast="smallint"),
    # gold
    "gold_daily_revenue": _gold("daily_revenue"),
    "gold_daily_revenue_approx": _gold("daily_revenue", percentiles="approx"),
    "gold_hourly_demand": _gold("hourly_demand"),
    # the second dialect's gold: approximate percentiles over its own silver
    "gold_daily_revenue_mirror": lambda spark, d: gold.daily_revenue(_mirror_clean(spark, d), "approx"),
    "gold_borough_pairs_mirror": lambda spark, d: gold.borough_pairs(silver.enrich(
        _mirror_clean(spark, d), _m(spark, d).bronze_zones, zone_key_cast="smallint")),
    "gold_borough_pairs": _gold("borough_pairs"),
    "gold_driver_economics": _gold("driver_economics"),
    "gold_shared_vs_solo": _gold("shared_vs_solo"),
    # questions per layer
    "q1_bronze": lambda spark, d: Q.q1_bronze(_m(spark, d).bronze_trips, fixtures.FIXTURE_WINDOW),
    "q1_silver": lambda spark, d: Q.q1_silver(_m(spark, d).clean),
    "q1_gold": lambda spark, d: Q.q1_gold(_m(spark, d).gold("daily_revenue", percentiles="none")),
    "q2_bronze": lambda spark, d: Q.q2_bronze(_m(spark, d).bronze_trips, _m(spark, d).bronze_zones,
                                              fixtures.FIXTURE_WINDOW),
    "q2_silver": lambda spark, d: Q.q2_silver(_m(spark, d).enriched),
    "q2_gold": lambda spark, d: Q.q2_gold(_m(spark, d).gold("borough_pairs")),
    # quality
    "safe_location_cast": lambda spark, d: quality.cast_report(_m(spark, d).bronze_trips),
    "rejected_rows": lambda spark, d: quality.rejected_rows(_m(spark, d).bronze_trips,
                                                            fixtures.FIXTURE_WINDOW),
    "dq_report": lambda spark, d: quality.fused_report(_m(spark, d).enriched),
    "dq_relationships": lambda spark, d: _relationships(_m(spark, d)),
    # measurement history
    "engine_log_enriched": lambda spark, d: H.enrich_with_engine_log(*_client_and_log(spark, d)),
    "layer_union": lambda spark, d: H.consolidate_layers(*_client_and_log(spark, d)),
    "run_summary": lambda spark, d: H.run_summary(_results(spark, d), digits=2),
    "speedup_by_layer": lambda spark, d: H.speedup_by_layer(H.run_summary(_results(spark, d))),
    "per_run_stats": lambda spark, d: H.per_run_stats(_results(spark, d)),
    "latest_runs": lambda spark, d: H.latest_runs(_results(spark, d)),
    "cross_run_stats": lambda spark, d: H.cross_run_stats(_results(spark, d)),
    "cv_bands": lambda spark, d: H.cv_bands(H.cross_run_cells(_results(spark, d))),
    "cv_share": lambda spark, d: H.cv_share(H.cross_run_cells(_results(spark, d))),
    "cell_stats": lambda spark, d: H.cell_stats(_results(spark, d)),
    "latest_measurements": lambda spark, d: H.latest_measurements(_results(spark, d)),
    # sources and sinks
    "landing_files": lambda spark, d: landing.read_trip_files(
        spark, [f"{d}/events.parquet", f"{d}/events.parquet"], with_batch=False),
    "landing_view": stored.landing_view,
    "bench_tags": lambda spark, d: _tags(spark, d),
    "ingest_audit": lambda spark, d: tables.ingest_audit(
        _m(spark, d).bronze_trips.withColumn("_batch", F.date_format("pickup_datetime", "yyyy-MM"))),
    # both measure what is there; nothing is built, moved or registered
    "table_footprint": lambda spark, d: footprint.table_footprint(
        spark, {("input", t): f"{d}/{t}.parquet" for t in INPUT_TABLES}),
    "table_rows": lambda spark, d: footprint.row_counts(_layer_tables(_m(spark, d))),
    # metric rollups
    "metric_select": lambda spark, d: MET.select_series(
        _samples(spark, d), "click", [("instance", "=~", "[0-3]"), ("instance", "!=", "1"),
                                      ("instance", "!~", "3")]),
    "metric_instant": lambda spark, d: MET.last_per_window(_samples(spark, d), LABELS, HOUR),
    # results are rounded here, after all filters: the operators themselves keep full precision
    "metric_rate": lambda spark, d: _rounded(MET.increase(
        MET.select_series(_samples(spark, d), "click"), LABELS, RATE_WINDOW), increase=4, rate=8),
    "metric_irate": lambda spark, d: _rounded(MET.irate(
        MET.select_series(_samples(spark, d), "signup"), LABELS, DAY), irate=6),
    "metric_delta": lambda spark, d: _rounded(MET.delta(
        MET.select_series(_samples(spark, d), "purchase"), LABELS, DAY), delta=4),
    "metric_instant_at": lambda spark, d: MET.instant_at(
        _samples(spark, d), LABELS, INSTANT, INSTANT_LOOKBACK),
    # on a step grid: overlapping windows, windows that are no multiple of the step, steps longer than the window
    "metric_absent_labels": lambda spark, d: _by_matcher(fixtures.pod_samples(_events(spark, d))),
    "metric_step_rate": lambda spark, d: _rounded(STEP.step_increase(
        MET.select_series(_samples(spark, d), "click"), LABELS, HOUR, RATE_WINDOW), increase=4, rate=8),
    "metric_step_irate": lambda spark, d: _rounded(STEP.step_irate(
        MET.select_series(_samples(spark, d), "signup"), LABELS, 4 * HOUR, 10 * HOUR), irate=6),
    "metric_step_delta": lambda spark, d: _rounded(STEP.step_delta(_samples(spark, d), LABELS, 5 * HOUR, 2 * HOUR), delta=4),
    "metric_instant_range": lambda spark, d: STEP.step_instants(_samples(spark, d), LABELS, HOUR, 5 * HOUR // 2),
    "metric_step_min_of_avg": lambda spark, d: _rounded(MET.aggregate_by(MET.aggregate_by(
        STEP.step_increase(_samples(spark, d), LABELS, HOUR, RATE_WINDOW), "rate", LABELS, "avg", "value"),
        "value", [], "min"), value=8),
    "metric_sum_by": lambda spark, d: _sum_by_metric(_samples(spark, d)),
    "metric_min_of_avg": lambda spark, d: _min_of_avg_rate(_samples(spark, d)),
    "metric_ratio": lambda spark, d: MET.aggregate_by(
        MET.vector_ratio(MET.last_per_window(_samples(spark, d), LABELS, HOUR), "click", "view", LABELS)
        .withColumn("value", F.round("value", 6)), "value", [], "min"),
    "metric_ratio_by_instance": lambda spark, d: MET.aggregate_by(
        MET.vector_ratio(MET.last_per_window(_samples(spark, d), LABELS, HOUR), "click", "view", LABELS)
        .withColumn("value", F.round("value", 6)), "value", LABELS, "min"),
    "metric_vector_sum": lambda spark, d: _rounded(MET.vector_sum(
        MET.last_per_window(_samples(spark, d), LABELS, HOUR), ["click", "view", "purchase"], LABELS), value=4),
    "metric_positive_count": lambda spark, d: _positive_count(_samples(spark, d)),
    "metric_topk": lambda spark, d: _rounded(MET.topk(
        MET.aggregate_by(MET.rate(_samples(spark, d), LABELS, RATE_WINDOW), "rate",
                         ["metric", *LABELS], "sum", "value"), "value", 5, ["metric", *LABELS]), value=8),
}

REGISTRY.update(stored.REGISTRY)

# Window lengths are scaled to the fixture's sample density (one sample per
# series every ~75 minutes), not to a 15-second scrape interval.
LABELS = ["instance"]
HOUR, RATE_WINDOW, DAY = 3600, 6 * 3600, 86400
INSTANT, INSTANT_LOOKBACK = "2024-01-10 00:00:00", 2 * 86400


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _samples(spark, d):
    return fixtures.metric_samples(fixtures.table(spark, d, "events"))


# fixed values: one matcher of each kind, and two that only a missing label meets
POD_MATCHERS = (("!=", "pod-1"), ("!~", "pod-[12]"), ("=", ""), ("=~", "pod-[01]|"), ("=~", ".*"), ("=", "pod-2"))


def _by_matcher(samples):
    """Samples that each label matcher selects."""
    found = [MET.select_series(samples, None, [("pod", op, v)]).groupBy("metric", "pod").agg(
        F.count(F.lit(1)).alias("samples")).select(F.lit(f"pod{op}{v}").alias("matcher"), "*") for op, v in POD_MATCHERS]
    return reduce(DataFrame.unionByName, found)


def _tags(spark, d):
    """Tag of each measurement, and its parts read back."""
    tagged = _results(spark, d).select("run_id", "question_id", "layer", "iteration", X.bench_tag(
        "run_id", "question_id", "layer", "iteration").alias("tag"))
    return tagged.select("tag", *[X.tag_part("tag", i).alias(n) for i, n in
                                  enumerate(("prefix", "run_id", "question_id", "layer", "mark"))])


def _sum_by_metric(samples):
    inst = MET.last_per_window(samples, LABELS, HOUR)
    return inst.groupBy("window_start", "metric").agg(
        F.round(F.sum("value"), 4).alias("sum_value"), F.round(F.avg("value"), 4).alias("avg_value"),
        F.min("value").alias("min_value"), F.count(F.lit(1)).alias("series"))


def _min_of_avg_rate(samples):
    r = MET.rate(MET.select_series(samples, None, [("metric", "=~", "click|view")]), LABELS, RATE_WINDOW)
    per_instance = MET.aggregate_by(r, "rate", LABELS, "avg", "value")
    return MET.sort_desc(_rounded(MET.aggregate_by(per_instance, "value", [], "min"), value=8), "value")


def _positive_count(samples):
    d = MET.delta(MET.select_series(samples, "purchase"), LABELS, DAY)
    per_instance = MET.aggregate_by(MET.compare_filter(d, "delta", ">", 0.0), "delta", LABELS, "sum")
    return MET.aggregate_by(per_instance, "delta", [], "count", "value")


# fixed values: the input tables that the trip and measurement fixtures are derived from
INPUT_TABLES = ("events", "lineitem", "nation", "orders", "region", "supplier")


def _layer_tables(m: Medallion) -> dict[tuple[str, str], DataFrame]:
    """Every table of a refresh, by layer, as it would be stored."""
    return {("bronze", "fhvhv_trips"): m.bronze_trips, ("bronze", "taxi_zones"): m.bronze_zones,
            ("silver", "fhvhv_trips_clean"): m.clean,
            **{("gold", g): m.gold(g, percentiles="none") if g == "daily_revenue" else m.gold(g)
               for g in gold.GOLD_MODELS}}


def _mirror_clean(spark, d):
    """Silver of the second dialect: elapsed minutes, SMALLINT ids."""
    return silver.clean(_m(spark, d).bronze_trips, fixtures.FIXTURE_WINDOW, "elapsed", id_cast="strict")


def _events(spark, d):
    return fixtures.table(spark, d, "events")


def _client_and_log(spark, d):
    e = _events(spark, d)
    return fixtures.client_timings(e), fixtures.engine_log(e)


def _results(spark, d):
    return fixtures.medallion_results(_events(spark, d))


def _relationships(m: Medallion) -> DataFrame:
    a = quality.relationship_failures(m.clean, "pickup_location_id", m.bronze_zones, "LocationID",
                                      "fhvhv_trips_clean")
    b = quality.relationship_failures(m.clean, "dropoff_location_id", m.bronze_zones, "LocationID",
                                      "fhvhv_trips_clean")
    return a.unionByName(b)


#: queries that run jobs when they are built: those that store tables, those whose exact quantiles are narrowed down round
#: by round on a stored histogram, and the ingest that compares its files' columns
EAGER = {*stored.REGISTRY, "gold_daily_revenue", "cross_run_stats", "cell_stats", "landing_files"}

FLAGSHIP = "gold_daily_revenue"
