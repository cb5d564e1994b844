"""Layer benchmark: the two business questions on bronze, silver and gold.

1. Materializes the layers once (timed per stage) and measures their footprint.
2. Runs each question on each layer with 2 warm-ups and 5 measured runs, each
   measured run under its own job group (the tag).
3. Reads Spark's event log as the engine-side query log, joins it to the client
   timings, appends the merged rows to ``benchmark.medallion_results`` and
   computes the run summary and speed-ups with the library's history operators.

Prints ONE JSON line.  Environment: BENCH_SF_DIR (default /root/testdata/sf0.1),
BENCH_CPUS (default 8), BENCH_COPIES (default 16: the trips of the tables so many
times over, for the layers and Q1/Q2; the secondary workloads read them once).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

WARMUPS, MEASURED = 2, 5
COPIES = 16


def _scale_factor(sf_dir: str):
    name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="strata-bench-")
    event_dir = os.path.join(scratch, "eventlog")
    os.makedirs(event_dir)

    from strata.plans import benchmark as B
    from strata.session import build_session
    spark = build_session(f"local[{cpus}]", app="strata-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "8g",
                                 "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
                                 "spark.eventLog.dir": event_dir, **B.EVENT_LOG_CONF})
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))

    from pyspark.sql import functions as F

    from strata.operators import history, metrics, quality
    from strata.plans import pipeline
    from strata.plans import questions as Q
    from strata.plans.layers import Medallion
    from strata.sinks import footprint, tables
    from strata.sources import fixtures

    # the trips of the test tables, COPIES times over, so that the questions' work outweighs a job's fixed cost
    copies = int(os.environ.get("BENCH_COPIES", str(COPIES)))
    trips = fixtures.bronze_trips(spark, sf_dir)
    # each copy is shifted in time, zones and amounts: equal copies would compress away and make the scans too cheap
    many = trips.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    shifted = {c: F.timestamp_add("SECOND", F.col("_copy") * 37, F.col(c))
               for c in ("request_datetime", "pickup_datetime", "dropoff_datetime")}
    shifted |= {c: (F.col(c) + F.col("_copy")) % fixtures.ZONE_MOD for c in ("PULocationID", "DOLocationID")}
    shifted |= {c: F.col(c) * (1 + F.col("_copy") * 0.003) for c in ("base_passenger_fare", "driver_pay", "tips", "trip_miles")}
    many = many.withColumns(shifted).drop("_copy")
    # one landing file per month, as the real inputs come: silver then covers disjoint time ranges without a shuffle
    landing_dir = os.path.join(scratch, "landing")
    (many.withColumn("_month", F.date_format("pickup_datetime", "yyyy-MM")).repartition(cpus * 2, "_month")
     .write.partitionBy("_month").parquet(landing_dir))
    landed = spark.read.parquet(landing_dir).drop("_month")
    single = Medallion(spark, sf_dir)
    m = Medallion(spark, bronze_trips=landed, bronze_zones=single.bronze_zones, window=fixtures.FIXTURE_WINDOW)
    t0 = time.perf_counter()
    built = pipeline.build(m, root=os.path.join(scratch, "layers"), run_tests=True)
    build_s = time.perf_counter() - t0
    try:
        sizes = {f"{r.layer}.{r.table}": {"rows": r.rows, "bytes_on_disk": r.bytes_on_disk,
                                          "compression_ratio": r.compression_ratio}
                 for r in footprint.table_footprint(spark, built.locations()).collect()}
    except Exception as e:   # the headline timings do not depend on it
        sizes = {"error": f"{type(e).__name__}: {str(e)[:200]}"}

    w = fixtures.FIXTURE_WINDOW
    q1, q2 = "Q1_daily_revenue", "Q2_top_borough_pairs_by_revenue"
    cases = {
        (q1, "bronze"): lambda: Q.q1_bronze(built.bronze, w),
        (q1, "silver"): lambda: Q.q1_silver(built.clean),
        (q1, "gold"): lambda: Q.q1_gold(built.gold("daily_revenue")),
        (q2, "bronze"): lambda: Q.q2_bronze(built.bronze, built.zones, w),
        (q2, "silver"): lambda: Q.q2_silver(built.enriched),
        (q2, "gold"): lambda: Q.q2_gold(built.gold("borough_pairs")),
        # secondary workloads, from the raw tables
        ("gold_daily_revenue_from_bronze", "raw"): lambda: single.gold("daily_revenue"),
        ("dq_report", "raw"): lambda: quality.fused_report(single.enriched),
        ("cross_run_stats", "raw"): lambda: history.cross_run_stats(
            fixtures.medallion_results(fixtures.table(spark, sf_dir, "events"))),
        ("metric_rate", "raw"): lambda: metrics.increase(
            fixtures.metric_samples(fixtures.table(spark, sf_dir, "events")), ["instance"], 21600),
    }
    short = {q1: "q1", q2: "q2"}
    run_id = f"bench-{int(time.time())}"
    client, walls = B.measure(spark, cases, run_id, WARMUPS, MEASURED)

    def key(q, layer):
        return f"{short[q]}_{layer}" if q in short else q

    med = {key(*k): round(statistics.median(v), 4) for k, v in walls.items()}
    cv = {key(*k): round(statistics.stdev(v) / statistics.mean(v) * 100, 1) for k, v in walls.items()}

    # engine side: Spark's event log is the query log, joined on the tag
    try:
        engine = B.engine_log_from_event_log(spark, B.event_log_path(spark))
        merged = history.enrich_with_engine_log(client, engine)
        tables.append_measurements(spark, merged, "benchmark.medallion_results")
        results = spark.table("benchmark.medallion_results").filter(f"run_id = '{run_id}'")
        summary = history.run_summary(results)
        speed = {(r.question_id, r.layer): r.speedup for r in history.speedup_by_layer(summary).collect()}
        engine_ms = {key(r.question_id, r.layer): {"engine_avg_ms": round(r.engine_avg, 1),
                                                   "read_rows": r.read_rows,
                                                   "memory_peak": r.memory_peak}
                     for r in summary.collect()}
    except Exception as e:   # the headline timings do not depend on it
        speed, engine_ms = {}, {"error": f"{type(e).__name__}: {str(e)[:200]}"}

    headline = [k for k in med if k[:2] in ("q1", "q2")]
    result = {
        "metric": "q1_q2_all_layers_median_sum",
        "value": round(sum(med[k] for k in headline), 4),
        "unit": "sec",
        "queries": med,
        "sf": _scale_factor(sf_dir),
        "cv_pct": cv,
        "build_sec": round(build_s, 3),
        "build_stages_sec": built.seconds,
        "speedup_gold_over_bronze": {
            short[q]: round(med[f"{short[q]}_bronze"] / med[f"{short[q]}_gold"], 2) for q in (q1, q2)},
        "speedup_silver_over_bronze": {
            short[q]: round(med[f"{short[q]}_bronze"] / med[f"{short[q]}_silver"], 2) for q in (q1, q2)},
        "engine_speedup_over_bronze": {key(q, l): s for (q, l), s in speed.items() if q in short},
        "engine": engine_ms,
        "footprint": sizes,
        "cpus": cpus,
        "copies": copies,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
