"""Statistics over the append-only measurement history.

Input rows look like ``benchmark.medallion_results`` (run, captured_at,
question, layer, iteration, wall_ms, engine counters).  Every report is a
grouped aggregation over the history, so it runs distributed no matter how
many runs accumulate; rankings use TakeOrderedAndProject-style top-k or a
window over an already aggregated (small) table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators.joins import join_on_keys, latest_per_key, order_number
from strata.operators.quantiles import exact_quantiles, histogram, quantiles_from_histogram

ENGINE_METRICS = ("query_duration_ms", "read_rows", "read_bytes", "memory_usage")
CELL = ("question_id", "layer")


# --------------------------------------------------------------------------
# JOIN-4: client timings + engine log
# --------------------------------------------------------------------------

def enrich_with_engine_log(client: DataFrame, log: DataFrame, finished: str = "QueryFinish") -> DataFrame:
    """Attach engine counters to client measurements by tag.

    Only finished log entries of the measured tags count; when a tag was
    logged more than once the latest entry wins.  A measurement without a log entry keeps
    0 for the engine counters and its own client-side ``result_rows``.
    """
    # the left join below keeps the measured tags only; entries of other tags
    # fall away there, after one map-side combined row per tag
    finished_log = log.filter(F.col("type") == finished)
    latest = latest_per_key(finished_log, ["log_comment"], "event_time", [*ENGINE_METRICS, "result_rows"])
    latest = latest.withColumnRenamed("result_rows", "engine_result_rows")
    joined = client.join(latest, client.tag == latest.log_comment, "left")
    return joined.select(
        "run_id", "question_id", "layer", "iteration", "wall_ms",
        *[F.coalesce(F.col(m), F.lit(0).cast("long")).alias(m) for m in ENGINE_METRICS],
        F.coalesce(F.col("engine_result_rows"), F.col("result_rows")).alias("result_rows"))


def consolidate_layers(client: DataFrame, log: DataFrame, layers=X.LAYER_ORDER) -> DataFrame:
    """SET-1: the measurements of the three layers as one list, with the engine
    log attached once (one pass over either input)."""
    return enrich_with_engine_log(client.filter(F.col("layer").isin(*layers)), log)


# --------------------------------------------------------------------------
# AGG-8: per (question, layer) summary of one batch of measurements
# --------------------------------------------------------------------------

def run_summary(results: DataFrame, digits: int | None = None) -> DataFrame:
    """Means are optionally rounded (``digits``) for reporting; the speed-up
    should be computed from the unrounded summary."""
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return (results.groupBy(*CELL).agg(
        r(F.avg("wall_ms")).alias("wall_avg"),
        F.min("wall_ms").alias("wall_min"),
        F.max("wall_ms").alias("wall_max"),
        r(F.avg("query_duration_ms")).alias("engine_avg"),
        F.avg("read_bytes").cast("long").alias("read_bytes"),     # int(mean): truncation
        F.avg("read_rows").cast("long").alias("read_rows"),
        F.max("memory_usage").alias("memory_peak"),
        # "last" = the latest appended row: capture time, then iteration (then a hash of the run)
        F.max_by("result_rows", order_number(F.col("captured_at"), F.col("iteration").cast("long") * F.lit(1 << 32)
                                             + F.pmod(F.hash("run_id"), F.lit(1 << 31)))).alias("result_rows"),
    ))


def speedup_by_layer(summary: DataFrame) -> DataFrame:
    """AGG-12 / JOIN-5: speed-up of each layer over the bronze layer.

    The reference time is the engine mean, or the wall mean when the engine
    mean is 0; bronze's reference falls back to 1.  The ratio is 0 when the
    layer's own reference time is 0.  The bronze baseline is broadcast along
    each question with a window over the (3-rows-per-question) summary.
    """
    ref = F.when(F.coalesce(F.col("engine_avg"), F.lit(0.0)) != 0, F.col("engine_avg")) \
        .otherwise(F.col("wall_avg"))
    bronze_ref = F.when(F.coalesce(F.col("engine_avg"), F.lit(0.0)) != 0, F.col("engine_avg")) \
        .when(F.coalesce(F.col("wall_avg"), F.lit(0.0)) != 0, F.col("wall_avg")).otherwise(F.lit(1.0))
    per_q = Window.partitionBy("question_id")
    base = F.max(F.when(F.col("layer") == "bronze", bronze_ref)).over(per_q)
    base = F.coalesce(base, F.lit(1.0))
    speedup = F.when(F.coalesce(ref, F.lit(0.0)) != 0, base / ref).otherwise(F.lit(0.0))
    return summary.select(*CELL, F.round("engine_avg", 2).alias("engine_avg"),
                          F.round("wall_avg", 2).alias("wall_avg"),
                          F.round(speedup, 2).alias("speedup"))


# --------------------------------------------------------------------------
# AGG-9 / SRT-4: per-run statistics and the latest runs
# --------------------------------------------------------------------------

def per_run_stats(results: DataFrame) -> DataFrame:
    g = results.groupBy("run_id", *CELL).agg(
        F.min("captured_at").alias("ts"),
        F.count(F.lit(1)).alias("iters"),
        F.round(F.avg("query_duration_ms"), 1).alias("engine_avg"),
        F.round(F.stddev_pop("query_duration_ms"), 1).alias("engine_stddev"))
    cv = X.cv_pct(F.col("engine_stddev"), F.col("engine_avg"))
    return g.withColumn("cv_pct", F.round(cv, 2))


def latest_runs(results: DataFrame, n: int = 10) -> DataFrame:
    """Per-run statistics of the ``n`` most recent runs (by capture time).

    Runs are ranked on a per-run table (one row per run) with a top-n; the n
    survivors enter the semi-join, whose strategy the optimizer picks.
    """
    runs = results.groupBy("run_id").agg(F.min("captured_at").alias("run_ts"))
    top = runs.orderBy(F.col("run_ts").desc(), F.col("run_id").desc()).limit(n).select("run_id")
    return per_run_stats(results).join(top, "run_id", "left_semi")


# --------------------------------------------------------------------------
# AGG-10 / PRJ-21 / AGG-13: cross-run consistency
# --------------------------------------------------------------------------

def _cross_run_measures() -> dict[str, Column]:
    return {
        "total_samples": F.count(F.lit(1)),
        "total_runs": F.count_distinct("run_id"),
        "engine_avg": F.round(F.avg("query_duration_ms"), 1),
        "engine_stddev": F.round(F.stddev_pop("query_duration_ms"), 1),
        "wall_avg": F.round(F.avg("wall_ms"), 1),
        "wall_stddev": F.round(F.stddev_pop("wall_ms"), 1),
        "read_rows": F.min("read_rows"),
        "read_bytes_h": X.human_bytes(F.min("read_bytes")),
    }


def _with_cv(cells: DataFrame) -> DataFrame:
    return cells.withColumn("cv_pct", F.round(X.cv_pct(F.col("engine_stddev"), F.col("engine_avg")), 2))


def cross_run_cells(results: DataFrame) -> DataFrame:
    """Cross-run statistics per cell, without the percentiles."""
    return _with_cv(results.groupBy(*CELL).agg(*[c.alias(n) for n, c in _cross_run_measures().items()]))


def cross_run_stats(results: DataFrame) -> DataFrame:
    """Cross-run statistics per cell; all of them from one scan of the results."""
    probs = {"engine_p50": 0.5, "engine_p95": 0.95}
    cells, hist = histogram(results, list(CELL), "query_duration_ms", _cross_run_measures(),
                            ["run_id", "query_duration_ms", "wall_ms", "read_rows", "read_bytes"])
    q = quantiles_from_histogram(hist, list(CELL), "_v", "_c", probs)
    q = q.select(*CELL, *[F.round(n, 1).alias(n) for n in probs])
    return (join_on_keys(_with_cv(cells), q, list(CELL), "left")
            .orderBy("question_id", X.layer_ordinal(F.col("layer"))))


def cv_bands(cross: DataFrame) -> DataFrame:
    return cross.select(*CELL, F.round("cv_pct", 1).alias("cv_pct"),
                        X.cv_band(F.col("cv_pct")).alias("band"))


def cv_share(cross: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Cells whose CV is below ``threshold`` percent (a CV of 0 counts)."""
    return cross.agg(
        F.count_if(F.col("cv_pct") < threshold).alias("consistent_cells"),
        F.count(F.lit(1)).alias("total_cells")).withColumn(
        "share_pct", F.round(X.safe_div(F.col("consistent_cells") * 100.0, F.col("total_cells")), 1))


# --------------------------------------------------------------------------
# AGG-11: cell statistics of the second platform (sample stdev)
# --------------------------------------------------------------------------

def cell_stats(results: DataFrame, value: str = "wall_ms",
               keys=("run_id", "question_id", "layer")) -> DataFrame:
    """mean, median, *sample* stdev (0 for a single sample) and CV per cell."""
    keys = list(keys)
    g, hist = histogram(results, keys, value, {
        "n": F.count(F.lit(1)), "_mean": F.avg(value), "_sd": F.coalesce(F.stddev_samp(value), F.lit(0.0))}, [value])
    out = join_on_keys(g, quantiles_from_histogram(hist, keys, "_v", "_c", {"median_ms": 0.5}), keys, "left")
    cv = F.when(F.col("n") > 1, X.cv_pct(F.col("_sd"), F.col("_mean"))).otherwise(F.lit(0.0))
    return out.select(*keys, "n", F.round("_mean", 2).alias("mean_ms"),
                      F.round("median_ms", 2).alias("median_ms"),
                      F.round("_sd", 2).alias("stdev_ms"), F.round(cv, 2).alias("cv_pct"))


# --------------------------------------------------------------------------
# SRT-5
# --------------------------------------------------------------------------

def latest_measurements(results: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` most recent raw rows (a top-n report; ties broken by ids)."""
    return results.orderBy(F.col("captured_at").desc(), F.col("run_id").desc(),
                           F.col("question_id"), F.col("layer"), F.col("iteration").desc()).limit(n)


__all__ = ["enrich_with_engine_log", "consolidate_layers", "run_summary", "speedup_by_layer",
           "per_run_stats", "latest_runs", "cross_run_cells", "cross_run_stats", "cv_bands", "cv_share", "cell_stats",
           "latest_measurements", "evidence_document"]


# --------------------------------------------------------------------------
# Measurement evidence document (nested: question -> layer -> samples + stats)
# --------------------------------------------------------------------------

def evidence_document(results: DataFrame, run_id: str, engine: str, dataset: str,
                      warmups: int, measurements: int) -> DataFrame:
    """One-row nested document of one benchmark run, ready for ``write.json``.

    ``queries`` maps question -> {layers: layer -> {samples, mean_ms,
    median_ms, stdev_ms, cv_pct}, speedup_gold_over_bronze,
    speedup_silver_over_bronze} (NULL speed-up when the divisor mean is 0).
    A cell's sample list holds one run's measured iterations, so its size is
    the benchmark's ``measurements`` setting, not the data volume.
    """
    r = results.filter(F.col("run_id") == F.lit(run_id))
    sample = F.struct(F.col("iteration"), F.col("wall_ms").alias("client_wall_ms"),
                      F.col("result_rows").alias("rows_returned"))
    cells = r.groupBy(*CELL).agg(
        F.sort_array(F.collect_list(sample)).alias("samples"),
        F.avg("wall_ms").alias("mean_ms"),
        F.coalesce(F.stddev_samp("wall_ms"), F.lit(0.0)).alias("stdev_ms"),
        F.count(F.lit(1)).alias("n"))
    cells = join_on_keys(cells, exact_quantiles(r, list(CELL), "wall_ms", {"median_ms": 0.5}), list(CELL), "left")
    cells = cells.withColumn("cv_pct", F.when(F.col("n") > 1, X.cv_pct(F.col("stdev_ms"), F.col("mean_ms")))
                             .otherwise(F.lit(0.0)))
    stats = F.struct("samples", "mean_ms", "median_ms", "stdev_ms", "cv_pct")

    def mean_of(layer):
        return F.max(F.when(F.col("layer") == layer, F.col("mean_ms")))

    per_q = cells.groupBy("question_id").agg(
        F.map_from_entries(F.collect_list(F.struct("layer", stats))).alias("layers"),
        mean_of("bronze").alias("b"), mean_of("silver").alias("s"), mean_of("gold").alias("g"))
    per_q = per_q.select("question_id", F.struct(
        "layers",
        (F.col("b") / F.nullif(F.col("g"), F.lit(0.0))).alias("speedup_gold_over_bronze"),
        (F.col("b") / F.nullif(F.col("s"), F.lit(0.0))).alias("speedup_silver_over_bronze")).alias("q"))
    return per_q.agg(F.map_from_entries(F.collect_list(F.struct("question_id", "q"))).alias("queries")).select(
        F.lit(engine).alias("engine"), F.lit(dataset).alias("dataset"), F.lit(run_id).alias("run_id"),
        F.lit(warmups).alias("warmups"), F.lit(measurements).alias("measurements"), "queries")
