"""Rollups over labelled metric samples (dashboard-style range queries).

Samples are a long table ``(metric, <label columns>, ts, value, sample_id)``;
a *series* is one metric plus one combination of label values.  Range
functions are evaluated over tumbling, epoch-aligned windows
(``window_start``); instant vectors are the last sample of each series in a
window.  ``sample_id`` breaks timestamp ties so every "last"/"first" is
deterministic.

Scale notes: range functions never sort a whole series.  Per-sample work is
partitioned by (series, window), so a hot series is spread across its
windows; only one row per (series, window) is then ordered along the series
to carry a counter across window boundaries.  Everything else is a grouped
aggregation with map-side combine.  Boundary extrapolation of the original
query language is deliberately not reproduced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.joins import join_on_keys, order_number

ORDER = ("ts", "sample_id")


def _order() -> Column:
    return order_number(*[F.col(c) for c in ORDER])


def with_window(samples: DataFrame, seconds: int) -> DataFrame:
    """Add ``window_start``: the epoch-aligned tumbling window of each sample."""
    return samples.withColumn("window_start", F.window("ts", f"{int(seconds)} seconds").start)


# --------------------------------------------------------------------------
# MET-1: series selection
# --------------------------------------------------------------------------

def matcher(label: str, op: str, value: str) -> Column:
    """Label matcher: ``=``, ``!=``, ``=~`` and ``!~`` (regexes fully anchored).

    A series without the label (NULL) counts as having it empty, so ``!=`` and
    ``!~`` keep it, and ``=""`` and a regex that matches nothing find it.
    """
    c = F.coalesce(F.col(label), F.lit(""))
    if op == "=":
        return c == F.lit(value)
    if op == "!=":
        return c != F.lit(value)
    anchored = f"^(?:{value})$"
    if op == "=~":
        return c.rlike(anchored)
    if op == "!~":
        return ~c.rlike(anchored)
    raise ValueError(f"unknown matcher {op!r}")


def select_series(samples: DataFrame, metric: str | None = None,
                  matchers: list[tuple[str, str, str]] = ()) -> DataFrame:
    pred = F.lit(True) if metric is None else (F.col("metric") == F.lit(metric))
    for m in matchers:
        pred = pred & matcher(*m)
    return samples.filter(pred)


# --------------------------------------------------------------------------
# MET-2: instant vectors
# --------------------------------------------------------------------------

def last_per_window(samples: DataFrame, labels: list[str], seconds: int) -> DataFrame:
    """Instant value of each series at the end of each window (its last sample)."""
    keys = ["metric", *labels, "window_start"]
    return (with_window(samples, seconds).groupBy(*keys)
            .agg(F.max_by("value", _order()).alias("value")))


def instant_at(samples: DataFrame, labels: list[str], at: str, lookback_seconds: int = 300) -> DataFrame:
    """Instant query at time ``at``: per series, the latest sample with
    ``at - lookback < ts <= at`` (series without one are absent).  The time
    predicate is pushed to the scan; the rest is one aggregation."""
    t = F.lit(at).cast("timestamp_ntz")
    lo = F.timestamp_add("SECOND", F.lit(-int(lookback_seconds)), t)
    return (samples.filter((F.col("ts") <= t) & (F.col("ts") > lo))
            .groupBy("metric", *labels)
            .agg(F.max_by("value", _order()).alias("value"), F.max("ts").alias("ts")))


# --------------------------------------------------------------------------
# MET-3 / MET-4 / MET-5: range functions
# --------------------------------------------------------------------------

def _counter_step(v: Column, prev: Column) -> Column:
    """Increase between consecutive counter samples; a drop is a reset, after
    which the new value is the increase.  NULL when there is no previous sample."""
    return F.when(prev.isNull(), F.lit(None).cast("double")).when(v >= prev, v - prev).otherwise(v)


def _windowed_steps(samples: DataFrame, labels: list[str], seconds: int) -> DataFrame:
    """Per sample: the previous sample of the same series *within the window*."""
    keys = ["metric", *labels, "window_start"]
    w = Window.partitionBy(*keys).orderBy(*ORDER)
    s = with_window(samples, seconds)
    return s.withColumn("prev_value", F.lag("value").over(w))


def increase(samples: DataFrame, labels: list[str], seconds: int,
             chunk_seconds: int | None = None) -> DataFrame:
    """Reset-aware counter increase and per-second rate per (series, window).

    The first sample of a series contributes 0; each later sample contributes
    its step from the previous sample of the series, even when that sample
    lies in an earlier window.

    Per-sample steps are computed inside time chunks (``chunk_seconds``,
    default: the window itself, which must be a multiple of it); only one
    row per (series, chunk) is then ordered along the series to carry the
    counter across chunk boundaries.  A finer chunk splits a hot series
    across more tasks without changing the result.
    """
    chunk = int(chunk_seconds or seconds)
    if seconds % chunk:
        raise ValueError("the window must be a multiple of the chunk")
    series = ["metric", *labels]
    steps = _windowed_steps(samples, labels, chunk)              # window_start = chunk start
    per_chunk = steps.groupBy(*series, "window_start").agg(
        F.sum(_counter_step(F.col("value"), F.col("prev_value"))).alias("inner"),
        F.min_by("value", _order()).alias("first_value"),
        F.max_by("value", _order()).alias("last_value"))
    along = Window.partitionBy(*series).orderBy("window_start")
    prev_last = F.lag("last_value").over(along)
    carried = F.when(prev_last.isNull(), F.lit(0.0)).otherwise(_counter_step(F.col("first_value"), prev_last))
    chunk_inc = per_chunk.select(*series, F.col("window_start").alias("chunk_start"),
                                 (F.coalesce(F.col("inner"), F.lit(0.0)) + carried).alias("inc"))
    if chunk != seconds:
        chunk_inc = chunk_inc.withColumn(
            "window_start", F.window("chunk_start", f"{int(seconds)} seconds").start)
        out = chunk_inc.groupBy(*series, "window_start").agg(F.sum("inc").alias("increase"))
    else:
        out = chunk_inc.select(*series, F.col("chunk_start").alias("window_start"),
                               F.col("inc").alias("increase"))
    return out.withColumn("rate", F.col("increase") / F.lit(float(seconds)))


def rate(samples: DataFrame, labels: list[str], seconds: int, chunk_seconds: int | None = None) -> DataFrame:
    return increase(samples, labels, seconds, chunk_seconds).drop("increase")


def irate(samples: DataFrame, labels: list[str], seconds: int) -> DataFrame:
    """Per-second rate from the last two samples of each series in a window
    (windows with fewer than two samples give no row).

    Two hash aggregations, no window function: the last sample per (series,
    window), then the greatest sample ordered before it, found by joining the
    samples to the (one row per series-window) last-sample table.  A hot
    series-window is combined map-side, and the join's skewed partitions can
    be split by AQE.
    """
    series = ["metric", *labels]
    keys = [*series, "window_start"]
    s = with_window(samples, seconds).select(*keys, "ts", "value", _order().alias("_order"))
    last = s.groupBy(*keys).agg(F.max("_order").alias("_last"), F.max("ts").alias("_last_ts"),
                                F.max_by("value", "_order").alias("_last_value"))
    before = join_on_keys(s, last, keys).filter(F.col("_order") < F.col("_last"))
    prev = before.groupBy(*keys).agg(
        F.max_by("value", "_order").alias("_value"), F.max("ts").alias("_ts"),
        F.max("_last_ts").alias("_last_ts"), F.max("_last_value").alias("_last_value"))
    dt = F.timestamp_diff("MICROSECOND", F.col("_ts"), F.col("_last_ts")) / F.lit(1e6)
    step = _counter_step(F.col("_last_value"), F.col("_value"))
    return prev.select(*keys, F.when(dt > 0, step / dt).alias("irate"))


def delta(samples: DataFrame, labels: list[str], seconds: int) -> DataFrame:
    """Gauge change over a window: last minus first sample."""
    series = ["metric", *labels]
    return (with_window(samples, seconds).groupBy(*series, "window_start")
            .agg((F.max_by("value", _order()) - F.min_by("value", _order())).alias("delta")))


# --------------------------------------------------------------------------
# MET-6 .. MET-12: vector operations
# --------------------------------------------------------------------------

AGGS = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


def aggregate_by(vec: DataFrame, value: str, by: list[str], how: str = "sum",
                 alias: str | None = None) -> DataFrame:
    """``how(value) by (by...)`` per window."""
    return vec.groupBy("window_start", *by).agg(AGGS[how](value).alias(alias or value))


def pivot_metrics(vec: DataFrame, metrics: list[str], labels: list[str]) -> DataFrame:
    """One column per metric, matched on equal label values (one shuffle)."""
    return (vec.filter(F.col("metric").isin(metrics))
            .groupBy("window_start", *labels)
            .agg(*[F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]))


def vector_ratio(vec: DataFrame, num: str, den: str, labels: list[str]) -> DataFrame:
    """num / den on matching label sets; a side without a match yields no row.
    Division follows floating-point rules: x / 0 is +Inf or -Inf, 0 / 0 NaN."""
    p = pivot_metrics(vec, [num, den], labels)
    n, d = F.col(num), F.col(den)
    # Spark's division has no infinities: spell them out (the sign of a zero doesn't matter here)
    by_zero = F.when(n > 0, F.lit(float("inf"))).when(n < 0, F.lit(float("-inf"))).otherwise(F.lit(float("nan")))
    r = F.when(n.isNotNull() & d.isNotNull(), F.when(d == 0, by_zero).otherwise(n / F.nullif(d, F.lit(0.0))))
    return p.select("window_start", *labels, r.alias("value")).filter(F.col("value").isNotNull())


def vector_sum(vec: DataFrame, metrics: list[str], labels: list[str]) -> DataFrame:
    """Sum of several metrics on matching label sets; a missing term drops the set."""
    p = pivot_metrics(vec, metrics, labels)
    total = reduce(lambda a, b: a + b, [F.col(m) for m in metrics])
    return p.select("window_start", *labels, total.alias("value")).filter(
        F.col("value").isNotNull())


def compare_filter(vec: DataFrame, value: str, op: str, threshold: float) -> DataFrame:
    c = F.col(value)
    cond = {">": c > threshold, ">=": c >= threshold, "<": c < threshold,
            "<=": c <= threshold, "==": c == threshold, "!=": c != threshold}[op]
    return vec.filter(cond)


def topk(vec: DataFrame, value: str, k: int, labels: list[str], buckets: int = 64) -> DataFrame:
    """The k largest series per window; label values break ties.

    Two phases, so a window with millions of series never sorts them in one
    task: first the top k inside each hash bucket of the label set, then the
    top k of those survivors (at most ``k * buckets`` rows per window).
    Ties are broken by the labels in both phases, so the cut is the same as
    a single global ranking.
    """
    order = [F.col(value).desc(), *[F.col(c) for c in labels]]
    if labels:
        bucket = F.pmod(F.hash(*[F.col(c) for c in labels]), F.lit(buckets))
        pre = Window.partitionBy("window_start", "_b").orderBy(*order)
        vec = (vec.withColumn("_b", bucket).withColumn("_rn", F.row_number().over(pre))
               .filter(F.col("_rn") <= k).drop("_rn", "_b"))
    w = Window.partitionBy("window_start").orderBy(*order)
    return vec.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def sort_desc(vec: DataFrame, value: str) -> DataFrame:
    return vec.orderBy(F.col(value).desc())
