"""Range functions and instant vectors on a step grid, with windows that overlap (MET-2..MET-5 as dashboards use them).

A range query evaluates ``rate(x[15m])`` at every step, say every minute, so each sample lies in many windows.  Windows
are not built one by one.  Time is cut into panes of the greatest common divisor of step and window, and the samples of a
series in a pane become one summary: count, counter increase between them, first, last and second last sample.  Summaries
of neighbouring panes merge associatively (the increase across their border is the step from the one's last to the
other's first sample).

A window is a run of W panes.  Panes are grouped in blocks of W, so each window is the tail of one block and the head of
the next.  Running merges inside the blocks, one forwards and one backwards, give all heads and tails; the head at a pane
stands for the steps up to the next pane with samples, the tail likewise, and each step merges one of each.  So a sample
costs the same whatever the ratio of window to step: a summary, two running merges, and its share of the output rows.  The
running merges work per (series, block), so a long series is spread over its blocks.

A window at time t holds the samples with t - window < ts <= t.  Only these count: unlike in the tumbling
``metrics.increase`` the step from the sample before the window does not.  Values are not extrapolated to its borders.
Steps are multiples of the step length since 1970; a step whose window is empty gives no row.  Samples without a time or
a value are left out.  ``window_start`` is t - window, so that the vector operations of ``metrics`` apply to the result.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.joins import order_number
from strata.operators.metrics import ORDER, _counter_step

_MICRO = 1_000_000
_EPOCH = "1970-01-01 00:00:00"


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def _time(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.lit(_EPOCH).cast("timestamp_ntz"))


def _floor_div(a: Column, b: int) -> Column:
    """Integer quotient, rounded down for negative numbers as well."""
    return ((a - F.pmod(a, F.lit(b))) / F.lit(b)).cast("long")


def _up_to(a: Column, b: int) -> Column:
    """The smallest multiple of ``b`` that is not below ``a``."""
    return a + F.pmod(-a, F.lit(b))


def _timed(samples: DataFrame, labels: list[str], pane: int) -> DataFrame:
    """(series, pane, us, value, order): a pane holds the times up to and including its number times its length."""
    us = _micros(F.col("ts"))
    return samples.where("ts is not null and value is not null").select(
        "metric", *labels, us.alias("us"), F.col("value").cast("double").alias("value"), *[c for c in ORDER if c != "ts"],
        order_number(*[F.col(c) for c in ORDER]).alias("order"),
        (_floor_div(us - 1, pane * _MICRO) + 1).alias("pane"))


def pane_summaries(samples: DataFrame, labels: list[str], pane: int) -> DataFrame:
    """One row per (series, pane) with samples: n, inc, and the first, last and second last sample."""
    keys = ["metric", *labels, "pane"]
    rows = _timed(samples, labels, pane)
    along = Window.partitionBy(*keys).orderBy("order")
    rows = rows.select(*keys, "us", "value", "order", F.lag("value").over(along).alias("prev"),
                       F.lag("us").over(along).alias("prev_us"))
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_counter_step(F.col("value"), F.col("prev"))), F.lit(0.0)).alias("inc"),
        F.min_by("value", "order").alias("first"), F.max_by("value", "order").alias("last"), F.max("us").alias("last_us"),
        F.max_by("prev", "order").alias("second"), F.max_by("prev_us", "order").alias("second_us"))


_SUMMARY = ("n", "inc", "first", "last", "last_us", "second", "second_us")


def _heads_and_tails(panes: DataFrame, labels: list[str], width: int, stride: int) -> DataFrame:
    """(series, t, head, summary columns): the part of each step's window in its own block, and that in the block before.

    ``width`` is the window and ``stride`` the step, in panes.
    """
    series = ["metric", *labels]
    p = panes.withColumn("block", _floor_div(F.col("pane"), width))
    forward = Window.partitionBy(*series, "block").orderBy("pane")
    back = Window.partitionBy(*series, "block").orderBy(F.col("pane").desc())
    so_far, from_end = (w.rowsBetween(Window.unboundedPreceding, 0) for w in (forward, back))
    carry = F.coalesce(_counter_step(F.col("first"), F.col("before")), F.lit(0.0))
    p = (p.withColumn("before", F.lag("last").over(forward)).withColumn("before_us", F.lag("last_us").over(forward))
         .withColumn("prev_pane", F.lag("pane").over(forward)).withColumn("next_pane", F.lead("pane").over(forward))
         .withColumn("carry", carry))
    end = (F.col("block") + 1) * width            # the first pane of the next block
    head = F.struct(
        F.lit(True).alias("head"), F.col("pane").alias("lo"), (F.coalesce("next_pane", end) - 1).alias("hi"),
        F.sum("n").over(so_far).alias("n"), F.sum(F.col("inc") + F.col("carry")).over(so_far).alias("inc"),
        F.first("first").over(so_far).alias("first"), F.col("last"), F.col("last_us"),
        F.coalesce("second", "before").alias("second"), F.coalesce("second_us", "before_us").alias("second_us"))
    tail = F.struct(
        F.lit(False).alias("head"), F.greatest(F.coalesce(F.col("prev_pane") + width, end), end).alias("lo"),
        (F.col("pane") + width - 1).alias("hi"),
        F.sum("n").over(from_end).alias("n"),
        (F.sum(F.col("inc") + F.col("carry")).over(from_end) - F.col("carry")).alias("inc"),
        F.col("first"), F.first("last").over(from_end).alias("last"), F.first("last_us").over(from_end).alias("last_us"),
        F.coalesce(F.first("second").over(from_end), F.nth_value("last", 2).over(from_end)).alias("second"),
        F.coalesce(F.first("second_us").over(from_end), F.nth_value("last_us", 2).over(from_end)).alias("second_us"))
    parts = p.select(*series, head.alias("h"), tail.alias("t")).select(*series, F.explode(F.array("h", "t")).alias("x")).select(
        *series, "x.*").withColumn("lo", _up_to(F.col("lo"), stride)).where("lo <= hi")
    return parts.select(*series, F.explode(F.sequence("lo", "hi", F.lit(stride).cast("long"))).alias("t"), "head", *_SUMMARY)


def step_summaries(samples: DataFrame, labels: list[str], step: int, window: int) -> DataFrame:
    """(metric, labels, at, window_start, n, inc, first, last, last_us, second, second_us) of every step's window.

    ``step`` and ``window`` are whole seconds; the window may be shorter or longer than the step, and any multiple of it
    or none.
    """
    if step < 1 or window < 1:
        raise ValueError("step and window must be positive")
    series, pane = ["metric", *labels], gcd(step, window)
    parts = _heads_and_tails(pane_summaries(samples, labels, pane), labels, window // pane, step // pane)
    side = {True: F.col("head"), False: ~F.col("head")}
    both = parts.groupBy(*series, "t").agg(*[F.max(F.when(side[h], F.col(c))).alias(f"{'h' if h else 't'}_{c}")
                                             for h in (True, False) for c in _SUMMARY])
    across = F.coalesce(_counter_step(F.col("h_first"), F.col("t_last")), F.lit(0.0))
    zero = F.lit(0.0)
    second = {c: F.coalesce(F.col(f"h_{c}"), F.when(F.col("h_n").isNotNull(), F.col(f"t_{whole}")).otherwise(F.col(f"t_{c}")))
              for c, whole in (("second", "last"), ("second_us", "last_us"))}
    at = F.col("t") * F.lit(pane * _MICRO)
    return both.select(
        *series, _time(at).alias("at"), _time(at - F.lit(window * _MICRO)).alias("window_start"),
        (F.coalesce("h_n", F.lit(0)) + F.coalesce("t_n", F.lit(0))).alias("n"),
        # a border without samples on one side adds nothing
        (F.coalesce("t_inc", zero) + F.coalesce("h_inc", zero)
         + F.when(F.col("h_n").isNotNull() & F.col("t_n").isNotNull(), across).otherwise(zero)).alias("inc"),
        F.coalesce("t_first", "h_first").alias("first"), F.coalesce("h_last", "t_last").alias("last"),
        F.coalesce("h_last_us", "t_last_us").alias("last_us"), second["second"].alias("second"),
        second["second_us"].alias("second_us"))


def step_increase(samples: DataFrame, labels: list[str], step: int, window: int) -> DataFrame:
    """Counter increase and per-second rate inside the window at every step; windows of one sample give no row."""
    s = step_summaries(samples, labels, step, window).where("n > 1")
    return s.select("metric", *labels, "at", "window_start", F.col("inc").alias("increase"),
                    (F.col("inc") / F.lit(float(window))).alias("rate"))


def step_irate(samples: DataFrame, labels: list[str], step: int, window: int) -> DataFrame:
    """Per-second rate between the last two samples of the window at every step (NULL if they have the same time)."""
    s = step_summaries(samples, labels, step, window).where("n > 1")
    seconds = (F.col("last_us") - F.col("second_us")) / F.lit(float(_MICRO))
    return s.select("metric", *labels, "at", "window_start",
                    F.when(seconds > 0, _counter_step(F.col("last"), F.col("second")) / seconds).alias("irate"))


def step_delta(samples: DataFrame, labels: list[str], step: int, window: int) -> DataFrame:
    """Last minus first sample of the window at every step; windows of one sample give no row."""
    s = step_summaries(samples, labels, step, window).where("n > 1")
    return s.select("metric", *labels, "at", "window_start", (F.col("last") - F.col("first")).alias("delta"))


def step_instants(samples: DataFrame, labels: list[str], step: int, lookback: int) -> DataFrame:
    """The latest sample of each series at every step, if it is younger than ``lookback`` seconds: (series, at, value, ts).

    A bounded as-of match.  The last sample of a pane of one step is carried forward over at most lookback / step panes:
    inside its block of that many panes up to the next pane with samples, and, for the last one of a block, into the next
    block, where any sample of that block takes precedence.
    """
    if step < 1 or lookback < 1:
        raise ValueError("step and lookback must be positive")
    series, width = ["metric", *labels], -(-lookback // step)
    last = _timed(samples, labels, step).groupBy(*series, "pane").agg(
        F.max_by("value", "order").alias("value"), F.max("us").alias("us"))
    p = last.withColumn("block", _floor_div(F.col("pane"), width))
    along = Window.partitionBy(*series, "block").orderBy("pane")
    reach = F.col("pane") + width - 1
    p = p.withColumn("hi", F.coalesce(F.lead("pane").over(along) - 1, reach))
    carried = p.select(*series, F.explode(F.sequence("pane", "hi")).alias("t"), "us", "value")
    # of two candidates for a step the one of the step's own block is younger
    best = carried.groupBy(*series, "t").agg(F.max_by("value", "us").alias("value"), F.max("us").alias("us"))
    at = F.col("t") * F.lit(step * _MICRO)
    return best.where(F.col("us") > at - F.lit(lookback * _MICRO)).select(
        *series, _time(at).alias("at"), "value", _time(F.col("us")).alias("ts"))
