"""Windows on a step grid against windows that are built one by one."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import metrics as MET
from strata.operators import step_metrics as STEP

EPOCH = dt.datetime(1970, 1, 1)


def samples(seed, n=400, series=3, span=40_000):
    """(metric, instance, second, value, id): counters with resets, ties in time, gaps, samples before 1970."""
    pick = random.Random(seed)
    out, value = [], {}
    for i in range(n):
        s = pick.randrange(series)
        t = pick.choice([pick.randrange(-span, span), pick.randrange(0, 600), 60 * pick.randrange(0, 100)])
        out.append(("m", None if s == 0 else f"i{s}", t, i))
    rows = []
    for m, inst, t, i in sorted(out, key=lambda r: (r[2], r[3])):
        v = value.get(inst, 0.0) + pick.randrange(0, 5)
        value[inst] = 0.0 if pick.random() < 0.1 else v
        rows.append((m, inst, t, value[inst], i))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "metric string, instance string, t long, value double, sample_id long")
    at = F.timestamp_add("SECOND", F.col("t"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return df.select("metric", "instance", at.alias("ts"), "value", "sample_id").repartition(5)


def windows(rows, step, window):
    """{(instance, t): samples with t - window < ts <= t, in order}, by looking at every sample for every step."""
    out = {}
    for inst in {r[1] for r in rows}:
        own = sorted((r[2], r[4], r[3]) for r in rows if r[1] == inst)
        lo, hi = own[0][0], own[-1][0] + window
        for k in range(math.floor(lo / step), math.ceil(hi / step) + 1):
            inside = [s for s in own if k * step - window < s[0] <= k * step]
            if inside:
                out[(inst, k * step)] = inside
    return out


def second(ts):
    return int((ts - EPOCH).total_seconds())


def step_up(a, b):
    return b - a if b >= a else b


GRIDS = [(60, 120), (60, 900), (100, 250), (250, 100), (3600, 3600), (7, 11), (900, 86_400)]


@pytest.mark.parametrize("step,window", GRIDS)
def test_every_window_equals_the_one_built_alone(spark, step, window):
    rows = samples(step + window)
    df, want = frame(spark, rows), windows(rows, step, window)
    summaries = {(r.instance, second(r["at"])): r for r in STEP.step_summaries(df, ["instance"], step, window).collect()}
    assert set(summaries) == set(want)
    for key, inside in want.items():
        r = summaries[key]
        assert (r.n, r["first"], r["last"]) == (len(inside), inside[0][2], inside[-1][2]), key
        assert r.inc == pytest.approx(sum(step_up(a[2], b[2]) for a, b in zip(inside, inside[1:])))
        assert second(r.window_start) == key[1] - window
    many = {k: v for k, v in want.items() if len(v) > 1}
    got = {(r.instance, second(r["at"])): r for r in STEP.step_increase(df, ["instance"], step, window).collect()}
    assert set(got) == set(many)
    assert all(got[k].rate == pytest.approx(got[k].increase / window) for k in got)
    got = {(r.instance, second(r["at"])): r.delta for r in STEP.step_delta(df, ["instance"], step, window).collect()}
    assert got == {k: v[-1][2] - v[0][2] for k, v in many.items()}
    got = {(r.instance, second(r["at"])): r.irate for r in STEP.step_irate(df, ["instance"], step, window).collect()}
    for k, v in many.items():
        (t1, _, a), (t2, _, b) = v[-2:]
        assert got[k] == (pytest.approx(step_up(a, b) / (t2 - t1)) if t2 > t1 else None), k


@pytest.mark.parametrize("step,lookback", [(60, 300), (60, 90), (100, 30), (7, 1000)])
def test_instants_are_the_latest_samples_in_reach(spark, step, lookback):
    rows = samples(step * lookback)
    got = {(r.instance, second(r["at"])): (r.value, second(r.ts))
           for r in STEP.step_instants(frame(spark, rows), ["instance"], step, lookback).collect()}
    assert got == {k: (v[-1][2], v[-1][0]) for k, v in windows(rows, step, lookback).items()}


def test_work_does_not_depend_on_the_overlap(spark):
    """Rows of the running merges: two for each pane with samples, whatever the window; no row per sample and window."""
    df = frame(spark, samples(5, n=300))
    panes = {w: STEP.pane_summaries(df, ["instance"], 60).count() for w in (120, 6000)}
    assert panes[120] == panes[6000] <= 300
    plan = STEP.step_increase(df, ["instance"], 60, 6000)._jdf.queryExecution().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_odd_samples(spark):
    df = spark.createDataFrame([("m", "a", None, 1.0, 1), ("m", "a", 5, None, 2), ("m", "a", 7, 3.0, 3)],
                               "metric string, instance string, t long, value double, sample_id long")
    at = F.timestamp_add("SECOND", F.col("t"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    df = df.select("metric", "instance", at.alias("ts"), "value", "sample_id")
    assert [(second(r["at"]), r.n) for r in STEP.step_summaries(df, ["instance"], 10, 20).orderBy("at").collect()] == [(10, 1), (20, 1)]
    assert STEP.step_increase(df, ["instance"], 10, 20).count() == 0
    assert STEP.step_instants(df.where("false"), ["instance"], 10, 20).count() == 0
    with pytest.raises(ValueError):
        STEP.step_summaries(df, ["instance"], 0, 20)


def test_vector_operations_apply(spark):
    df = frame(spark, samples(9))
    r = STEP.step_increase(df, ["instance"], 600, 1800)
    assert MET.aggregate_by(r, "rate", [], "max").count() == r.select("window_start").distinct().count()
