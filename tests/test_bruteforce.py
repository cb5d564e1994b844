"""Distributed operators vs straightforward pandas/numpy on small inputs."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators import metrics as MET
from strata.operators.quantiles import exact_quantiles
from strata.sources import fixtures
from conftest import SF_SMALL


def test_exact_quantiles_match_numpy_with_a_hot_key(spark):
    rng = np.random.default_rng(7)
    keys = np.concatenate([np.zeros(3000, int), rng.integers(1, 40, 6000)])   # key 0 holds a third
    vals = np.round(rng.gamma(2.0, 10.0, keys.size), 2)
    vals[::97] = np.nan
    pdf = pd.DataFrame({"k": keys, "v": vals})
    rows = [(int(k), None if np.isnan(v) else float(v)) for k, v in zip(keys, vals)]
    df = spark.createDataFrame(rows, "k long, v double").repartition(16)
    got = {r.k: (r.p50, r.p95, r.p0, r.p100) for r in
           exact_quantiles(df, ["k"], "v", {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}).collect()}
    for k, g in pdf.dropna().groupby("k")["v"]:
        exp = np.percentile(g.to_numpy(), [50, 95, 0, 100])   # linear interpolation
        assert np.allclose(got[k], exp, rtol=0, atol=1e-9), k


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=30))
def test_exact_quantiles_property(spark, xs):
    df = spark.createDataFrame([(0, float(x)) for x in xs], "k int, v double")
    r = exact_quantiles(df, ["k"], "v", {"q": 0.37}).first()
    assert abs(r.q - float(np.percentile(xs, 37))) < 1e-9


def _brute_increase(pdf, seconds):
    out = {}
    for (m, inst), g in pdf.sort_values(["ts", "sample_id"]).groupby(["metric", "instance"]):
        prev = None
        for ts, v in zip(g["ts"], g["value"]):
            step = 0.0 if prev is None else (v - prev if v >= prev else v)
            w = pd.Timestamp(ts).floor(f"{seconds}s")
            out[(m, inst, w)] = out.get((m, inst, w), 0.0) + step
            prev = v
    return out


def test_rate_matches_sequential_scan(spark):
    samples = fixtures.metric_samples(fixtures.table(spark, SF_SMALL, "events"))
    pdf = samples.toPandas()
    exp = _brute_increase(pdf, 21600)
    got = {(r.metric, r.instance, pd.Timestamp(r.window_start)): r.increase
           for r in MET.increase(samples, ["instance"], 21600).collect()}
    assert set(got) == set(exp)
    assert all(abs(got[k] - exp[k]) < 1e-6 for k in exp)
    # finer chunks split a hot series across tasks without changing the answer
    chunked = {(r.metric, r.instance, pd.Timestamp(r.window_start)): r.increase
               for r in MET.increase(samples, ["instance"], 21600, chunk_seconds=1800).collect()}
    assert set(chunked) == set(exp)
    assert all(abs(chunked[k] - exp[k]) < 1e-6 for k in exp)


def test_irate_and_delta_match_pandas(spark):
    samples = fixtures.metric_samples(fixtures.table(spark, SF_SMALL, "events"))
    pdf = samples.toPandas().sort_values(["ts", "sample_id"])
    pdf["w"] = pdf["ts"].dt.floor("86400s")
    exp_delta, exp_irate = {}, {}
    for (m, inst, w), g in pdf.groupby(["metric", "instance", "w"]):
        exp_delta[(m, inst, w)] = g["value"].iloc[-1] - g["value"].iloc[0]
        if len(g) >= 2:
            v, p = g["value"].iloc[-1], g["value"].iloc[-2]
            dt = (g["ts"].iloc[-1] - g["ts"].iloc[-2]).total_seconds()
            exp_irate[(m, inst, w)] = ((v - p) if v >= p else v) / dt if dt > 0 else None
    d = {(r.metric, r.instance, pd.Timestamp(r.window_start)): r.delta
         for r in MET.delta(samples, ["instance"], 86400).collect()}
    assert d == exp_delta
    ir = {(r.metric, r.instance, pd.Timestamp(r.window_start)): r.irate
          for r in MET.irate(samples, ["instance"], 86400).collect()}
    assert set(ir) == set(exp_irate)
    assert all(abs(ir[k] - round(exp_irate[k], 6)) < 1e-6 for k in exp_irate)


def test_matchers_are_anchored(spark):
    df = spark.createDataFrame([("m", "node-1"), ("m", "xnode-1"), ("m", "node-12")], "metric string, instance string")
    got = [r.instance for r in MET.select_series(df, "m", [("instance", "=~", "node-1")]).collect()]
    assert got == ["node-1"]
    got = [r.instance for r in MET.select_series(df, "m", [("instance", "!~", "node-.*")]).collect()]
    assert got == ["xnode-1"]


def test_vector_sum_drops_incomplete_label_sets(spark):
    import datetime as dt
    w = dt.datetime(2024, 1, 1)
    vec = spark.createDataFrame([("a", "i1", w, 1.0), ("b", "i1", w, 2.0), ("a", "i2", w, 5.0)],
                                "metric string, instance string, window_start timestamp_ntz, value double")
    got = [(r.instance, r.value) for r in MET.vector_sum(vec, ["a", "b"], ["instance"]).collect()]
    assert got == [("i1", 3.0)]
    top = MET.topk(vec, "value", 2, ["metric", "instance"]).collect()
    assert [(r.metric, r.instance) for r in top] == [("a", "i2"), ("b", "i1")]


def test_instant_at_takes_latest_within_lookback(spark):
    import datetime as dt
    T = dt.datetime
    df = spark.createDataFrame(
        [("m", "a", T(2024, 1, 1, 0, 0), 1.0, 1), ("m", "a", T(2024, 1, 1, 0, 4), 2.0, 2),
         ("m", "a", T(2024, 1, 1, 0, 6), 9.0, 3), ("m", "b", T(2023, 12, 31, 23, 50), 5.0, 4)],
        "metric string, instance string, ts timestamp_ntz, value double, sample_id long")
    got = {r.instance: r.value for r in MET.instant_at(df, ["instance"], "2024-01-01 00:05:00").collect()}
    assert got == {"a": 2.0}


def test_exact_quantiles_across_range_slices(spark):
    """A hot key with many distinct values spans several range partitions;
    ranks must stay global across the slice boundaries."""
    rng = np.random.default_rng(11)
    keys = np.concatenate([np.zeros(20000, int), rng.integers(1, 6, 4000)])
    vals = rng.gamma(2.0, 10.0, keys.size)
    df = spark.createDataFrame(list(zip(keys.tolist(), vals.tolist())), "k long, v double").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        probs = {"p01": 0.01, "p50": 0.5, "p95": 0.95, "p999": 0.999}
        got = {r.k: [r[n] for n in probs] for r in exact_quantiles(df, ["k"], "v", probs).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    pdf = pd.DataFrame({"k": keys, "v": vals})
    for k, g in pdf.groupby("k")["v"]:
        exp = np.percentile(g.to_numpy(), [1, 50, 95, 99.9])
        assert np.allclose(got[k], exp, rtol=0, atol=1e-9), k


def test_null_keys_form_their_own_group(spark):
    import datetime as dt
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 10.0)], "k string, v double")
    got = {r.k: r.q for r in exact_quantiles(df, ["k"], "v", {"q": 0.5}).collect()}
    assert got == {None: 2.0, "a": 10.0}
    T = dt.datetime
    s = spark.createDataFrame([("m", None, T(2024, 1, 1, 0, 0), 1.0, 1), ("m", None, T(2024, 1, 1, 0, 0, 10), 3.0, 2)],
                              "metric string, instance string, ts timestamp_ntz, value double, sample_id long")
    r = MET.irate(s, ["instance"], 3600).collect()
    assert len(r) == 1 and r[0].instance is None and abs(r[0].irate - 0.2) < 1e-9


def test_two_phase_topk_equals_global_ranking(spark):
    import datetime as dt
    rng = np.random.default_rng(5)
    rows = [(dt.datetime(2024, 1, 1, w), f"m{i % 7}", f"i{i}", float(rng.integers(0, 40)))
            for w in range(3) for i in range(300)]                    # many ties on value
    vec = spark.createDataFrame(rows, "window_start timestamp_ntz, metric string, instance string, value double")
    got = sorted((r.window_start, r.metric, r.instance) for r in
                 MET.topk(vec, "value", 7, ["metric", "instance"], buckets=4).collect())
    pdf = pd.DataFrame(rows, columns=["window_start", "metric", "instance", "value"])
    exp = sorted((pd.Timestamp(r.window_start).to_pydatetime(), r.metric, r.instance) for _, g in
                 pdf.groupby("window_start") for r in
                 g.sort_values(["value", "metric", "instance"], ascending=[False, True, True]).head(7).itertuples())
    assert got == exp
