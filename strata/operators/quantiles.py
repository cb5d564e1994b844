"""Exact and approximate per-group quantiles.

Spark's built-in exact ``percentile`` merges a value->count map of a whole
group into one aggregation buffer, so one hot group must fit in one task's
memory.  Here a group is never gathered:

1. ``histogram`` counts ``(keys, value)`` pairs and computes the group's other
   aggregates in the same pass: every row enters one aggregation twice, once
   for its group and once for its value (map-side combine; the shuffle of the
   pairs is spread by value).  The result is written once.
2. ``refine`` narrows down where each wanted rank ``(n - 1) * p`` lies.  It
   starts with one interval per group, the whole of it.  An interval with more
   than ``RANK_ROWS`` different values is split into ``PARTS`` parts between its
   own least and greatest value, the parts are counted, and those that hold a
   wanted rank go on; each split separates the least from the greatest value,
   so it ends, however close the values lie or however far out a few of them.
   Only the parts' counts move, and intervals that are small enough rest.
3. ``quantiles_from_histogram`` ranks the values inside the intervals left,
   each of at most ``RANK_ROWS`` values, picks the two around the wanted rank
   and interpolates linearly (the continuous definition of ``percentile_cont``).

The result doesn't depend on partition numbers or on how the planner shares
work.  Infinities are values like others, NaN is the greatest.
``approx_quantiles`` wraps ``percentile_approx`` (a bounded-size sketch that
returns an actual element).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_path

#: different values that one task ranks at most, and parts that a larger interval is split into
RANK_ROWS, PARTS = 100_000, 4096

_INF = float("inf")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back; it is there until the session's scratch is removed."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def histogram(df: DataFrame, keys: list[str], value: str, measures: dict[str, Column] | None = None,
              columns: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``(groups, hist)`` from one scan and one shuffle of ``df``, written once.

    ``groups`` has one row per group with its ``measures``, aggregates over ``columns``; ``hist`` has one row
    (keys, _v, _c) per group and non-NULL value.  A hot group is combined map-side in both.
    """
    v = F.col(value).cast("double")
    whole = F.struct(F.lit(True).alias("_whole"), F.lit(None).cast("double").alias("_v"), *[F.col(c) for c in columns])
    single = F.struct(F.lit(False).alias("_whole"), v.alias("_v"),
                      *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in columns])
    # keys that are measured as well keep their names in the aggregates
    twice = df.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.explode(F.array(whole, single)).alias("_r")).select(
        *[f"_k_{k}" for k in keys], "_r.*")
    counted = twice.where("_whole or _v is not null").groupBy(*[f"_k_{k}" for k in keys], "_whole", "_v").agg(
        F.count(F.lit(1)).alias("_c"), *[c.alias(n) for n, c in (measures or {}).items()])
    stored = _stored(counted, "histogram")
    own = [F.col(f"_k_{k}").alias(k) for k in keys]
    return (stored.where("_whole").select(*own, *(measures or {})),
            stored.where("not _whole").select(*own, "_v", "_c"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str,
                    probs: dict[str, float]) -> DataFrame:
    """keys + one DOUBLE column per entry of ``probs`` (name -> p in [0, 1]).

    NULL values are ignored; a group with no values gets no row.
    """
    return quantiles_from_histogram(histogram(df, keys, value)[1], keys, "_v", "_c", probs)


def _positions(probs: dict[str, float]) -> dict[str, Column]:
    return {name: (F.col("_n") - 1) * F.lit(float(p)) for name, p in probs.items()}


def _holds(start: Column, end: Column, probs: dict[str, float]) -> Column:
    """Whether ranks from ``start`` to before ``end`` include a wanted one."""
    wanted = F.lit(False)
    for position in _positions(probs).values():
        for rank in (F.floor(position), F.ceil(position)):
            wanted = wanted | ((start <= rank) & (rank < end))
    return wanted


def part_of(v: Column, lo: Column, hi: Column, parts: int) -> Column:
    """Part number of a value between ``lo`` and ``hi`` (the least and greatest finite value), from 0 to ``parts`` - 1;
    -1 for minus infinity, ``parts`` for infinity and ``parts`` + 1 for NaN.  Larger values never have smaller numbers."""
    share = (v / 2 - lo / 2) / F.nullif(hi / 2 - lo / 2, F.lit(0.0))      # halves: the difference may overflow
    inside = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * F.lit(float(parts))), F.lit(parts - 1))
    # rounding must not put the greatest value into an earlier part than smaller ones
    return (F.when(F.isnan(v), F.lit(parts + 1)).when(v == _INF, F.lit(parts)).when(v == -_INF, F.lit(-1))
            .when(v >= hi, F.lit(parts - 1)).otherwise(inside)).cast("int")


def refine(hist: DataFrame, probs: dict[str, float], rank_rows: int = RANK_ROWS, parts: int = PARTS) -> DataFrame:
    """Intervals (_wk, _lo, _hi, _before, _n) that hold the wanted ranks of each group of ``hist`` (_k, _v, _c).

    ``_before`` counts the group's values below the interval and ``_n`` all of them.  An interval has at most
    ``rank_rows`` different values.  Every round is an aggregation of the rows in the intervals that are still too large.
    """
    finite = F.when(~F.isnan("_v") & (F.abs("_v") != _INF), F.col("_v"))
    extent = [F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.min(finite).alias("_flo"), F.max(finite).alias("_fhi"),
              F.count(F.lit(1)).alias("_rows")]
    now = _stored(hist.groupBy(F.col("_k").alias("_wk")).agg(*extent, F.sum("_c").alias("_n"))
                  .withColumn("_before", F.lit(0).cast("long")), "intervals")
    while True:
        large = now.where((F.col("_rows") > rank_rows) & ~F.col("_lo").eqNullSafe(F.col("_hi")))
        if large.isEmpty():
            return now.select("_wk", "_lo", "_hi", "_before", "_n")
        inside = _inside(hist, large).withColumn("_part", part_of(F.col("_v"), F.col("_flo"), F.col("_fhi"), parts))
        split = inside.groupBy("_wk", F.col("_lo").alias("_from"), "_before", "_n", "_part").agg(
            *extent, F.sum("_c").alias("_pn"))
        along = Window.partitionBy("_wk", "_from").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
        split = split.withColumn("_end", F.col("_before") + F.sum("_pn").over(along))
        start = F.col("_end") - F.col("_pn")
        kept = split.where(_holds(start, F.col("_end"), probs)).withColumn("_before", start).select(*now.columns)
        resting = now.where((F.col("_rows") <= rank_rows) | F.col("_lo").eqNullSafe(F.col("_hi")))
        now = _stored(resting.unionByName(kept), "intervals")


def _inside(hist: DataFrame, intervals: DataFrame) -> DataFrame:
    """Rows of a histogram (_k, _v, _c) that lie in an interval of their group."""
    return hist.join(intervals, (F.col("_k") == F.col("_wk")) & (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))


def quantiles_from_histogram(hist: DataFrame, keys: list[str], value: str, count: str,
                             probs: dict[str, float], rank_rows: int = RANK_ROWS) -> DataFrame:
    """Exact quantiles from a stored histogram with one row per (keys, value) and its ``count``.  NULL values must
    already be removed."""
    # One non-NULL struct key: struct equality matches NULL fields (NULL keys
    # form a group, as in groupBy).
    k = F.struct(*keys) if keys else F.lit(True)
    hist = hist.select(k.alias("_k"), F.col(value).cast("double").alias("_v"), F.col(count).alias("_c"))
    largest = hist.groupBy("_k").count().agg(F.max("count")).first()[0] or 0
    if largest <= rank_rows:      # every group is an interval that is small enough as it is
        by = ["_k"]
        found = hist.withColumns({"_n": F.sum("_c").over(Window.partitionBy(*by)), "_before": F.lit(0)})
    else:
        by = ["_k", "_lo"]
        found = _inside(hist, refine(hist, probs, rank_rows))
    inside = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("_hi_rank", F.col("_before") + F.sum("_c").over(inside))          # exclusive end
    lo_rank, hi_rank = F.col("_hi_rank") - F.col("_c"), F.col("_hi_rank")
    aggs = []
    for name, pos in _positions(probs).items():
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [
            F.max(F.when((lo_rank <= lo) & (lo < hi_rank), F.col("_v"))).alias(f"_{name}_lo"),
            F.max(F.when((lo_rank <= hi) & (hi < hi_rank), F.col("_v"))).alias(f"_{name}_hi"),
            F.max(pos - lo).alias(f"_{name}_f"),
        ]
    picked = found.groupBy("_k").agg(*aggs)
    # equal neighbours need no interpolation (and infinite ones have none)
    return picked.select(*[F.col("_k")[c].alias(c) for c in keys], *[
        F.when(F.col(f"_{n}_lo") == F.col(f"_{n}_hi"), F.col(f"_{n}_lo"))
         .otherwise(F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_f")).alias(n)
        for n in probs])


def approx_quantiles(value: str, probs: dict[str, float], accuracy: int = 10000):
    """Aggregate expressions (for ``groupBy().agg``) of approximate quantiles."""
    arr = F.percentile_approx(F.col(value).cast("double"), [float(p) for p in probs.values()], accuracy)
    return [arr[i].alias(name) for i, name in enumerate(probs)]
