"""Join helpers: latest-row selection and null-safe key joins.

Lookup joins carry no hint: the optimizer broadcasts a dimension by its size
in bytes (``spark.sql.autoBroadcastJoinThreshold``), and adaptive execution
does so at run time from the bytes it has seen.  Building a query never
starts a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def order_number(time: Column, tie: Column) -> Column:
    """``(time, tie)`` as one fixed-width number, for ``max_by`` / ``min_by``:
    microseconds first, then the integer ``tie``.  With a fixed-width order
    Spark aggregates in a hash table and combines map-side; an order of
    several columns (a struct) would sort every row by key first.
    """
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                              time.cast("timestamp_ntz"))
    scale = F.lit("20000000000000000000").cast("decimal(20,0)")     # over the range of a 64-bit tie
    return (micros.cast("decimal(17,0)") * scale).cast("decimal(38,0)") \
        + F.coalesce(tie.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))


def latest_per_key(df: DataFrame, keys: list[str], time: str, values: list[str]) -> DataFrame:
    """One row per key: the ``values`` (of fixed width) of its latest row by ``time``.

    Rows of the same time are told apart by a hash of their values, so all
    columns come from one row and the choice doesn't depend on the plan.  An
    aggregation, combined map-side: a key with many duplicates is never
    buffered or sorted in one task.
    """
    order = order_number(F.col(time), F.xxhash64(*[F.col(v) for v in values]))
    ordered = df.select(*keys, *values, order.alias("_order"))
    return ordered.groupBy(*keys).agg(*[F.max_by(v, "_order").alias(v) for v in values])


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on same-named key columns where NULL matches NULL (``<=>``), as
    ``groupBy`` treats NULL as a group of its own; one copy of each key is
    kept.  Spark still plans it as an equi-join."""
    renamed = right.select(*[F.col(k).alias(f"_rk_{k}") for k in keys],
                           *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_rk_{k}"))
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_rk_{k}" for k in keys])
