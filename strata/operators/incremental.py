"""Incremental gold: mergeable states per batch, merged into the gold models (AGG-1..AGG-5 on a schedule).

A full refresh aggregates all trips every hour although only one batch (a month) is new.  Every gold column is an aggregate
that can be merged: sums, counts, averages as sums and counts, and quantiles as KLL sketches.  So each batch is aggregated
once, on its own, into states: per model and group the sums and counts, and per day a sketch of the fares.  They are stored
partitioned by batch; a batch that comes again, corrected or because a run was repeated, replaces its own states.  Gold is
the merge of all states: a small aggregation, which reads no trips.

All columns but the two quantiles are exact; those have the rank error of a sketch of ``SKETCH_K``.  A group may be spread
over batches, like a weekday over all months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import exprs as X
from strata.operators import gold, silver

#: size parameter of the fare sketches: a rank error of about 0.4 percent
SKETCH_K = 800
BATCH = "batch"


def batch_states(clean: DataFrame) -> DataFrame:
    """(batch, _gid, keys, _n, _s_*, _c_*): the sums and counts of the groups of the four models over clean trips."""
    return gold.fused_aggregates(clean, gold.FUSED_SETS, (BATCH,))


def batch_pairs(enriched: DataFrame) -> DataFrame:
    """(batch, keys, _n, _s_*, _c_*) of the borough pairs."""
    return gold.fused_aggregates(enriched, gold.PAIR_SET, (BATCH,), gold.PAIR_MEASURES)


def batch_sketches(clean: DataFrame) -> DataFrame:
    """(batch, trip_date, sketch) of the fares of a day."""
    fares = clean.select(BATCH, X.trip_date("pickup_at").alias("trip_date"), F.col("total_amount").cast("double").alias("fare"))
    return fares.where("fare is not null").groupBy(BATCH, "trip_date").agg(
        F.kll_sketch_agg_double("fare", SKETCH_K).alias("sketch"))


def write_states(clean: DataFrame, zones: DataFrame, path: str) -> None:
    """Aggregate the batches in ``clean`` (which has a ``batch`` column) and put their states in the place of old ones.

    Each of the three tables is overwritten by batch, so a run that died in between is simply repeated.
    """
    enriched = silver.enrich(clean, zones, also=(BATCH,))
    for name, states in (("sums", batch_states(clean)), ("pairs", batch_pairs(enriched)), ("sketches", batch_sketches(clean))):
        (states.write.partitionBy(BATCH).mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .parquet(f"{path}/{name}"))


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of all batches as those of one."""
    totals = [c for c in states.columns if c == "_n" or c.startswith(("_s_", "_c_"))]
    return states.groupBy("_gid", *keys).agg(*[F.sum(c).alias(c) for c in totals])


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """(trip_date, quantile columns): the fare quantiles of a day over all batches."""
    merged = sketches.groupBy("trip_date").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select("trip_date", *[F.kll_sketch_get_quantile_double("sketch", F.lit(p)).alias(n)
                                        for n, p in gold.FARE_PERCENTILES.items()])


def gold_models(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All gold models from the stored states."""
    sums = merge_states(spark.read.parquet(f"{path}/sums"), gold.set_keys(gold.FUSED_SETS))
    pairs = merge_states(spark.read.parquet(f"{path}/pairs"), gold.set_keys(gold.PAIR_SET))
    return {**gold.models_from_fused(sums, None, merge_sketches(spark.read.parquet(f"{path}/sketches"))),
            "borough_pairs": gold.pairs_from_fused(pairs)}
