"""Declarative data-quality checks and rejected-row accounting.

A check returns *failing-row counts*, 0 = pass.  All not-null checks of one
model run as one aggregation pass (one partial aggregate per partition, a
single-row shuffle); uniqueness is a ``groupBy`` on the column; a
relationship check is a ``left_anti`` join against the parent keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators import gold, silver

REPORT_COLUMNS = ("model", "column_name", "test", "failures", "status")

# fixed values: the declared tests per model (column -> tests)
DECLARED_TESTS = {
    "fhvhv_trips_clean": {"pickup_at": ["not_null"], "dropoff_at": ["not_null"],
                          "base_fare": ["not_null"], "trip_minutes": ["not_null"],
                          "total_amount": ["not_null"]},
    "fhvhv_trips_enriched": {"pickup_at": ["not_null"]},
    "daily_revenue": {"trip_date": ["not_null", "unique"], "gross_revenue_usd": ["not_null"]},
    "hourly_demand": {"weekday": ["not_null"], "hour_of_day": ["not_null"]},
    "borough_pairs": {"pickup_borough": ["not_null"], "dropoff_borough": ["not_null"]},
    "driver_economics": {"month": ["not_null", "unique"]},
    "shared_vs_solo": {"ride_type": ["not_null", "unique"]},
}


def _status(failures):
    return F.when(failures == 0, F.lit("pass")).otherwise(F.lit("fail"))


def not_null_counts(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """One report row per column: rows where the column is NULL (single pass)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "column_name", "failures")
    return long.select(F.lit(model).alias("model"), "column_name",
                       F.lit("not_null").alias("test"), F.col("failures").cast("long").alias("failures"))


def unique_failures(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    dups = (df.select(column).filter(F.col(column).isNotNull()).groupBy(column).count()
            .filter(F.col("count") > 1))
    return dups.agg(F.count(F.lit(1)).cast("long").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.lit("unique").alias("test"), "failures")


def relationship_failures(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str,
                          model: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (a ``left_anti`` join).

    The parent side is reduced to its distinct keys first, so the join's
    build side is as small as the key domain.
    """
    keys = parent.select(F.col(parent_col).alias("_pk")).distinct()
    orphans = (child.select(F.col(child_col).alias("_ck")).filter(F.col("_ck").isNotNull())
               .join(keys, F.col("_ck") == F.col("_pk"), "left_anti"))
    return orphans.agg(F.count(F.lit(1)).cast("long").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(child_col).alias("column_name"),
        F.lit("relationships").alias("test"), "failures",
        _status(F.col("failures")).alias("status"))


def model_report(df: DataFrame, model: str, tests: dict[str, list[str]]) -> DataFrame:
    """All declared tests of one model in one pass: (model, column_name, test, failures).

    A unique column groups the rows first, and the not-null counts are summed over
    its groups; without one the whole model is one aggregate.  Further unique
    columns, which no declared model has, take a pass each.
    """
    null = [c for c, t in tests.items() if "not_null" in t]
    unique = [c for c, t in tests.items() if "unique" in t]
    parts = []
    if unique:
        key = unique[0]
        grouped = df.groupBy(F.col(key).alias("_key")).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(null)])
        wide = grouped.agg(
            F.count_if(F.col("_key").isNotNull() & (F.col("_n") > 1)).alias("_unique"),
            *[F.coalesce(F.sum(f"_null_{i}"), F.lit(0)).alias(f"_null_{i}") for i in range(len(null))])
        cells = [(key, "unique", "_unique"), *((c, "not_null", f"_null_{i}") for i, c in enumerate(null))]
    else:
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(null)])
        cells = [(c, "not_null", f"_null_{i}") for i, c in enumerate(null)]
    rows = [F.struct(F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit(t).alias("test"),
                     F.col(n).cast("long").alias("failures")) for c, t, n in cells]
    parts.append(wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    parts += [unique_failures(df, model, c) for c in unique[1:]]
    return reduce(DataFrame.unionByName, parts)


def run_declared_tests(models: dict[str, DataFrame], tests=DECLARED_TESTS) -> DataFrame:
    """The full report: one row per (model, column, test) with failures and
    status, for the declared tests of the models given (one pass over each)."""
    parts = [model_report(models[m], m, t) for m, t in tests.items() if m in models]
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("status", _status(F.col("failures")))


def fused_report(enriched: DataFrame) -> DataFrame:
    """The full report of the silver and gold models from one scan of the fact.

    ``enriched`` is the silver view with the zone names.  One grouping-sets aggregation has the groups of every gold model
    and, as the empty set, the silver rows themselves, with the null counts of the tested columns; a second, small one
    counts the failing groups per model.  A group is its key, so a unique column fails only where a model had a key
    twice, and ``not_null`` on a key fails where its group is that of NULL.
    """
    keys = list(dict.fromkeys(c for own in gold.REPORT_SETS.values() for c in own))
    silver_columns = list(DECLARED_TESTS["fhvhv_trips_clean"])
    t = enriched.select(*[e.alias(n) for n, e in gold.key_columns().items()],
                        *[F.col(c).alias(f"_m_{c}") for c in silver_columns])
    sets = [list(own) for own in gold.REPORT_SETS.values()] + [[]]
    groups = t.groupingSets(sets, *keys).agg(
        F.grouping_id().alias("_gid"), F.count("_m_total_amount").alias("_amounts"),
        *[F.count_if(F.col(f"_m_{c}").isNull()).alias(f"_nulls_{c}") for c in silver_columns])
    gid = {m: gold.set_id(own, keys) for m, own in (*gold.REPORT_SETS.items(), ("silver", ()))}
    # (model, column, test) -> failures among the groups of that model
    cells = []
    for model, tests in DECLARED_TESTS.items():
        for column, kinds in tests.items():
            for kind in kinds:
                if model.startswith("fhvhv"):
                    n = F.sum(F.when(F.col("_gid") == gid["silver"], F.col(f"_nulls_{column}")))
                else:
                    own = F.col("_gid") == gid[model]
                    if model == "borough_pairs":      # the model leaves out trips without a borough
                        own = own & F.col("pickup_borough").isNotNull() & F.col("dropoff_borough").isNotNull()
                    # an aggregate is NULL where no trip of the group has the amount
                    null = F.col(column).isNull() if column in keys else F.col("_amounts") == 0
                    n = F.count_if(own & null) if kind == "not_null" else None
                cells.append((model, column, kind, n))
    repeated = {m: own for m, own in gold.REPORT_SETS.items() if any("unique" in k for k in DECLARED_TESTS[m].values())}
    wide = groups.agg(*[n.alias(f"_{i}") for i, (*_, n) in enumerate(cells) if n is not None],
                      *[(F.count_if((F.col("_gid") == gid[m]) & F.col(own[0]).isNotNull())
                         - F.count_distinct(F.when(F.col("_gid") == gid[m], F.col(own[0])))).alias(f"_twice_{m}")
                        for m, own in repeated.items()])
    rows = [F.struct(F.lit(m).alias("model"), F.lit(c).alias("column_name"), F.lit(k).alias("test"),
                     F.coalesce(F.col(f"_twice_{m}" if n is None else f"_{i}"), F.lit(0)).cast("long").alias("failures"))
            for i, (m, c, k, n) in enumerate(cells)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*").withColumn("status", _status(F.col("failures")))


def observed_nulls(tests: dict[str, list[str]]) -> dict[str, Column]:
    """Null counts of the not_null columns of a model, as aggregates that Spark collects while it writes the model."""
    return {f"null_{c}": F.count_if(F.col(c).isNull()) for c, t in tests.items() if "not_null" in t}


def observed_report(model: str, tests: dict[str, list[str]], metrics: dict, stored: DataFrame) -> list[dict]:
    """Report rows of one model from ``observed_nulls`` metrics; only unique columns are read, from the staged rows."""
    rows = [(c, "not_null", metrics[f"null_{c}"]) for c, t in tests.items() if "not_null" in t]
    rows += [(c, "unique", unique_failures(stored, model, c).first()["failures"])
             for c, t in tests.items() if "unique" in t]
    return [dict(zip(REPORT_COLUMNS, (model, c, t, n, "fail" if n else "pass"))) for c, t, n in rows]


def gate(report: DataFrame) -> DataFrame:
    """Failing checks only: an empty result means the refresh may proceed."""
    return report.filter(F.col("status") == "fail")


def rejected_rows(bronze: DataFrame, window=silver.DEFAULT_WINDOW) -> DataFrame:
    """Raw vs clean row counts and per-rule failures, in one scan.

    A row fails a rule when the rule is not true for it (NULL fails too); a
    row may fail several rules, so the per-rule counts can add up to more
    than ``rejected_rows``.
    """
    def fails(pred):
        return F.count_if(~F.coalesce(pred, F.lit(False)))
    return bronze.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(F.coalesce(silver.quality_predicate(window), F.lit(False))).alias("clean_rows"),
        fails(silver.in_window("pickup_datetime", window)).alias("outside_window"),
        fails(F.col("base_passenger_fare") > 0).alias("non_positive_fare"),
        fails(F.col("trip_miles").between(0, silver.MAX_MILES)).alias("miles_out_of_range"),
        fails(F.col("trip_time").between(0, silver.MAX_TRIP_SECONDS)).alias("time_out_of_range"),
    ).withColumn("rejected_rows", F.col("raw_rows") - F.col("clean_rows"))


def cast_report(bronze: DataFrame, columns=("PULocationID", "DOLocationID")) -> DataFrame:
    """How the null-on-failure id cast treats each raw id column (one scan)."""
    from strata.functions.exprs import uint16_or_null
    aggs = []
    for c in columns:
        v = uint16_or_null(c)       # the text round trip itself is what is reported on
        aggs += [F.count(F.lit(1)).alias(f"{c}__rows"), F.count(v).alias(f"{c}__valid"),
                 F.min(v).alias(f"{c}__min_id"), F.max(v).alias(f"{c}__max_id")]
    wide = bronze.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__rows").alias("rows"),
                     F.col(f"{c}__valid").alias("valid"),
                     (F.col(f"{c}__rows") - F.col(f"{c}__valid")).alias("nulls"),
                     F.col(f"{c}__min_id").alias("min_id"), F.col(f"{c}__max_id").alias("max_id"))
            for c in columns]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
