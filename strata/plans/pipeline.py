"""Materialize the layers (the pipeline run) and read them back.

``build`` writes bronze, silver and gold as managed Parquet tables, each
range-sorted by its key; the enriched silver model stays a view.  Later
queries then start from the stored tables: gold answers read a few hundred
rows instead of recomputing from the trips.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from strata.operators import gold, quality, silver
from strata.plans.layers import Medallion
from strata.session import scratch_path
from strata.sinks import tables
from strata.sinks.versions import delete_path


# fixed value: the name of the enriched view
ENRICHED_VIEW = "silver.fhvhv_trips_enriched"


@dataclass
class Built:
    spark: SparkSession
    seconds: dict[str, float] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        return self.spark.table(name)

    @property
    def clean(self) -> DataFrame:
        return self.table("silver.fhvhv_trips_clean")

    @property
    def zones(self) -> DataFrame:
        return self.table("bronze.taxi_zones")

    @property
    def bronze(self) -> DataFrame:
        return self.table("bronze.fhvhv_trips")

    @property
    def enriched(self) -> DataFrame:
        """The catalog view: recomputed from the stored clean table on each use."""
        return self.table(ENRICHED_VIEW)

    def gold(self, name: str) -> DataFrame:
        return self.table(f"gold.{name}")

    def ingest_audit(self) -> DataFrame | None:
        """Rows added per landing file and the running total (when the bronze
        table carries its source file, as ``read_trip_files`` provides)."""
        bronze = self.bronze
        return tables.ingest_audit(bronze) if "_batch" in bronze.columns else None

    def locations(self) -> dict[tuple[str, str], str]:
        names = [("bronze", "fhvhv_trips"), ("bronze", "taxi_zones"), ("silver", "fhvhv_trips_clean"),
                 *[("gold", g) for g in gold.GOLD_MODELS]]
        return {(l, t): f"{l}.{t}" for l, t in names}


def build(m: Medallion, root: str | None = None, files: int | None = None,
          run_tests: bool = True, gate: bool = False, silver_layout: str = "local",
          fuse: bool = True) -> Built:
    """Full refresh of every layer.  ``gate`` raises when a declared data test
    fails; the failing checks are kept in ``Built.failing_tests``.

    Each table is staged, tested and then made current in one step, so a
    refresh that fails leaves the tables that it hasn't reached as they were,
    and one that fails a test leaves the tested table, too.  The tests cost no
    scan: null counts are collected while the rows are written, and unique
    columns are looked up in the staged gold tables, which are small.

    ``silver_layout``: ``local`` sorts silver by pickup time within each
    input partition (no shuffle; right when landing files are per month, as
    they are), ``range`` range-partitions it first (one full shuffle; for
    inputs that are not clustered in time).

    ``fuse`` computes the four clean-based gold models from one grouping-sets
    aggregation, and the daily fare histogram from a second, narrow one (two
    scans of silver instead of five)."""
    spark = m.spark
    b = Built(spark)
    b.failing_tests = []

    def timed(key, fn):
        t0 = time.perf_counter()
        fn()
        b.seconds[key] = round(time.perf_counter() - t0, 3)

    def refresh(key, df, table, *models, n=files, how="range"):
        """Write a table; ``models`` are those whose declared tests its rows decide."""
        tests = {t: quality.DECLARED_TESTS[t] for t in models if run_tests}
        columns = {c: ["not_null"] for t in tests.values() for c, kinds in t.items() if "not_null" in kinds}

        def check(staged, seen):
            failing = [r for t, own in tests.items() for r in quality.observed_report(t, own, seen, staged)
                       if r["status"] == "fail"]
            b.failing_tests.extend(failing)
            if gate and failing:
                raise RuntimeError(f"data tests failed: {b.failing_tests}")

        timed(key, lambda: tables.write_table(
            df, table, gold.SORT_KEYS.get(table.split(".", 1)[1]), n, how=how,
            metrics=quality.observed_nulls(columns) or None, check=check if tests else None))

    timed("create_schemas", lambda: tables.create_layers(spark, root))
    refresh("ingest_trips", m.bronze_trips, "bronze.fhvhv_trips")
    refresh("ingest_zones", m.bronze_zones, "bronze.taxi_zones", n=1)
    stored = Medallion(spark, window=m.window, minute_mode=m.minute_mode,
                       bronze_trips=b.bronze, bronze_zones=b.zones)
    # the enriched view keeps every clean row and its pickup time, so the clean rows decide its test as well
    refresh("silver_clean", stored.clean, "silver.fhvhv_trips_clean", "fhvhv_trips_clean", "fhvhv_trips_enriched",
            how=silver_layout)
    tables.create_catalog_view(spark, ENRICHED_VIEW, silver.enriched_view_sql("silver.fhvhv_trips_clean",
                                                                              "bronze.taxi_zones"))
    built_models, scratch = {}, None
    if fuse:
        # both tables go to the shared folder: lost executors don't lose them, and every model reads them from there
        scratch = scratch_path(spark, f"fused-{uuid.uuid4().hex}")
        timed("gold_fused_aggregate", lambda: (gold.fused_aggregates(b.clean).write.parquet(f"{scratch}/sets"),
                                               gold.fare_histogram(b.clean).write.parquet(f"{scratch}/fares")))
        built_models = gold.models_from_fused(spark.read.parquet(f"{scratch}/sets"),
                                              spark.read.parquet(f"{scratch}/fares"))
    try:
        for name, (src, fn) in gold.GOLD_MODELS.items():
            df = built_models.get(name)
            if df is None:
                df = fn(b.clean if src == "clean" else b.enriched)
            refresh(f"gold_{name}", df, f"gold.{name}", name, n=1)
    finally:
        if scratch:
            delete_path(spark, scratch)
    return b


# fixed values: the materialized tables that compaction rewrites
COMPACTED = ("bronze.fhvhv_trips", "silver.fhvhv_trips_clean", *[f"gold.{g}" for g in gold.GOLD_MODELS])


def compact_all(spark: SparkSession, files: int | None = None) -> DataFrame:
    """Compact every materialized table (bronze trips, silver clean, the five
    gold tables), each range-sorted by its own key; a table that fails is
    reported and skipped, the rest still run.  The file count follows from each
    table's bytes unless given."""
    return tables.compact(spark, {t: gold.SORT_KEYS.get(t.split(".", 1)[1]) for t in COMPACTED}, files)


# fixed values: every table a build materializes, by layer
MATERIALIZED = (("bronze", "fhvhv_trips"), ("bronze", "taxi_zones"), ("silver", "fhvhv_trips_clean"),
                *[("gold", g) for g in gold.GOLD_MODELS])


def attach(spark: SparkSession, root: str) -> list[str]:
    """Register the tables of a lake folder written by ``build(root=...)`` in
    this session's catalog (e.g. a new process without a shared metastore).
    Tables that are registered already are pointed to the lake's current versions; nothing is copied."""
    names = []
    for layer, table in MATERIALIZED:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root.rstrip('/')}/{layer}'")
        names.append(tables.attach_table(spark, f"{layer}.{table}", f"{root.rstrip('/')}/{layer}/{table}"))
    tables.create_catalog_view(spark, ENRICHED_VIEW, silver.enriched_view_sql("silver.fhvhv_trips_clean",
                                                                              "bronze.taxi_zones"))
    return names
