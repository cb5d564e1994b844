"""Wire the layers together over one input directory.

``Medallion`` builds each layer lazily from the one below it, exactly like the
model graph: bronze trips -> clean -> {daily, hourly, driver, shared};
clean + zones -> enriched -> pairs.  Nothing is computed until an action;
``materialize`` (in :mod:`strata.plans.pipeline`) writes the layers out so
that later reads start from the stored tables instead of the lineage.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from strata.operators import gold, silver
from strata.sources import fixtures


class Medallion:
    """Lazily composed bronze / silver / gold DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 window=None, minute_mode: str = "boundary",
                 bronze_trips: DataFrame | None = None, bronze_zones: DataFrame | None = None):
        """``sf_dir`` reads the shared test tables through the fixture adapter;
        otherwise pass ``bronze_trips`` / ``bronze_zones``.  The trip window
        defaults to the fixture year for the test tables and to the
        production window (2023) for real inputs."""
        self.spark = spark
        self.sf_dir = sf_dir
        if window is None:
            window = fixtures.FIXTURE_WINDOW if bronze_trips is None else silver.DEFAULT_WINDOW
        self.window = window
        self.minute_mode = minute_mode
        self._trips = bronze_trips
        self._zones = bronze_zones

    @cached_property
    def bronze_trips(self) -> DataFrame:
        return self._trips if self._trips is not None else fixtures.bronze_trips(self.spark, self.sf_dir)

    @cached_property
    def bronze_zones(self) -> DataFrame:
        return self._zones if self._zones is not None else fixtures.bronze_zones(self.spark, self.sf_dir)

    @cached_property
    def clean(self) -> DataFrame:
        return silver.clean(self.bronze_trips, self.window, self.minute_mode)

    @cached_property
    def enriched(self) -> DataFrame:
        return silver.enrich(self.clean, self.bronze_zones)

    def models(self) -> dict[str, DataFrame]:
        """Every silver and gold model by table name (all lazy), as the data
        tests need them: no test looks at the percentiles, so they are left out."""
        out = {"fhvhv_trips_clean": self.clean, "fhvhv_trips_enriched": self.enriched}
        out.update({name: self.gold(name, **({"percentiles": "none"} if name == "daily_revenue" else {}))
                    for name in gold.GOLD_MODELS})
        return out

    def gold(self, name: str, **kw) -> DataFrame:
        source, fn = gold.GOLD_MODELS[name]
        return fn(self.clean if source == "clean" else self.enriched, **kw)
