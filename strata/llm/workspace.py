"""Tables between the steps of an operator, in the shared folder, removed as soon as nothing reads them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.session import scratch_path
from strata.sinks.versions import delete_path


class Workspace:
    """One folder for the tables of one run of an operator.

    ``write`` stores a table and reads it back, so that later steps, lost tasks too, start from it.  ``drop`` removes
    tables that no lazy DataFrame reads any more; what the operator returns stays until ``close``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        self._made = 0

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self._made += 1
        path = f"{self.path}/{self._made:03d}-{name}"
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._workspace_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            delete_path(self.spark, table._workspace_path)

    def close(self) -> None:
        delete_path(self.spark, self.path)
