"""Incremental ingest with Structured Streaming.

The pipeline's hourly full refresh re-reads every landing file.  The same
ingest can instead run as a file stream triggered with ``availableNow``:
each run picks up only files it has not seen, processes them in one or more
micro-batches and stops.  Offsets and the file sink's commit log live in the
checkpoint folder, so a run that loses executors (or the driver) is simply
re-run and neither drops nor duplicates a file.

Silver cleaning is a stateless row filter + projection, so it runs on the
stream unchanged; gold aggregates stay batch jobs over the stored silver
table.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators import silver
from strata.session import checkpoint_dir
from strata.sinks.versions import list_names
from strata.sources.landing import SchemaDriftError, files_missing_columns


def landing_stream(spark: SparkSession, landing_dir: str, schema: StructType,
                   max_files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files under ``landing_dir`` as a stream (schema is fixed,
    as in the batch ingest: the first file's schema)."""
    r = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_batch:
        r = r.option("maxFilesPerTrigger", max_files_per_batch)
    return r.parquet(landing_dir).withColumn("_batch", F.col("_metadata.file_name"))


def _run(df: DataFrame, out_path: str, checkpoint: str) -> int:
    """Process what is there; the number of micro-batches committed so far,
    over all runs of this checkpoint (a batch without new files isn't one)."""
    q = (df.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    last = q.lastProgress
    return 0 if last is None else last["batchId"] + int(last["numInputRows"] > 0)


def _check_new_files(spark: SparkSession, landing_dir: str, schema: StructType, checked: str) -> None:
    """Refuse files that lack a column; ``checked`` remembers the files that earlier runs have looked into."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .load(landing_dir).select("path", "modificationTime", "length"))
    new = listed
    if list_names(spark, checked):
        new = listed.join(spark.read.schema(listed.schema).parquet(checked), listed.columns, "left_anti")
    rows = new.collect()    # the files of this run
    short = files_missing_columns(spark, [r["path"] for r in rows], schema.fieldNames())
    if short:
        raise SchemaDriftError(f"{len(short)} file(s) lacking columns of the schema, e.g. {short[:5]}")
    if rows:
        spark.createDataFrame(rows, listed.schema).coalesce(1).write.mode("append").parquet(checked)


def ingest_new_files(spark: SparkSession, landing_dir: str, bronze_path: str, schema: StructType,
                     checkpoint: str | None = None, silver_path: str | None = None,
                     window=silver.DEFAULT_WINDOW, check_drift: bool = True) -> dict[str, int]:
    """Append the not-yet-seen landing files to bronze (and, with
    ``silver_path``, their cleaned rows to silver).  Returns the number of
    micro-batches that each stream has committed.

    The default checkpoint belongs to the landing folder and the target, so
    another target starts from the first file.  New files lacking a column of
    ``schema`` are refused, as in the batch ingest.
    """
    key = hashlib.sha256(f"{landing_dir}\n{bronze_path}\n{silver_path}".encode()).hexdigest()[:16]
    root = checkpoint or os.path.join(checkpoint_dir(spark), f"ingest-{key}")
    if check_drift:
        _check_new_files(spark, landing_dir, schema, os.path.join(root, "checked"))
    src = landing_stream(spark, landing_dir, schema)
    out = {"bronze": _run(src, bronze_path, os.path.join(root, "bronze"))}
    if silver_path:
        out["silver"] = _run(silver.clean(src.drop("_batch"), window), silver_path,
                             os.path.join(root, "silver"))
    return out
