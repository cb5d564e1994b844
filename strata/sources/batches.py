"""Idempotent batch ingest: monthly landing files into a partitioned table, each batch once (SRC-1, SET-2).

A batch (a month) is all landing files whose path names it.  The ledger remembers for each batch what it was made of: the
number of files and a fingerprint of their paths, sizes and modification times.  A run lists the landing folder, drops
the batches that the ledger knows in this form, and reads only the others.  Their rows overwrite their own partitions of
the target and nothing else, so a batch that was corrected replaces its former rows, and a run that is repeated, or that
died before it could note what it did, puts the same rows into the same place.

The ledger is written after the rows.  If a run dies between the two, the next one ingests these batches again.  A batch
whose files have all gone from the landing folder stays as it is.

The listing is Spark's own (sizes and times only, no content), so it works on any store.  Batch names and the paths of
changed batches are the only things that reach the driver, which needs them to plan the read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.versions import list_names
from strata.sources.landing import check_files

_LEDGER = "batch string, files long, bytes long, fingerprint decimal(38,0), ingested_at timestamp"


def landed_files(spark: SparkSession, landing: str, pattern: str) -> DataFrame:
    """(batch, path, length, modified) of the landing files; ``pattern`` is a regex whose first group names the batch."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(landing))
    return files.select(F.regexp_extract("path", pattern, 1).alias("batch"), "path", "length",
                        F.col("modificationTime").alias("modified")).where("batch <> ''")


def _fingerprints(files: DataFrame) -> DataFrame:
    # a sum of hashes doesn't depend on the order of the listing
    return files.groupBy("batch").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"),
        F.sum(F.xxhash64("path", "length", "modified").cast("decimal(38,0)")).alias("fingerprint"))


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """What the target's ledger says of each batch: its latest entry."""
    path = f"{target}.ledger"
    entries = spark.read.schema(_LEDGER).parquet(path) if list_names(spark, path) else spark.createDataFrame([], _LEDGER)
    latest = F.max_by(F.struct("files", "bytes", "fingerprint", "ingested_at"), "ingested_at")
    return entries.groupBy("batch").agg(latest.alias("e")).select("batch", "e.*")


def ingest_batches(spark: SparkSession, landing: str, target: str, pattern: str, column: str = "batch",
                   transform: Callable[[DataFrame], DataFrame] | None = None, check_drift: bool = True) -> list[str]:
    """Bring the target up to date with the landing folder; returns the names of the batches that were (re)ingested.

    Rows get the batch's name in ``column``, by which the target is partitioned.  Files with other columns or types than
    the first one are refused before anything is written; ``transform`` is applied to the rows of the new batches.
    """
    files = landed_files(spark, landing, pattern)
    now = _fingerprints(files)
    known = ledger(spark, target).select("batch", "files", "fingerprint")
    changed = now.join(known, ["batch", "files", "fingerprint"], "left_anti")
    todo = files.join(changed.select("batch"), "batch").select("batch", "path").collect()
    if not todo:
        return []
    paths = sorted(r["path"] for r in todo)
    schema = check_files(spark, paths) if check_drift else spark.read.parquet(paths[0]).schema
    rows = spark.read.schema(schema).parquet(*paths).withColumn(
        column, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))
    if transform:
        rows = transform(rows)
    (rows.write.partitionBy(column).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(target))
    # the entries describe the files as they were listed for this run, not as they may be by now
    names = sorted({r["batch"] for r in todo})
    made = changed.where(F.col("batch").isin(names)).withColumn("ingested_at", F.current_timestamp())
    made.select(*[f.split()[0] for f in _LEDGER.split(", ")]).coalesce(1).write.mode("append").parquet(f"{target}.ledger")
    return names
