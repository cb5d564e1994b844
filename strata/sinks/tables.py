"""Table sinks: layer namespaces, sorted full-refresh writes, views, appends,
compaction and the ingest audit (SNK-1..8).  Refresh and compaction commit versions (``sinks.versions``)."""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, CalendarIntervalType, DecimalType, MapType, StringType, StructType,
                               VariantType)

from strata.sinks.versions import VersionedTable, delete_path, list_names

# fixed values: layer namespaces, created with their literal names
LAYERS = ("bronze", "silver", "gold")
RESULTS_NAMESPACE = "benchmark"


def create_layers(spark: SparkSession, root: str | None = None,
                  names=(*LAYERS, RESULTS_NAMESPACE)) -> list[str]:
    """Idempotent ``CREATE DATABASE IF NOT EXISTS`` per layer.

    With ``root`` each namespace lives in ``root/<name>``; otherwise under the
    session's warehouse directory.
    """
    for n in names:
        loc = os.path.join(root, n) if root else None
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}" + (f" LOCATION '{loc}'" if loc else ""))
        if loc and _db_location(spark, n) != _db_location_of_path(loc):
            # the namespace exists from an earlier run elsewhere: tables written
            # from now on go to the requested root
            spark.sql(f"ALTER DATABASE {n} SET LOCATION '{loc}'")
    return list(names)


def _db_location(spark: SparkSession, name: str) -> str:
    return spark.catalog.getDatabase(name).locationUri.rstrip("/")


def _db_location_of_path(path: str) -> str:
    return (path if "://" in path else "file:" + os.path.abspath(path)).rstrip("/")


def layout(df: DataFrame, sort_by: list[str] | None, files: int | None = None,
           how: str = "range") -> DataFrame:
    """Cluster rows by the table's key so that Parquet row-group min/max
    statistics skip data for predicates on the key.

    ``how="range"`` range-partitions then sorts each partition: every file
    covers a disjoint key range (one shuffle of the table).  ``how="local"``
    only sorts within the existing partitions: no shuffle, and nearly as good
    when the input is already clustered by the key (e.g. one landing file per
    month for a time key).  Without ``files`` the partition count comes from
    the session and AQE coalesces small ranges toward the advisory size.
    """
    if not sort_by:
        return df.repartition(files) if files is not None else df
    keys = [F.col(k) for k in sort_by]
    if how == "local" and files is None:
        return df.sortWithinPartitions(*keys)
    if how not in ("range", "local"):
        raise ValueError("how must be 'range' or 'local'")
    parts = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return parts.sortWithinPartitions(*keys)


def write_table(df: DataFrame, table: str, sort_by: list[str] | None = None, files: int | None = None,
                fmt: str = "parquet", how: str = "range", metrics: dict[str, Column] | None = None,
                check: Callable[[DataFrame, dict], None] | None = None, keep: int = 1) -> str:
    """Full refresh of a table: staged, checked, then current in one step.

    The rows go to a fresh folder of the table's versions; until they are complete and ``check`` has passed, the table
    is as it was, for this and for every other session.  Queries planned on the old version go on reading it: ``keep``
    earlier versions stay.  The catalog then points to the new folder.
    """
    spark = df.sparkSession
    versions = VersionedTable(spark, table_path(spark, table))
    version = versions.refresh(layout(df, sort_by, files, how), fmt, metrics, check)
    register(spark, table, version.folder, fmt)
    versions.vacuum(keep)
    return table


def table_path(spark: SparkSession, table: str) -> str:
    """Where a table of this name belongs: a folder of its database."""
    database, _, name = table.rpartition(".")
    return f"{_db_location(spark, database or spark.catalog.currentDatabase())}/{name}"


def register(spark: SparkSession, table: str, folder: str, fmt: str = "parquet") -> None:
    """Point the catalog's table to a folder; rows of the same columns take one metadata step."""
    schema = spark.read.format(fmt).load(folder).schema
    if spark.catalog.tableExists(table):
        if _location(spark, table) == folder:
            spark.catalog.refreshTable(table)
            return
        same = [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in schema]
        if same and _provider(spark, table) == fmt:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")    # other columns: the entry is made anew, the files of its versions stay
    spark.catalog.createTable(table, path=folder, source=fmt, schema=schema)


def write_path(df: DataFrame, path: str, sort_by: list[str] | None = None, files: int | None = None,
               mode: str = "overwrite") -> str:
    layout(df, sort_by, files).write.mode(mode).parquet(path)
    return path


def create_view(df: DataFrame, name: str) -> str:
    """View of this session: the definition is kept, nothing is computed."""
    df.createOrReplaceTempView(name)
    return name


def create_catalog_view(spark: SparkSession, name: str, select: str) -> str:
    """View materialization: the definition is stored in the catalog under
    ``database.name``, for every session that shares it."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {select}")
    return name


# fixed values: measurement table columns, in table order
RESULT_COLUMNS = ("run_id", "captured_at", "question_id", "layer", "iteration", "wall_ms",
                  "query_duration_ms", "read_rows", "read_bytes", "memory_usage", "result_rows")


def measurement_rows(rows: DataFrame) -> DataFrame:
    """Rows as they are appended: the table's columns by *name*, in its order;
    ``captured_at`` defaults to now."""
    if "captured_at" not in rows.columns:
        rows = rows.withColumn("captured_at", F.current_timestamp().cast("timestamp_ntz"))
    return rows.select(*RESULT_COLUMNS)


def append_measurements(spark: SparkSession, rows: DataFrame, table: str) -> str:
    """Append ``measurement_rows`` to a table."""
    measurement_rows(rows).write.mode("append").saveAsTable(table)
    return table


# fixed values: what identifies a measurement
MEASUREMENT_KEY = ("run_id", "question_id", "layer", "iteration")


def append_once(rows: DataFrame, path: str, keys: tuple[str, ...] = MEASUREMENT_KEY, latest: str = "captured_at") -> str:
    """Append rows to the Parquet table at ``path``, each key once, however often the append is repeated.

    Rows whose key the table has already are left out (NULL equals NULL), so an append whose outcome is unknown can
    simply be repeated.  Of rows with equal keys in one batch the one with the greatest ``latest`` goes in.  Spark's
    commit makes a batch visible as a whole: a run that dies in the middle leaves no rows.
    """
    spark = rows.sparkSession
    others = [c for c in rows.columns if c not in keys and c != latest]
    one = rows.groupBy(*keys).agg(F.max(F.struct(F.col(latest), *[F.col(c) for c in others])).alias("_r"))
    batch = one.select(*keys, "_r.*").select(*rows.columns)
    if list_names(spark, path):
        there = spark.read.schema(rows.schema).parquet(path).select(*[F.col(k).alias(f"_t_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]
        batch = batch.join(there, reduce(Column.__and__, same), "left_anti")
    batch.write.mode("append").parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, buckets: int, by: list[str], sort_by: list[str],
                   path: str | None = None) -> str:
    """Full refresh of a table that is dealt into ``buckets`` files by the hash of ``by`` and sorted inside them.

    Grouping by all of ``by`` (or more columns), and joins with a table dealt alike on the same columns, need no shuffle.
    """
    # one task per bucket: otherwise every task would write a file into each
    writer = df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*sort_by).mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return table


def file_ranges(df: DataFrame, key: str) -> DataFrame:
    """(file, rows, lo, hi): the range of a key in every file of a stored table."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(key).alias("lo"), F.max(key).alias("hi"))


def overlapping_files(df: DataFrame, key: str) -> DataFrame:
    """(files, overlaps, rows): how many files reach into the key range of files that start earlier.

    Where none does, a predicate on the key reads only the files of its range.  The window is over one row per file.
    """
    earlier = Window.orderBy("lo", "hi", "file").rowsBetween(Window.unboundedPreceding, -1)
    ranges = file_ranges(df, key).withColumn("reach", F.max("hi").over(earlier))
    return ranges.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("reach") > F.col("lo")).alias("overlaps"),
                      F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))


#: size of a file that compaction aims at
TARGET_FILE_BYTES = 256 << 20

#: memory that the rows of one file may take where compaction sorts them, which is in one task
SORT_BYTES = 512 << 20


def bytes_on_disk(spark: SparkSession, files: list[str]) -> int:
    """Total size of files, from Spark's own file index (their content is not read)."""
    if not files:
        return 0
    return spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0


def checksum(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free sum of the row hashes."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s")).first()
    return r["n"], int(r["s"] or 0)


# fixed values: sort bytes of a row beside its fields: its length, then pointer and key prefix (16 bytes, twice for the
# sort's own use, and twice again because their array doubles when it is full)
SORT_ENTRY_BYTES = 8 + 4 * 16


def bytes_in_sort(df: DataFrame, rows: int) -> int:
    """About the memory that sorting ``rows`` rows of ``df`` takes, however well they are compressed on disk.

    Each field is a word, and so are the null flags of 64.  What strings and nested values hold beyond that is summed up
    from their columns (of nested ones the text, three times: an element is a word, its text often less); a table without
    such columns isn't read.
    """
    fields = df.schema.fields
    row = 8 * (len(fields) + -(-len(fields) // 64)) + SORT_ENTRY_BYTES
    held = []
    for f in fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            held.append(F.octet_length(f.name))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType)):
            held.append(3 * F.octet_length(F.col(f.name).cast("string")))
        elif isinstance(f.dataType, (DecimalType, CalendarIntervalType)):
            row += 16
    if not held:
        return rows * row
    total = reduce(Column.__add__, [F.coalesce(h, F.lit(0)).cast("long") for h in held])
    return rows * row + (df.agg(F.sum(total)).first()[0] or 0)


def compact(spark: SparkSession, tables: dict[str, list[str] | None], files: int | None = None,
            target_bytes: int = TARGET_FILE_BYTES, keep: int = 1, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """Rewrite each table into few range-sorted files and point it at them.

    The new copy is a version of its own (``sinks.versions``): it is staged, its rows and checksum are compared with
    the original, and one commit makes it current.  Until then the table is as it was; managed, external and attached
    tables are treated alike.  ``keep`` earlier versions stay for queries that still read them.  If the table has been
    refreshed in the meantime, the copy is given up.  ``files`` defaults to the table's bytes over ``target_bytes``; a
    sorted table gets as many as keep the rows of each within ``sort_bytes`` of memory, if that is more (well compressed
    rows take ten times their bytes on disk, and one task sorts a file).  A table that fails is reported and left alone;
    the others still run.  Returns one report row per table.
    """
    report = []
    for table, sort_by in tables.items():
        t0 = time.time()
        try:
            versions = VersionedTable.at_location(spark, _location(spark, table))
            version = versions.current()
            if version:    # the catalog may still name an older one
                register(spark, table, version.folder, version.fmt)
            fmt = version.fmt if version else _provider(spark, table)
            src = spark.table(table)
            before = src.inputFiles()
            old_bytes = bytes_on_disk(spark, before)
            want = checksum(src)
            count = files or max(1, -(-old_bytes // target_bytes),
                                 -(-bytes_in_sort(src, want[0]) // sort_bytes) if sort_by else 0)
            staged = versions.stage(layout(src, sort_by, count), fmt)
            try:
                got = checksum(spark.read.format(fmt).load(staged.folder))
                if got != want:
                    raise RuntimeError(f"rows or checksum changed: {want} -> {got}")
                fresh = versions.commit(staged, after=version.number if version else 0)
            except BaseException:
                versions.discard(staged)
                raise
            register(spark, table, fresh.folder, fmt)
            after = spark.table(table).inputFiles()
            size = bytes_on_disk(spark, after)
            versions.vacuum(keep)
            report.append((table, want[0], len(before), len(after), size, "ok", "", round(time.time() - t0, 3)))
        except Exception as e:  # per-table failure is tolerated
            report.append((table, None, None, None, None, "skipped", str(e)[:200], round(time.time() - t0, 3)))
    schema = ("table string, rows long, files_before long, files_after long, bytes_on_disk long, "
              "status string, error string, seconds double")
    return spark.createDataFrame(report, schema)


def _described(spark: SparkSession, table: str, what: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {table}").where(F.col("col_name") == what).first()["data_type"]


def _location(spark: SparkSession, table: str) -> str:
    return _described(spark, table, "Location").rstrip("/")


def _provider(spark: SparkSession, table: str) -> str:
    return _described(spark, table, "Provider").lower()


def latest_folder(spark: SparkSession, path: str) -> str:
    """The folder that holds the current rows of the table at ``path``, as its log records it."""
    return VersionedTable(spark, path).folder()


def attach_table(spark: SparkSession, table: str, path: str) -> str:
    """Point the catalog to the current version of the table stored at ``path``, also where it named an older one."""
    version = VersionedTable(spark, path).current()
    register(spark, table, version.folder if version else path, version.fmt if version else "parquet")
    return table


def ingest_audit(bronze: DataFrame, batch_col: str = "_batch") -> DataFrame:
    """Rows added per ingest batch and the running total after each batch.

    The running sum is a window over the per-batch counts (one row per
    batch), never over the trips themselves.
    """
    per_batch = bronze.groupBy(F.col(batch_col).alias("batch")).agg(F.count(F.lit(1)).alias("rows_added"))
    running = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return per_batch.withColumn("total_rows", F.sum("rows_added").over(running))
