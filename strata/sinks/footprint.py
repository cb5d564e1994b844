"""Table footprint: rows, bytes on disk, uncompressed bytes, compression ratio.

The file list comes from the table's file index (metadata the driver holds
anyway); the footers are then read *on the executors*, one task per slice
of files, with ``mapInPandas``.  Nothing but per-file numbers returns.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.exprs import human_bytes

_FILE_STATS = "file string, rows long, bytes_on_disk long, bytes_uncompressed long"


def _footer_reader():
    """The per-task footer reader.  Built as a closure with local imports so
    that it is shipped to executors by value: workers need pyarrow, not this
    package."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd_
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        for b in batches:
            out = []
            for path in b["file"]:
                # Hadoop's name of the S3 scheme is not pyarrow's
                fs, p = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                size = fs.get_file_info(p).size
                with fs.open_input_file(p) as f:
                    md = pq.ParquetFile(f).metadata
                    raw = sum(md.row_group(i).total_byte_size for i in range(md.num_row_groups))
                    out.append((path, md.num_rows, size, raw))
            yield pd_.DataFrame(out, columns=["file", "rows", "bytes_on_disk", "bytes_uncompressed"])
    return read


def file_stats(spark: SparkSession, files: list[str]) -> DataFrame:
    slices = max(1, min(len(files), spark.sparkContext.defaultParallelism))
    lst = spark.createDataFrame([(f,) for f in files], "file string").repartition(slices)
    return lst.mapInPandas(_footer_reader(), _FILE_STATS)


def row_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table, rows): a plain count of each given DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table"), "rows")
             for (layer, name), df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy("layer", "table")


def table_footprint(spark: SparkSession, tables: dict[tuple[str, str], str]) -> DataFrame:
    """One row per (layer, table); ``tables`` maps it to a table name or a path.

    Raises if none of the tables has any file (nothing was built yet).
    """
    parts = []
    for (layer, name), source in tables.items():
        df = spark.table(source) if "/" not in source else spark.read.parquet(source)
        files = df.inputFiles()
        if files:
            parts.append(file_stats(spark, files).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("table"), "*"))
    if not parts:
        raise RuntimeError("no table found in bronze/silver/gold; build the layers first")
    allf = parts[0]
    for p in parts[1:]:
        allf = allf.unionByName(p)
    g = allf.groupBy("layer", "table").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"),
        F.sum("bytes_on_disk").alias("bytes_on_disk"),
        F.sum("bytes_uncompressed").alias("bytes_uncompressed"))
    ratio = F.when(F.col("bytes_on_disk") > 0, F.col("bytes_uncompressed") / F.col("bytes_on_disk")) \
        .otherwise(F.lit(0.0))
    return (g.withColumn("compression_ratio", F.round(ratio, 2))
             .withColumn("on_disk_h", human_bytes(F.col("bytes_on_disk")))
             .withColumn("raw_h", human_bytes(F.col("bytes_uncompressed")))
             .orderBy("layer", "table"))
