"""Readers for landing files (SRC-1..4).

All readers are lazy DataFrames; the only eager step is the schema check of
``read_trip_files``: two distributed jobs over the footers, whatever the number
of files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# fixed values: the zone lookup's declared columns
ZONE_SCHEMA = StructType([
    StructField("LocationID", IntegerType()),
    StructField("Borough", StringType()),
    StructField("Zone", StringType()),
    StructField("service_zone", StringType()),
])


class SchemaDriftError(ValueError):
    pass


def read_trip_files(spark: SparkSession, paths: list[str], check_drift: bool = True,
                    with_batch: bool = True) -> DataFrame:
    """Batch Parquet ingest with the schema of the first file.

    All files are read in one distributed scan (the month-by-month loop of a
    memory-bound engine is unnecessary: splits are independent tasks).  Columns
    are matched by *name*.  With ``check_drift`` a column that the first file
    lacks, one that another file lacks, or a type conflict raises
    :class:`SchemaDriftError` instead of silently shifting data.  ``with_batch`` adds ``_batch`` = source file name for audits.
    """
    if not paths:
        raise ValueError("no input files")
    # The first path given (the first month) defines the schema; Spark's file
    # index expands a glob or directory there on any filesystem, and the
    # first file of it in name order is used.
    first_files = sorted(spark.read.parquet(paths[0]).inputFiles())
    if not first_files:
        raise ValueError(f"no Parquet files under {paths[0]}")
    if check_drift:
        first = check_files(spark, spark.read.parquet(*paths).inputFiles(), first_files[0])
    else:
        first = spark.read.parquet(first_files[0]).schema
    df = spark.read.schema(first).parquet(*paths)
    if with_batch:
        df = df.withColumn("_batch", F.col("_metadata.file_name"))
    return df


def check_files(spark: SparkSession, files: list[str], first: str | None = None) -> StructType:
    """Schema of the first file, after checking that all files have its columns and types and no others.

    One Spark job merges the schemas of all footers (extra columns, other types), another one compares each file's
    column names (missing columns); their number doesn't depend on the number of files.
    """
    schema = spark.read.parquet(first or files[0]).schema
    try:
        merged = spark.read.option("mergeSchema", "true").parquet(*files).schema
    except Exception as e:  # incompatible types across files
        raise SchemaDriftError(str(e)) from e
    extra = sorted(set(merged.fieldNames()) - set(schema.fieldNames()))
    if extra:
        raise SchemaDriftError(f"columns not in the first file: {extra}")
    short = files_missing_columns(spark, files, schema.fieldNames())
    if short:
        raise SchemaDriftError(f"{len(short)} file(s) lacking columns of the first file, e.g. {short[:5]}")
    return schema


def files_missing_columns(spark: SparkSession, files: list[str], expected: list[str]) -> list[tuple[str, list[str]]]:
    """(file, missing columns) for every file that lacks an expected column.

    One distributed job opens the footers on the executors.  Files in a store that only Spark's readers can open are
    told apart by those: the task reports them, and their whole content is read in a second job.
    """
    if not files:
        return []
    slices = max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(slices)
    seen = listed.mapInPandas(_missing_columns(expected), _MISSING).where("size(missing) > 0 or not opened").collect()
    found = [(r["file"], r["missing"]) for r in seen if r["opened"]]
    closed = [r["file"] for r in seen if not r["opened"]]
    if closed:
        content = spark.read.format("binaryFile").load(closed).select(F.col("path").alias("file"), "content")
        more = content.mapInPandas(_missing_columns(expected), _MISSING)
        found += [(r["file"], r["missing"]) for r in more.where("size(missing) > 0").collect()]
    return sorted(found)


_MISSING = "file string, missing array<string>, opened boolean"


def _missing_columns(expected: list[str]):
    """The per-task footer reader, shipped by value: workers need pyarrow, not this package."""
    def read(batches):
        import io

        import pandas as pd
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        for b in batches:
            rows = []
            for i, path in enumerate(b["file"]):
                try:
                    if "content" in b.columns:
                        names = set(pq.read_schema(io.BytesIO(b["content"][i])).names)
                    else:
                        fs, p = pafs.FileSystem.from_uri(path)
                        with fs.open_input_file(p) as f:
                            names = set(pq.read_schema(f).names)
                except Exception:
                    if "content" in b.columns:
                        raise
                    rows.append((path, [], False))
                    continue
                rows.append((path, [c for c in expected if c not in names], True))
            yield pd.DataFrame(rows, columns=["file", "missing", "opened"])
    return read


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV (header) into declared types."""
    return spark.read.schema(ZONE_SCHEMA).option("header", True).csv(path)


def parquet_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A view over Parquet files, no copy."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def csv_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A view over a CSV with header and undeclared (string) types; ids are
    cast where they are used."""
    df = spark.read.option("header", True).csv(path)
    df.createOrReplaceTempView(name)
    return df


def read_csv_checked(spark: SparkSession, path: str, schema: StructType, required: tuple[str, ...] = (),
                     header: bool = True) -> DataFrame:
    """CSV into declared types, with the reason for every row that doesn't fit: one pass over the file.

    The columns of ``schema``, then ``_reason`` and ``_line``: both NULL for a good row.  A line with too few or too many
    fields has the reason ``columns``; one with a field that isn't of its type ``type:<column>``, the first such
    column; their columns are NULL.  A row without a value in a ``required`` column has ``missing:<column>`` and keeps its
    values.  ``_line`` is the line as it stands in the file, for a second attempt.  Quotes inside quoted fields are
    doubled.  Select by ``_reason``, or write both kinds at once, partitioned by it.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema])
    declared = StructType([*schema.fields, StructField("_line", StringType())])
    rows = spark.read.schema(declared).options(
        header=header, mode="PERMISSIVE", columnNameOfCorruptRecord="_line", escape='"', columnPruning=False).csv(path)
    # only rejected lines are looked at again, field by field
    fields = F.from_csv(F.col("_line"), text.simpleString()[len("struct<"):-1].replace(":", " "), {"escape": '"'})
    n_fields = F.size(F.split(F.regexp_replace("_line", r'"(?:[^"]|"")*"', "x"), ",", -1))
    bad_type = [F.when(fields[f.name].isNotNull() & fields[f.name].try_cast(f.dataType).isNull(), F.lit(f"type:{f.name}"))
                for f in schema]
    of_line = F.when(n_fields != len(schema.fields), F.lit("columns")).otherwise(F.coalesce(*bad_type, F.lit("malformed")))
    lacking = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in required]
    # a line is only checked for the columns that a query asks for, so the reason asks for all (the condition never holds)
    all_read = F.array_max(F.array(*[F.col(c).isNull().cast("int") for c in schema.fieldNames()])) > 1
    reason = F.when(all_read | F.col("_line").isNotNull(), of_line).otherwise(F.coalesce(*lacking, F.lit(None).cast("string")))
    line = F.coalesce("_line", F.to_csv(F.struct(*schema.fieldNames()), {"escape": '"'}))
    return rows.withColumn("_reason", reason).select(
        *[F.when(F.col("_line").isNull(), F.col(c)).alias(c) for c in schema.fieldNames()], "_reason",
        F.when(F.col("_reason").isNotNull(), line).alias("_line"))
