"""Batch ingest with a ledger, drift checks, CSV with rejects, appends that may be repeated."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from strata.sinks import tables
from strata.sources import batches, landing
from strata.streaming.ingest import ingest_new_files

PATTERN = r"/trips_(\d{4}-\d{2})[^/]*\.parquet"


def land(spark, folder, month, ids, part=""):
    path = f"{folder}/trips_{month}{part}.parquet"
    spark.createDataFrame([(i, f"{month}/{i}") for i in ids], "id long, what string").coalesce(1).write.mode("overwrite").parquet(path)
    return path


def rows(spark, target):
    return sorted((r.batch, r.id) for r in spark.read.schema("id long, what string, batch string").parquet(target).collect())


def test_each_batch_is_there_once_whatever_is_repeated(spark, scratch):
    folder, target = f"{scratch}/landing", f"{scratch}/bronze"
    land(spark, folder, "2023-01", [1, 2, 3])
    land(spark, folder, "2023-02", [4])
    assert batches.ingest_batches(spark, folder, target, PATTERN) == ["2023-01", "2023-02"]
    assert batches.ingest_batches(spark, folder, target, PATTERN) == []
    land(spark, folder, "2023-01", [1, 2, 30, 31])          # corrected
    land(spark, folder, "2023-02", [5], part="_more")       # a second file of the month
    land(spark, folder, "2023-03", [6])
    assert batches.ingest_batches(spark, folder, target, PATTERN) == ["2023-01", "2023-02", "2023-03"]
    assert batches.ingest_batches(spark, folder, target, PATTERN) == []
    want = [("2023-01", 1), ("2023-01", 2), ("2023-01", 30), ("2023-01", 31), ("2023-02", 4), ("2023-02", 5), ("2023-03", 6)]
    assert rows(spark, target) == want
    made = {r.batch: r.files for r in batches.ledger(spark, target).collect()}
    assert made == {"2023-01": 1, "2023-02": 2, "2023-03": 1}


def test_a_run_that_died_before_the_ledger_is_repeated(spark, scratch, monkeypatch):
    folder, target = f"{scratch}/landing", f"{scratch}/bronze"
    land(spark, folder, "2023-01", [1, 2, 3])
    monkeypatch.setattr(batches.F, "current_timestamp", lambda: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        batches.ingest_batches(spark, folder, target, PATTERN)
    monkeypatch.undo()
    assert rows(spark, target) == [("2023-01", i) for i in (1, 2, 3)]
    assert batches.ingest_batches(spark, folder, target, PATTERN) == ["2023-01"]
    assert rows(spark, target) == [("2023-01", i) for i in (1, 2, 3)]


def test_only_new_batches_are_read(spark, scratch):
    """Files of known batches may be unreadable by now; what names no batch is not read at all."""
    folder, target = f"{scratch}/landing", f"{scratch}/bronze"
    path = land(spark, folder, "2023-01", [1])
    batches.ingest_batches(spark, folder, target, PATTERN)
    (name,) = [n for n in os.listdir(path) if n.startswith("part")]
    stat = os.stat(f"{path}/{name}")
    with open(f"{path}/{name}", "r+b") as f:
        f.write(b"\0" * stat.st_size)
    os.utime(f"{path}/{name}", ns=(stat.st_atime_ns, stat.st_mtime_ns))
    with open(f"{folder}/notes.parquet", "wb") as f:
        f.write(b"no parquet")
    land(spark, folder, "2023-02", [2])
    assert batches.ingest_batches(spark, folder, target, PATTERN) == ["2023-02"]
    assert rows(spark, target) == [("2023-01", 1), ("2023-02", 2)]


def test_drift_is_refused_before_anything_is_written(spark, scratch):
    folder, target = f"{scratch}/landing", f"{scratch}/bronze"
    land(spark, folder, "2023-01", [1])
    spark.createDataFrame([(1,)], "id long").write.parquet(f"{folder}/trips_2023-02.parquet")
    with pytest.raises(landing.SchemaDriftError, match="lacking"):
        batches.ingest_batches(spark, folder, target, PATTERN)
    assert not os.path.exists(target)


def _jobs(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    action()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("tests", "tests")
    return n


def test_the_drift_check_takes_the_same_jobs_for_any_number_of_files(spark, scratch):
    for n in (40, 80):      # from 33 paths on Spark lists them in a job of its own
        spark.range(n * 10).repartition(n).write.parquet(f"{scratch}/{n}")
    jobs = {n: _jobs(spark, f"drift-{n}", lambda n=n: landing.read_trip_files(spark, [f"{scratch}/{n}"])) for n in (40, 80)}
    assert jobs[40] == jobs[80] < 10


def test_files_that_only_spark_can_open_are_checked_too(spark, scratch):
    spark.range(3).withColumn("x", F.lit(1)).coalesce(1).write.parquet(f"{scratch}/a")
    spark.range(3).coalesce(1).write.parquet(f"{scratch}/b")
    files = [f.replace("file:", "nosuch:", 1) for f in spark.read.parquet(f"{scratch}/a").inputFiles()]
    read = landing._missing_columns(["id", "x"])
    import pandas as pd
    (out,) = read([pd.DataFrame({"file": files})])
    assert out["opened"].tolist() == [False]
    (name,) = [n for n in os.listdir(f"{scratch}/b") if n.startswith("part")]
    with open(f"{scratch}/b/{name}", "rb") as f:
        (out,) = read([pd.DataFrame({"file": ["x"], "content": [f.read()]})])
    assert out["missing"].tolist() == [["x"]]


def test_the_stream_checks_new_files_only(spark, scratch, monkeypatch):
    from strata.streaming import ingest
    seen = []
    real = ingest.files_missing_columns
    monkeypatch.setattr(ingest, "files_missing_columns", lambda s, files, cols: (seen.append(len(files)), real(s, files, cols))[1])
    schema = spark.createDataFrame([], "id long, what string").schema
    for month in ("2023-01", "2023-02", "2023-03"):
        land(spark, f"{scratch}/landing", month, [1])
        ingest_new_files(spark, f"{scratch}/landing", f"{scratch}/bronze", schema)
    ingest_new_files(spark, f"{scratch}/landing", f"{scratch}/bronze", schema)
    assert seen == [1, 1, 1, 0] and spark.read.parquet(f"{scratch}/bronze").count() == 3


SCHEMA = StructType([StructField("id", IntegerType()), StructField("name", StringType()), StructField("price", DoubleType())])


def test_csv_rows_and_rejects_by_reason(spark, scratch):
    lines = ["id,name,price", "1,a,1.5", "2,\"b, c\",2", "x,d,3", "4,e", "5,f,5,6", "6,g,cheap", "7,,7", ",h,8", "9,\"i \"\"j\"\"\",9", "1e3,k,1"]
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/in.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    df = landing.read_csv_checked(spark, f"{scratch}/in.csv", SCHEMA, required=("id", "name"))
    got = [tuple(r) for r in df.collect()]
    assert got == [
        (1, "a", 1.5, None, None), (2, "b, c", 2.0, None, None), (None, None, None, "type:id", "x,d,3"),
        (None, None, None, "columns", "4,e"), (None, None, None, "columns", "5,f,5,6"), (None, None, None, "type:price", "6,g,cheap"),
        (7, None, 7.0, "missing:name", "7,,7.0"), (None, "h", 8.0, "missing:id", ",h,8.0"), (9, 'i "j"', 9.0, None, None),
        (None, None, None, "type:id", "1e3,k,1")]
    # fewer columns asked for: the same rows are rejected
    assert sorted(r._reason or "" for r in df.select("_reason").collect()) == sorted(r[3] or "" for r in got)
    assert df.where("_reason is null").agg(F.sum("id")).first()[0] == 12


def _measurements(spark, rows):
    return spark.createDataFrame(rows, "run_id string, captured_at timestamp_ntz, question_id string, layer string, iteration int, wall_ms double")


def test_an_append_that_is_repeated_adds_nothing(spark, scratch):
    t = dt.datetime(2024, 1, 1)
    one = _measurements(spark, [("r", t, "q", "gold", i, 1.0 * i) for i in range(5)] + [("r", t, "q", None, 1, 7.0)])
    path = f"{scratch}/m"
    for _ in range(3):
        tables.append_once(one, path)
    later = _measurements(spark, [("r", t, "q", "gold", 4, 99.0), ("r", t, "q", "gold", 5, 5.0),
                                  ("r", t + dt.timedelta(1), "q", "gold", 5, 6.0), ("r", t, "q", None, 1, 8.0)])
    tables.append_once(later, path)
    got = sorted((str(r.layer), r.iteration, r.wall_ms) for r in spark.read.parquet(path).collect())
    assert got == [("None", 1, 7.0)] + [("gold", i, 1.0 * i) for i in range(5)] + [("gold", 5, 6.0)]


def test_overlapping_files_are_counted(spark, scratch):
    for name, lo, hi in (("a", 0, 10), ("b", 10, 20), ("c", 15, 30), ("d", 5, 6)):
        spark.range(lo, hi + 1).coalesce(1).write.parquet(f"{scratch}/{name}")
    df = spark.read.parquet(*[f"{scratch}/{n}" for n in "abcd"])
    assert tuple(tables.overlapping_files(df, "id").first()) == (4, 2, 40)
