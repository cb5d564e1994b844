"""The layer benchmark: client timings joined with Spark's own event log.

Each measured run executes under a Spark job group named by its tag
(``tcc_bench|run|question|layer|iN``).  Spark's event log (JSON lines in the
folder named by ``spark.eventLog.dir``) then plays the engine's query log:
per tag it yields the engine-side duration (first SQL execution start to
last end), rows and bytes read by the scans, and peak task execution memory.
The log is read with Spark and joined to the client timings by
:func:`strata.operators.history.enrich_with_engine_log` — the same join the
history reports use — and the merged rows can be appended to the results
table.

Only the timing loop itself runs on the driver (it is client-side timing by
definition); everything derived from the log is a Spark job.
"""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sinks.versions import hadoop_path

# fixed values: event names in Spark's event log
SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
SQL_END = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd"
JOB_START = "SparkListenerJobStart"
TASK_END = "SparkListenerTaskEnd"

EVENT_LOG_CONF = {
    "spark.eventLog.enabled": "true",
    "spark.eventLog.compress": "false",          # plain JSON lines, readable by spark.read
    "spark.eventLog.rolling.enabled": "false",
}


def tag(run_id: str, question: str, layer: str, iteration: int) -> str:
    """The tag that ``exprs.bench_tag`` builds in a column."""
    # fixed values: tag prefix and layout
    return f"tcc_bench|{run_id}|{question}|{layer}|i{iteration}"


def measure(spark: SparkSession, cases: dict[tuple[str, str], Callable[[], DataFrame]], run_id: str,
            warmups: int = 2, measured: int = 5) -> tuple[DataFrame, dict[tuple[str, str], list[float]]]:
    """Run every (question, layer) case: ``warmups`` discarded runs, then
    ``measured`` runs, each under its own job group.  Returns the client rows
    (run_id, question_id, layer, iteration, tag, wall_ms, result_rows) and the
    raw wall times in seconds per case."""
    sc = spark.sparkContext
    rows, walls = [], {}
    for (question, layer), make in cases.items():
        sc.setJobGroup(f"warmup|{run_id}", "warm-up", interruptOnCancel=False)
        for _ in range(warmups):
            make().collect()
        walls[(question, layer)] = []
        for i in range(1, measured + 1):
            t = tag(run_id, question, layer, i)
            sc.setJobGroup(t, t, interruptOnCancel=False)
            t0 = time.perf_counter()
            out = make().collect()
            wall = time.perf_counter() - t0
            walls[(question, layer)].append(wall)
            rows.append((run_id, question, layer, i, t, wall * 1000.0, len(out)))
    sc.setJobGroup(f"report|{run_id}", "report", interruptOnCancel=False)
    schema = ("run_id string, question_id string, layer string, iteration int, tag string, "
              "wall_ms double, result_rows long")
    return spark.createDataFrame(rows, schema), walls


def event_log_path(spark: SparkSession) -> str:
    """This application's event log file, in progress or done, on whatever file system Spark writes it to."""
    base = f"{spark.sparkContext.getConf().get('spark.eventLog.dir').rstrip('/')}/{spark.sparkContext.applicationId}"
    fs, path = hadoop_path(spark, f"{base}.inprogress")
    return f"{base}.inprogress" if fs.exists(path) else base


def engine_log_from_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Engine-side log per job group, in the shape the history join expects:
    log_comment, query_duration_ms, read_rows, read_bytes, memory_usage,
    result_rows (NULL: not in the log), type, event_time."""
    raw = spark.read.text(path)
    j = lambda p: F.get_json_object("value", p)
    ev = j("$.Event")
    starts = raw.filter(ev == SQL_START).select(
        j("$.executionId").cast("long").alias("exec_id"), j("$.jobGroupId").alias("tag"),
        j("$.time").cast("long").alias("t0"))
    ends = raw.filter(ev == SQL_END).select(
        j("$.executionId").cast("long").alias("exec_id"), j("$.time").cast("long").alias("t1"),
        j("$.errorMessage").alias("err"))
    execs = (starts.filter(F.col("tag").isNotNull()).join(ends, "exec_id", "left")
             .groupBy("tag").agg(F.min("t0").alias("t0"), F.max("t1").alias("t1"),
                                 F.count_if(F.coalesce(F.length("err"), F.lit(0)) > 0).alias("errors"),
                                 F.count_if(F.col("t1").isNull()).alias("unfinished")))
    jobs = raw.filter(ev == JOB_START).select(
        j("$['Job ID']").cast("long").alias("job_id"),
        j("$.Properties['spark.jobGroup.id']").alias("tag"),
        F.explode(F.from_json(j("$['Stage IDs']"), "array<long>")).alias("stage_id"))
    # a stage listed by several jobs (reused shuffle) belongs to the first one
    stage_tag = (jobs.filter(F.col("tag").isNotNull()).groupBy("stage_id")
                 .agg(F.min_by("tag", "job_id").alias("tag")))
    tasks = raw.filter(ev == TASK_END).select(
        j("$['Stage ID']").cast("long").alias("stage_id"),
        j("$['Task Metrics']['Input Metrics']['Records Read']").cast("long").alias("records"),
        j("$['Task Metrics']['Input Metrics']['Bytes Read']").cast("long").alias("bytes"),
        j("$['Task Metrics']['Peak Execution Memory']").cast("long").alias("peak"))
    io = (tasks.join(stage_tag, "stage_id")
          .groupBy("tag").agg(F.sum("records").alias("read_rows"), F.sum("bytes").alias("read_bytes"),
                              F.max("peak").alias("memory_usage")))
    out = execs.join(io, "tag", "left")
    return out.select(
        F.col("tag").alias("log_comment"),
        (F.col("t1") - F.col("t0")).alias("query_duration_ms"),
        F.coalesce("read_rows", F.lit(0).cast("long")).alias("read_rows"),
        F.coalesce("read_bytes", F.lit(0).cast("long")).alias("read_bytes"),
        F.coalesce("memory_usage", F.lit(0).cast("long")).alias("memory_usage"),
        F.lit(None).cast("long").alias("result_rows"),
        F.when((F.col("errors") == 0) & (F.col("unfinished") == 0), F.lit("QueryFinish"))
         .otherwise(F.lit("ExceptionWhileProcessing")).alias("type"),
        F.timestamp_millis(F.col("t1")).cast("timestamp_ntz").alias("event_time"))


def medians(walls: dict[tuple[str, str], list[float]]) -> dict[tuple[str, str], float]:
    return {k: statistics.median(v) for k, v in walls.items()}
