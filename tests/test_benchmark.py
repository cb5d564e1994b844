"""Event-log parsing and the client/engine merge of the layer benchmark."""

import json
import os

from strata.operators import history
from strata.plans import benchmark as B

T1, T2 = "tcc_bench|r|Q1|gold|i1", "tcc_bench|r|Q1|gold|i2"


def _events():
    return [
        {"Event": B.SQL_START, "executionId": 0, "jobGroupId": T1, "time": 1_000},
        {"Event": B.JOB_START, "Job ID": 0, "Stage IDs": [0, 1], "Properties": {"spark.jobGroup.id": T1}},
        {"Event": B.TASK_END, "Stage ID": 0, "Task Metrics": {"Peak Execution Memory": 10,
                                                               "Input Metrics": {"Bytes Read": 100, "Records Read": 7}}},
        {"Event": B.TASK_END, "Stage ID": 1, "Task Metrics": {"Peak Execution Memory": 30,
                                                               "Input Metrics": {"Bytes Read": 50, "Records Read": 3}}},
        {"Event": B.SQL_END, "executionId": 0, "time": 1_250, "errorMessage": ""},
        # a second query of the same group reuses stage 1 (skipped): counted once
        {"Event": B.SQL_START, "executionId": 1, "jobGroupId": T1, "time": 1_300},
        {"Event": B.JOB_START, "Job ID": 1, "Stage IDs": [1, 2], "Properties": {"spark.jobGroup.id": T1}},
        {"Event": B.TASK_END, "Stage ID": 2, "Task Metrics": {"Peak Execution Memory": 5,
                                                               "Input Metrics": {"Bytes Read": 0, "Records Read": 0}}},
        {"Event": B.SQL_END, "executionId": 1, "time": 1_400, "errorMessage": ""},
        # a failed query
        {"Event": B.SQL_START, "executionId": 2, "jobGroupId": T2, "time": 2_000},
        {"Event": B.SQL_END, "executionId": 2, "time": 2_100, "errorMessage": "boom"},
    ]


def test_engine_log_from_event_log(spark, scratch):
    path = os.path.join(scratch, "app.inprogress")
    with open(path, "w") as f:
        for e in _events():
            f.write(json.dumps(e) + "\n")
        f.write('{"Event": "SparkListenerTaskEnd", "Stage ID": 3, "Task Me')   # torn last line
    log = {r.log_comment: r for r in B.engine_log_from_event_log(spark, path).collect()}
    a = log[T1]
    assert (a.query_duration_ms, a.read_rows, a.read_bytes, a.memory_usage, a.type) == \
        (400, 10, 150, 30, "QueryFinish")
    assert log[T2].type == "ExceptionWhileProcessing"

    client = spark.createDataFrame([("r", "Q1", "gold", 1, T1, 300.0, 9), ("r", "Q1", "gold", 2, T2, 310.0, 9)],
                                   "run_id string, question_id string, layer string, iteration int, tag string,"
                                   " wall_ms double, result_rows long")
    merged = {r.iteration: r for r in history.enrich_with_engine_log(
        client, B.engine_log_from_event_log(spark, path)).collect()}
    assert (merged[1].query_duration_ms, merged[1].result_rows) == (400, 9)
    assert merged[2].query_duration_ms == 0            # failed query: no finished entry


def test_tag_layout():
    assert B.tag("r7", "Q2", "silver", 3) == "tcc_bench|r7|Q2|silver|i3"
