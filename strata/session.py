"""Session construction and cluster-provided locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this library relies on.  The session time zone
# matters because trip timestamps are zone-less (TIMESTAMP_NTZ) and the
# derived calendar fields must not shift with the executor's locale.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


# Sizing for a large cluster reading ~100 TB: big input splits, a generous
# initial shuffle width that AQE coalesces toward the advisory size, and
# skew splitting for joins.  Opt-in (``scale=True``); local runs keep defaults.
SCALE_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def build_session(master: str | None = None, app: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, scale: bool = False) -> SparkSession:
    """Create (or reuse) a session with the library's core settings.

    ``master`` is only set when given, so on a cluster the launcher's
    master wins.  The UI stays off: nothing here serves pages or ports.
    """
    b = (SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    # later entries win: core settings, then the scale sizing, then explicit
    # arguments
    settings = {**CORE_CONF, **(SCALE_CONF if scale else {})}
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # a reused session keeps its old values unless the SQL settings are re-applied
    for k, v in settings.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; that value is always
    used when present.  Only when it is unset (local tests) a fresh scratch
    folder is created and registered on the session.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(a machine-local temporary folder is only valid in local mode)")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table: in this application's folder under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"strata-{spark.sparkContext.applicationId}", name)


def remove_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that still read them must have been written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
