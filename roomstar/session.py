"""Session setup, shared folders and the few runtime settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Settings every job needs, whatever session it runs in. Calendar dates and window
# boundaries are computed in UTC; Parquet timestamps are written as INT64 micros so the
# footer carries min/max statistics (INT96 has none, so no row-group skipping).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Merge small shuffle partitions up to the advisory size rather than keeping one per
    # core: fewer, fuller tasks (the setting Spark's tuning guide gives for busy clusters).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}
# Bytes of a batch that goes to a Python worker. The limit on rows alone (10,000) makes batches of
# documents tens of megabytes large, and an executor holds several copies of one for each core.
BATCH_CONF = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
# Bytes that a task reads. Files and shuffles are compressed: Spark's 64 MB of the fact's shuffle are
# 2.7 million rows, which an aggregation or a sort holds in ten times the memory. These sizes are
# for executors of a few GB; a cluster with more sets its own.
TASK_CONF = {"spark.sql.files.maxPartitionBytes": str(16 << 20),
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(8 << 20)}
ROWS_PER_PARTITION = 250_000  # least rows of a shuffle partition in a job of known size


def submitted(key: str) -> bool:
    """Whether spark-submit (or PYSPARK_SUBMIT_ARGS) has set a key; such a value is kept."""
    if f"{key}=" in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        return True
    if "PYSPARK_GATEWAY_PORT" not in os.environ:
        return False
    SparkContext._ensure_initialized()
    return SparkConf().contains(key)


def build_session(master: str | None = None, app: str = "roomstar",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests, bench and the command line. On a cluster pass master=None."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.streaming.schemaInference": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **RUNTIME_CONF,
    }
    if (master or "").startswith("local"):  # a cluster's width and memory are the submitter's to set
        conf["spark.driver.memory"] = "8g"
        conf["spark.sql.shuffle.partitions"] = str(os.cpu_count() or 8)
    conf = {k: v for k, v in conf.items() if not submitted(k)}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in {**conf, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (e.g. one the caller built)."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    small_batches(spark)
    for k, v in TASK_CONF.items():
        if not submitted(k):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def small_batches(spark: SparkSession, size: int | None = None) -> None:
    """Bound the bytes of Arrow batches, unless the submitter has."""
    if not submitted(BATCH_CONF[0]):
        spark.conf.set(BATCH_CONF[0], str(size) if size else BATCH_CONF[1])


@contextmanager
def partitions_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """At least one shuffle partition for every ROWS_PER_PARTITION of ``rows``, so that what a task
    holds does not grow with the table; AQE merges those that turn out small."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), rows // ROWS_PER_PARTITION)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def few_files(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` narrow rows, in no more partitions than the cluster has cores or
    ROWS_PER_PARTITION asks for. On ``file://`` the executor's JVM starts a process for every file
    that it writes, and until that one runs it counts as a second JVM of the same size."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(cores, -(-rows // ROWS_PER_PARTITION)))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or a directory already set on the
    context). Only a local-mode session without one gets a private temporary folder, as
    in tests; on a cluster an unset value is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="roomstar-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running roomstar jobs")
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the shared checkpoint folder; a fresh one when no parts are given."""
    base = checkpoint_dir(spark).rstrip("/")
    tail = "/".join(parts) if parts else uuid.uuid4().hex
    return f"{base}/work/{tail}"
