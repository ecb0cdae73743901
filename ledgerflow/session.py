"""SparkSession construction and run-context helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on; AQE coalesces small partitions and splits skewed join
# partitions at runtime. How many partitions it starts from is set by ``size_shuffles``.
JOB_CONFIGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerflow") -> SparkSession:
    """Return the active session, creating a local one for tests and benches."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is also the only executor
            builder = builder.config("spark.driver.memory", os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "16g"))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in JOB_CONFIGS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_job_configs(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_job_configs(spark: SparkSession) -> None:
    for k, v in JOB_CONFIGS.items():  # all can be set on a running session
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``. Only in local mode, where the
    driver is the only executor, a missing one is set to a temporary folder."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master is {master})")
        current = tempfile.mkdtemp(prefix="ledgerflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


# A row of the ledger tables takes some twenty times its shuffled bytes in sorts and hash
# tables: a task is given at most so many of them, whatever the size of the input.
TASK_SHUFFLE_BYTES = 16 << 20
# Parquet bytes of the input for each partition that a shuffle starts with.
INPUT_BYTES_A_PARTITION = 4 << 20
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Shuffles start with a number of partitions that grows with the input, and AQE merges
    them up to ``TASK_SHUFFLE_BYTES``, so that what one task holds does not grow. The
    cluster's own numbers stay where they are more, or smaller, than these."""
    own = spark.sparkContext.getConf()
    least = int(own.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions", "200"))
    spark.conf.set(INITIAL, str(max(least, -(-input_bytes // INPUT_BYTES_A_PARTITION))))
    if own.get(ADVISORY, None) is None:
        spark.conf.set(ADVISORY, str(TASK_SHUFFLE_BYTES))


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions of what is dealt by number and no longer changed at runtime."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), int(spark.conf.get(INITIAL, None) or 0))
