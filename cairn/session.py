"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# ANSI stays on: bad input is handled by ``try_cast`` where NULL is wanted, and
# every other overflow or malformed value fails loudly.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep-latest sends one row per key and map task: plan top rows per group
    # below the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # Split a hot join partition even when that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task that writes one or two partitions of a table keeps a file open for each instead of sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "2",
    # Python tasks get few rows at a time: texts are long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


# Shuffle partitions are planned for this much data each. Columnar files hold
# their rows in about a third of the space that shuffled rows take.
PARTITION_BYTES = 128 << 20
FILE_EXPANSION = 3
# Tasks read this much at most, of files or of a shuffle: sums and windows hold several times as much.
TASK_BYTES = 32 << 20


def tune(spark: SparkSession, input_folder: str | None = None) -> SparkSession:
    """Apply the runtime settings the operators are written for.

    Given the folder that is going to be read, the size of its files decides
    with how many partitions shuffles start, so that each fits into memory and
    every core has work; adaptive execution merges what turns out to be small.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if input_folder is not None:
        wanted = shuffle_partitions(folder_bytes(spark, input_folder) * PARTITION_BYTES // TASK_BYTES)
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", max(wanted, cores))
        for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.set(key, TASK_BYTES)
    return spark


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions for a shuffle of that much input, each of the same size."""
    return 1 + input_bytes * FILE_EXPANSION // PARTITION_BYTES


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.getContentSummary(path).getLength()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to the machine's
    temporary folder; on a cluster the executors would not share it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="cairn-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/cairn/{label}-{uuid.uuid4().hex}"
