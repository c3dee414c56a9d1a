"""Session settings, shared working folders and size checks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every flow relies on. All of them can be changed on a running
# session, so ``configure`` also works on a session somebody else built.
RUNTIME_SETTINGS = {
    # Calendar days, hours and windows are cut in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key that holds a large share of the rows is split at run time, even
    # where the rows after the join are still grouped by that key.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A field that is given twice has its last value, as in other JSON readers.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Times are written with minima and maxima, so that a filter on them skips
    # files; the default form has none.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Window state can outgrow the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Upper bounds of what one task takes at once: bytes of files it scans, shuffled
# bytes that adaptive execution merges for it, and rows handed to Python in one
# batch. Files and shuffles are compressed, and texts may be long, so a task
# holds many times as much. A session that has less keeps it.
TASK_LIMITS = {
    "spark.sql.files.maxPartitionBytes": 32 * 1024 * 1024,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 * 1024 * 1024,
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1024,
}

# Files are packed by column: their rows take ten times the space and more.
FILE_PARTITION_BYTES = 16 * 1024 * 1024
TARGET_PARTITION_BYTES = 256 * 1024 * 1024
# Session setting: beyond this many partitions the blocks of a shuffle cost
# more than larger partitions do. The default holds the target size up to 25 TB
# per shuffle; raise it for more.
MAX_SHUFFLE_PARTITIONS = "spark.tidemark.maxShufflePartitions"
DEFAULT_MAX_SHUFFLE_PARTITIONS = 100_000


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    for key, most in TASK_LIMITS.items():
        have = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
        if not 0 < have <= most:
            spark.conf.set(key, str(most))
    return spark


def build_session(app_name: str = "tidemark", master: str | None = None, **settings) -> SparkSession:
    """Build a session; ``settings`` are extra Spark settings by name."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def estimated_bytes(df: DataFrame) -> int:
    """Size of the frame as the optimizer sees it.

    Without column statistics a filter does not lower the estimate and a join
    multiplies it, so the estimate errs on the large side.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def fits_broadcast(df: DataFrame) -> bool:
    """True when the whole frame is under the session's broadcast limit."""
    return estimated_bytes(df) <= broadcast_limit(df.sparkSession)


def size_shuffles(spark: SparkSession, *frames: DataFrame, target: int = TARGET_PARTITION_BYTES) -> int:
    """Raise the number of shuffle partitions to suit the size of the input, one for each ``target`` bytes.

    Never lowers what the cluster has set; adaptive execution merges the
    partitions that turn out small.
    """
    have = int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = -(-sum(estimated_bytes(f) for f in frames) // target)
    want = min(want, int(spark.conf.get(MAX_SHUFFLE_PARTITIONS, str(DEFAULT_MAX_SHUFFLE_PARTITIONS))))
    if want > have:
        spark.conf.set("spark.sql.shuffle.partitions", str(want))
    return max(have, want)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, used once."""
    return f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all staged results of this application; frames read from them no longer work."""
    from .storage import delete

    delete(spark, _scratch(spark))
