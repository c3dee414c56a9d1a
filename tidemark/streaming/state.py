"""What windowed streams hold back: windows still open, and rows that came too late.

Both are told from a stream's checkpoint and its results, without running it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Windows a stream has begun and not yet written, as of its last batch or a given one.

    ``window_start``, ``window_end``, the other keys of the stream's aggregate
    and ``partial``: what its functions have added up so far.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    held = reader.load(checkpoint)
    keys = [name for name in held.schema["key"].dataType.names if name != "window"]
    return held.select(
        F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"),
        *[F.col(f"key.`{name}`").alias(name) for name in keys], F.col("value").alias("partial"),
    )


def late_rows(landed: DataFrame, finished: DataFrame, waiting: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Rows per window that landed, were counted in a finished or an open window, and came too late for either.

    All three frames hold ``keys`` and a ``count``: of the rows that landed (the
    metric over them as a batch), of the windows written, and of those still
    open. What no window has counted was dropped behind the watermark.
    """
    def part(df: DataFrame, name: str) -> DataFrame:
        zeros = [F.lit(0).cast("bigint").alias(n) for n in ("landed", "finished", "open") if n != name]
        return df.select(*keys, F.col(count).cast("bigint").alias(name), *zeros)

    parts = part(landed, "landed").unionByName(part(finished, "finished")).unionByName(part(waiting, "open"))
    totals = parts.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in ("landed", "finished", "open")])
    return totals.withColumn("late", F.col("landed") - F.col("finished") - F.col("open"))
