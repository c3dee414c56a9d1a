"""Streaming sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.files import read_many

EVERY_20_SECONDS = {"processingTime": "20 seconds"}
UNTIL_CAUGHT_UP = {"availableNow": True}
# What the stream of files knows of each; contents are not selected, so none is opened.
FILES = "path string, modificationTime timestamp, length bigint, content binary"
# Settings of the stream of files; all others are for reading them.
FILE_OPTIONS = ("maxFilesPerTrigger", "latestFirst", "maxFileAge", "pathGlobFilter", "recursiveFileLookup")


def start_parquet_sink(
    df: DataFrame, path: str, checkpoint: str, partition_by: list[str] = (), trigger: dict = EVERY_20_SECONDS,
    name: str | None = None,
) -> StreamingQuery:
    """Append finished rows to Parquet files."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def to_messages(df: DataFrame, key: str) -> DataFrame:
    """key and JSON value of every row, as message sinks expect them."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def emit_events(
    df: DataFrame, key: str, fmt: str, options: dict[str, str], checkpoint: str, trigger: dict = EVERY_20_SECONDS
) -> StreamingQuery:
    """Send derived events to another stream or to files."""
    return (
        to_messages(df, key).writeStream.format(fmt).options(**options).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def await_all(spark: SparkSession, queries: list[StreamingQuery]) -> None:
    """Wait until every query has ended; a failure of any of them ends all."""
    try:
        while any(q.isActive for q in queries):
            try:
                spark.streams.awaitAnyTermination(10)
            except StreamingQueryException:
                pass  # some query of the session; the ones waited for are checked below
            spark.streams.resetTerminated()
            _raise_failure(queries)
        _raise_failure(queries)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def _raise_failure(queries: list[StreamingQuery]) -> None:
    for query in queries:
        failure = None if query.isActive else query.exception()
        if failure is not None:
            raise failure


def ingest_new_files(
    spark: SparkSession, source: str, archive: str, checkpoint: str, schema: StructType,
    apply: Callable[[DataFrame, int], None], fmt: str = "csv", **options,
) -> StreamingQuery:
    """Process files that are new since the last run, then move them to the archive.

    The checkpoint records which files are done, so none is taken twice. The
    stream follows the files' names; a batch's files are read together, CSV by
    the header of each file, so columns may be in any order (one that a file
    lacks is null). A batch names at most the files that are new, or
    ``maxFilesPerTrigger``. The archive must lie outside the source; each
    dataset needs one of its own.
    """
    if f"{archive.rstrip('/')}/".startswith(f"{source.rstrip('/')}/"):
        raise ValueError("the archive must lie outside the source")
    followed = {k: v for k, v in options.items() if k in FILE_OPTIONS}
    reading = {k: v for k, v in options.items() if k not in FILE_OPTIONS}
    multi_line = str(reading.get("multiLine", "false")).lower() == "true"

    def take(files: DataFrame, batch_id: int) -> None:
        # The source lists these files on the driver itself.
        paths = [row[0] for row in files.toLocalIterator()]
        if not paths:
            rows = spark.createDataFrame([], schema)
        elif fmt == "csv" and str(reading.get("header", "true")).lower() == "true":
            rows = read_many(spark, paths, schema, multi_line)
        else:
            rows = spark.read.format(fmt).schema(schema).options(**reading).load(paths)
        apply(rows, batch_id)

    files = (
        spark.readStream.format("binaryFile").schema(FILES).options(**followed).option("cleanSource", "archive")
        .option("sourceArchiveDir", archive).load(source).select("path")
    )
    return (
        files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        .trigger(**UNTIL_CAUGHT_UP).start()
    )
