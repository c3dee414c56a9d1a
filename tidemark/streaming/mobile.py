"""Mobile coverage logs in two-minute windows.

Each metric is a function from the timed logs to finished windows and works on
a stream, in append mode, and on a batch. Windows are grouped with partial
sums first, so one busy postal code or operator is one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import lenient_double
from ..functions.times import clock_time_on, hour_label
from ..sinks.streams import EVERY_20_SECONDS, start_parquet_sink

BASE_DATE = "2023-01-01"
WINDOW = "2 minutes"
LATENESS = "10 minutes"

# Folders and columns of the written files.
PARTITIONS = {
    "signal_strength_by_operator": ["partition_hour", "postal_code"],
    "gps_precision_by_provider": ["partition_hour", "provider"],
    "status_count": ["partition_hour", "postal_code"],
}


def with_log_time(logs: DataFrame, base_date: str = BASE_DATE) -> DataFrame:
    """Logs carry a time of day only; the day is a parameter."""
    return logs.withColumn("timestamp", clock_time_on(base_date, F.col("hour")))


def _windowed(logs: DataFrame, keys: list[str], metrics: dict[str, Column]) -> DataFrame:
    timed = logs.withColumn("partition_hour", hour_label(F.col("timestamp")))
    return (
        timed.withWatermark("timestamp", LATENESS)
        .groupBy(F.window("timestamp", WINDOW), *keys, "partition_hour")
        .agg(*[metric.alias(name) for name, metric in metrics.items()])
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            *keys, "partition_hour", *metrics,
        )
    )


def signal_strength_by_operator(logs: DataFrame) -> DataFrame:
    return _windowed(
        logs, ["postal_code", "operator"], {"average_signal": F.avg(lenient_double(F.col("signal")))}
    )


def gps_precision_by_provider(logs: DataFrame) -> DataFrame:
    return _windowed(logs, ["provider"], {
        "average_precision": F.avg(lenient_double(F.col("precission"))),
        "average_satellites": F.avg(lenient_double(F.col("satellites"))),
    })


def status_count(logs: DataFrame) -> DataFrame:
    return _windowed(logs, ["postal_code", "status"], {"status_count": F.count("*")})


METRICS = {
    "signal_strength_by_operator": signal_strength_by_operator,
    "gps_precision_by_provider": gps_precision_by_provider,
    "status_count": status_count,
}


def metric_files(logs: DataFrame, name: str) -> DataFrame:
    """A metric with the rows of each output folder brought together.

    A folder holds one hour of one postal code or provider, a few windows, so
    this moves little and saves every task from writing to every folder.
    """
    return METRICS[name](logs).repartition(*PARTITIONS[name])


def start_metrics(
    logs: DataFrame, path: str, checkpoint: str, trigger: dict = EVERY_20_SECONDS
) -> list[StreamingQuery]:
    """Run the three metrics side by side, each with a checkpoint of its own."""
    return [
        start_parquet_sink(
            metric_files(logs, name), f"{path}/{name}", f"{checkpoint}/{name}", PARTITIONS[name], trigger
        )
        for name in METRICS
    ]


# Columns of the written files besides the layout columns.
FILE_COLUMNS = {
    "signal_strength_by_operator": "operator string, average_signal double",
    "gps_precision_by_provider": "average_precision double, average_satellites double",
    "status_count": "status string, status_count bigint",
}


def read_metric(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Windows written so far; layout columns keep their text form."""
    layout = ", ".join(f"{c} string" for c in PARTITIONS[name])
    schema = f"window_start timestamp, window_end timestamp, {FILE_COLUMNS[name]}, {layout}"
    return spark.read.schema(schema).parquet(f"{path}/{name}")
