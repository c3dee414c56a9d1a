"""Trip starts and ends as streams of enveloped records."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .. import storage
from ..functions.encoding import decode_text, json_object_fields
from ..functions.numbers import to_money
from ..operators.staging import staged
from ..operators.tables import KeyedTable
from ..plans.trips import END_FIELDS, KEY, apply_ends, apply_starts, daily_fares, skipped_ends
from ..schemas import columns
from ..sinks.files import write_json
from ..sinks.split import split_ok_failed
from ..sinks.streams import EVERY_20_SECONDS
from ..sources.envelope import parse_envelope

START_FIELDS = ["pickup_datetime", "estimated_fare_amount"]
ORDER = "sequence"
LAYOUT = "pickup_date"
TRIPS = columns(
    "trip_id string, pickup_datetime string, estimated_fare_amount decimal(18,2), "
    "fare_amount decimal(18,2), tip_amount decimal(18,2), total_amount decimal(18,2), pickup_date date, end_sequence bigint"
).add("attributes", ArrayType(StructType([StructField("key", StringType()), StructField("value", StringType())])))
# Fields of a record beyond the declared ones, as text.
ATTRIBUTES = "attributes"
# The last end that was applied to a trip.
APPLIED = "end_sequence"
OUTCOMES = ["processed", "errors", "skipped", "triggered"]
FAILED, SKIPPED = "failed", "skipped"
FARES = ("map<string, struct<total_fare: decimal(28,2), count_trips: bigint, max_fare: double, "
         "min_fare: double, average_fare: double>>")


def _attributes(declared: list[str]) -> Column:
    fields = json_object_fields(decode_text(F.col("data")))
    return F.array_sort(F.map_entries(F.map_filter(fields, lambda name, _: ~name.isin(*declared)))).alias(ATTRIBUTES)


def attribute(name: str) -> Column:
    """One of the further fields of a trip; null if it has none of that name."""
    return F.map_from_entries(ATTRIBUTES)[name].alias(name)


def _texts(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _money_fields(parsed: DataFrame, fields: list[str], required: list[str]) -> Column:
    """Whether a record has a key and amounts that convert."""
    ok = F.col("valid")
    for name in KEY + required:
        ok = ok & F.col(f"payload.{name}").isNotNull()
    for name in fields:
        text = F.col(f"payload.{name}")
        ok = ok & (text.isNull() | to_money(text).isNotNull())
    return F.coalesce(ok, F.lit(False)).alias("ok")


def judge_starts(records: DataFrame) -> DataFrame:
    """Every record as received, with ``ok`` and the fields it has; the estimated
    fare must be a number. Fields that are not declared are kept as attributes."""
    parsed = parse_envelope(records, _texts(KEY + START_FIELDS))
    fare = to_money(F.col("payload.estimated_fare_amount")).alias("estimated_fare_amount")
    return parsed.select(*records.columns, _money_fields(parsed, ["estimated_fare_amount"], ["estimated_fare_amount"]),
                         "payload.trip_id", "payload.pickup_datetime", fare, _attributes(KEY + START_FIELDS))


def judge_ends(records: DataFrame) -> DataFrame:
    """Every record as received, with ``ok`` and the fields it has; amounts may
    be missing but not null."""
    parsed = parse_envelope(records, _texts(KEY + END_FIELDS), not_null=END_FIELDS)
    amounts = [to_money(F.col(f"payload.{n}")).alias(n) for n in END_FIELDS]
    return parsed.select(*records.columns, _money_fields(parsed, END_FIELDS, []), "payload.trip_id", *amounts,
                         _attributes(KEY + END_FIELDS))


def decode_starts(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Started trips, and failed records as received."""
    good, bad = split_ok_failed(judge_starts(records), F.col("ok"))
    return good.select(ORDER, "trip_id", "pickup_datetime", "estimated_fare_amount", ATTRIBUTES), bad.select(*records.columns)


def decode_ends(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ended trips, and failed records as received."""
    good, bad = split_ok_failed(judge_ends(records), F.col("ok"))
    return good.select(ORDER, "trip_id", *END_FIELDS, ATTRIBUTES), bad.select(*records.columns)


def create_trip_table(table: KeyedTable) -> KeyedTable:
    """Empty trip table, laid out by pickup date so that a batch rewrites the
    dates of its trips only."""
    return table.create(table.spark.createDataFrame([], TRIPS), LAYOUT)


def _as_trips(starts: DataFrame, grain: str) -> DataFrame:
    picked_up = F.substring("pickup_datetime", 1, 10).try_cast("date")
    dated = starts.withColumn(LAYOUT, F.trunc(picked_up, "month") if grain == "month" else picked_up)
    return dated.select(*[
        (F.col(f.name) if f.name in dated.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in TRIPS
    ], ORDER)


def _start_merge(trips: DataFrame, starts: DataFrame, _keys: list[str]) -> DataFrame:
    # Order travels with the rows while the last start of a trip is chosen.
    ordered = trips.withColumn(ORDER, F.lit(None).cast(starts.schema[ORDER].dataType))
    return apply_starts(ordered, starts, [ORDER]).drop(ORDER)


def _not_yet_overtaken(trips: DataFrame, ends: DataFrame) -> DataFrame:
    """Ends with what they may still set: all fields, or those that the trip
    lacks if a later end has been applied to it already."""
    held = trips.select(*KEY, *[F.col(c).alias(f"held_{c}") for c in [*END_FIELDS, ATTRIBUTES, APPLIED]])
    newer = F.col(f"held_{APPLIED}").isNull() | (F.col(ORDER) > F.col(f"held_{APPLIED}"))
    known = F.coalesce(F.transform(f"held_{ATTRIBUTES}", lambda a: a["key"]), F.array().cast("array<string>"))
    fields = [F.when(newer | F.col(f"held_{c}").isNull(), F.col(c)).alias(c) for c in END_FIELDS]
    rest = F.filter(ATTRIBUTES, lambda a: newer | ~F.array_contains(known, a["key"])).alias(ATTRIBUTES)
    return ends.join(held, KEY, "left").select(
        ORDER, *KEY, *fields, rest, F.when(newer, F.col(ORDER).cast("bigint")).alias(APPLIED))


def _end_merge(trips: DataFrame, ends: DataFrame, _keys: list[str]) -> DataFrame:
    """Declared fields are patched, attributes merged name by name; the last end
    decides, also among ends of different runs."""
    ends = _not_yet_overtaken(trips, ends)
    patched = apply_ends(trips, ends.drop(ATTRIBUTES), [ORDER])
    brought = (
        ends.select(*KEY, ORDER, F.inline(ATTRIBUTES))
        .groupBy(*KEY, "key").agg(F.max_by("value", F.struct(ORDER, F.coalesce("value", F.lit("")))).alias("value"))
        .groupBy(*KEY).agg(F.collect_list(F.struct("key", "value")).alias("brought"))
    )
    names = F.transform("brought", lambda a: a["key"])
    rest = F.filter(F.coalesce(ATTRIBUTES, F.array()), lambda a: ~F.array_contains(names, a["key"]))
    merged = F.when(F.col("brought").isNull(), F.col(ATTRIBUTES)).otherwise(F.array_sort(F.concat(rest, F.col("brought"))))
    return patched.join(brought, KEY, "left").withColumn(ATTRIBUTES, merged).select(*trips.columns)


def _run_id(table: KeyedTable, batch: int | None) -> str:
    """The same for a batch that is run again; a call without a batch is a run of its own."""
    return f"batch-{batch:010d}" if batch is not None else f"version-{table.version():010d}-{uuid.uuid4().hex}"


def _put_aside(rows: DataFrame, path: str | None, feed: str, reason: str, run_id: str) -> None:
    """Write records that were not applied, as received, under the feed and the reason."""
    if path is not None:
        rows.select(F.col(ORDER).cast("string").alias(ORDER), "data").write.mode("overwrite").parquet(
            f"{_aside_folder(path, feed, reason)}/run={run_id}")


def _aside_folder(path: str, feed: str, reason: str) -> str:
    return f"{path.rstrip('/')}/feed={feed}/reason={reason}"


def read_put_aside(spark: SparkSession, path: str) -> DataFrame:
    """sequence, data, feed and reason of all records put aside."""
    schema = "sequence string, data string, feed string, reason string, run string"
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema).drop("run")
    return spark.read.schema(schema).parquet(path).drop("run")


def apply_start_records(
    table: KeyedTable, records: DataFrame, batch: int | None = None, grain: str = "day", aside: str | None = None
) -> None:
    """Put started trips; records that fail go to the folder ``aside``."""
    records = staged(records, "trip-starts")
    started, failed = decode_starts(records)
    run_id = _run_id(table, batch)
    table.upsert(_as_trips(started, grain), KEY, _start_merge, feed="starts", batch=batch)
    _put_aside(failed, aside, "starts", FAILED, run_id)


def apply_end_records(
    table: KeyedTable, records: DataFrame, batch: int | None = None, report_path: str | None = None,
    aside: str | None = None, counts: str | None = None,
) -> None:
    """Patch known trips; then report the fares of the dates the batch touched.

    Records that fail, and ends of trips that are not known, go to the folder
    ``aside``. Under ``counts`` the outcomes of the batch are written, observed
    by the passes that do the work: ends applied, records that failed, ends
    skipped, and applied ends that set a field, each of which asks for the
    report. A batch that is run again writes the same folders again.
    """
    seen, unseen = Observation(), Observation()
    brings = F.size(ATTRIBUTES) > 0
    for name in END_FIELDS:
        brings = brings | F.col(name).isNotNull()
    # Decoded once; the same pass counts.
    judged = staged(judge_ends(records).withColumn("brings", brings).observe(
        seen, F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("errors"), F.count_if(F.col("ok") & F.col("brings")).alias("set")),
        "trip-ends")
    ended = judged.filter("ok").select(ORDER, *KEY, *END_FIELDS, ATTRIBUTES)
    run_id = _run_id(table, batch)
    table.upsert(ended, KEY, _end_merge, feed="ends", batch=batch)
    _put_aside(judged.filter("not ok"), aside, "ends", FAILED, run_id)
    if aside is not None or counts is not None:
        # Unknown to the version that the batch was merged into, not to a later one.
        merged = table.merged_into("ends")
        known = table.read(version=merged if table.has(merged) else None)
        unknown = skipped_ends(known, judged.filter("ok")).observe(
            unseen, F.count("*").alias("skipped"), F.count_if("brings").alias("set"))
        if aside is not None:
            _put_aside(unknown, aside, "ends", SKIPPED, run_id)
        else:
            unknown.write.format("noop").mode("overwrite").save()
    if counts is not None:
        ok, skipped = seen.get["ok"], unseen.get["skipped"]
        found = ok - skipped, seen.get["errors"], skipped, seen.get["set"] - unseen.get["set"]
        table.spark.createDataFrame([found], ", ".join(f"{c} bigint" for c in OUTCOMES)).write.mode("overwrite").parquet(
            f"{counts.rstrip('/')}/batch={run_id}")
    if report_path is not None:
        dates = table.touched_dates(ended.select(*KEY), KEY)
        write_json(daily_fares(table.read(dates)), report_path, run_id, "date")


def start_lifecycle(
    records: DataFrame, table: KeyedTable, checkpoint: str, kind: str, trigger: dict = EVERY_20_SECONDS,
    report_path: str | None = None, grain: str = "day", aside: str | None = None, counts: str | None = None,
) -> StreamingQuery:
    """Keep the trip table up to date from a stream of ``starts`` or ``ends``.

    ``grain`` is the width of the table's date folders, ``day`` or ``month``.
    Both streams may run at the same time: each merges into what the other has
    published. Ends that come before their start are put aside as skipped;
    ``replay_skipped`` applies them later.

    The table remembers the last batch of each feed, so a batch that is run
    again after a failure changes nothing.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        if kind == "starts":
            apply_start_records(table, batch, batch_id, grain, aside)
        else:
            apply_end_records(table, batch, batch_id, report_path, aside, counts)

    return (
        records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def replay_skipped(table: KeyedTable, aside: str, report_path: str | None = None) -> None:
    """Apply ends that were put aside as skipped to the trips known by now.

    An end is applied only as far as no later one has been. Ends whose trip is
    still unknown are put aside anew and the folders that were replayed are
    removed, so a second call does only what is left; one that is cut short may
    apply an end again, which changes nothing.
    """
    folder = _aside_folder(aside, "ends", SKIPPED)
    runs = [entry.path for entry in storage.listing(table.spark, folder)]
    if not runs:
        return
    waiting = table.spark.read.schema("sequence string, data string").parquet(*runs)
    records = waiting.select(F.col(ORDER).cast("bigint").alias(ORDER), "data")
    apply_end_records(table, records, report_path=report_path, aside=aside)
    for run in runs:
        storage.delete(table.spark, run)


def latest_fares(spark: SparkSession, report_path: str) -> DataFrame:
    """Fares of each date by the run that reported it last: date and ``v``."""
    files = spark.read.option("recursiveFileLookup", "true").text(report_path)
    fares = files.select(
        F.explode(F.from_json("value", FARES)).alias("date", "v"), F.col("_metadata.file_modification_time").alias("at"),
        F.col("_metadata.file_path").alias("file"))
    return fares.groupBy("date").agg(F.max_by("v", F.struct("at", "file")).alias("v"))


def start_outcome_counts(
    parsed: DataFrame, path: str, checkpoint: str, trigger: dict = EVERY_20_SECONDS
) -> StreamingQuery:
    """Write the processed and failed records of each batch, counted, under its number.

    A batch that is run again replaces its counts; ``outcome_counts`` adds up
    all of them, however many batches there were.
    """
    def count(batch: DataFrame, batch_id: int) -> None:
        batch.agg(
            F.count_if("valid").alias("processed"), F.count_if(~F.col("valid")).alias("errors")
        ).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return (
        parsed.select("valid").writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
        .trigger(**trigger).start()
    )


def outcome_counts(spark: SparkSession, path: str, names: list[str] = OUTCOMES[:2]) -> DataFrame:
    """Outcomes of all batches, added up; zero when none has run."""
    schema = ", ".join(f"{c} bigint" for c in names)
    if not storage.exists(spark, path):
        return spark.createDataFrame([(0,) * len(names)], schema)
    counted = spark.read.schema(f"{schema}, batch string").parquet(path)
    return counted.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def correlate_trips(
    starts: DataFrame, ends: DataFrame, longest: str | None = None, lateness: str = "10 minutes"
) -> DataFrame:
    """Pair each end with its start; an end without one keeps nulls.

    ``starts``: trip_id, started_at, ...; ``ends``: trip_id, ended_at, .... A
    stream needs ``longest``, the longest trip that is matched, to know which
    starts it can drop; in a batch trips may take any time.
    """
    if longest is None and (starts.isStreaming or ends.isStreaming):
        raise ValueError("a stream needs the longest time between start and end")
    begun = starts.withWatermark("started_at", lateness).withColumnRenamed("trip_id", "start_trip_id")
    done = ends.withWatermark("ended_at", lateness)
    same = (
        (F.col("trip_id") == F.col("start_trip_id"))
        & (F.col("started_at") <= F.col("ended_at"))
    )
    if longest is not None:
        same = same & (F.col("ended_at") <= F.col("started_at") + F.expr(f"INTERVAL {longest}"))
    return done.join(begun, same, "left_outer")
