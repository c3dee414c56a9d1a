"""Trips as keyed state: starts and ends in any order, each applied as it comes.

Both feeds are one stream, keyed by page: some hundreds of trips with one hash.
A call to the state costs far more than a trip, so trips share the calls of
their page. The state of a trip is what its start and its ends have brought,
field by field with the sequence that brought it, so the order of arrival does
not matter. Ends that come first wait in the state; a timer puts them aside if
no start follows. Every change is one appended row, so no folder is ever
rewritten: the trip table is the last row of each trip.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import MapType, StringType

from .. import storage
from ..plans.trips import END_FIELDS, KEY
from ..schemas import columns
from ..sinks.streams import EVERY_20_SECONDS
from .trips import ATTRIBUTES, FAILED, ORDER, SKIPPED, judge_ends, judge_starts

APPLIED = "applied"
WAIT = "1 hour"
# A page of so many trips is read about as fast as the calls that reach it are
# made. A stream keeps the number of pages it has begun with.
PAGE_TRIPS = 256
PAGES = 1 << 14
PAGE = "page_of_"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
# Rows of the log. Applied ones describe a trip, the others hold a record as received.
LOG = columns(
    "trip_id string, change bigint, pickup_datetime string, estimated_fare_amount decimal(18,2), fare_amount decimal(18,2), "
    "tip_amount decimal(18,2), total_amount decimal(18,2), sequence bigint, data string, feed string, outcome string"
).add(ATTRIBUTES, MapType(StringType(), StringType()))
_Logged = Row(*LOG.names)


class TripProcessor(StatefulProcessor):
    """One state per page, as JSON: by trip ``start`` and ``fields``, by name the value and its sequence."""

    def __init__(self, wait_ms: int):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.page = handle.getValueState("page", "value string")
        # Appended to, and read only when a start has come or the wait is over.
        self.waiting = handle.getListState("waiting", "trip_id string, sequence long, data string")

    def _trips(self) -> dict[str, dict]:
        held = self.page.get()
        return json.loads(held[0]) if held else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        trips, changed, early = None, {}, []
        for row in rows:
            record = json.loads(row.record)
            sequence = record.get(ORDER)
            if not record.get("ok"):
                yield self._aside(None, sequence, record.get("data"), record["feed"], FAILED)
                continue
            name, trips = record["trip_id"], self._trips() if trips is None else trips
            trip = trips.get(name)
            if trip is None:
                trip = trips[name] = {"change": 0, "start": None, "fields": {}, "timer": None}
            if record["feed"] == "starts":
                new = self._started(trip, sequence, record)
            else:
                new = self._ended(trip, sequence, record)
                early.append((name, sequence, record["data"]))
            if new:
                changed[name] = trip
        early = [end for end in early if trips[end[0]]["start"] is None]
        if early:
            self.waiting.appendList(early)
            self._set_timers(trips, {end[0] for end in early}, timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
        met = {name for name, trip in changed.items() if trip["start"] is not None and trip["timer"] is not None}
        if met:
            self._end_wait(trips, met)
        if not changed and not early:
            return
        for name, trip in changed.items():
            if trip["start"] is not None:
                trip["change"] += 1
                yield self._row(name, trip)
        self.page.update((json.dumps(trips),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        trips, now = self._trips(), expiredTimerInfo.getExpiryTimeInMs()
        over = {name for name, trip in trips.items() if trip["timer"] is not None and trip["timer"] <= now}
        if not over:
            return
        for name, sequence, data in self._take(over):
            yield self._aside(name, sequence, data, "ends", SKIPPED)
        left = {name: trip for name, trip in trips.items() if name not in over}
        if left:
            self.page.update((json.dumps(left),))
        else:
            self.page.clear()

    def close(self) -> None:
        pass

    def _set_timers(self, trips: dict[str, dict], names: set[str], at: int) -> None:
        """The clock runs from the first end of a trip; trips of a page share a timer."""
        new = [trips[name] for name in names if trips[name]["timer"] is None]
        if new and not any(trip["timer"] == at for trip in trips.values()):
            self.handle.registerTimer(at)
        for trip in new:
            trip["timer"] = at

    def _end_wait(self, trips: dict[str, dict], met: set[str]) -> None:
        """What these trips have waited with goes, and the timers that no other trip needs."""
        timers = {trips[name]["timer"] for name in met}
        for name in met:
            trips[name]["timer"] = None
        for timer in timers - {trip["timer"] for trip in trips.values()}:
            self.handle.deleteTimer(timer)
        for _ in self._take(met):
            pass

    def _take(self, names: set[str]) -> Iterator[tuple]:
        """Ends of these trips, taken from those that wait."""
        stay = []
        for end in self.waiting.get():
            if end[0] in names:
                yield end
            else:
                stay.append(end)
        if stay:
            self.waiting.put(stay)
        else:
            self.waiting.clear()

    @staticmethod
    def _started(trip: dict, sequence: int, brought: dict) -> bool:
        if trip["start"] is not None and sequence <= trip["start"]["sequence"]:
            return False
        trip["start"] = {"sequence": sequence, "at": brought.get("pickup_datetime"), "fare": brought.get("estimated_fare_amount"),
                         "attributes": {a["key"]: a.get("value") for a in brought.get(ATTRIBUTES) or []}}
        return True

    @staticmethod
    def _ended(trip: dict, sequence: int, brought: dict) -> bool:
        fields = {name: brought[name] for name in END_FIELDS if name in brought}
        fields |= {a["key"]: a.get("value") for a in brought.get(ATTRIBUTES) or []}
        new = False
        for name, value in fields.items():
            held = trip["fields"].get(name)
            # Of equal sequences the larger value stays, in any order of arrival.
            if held is None or (sequence, value or "") > (held[1], held[0] or ""):
                trip["fields"][name] = [value, sequence]
                new = True
        return new

    @staticmethod
    def _aside(trip_id: str | None, sequence: int, data: str | None, feed: str, outcome: str) -> Row:
        return _Logged(trip_id, None, None, None, None, None, None, sequence, data, feed, outcome, None)

    @staticmethod
    def _row(trip_id: str, trip: dict) -> Row:
        start, fields = trip["start"], {name: value for name, (value, _) in trip["fields"].items()}
        amounts = [Decimal(fields[n]) if fields.get(n) is not None else None for n in END_FIELDS]
        rest = start["attributes"] | {n: v for n, v in fields.items() if n not in END_FIELDS}
        estimated = Decimal(start["fare"]) if start["fare"] is not None else None
        return _Logged(trip_id, trip["change"], start["at"], estimated, *amounts, None, None, None, APPLIED, rest)


def lifecycle_log(starts: DataFrame, ends: DataFrame, wait_ms: int, pages: int = PAGES) -> DataFrame:
    """Changes of trips, ends whose start did not come within the wait, and failed records."""
    texts = ["pickup_datetime", "estimated_fare_amount", *END_FIELDS]
    # Named by the number of pages, so that a state with another is refused.
    page = f"{PAGE}{pages}"

    def packed(df: DataFrame, feed: str) -> DataFrame:
        fields = [*KEY, F.lit(feed).alias("feed"), F.col(ORDER).cast("bigint").alias(ORDER), "data", "ok",
                  *[F.col(c).cast("string").alias(c) for c in texts if c in df.columns], ATTRIBUTES]
        # Records that failed go with any page and past its state, so that none is judged twice.
        at = F.when(F.col("ok"), F.xxhash64(*KEY)).otherwise(F.xxhash64(ORDER, "data"))
        return df.select(F.pmod(at, F.lit(pages)).alias(page), F.to_json(F.struct(*fields)).alias("record"))

    both = packed(judge_starts(starts), "starts").unionByName(packed(judge_ends(ends), "ends"))
    return both.groupBy(page).transformWithState(TripProcessor(wait_ms), LOG, "Append", "ProcessingTime")


def start_trip_log(
    starts: DataFrame, ends: DataFrame, path: str, checkpoint: str, wait: str = WAIT, trigger: dict = EVERY_20_SECONDS,
    pages: int = PAGES,
) -> StreamingQuery:
    """Keep the log of trips up to date from a stream of starts and one of ends.

    Both have ``sequence`` and ``data``. A later start replaces what an earlier
    one has brought, a later end the fields that it brings; records that come
    again change nothing. What the ends of a trip have brought stays when a
    later start comes, as the two feeds have no common order. The state keeps
    every trip, in ``pages`` pages: one for each PAGE_TRIPS trips that are
    expected, and the same in all runs. Ends wait ``wait`` for their start, by
    the clock; a run that ends when it has caught up looks at the clock only
    when there are records.
    """
    wait_ms = int(starts.sparkSession.sql(f"select cast(unix_millis(timestamp_millis(0) + interval {wait}) as bigint)").first()[0])
    spark = starts.sparkSession
    before = spark.conf.get(EMPTY_BATCHES)
    # Clock timers ask for one empty batch after another; a run that is to end takes none.
    spark.conf.set(EMPTY_BATCHES, "false" if trigger.get("availableNow") else before)
    try:
        return (
            lifecycle_log(starts, ends, wait_ms, pages).writeStream.format("parquet").outputMode("append").partitionBy("outcome")
            .option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).start()
        )
    finally:
        spark.conf.set(EMPTY_BATCHES, before)


def _logged(spark: SparkSession, path: str) -> DataFrame:
    if not storage.exists(spark, path):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(path)


def trip_table(spark: SparkSession, path: str) -> DataFrame:
    """Each trip as its last change left it."""
    held = ["pickup_datetime", "estimated_fare_amount", *END_FIELDS, ATTRIBUTES]
    last = _logged(spark, path).filter(F.col("outcome") == APPLIED).groupBy(*KEY).agg(F.max_by(F.struct(*held), "change").alias("last"))
    return last.select(*KEY, "last.*")


def records_aside(spark: SparkSession, path: str) -> DataFrame:
    """sequence, data, feed and outcome of the records that were not applied."""
    return _logged(spark, path).filter(F.col("outcome") != APPLIED).select(ORDER, "data", "feed", "outcome")


def waiting_ends(spark: SparkSession, checkpoint: str) -> DataFrame:
    """trip_id, sequence and data of the ends that wait for their start, read from the state."""
    state = (spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "waiting")
             .option("flattenCollectionTypes", "true").load())
    return state.select(*[F.col(f"list_element.{c}").alias(c) for c in (*KEY, ORDER, "data")])
