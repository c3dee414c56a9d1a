from __future__ import annotations

import json
import re
import time
from collections import namedtuple
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark import storage
from tidemark.functions.encoding import encode_text
from tidemark.operators.tables import KeyedTable
from tidemark.plans.discounts import user_discounts
from tidemark.schemas import MOBILE_LOG, STREAMS, columns
from tidemark.session import fits_broadcast
from tidemark.sinks.streams import (
    UNTIL_CAUGHT_UP, await_all, emit_events, ingest_new_files, start_parquet_sink,
)
from tidemark.sources.streams import parse_events, read_event_stream
from tidemark.streaming import lifecycle, mobile, music, serve, state, trips


class Feed:
    """A folder that gets one file of JSON lines per call."""

    def __init__(self, folder):
        self.folder, self.n = folder, 0
        folder.mkdir()

    def send(self, *events):
        self.n += 1
        draft = self.folder / f".{self.n}"
        draft.write_text("".join(e if isinstance(e, str) else json.dumps(e) for e in _lines(events)))
        time.sleep(0.02)  # files are taken by modification time
        draft.rename(self.folder / f"{self.n:04d}.json")

    def stream(self, spark, schema):
        return read_event_stream(spark, "text", {"path": str(self.folder), "maxFilesPerTrigger": "1"}, schema)


def _lines(events):
    for e in events:
        yield e
        yield "\n"


def log(clock, **fields):
    return {"hour": clock, "postal_code": "1", "operator": "o", "status": "s", "provider": "gps", "signal": "10",
            "precission": "1", "satellites": "4"} | fields


def run(df, folder, **options):
    query = start_parquet_sink(df, str(folder / "out"), str(folder / "checkpoint"), trigger=UNTIL_CAUGHT_UP, **options)
    await_all(df.sparkSession, [query])
    return df.sparkSession.read.schema(df.schema).parquet(str(folder / "out"))


def test_windows_are_emitted_once_and_late_rows_dropped(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    logs = mobile.with_log_time(feed.stream(spark, MOBILE_LOG))
    feed.send(log("10:00:00", signal="10"), log("10:01:59", signal="20"), log("10:02:00", signal="abc"))
    feed.send(log("10:20:00", signal="50"))
    metric = mobile.signal_strength_by_operator(logs)
    first = rows(run(metric, tmp_path).select("window_start", "partition_hour", "average_signal"))
    assert first == [(datetime(2023, 1, 1, 10, 0), "10", 15.0), (datetime(2023, 1, 1, 10, 2), "10", None)]
    # The run goes on from its checkpoint; the first row is too late by now.
    feed.send(log("10:00:30", signal="99"), log("10:19:00", signal="70"))
    feed.send(log("10:40:00"))
    again = run(metric, tmp_path)
    assert rows(again.select("window_start", "average_signal")) == [
        (datetime(2023, 1, 1, 10, 0), 15.0), (datetime(2023, 1, 1, 10, 2), None),
        (datetime(2023, 1, 1, 10, 18), 70.0), (datetime(2023, 1, 1, 10, 20), 50.0),
    ]


def test_stream_equals_batch_over_finished_windows(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    events = [log(f"10:{m:02d}:{s:02d}", postal_code=str(s % 3), status="ab"[m % 2], signal=str(s), provider="xyz"[s % 3])
              for m in range(0, 50) for s in range(0, 60, 7)]
    feed.send(*events)
    stream = mobile.with_log_time(feed.stream(spark, MOBILE_LOG))
    batch = mobile.with_log_time(parse_events(spark.read.text(str(tmp_path / "in")), MOBILE_LOG))
    mark = F.lit("2023-01-01 10:39:56").cast("timestamp")
    queries = mobile.start_metrics(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), UNTIL_CAUGHT_UP)
    await_all(spark, queries)
    for name, metric in mobile.METRICS.items():
        got = mobile.read_metric(spark, str(tmp_path / "out"), name)
        want = metric(batch).filter(F.col("window_end") <= mark)
        assert got.count() > 20
        assert rows(got.select(sorted(got.columns))) == rows(want.select(sorted(want.columns)))
        hours = {e.name for e in storage.listing(spark, str(tmp_path / "out" / name)) if e.is_dir}
        assert hours == {"partition_hour=10"}


def test_day_rollover_is_a_parameter(spark):
    logs = spark.createDataFrame([("23:59:30",), ("25:00:00",)], "hour string")
    assert rows(mobile.with_log_time(logs, "2024-02-29")) == [
        ("23:59:30", datetime(2024, 2, 29, 23, 59, 30)), ("25:00:00", None)
    ]


def plays(*listed):
    return [{"user_id": u, "track_id": t, "listen_time": at} for u, t, at in listed]


SONGS = [("t1", "a", "al", 1000), ("t2", "b", "bl", 3000)]
SONG_SCHEMA = "track_id string, artists string, album_name string, duration_ms int"


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_music_metrics_with_a_small_and_a_large_catalogue(spark, tmp_path, settings, limit):
    settings(autoBroadcastJoinThreshold=limit)
    feed = Feed(tmp_path / "in")
    feed.send(*plays(
        ("u1", "t1", "2024-01-01 10:00:00"), ("u2", "t1", "2024-01-01 10:29:59"), (None, "t1", "2024-01-01 10:10:00"),
        ("u1", "t2", "2024-01-01 10:30:00"), ("u1", "t9", "2024-01-01 10:00:00"), ("u1", None, "2024-01-01 10:00:00"),
        ("u1", "t1", "not a time"), ("u1", "t1", "2024-01-01 11:20:00"),
    ))
    events = music.with_listen_time(feed.stream(spark, STREAMS))
    spark.createDataFrame(SONGS, SONG_SCHEMA).write.parquet(str(tmp_path / "songs"))
    songs = spark.read.parquet(str(tmp_path / "songs"))
    assert fits_broadcast(songs) is (limit == "10MB")
    out = run(music.music_metrics(events, songs), tmp_path)
    assert rows(out.drop("window_end")) == [
        (datetime(2024, 1, 1, 10, 0), "t1", "a", "al", 2, 2, 1000.0), (datetime(2024, 1, 1, 10, 30), "t2", "b", "bl", 1, 1, 3000.0),
    ]


def test_a_hot_track_named_by_earlier_plays_is_spread_and_changes_nothing(spark, tmp_path, settings):
    settings(autoBroadcastJoinThreshold="-1")
    feed = Feed(tmp_path / "in")
    listed = [(f"u{i}", "t1" if i % 3 else "t2", f"2024-01-01 10:{i % 30:02d}:00") for i in range(60)]
    feed.send(*plays(*listed, ("u1", "t1", "2024-01-01 12:00:00")))
    songs = spark.createDataFrame(SONGS + [(f"x{i}", "a", "b", 1) for i in range(50)], SONG_SCHEMA)
    events = music.with_listen_time(feed.stream(spark, STREAMS))
    history = spark.createDataFrame(listed, "user_id string, track_id string, listen_time string")
    named, all_salted = (music.music_metrics(events, songs, h) for h in (history, None))
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    want = rows(run(all_salted, tmp_path / "b"))
    assert rows(run(named, tmp_path / "a")) == want and [r[5] for r in want] == [40, 20]


def test_a_failing_query_ends_the_others(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send(log("10:00:00"))
    stream = feed.stream(spark, MOBILE_LOG)
    endless = start_parquet_sink(stream, str(tmp_path / "a"), str(tmp_path / "ca"), trigger={"processingTime": "1 second"})
    bad = stream.select(F.raise_error(F.lit("broken")).cast("string").alias("x"))
    failing = start_parquet_sink(bad, str(tmp_path / "b"), str(tmp_path / "cb"), trigger=UNTIL_CAUGHT_UP)
    with pytest.raises(Exception, match="broken"):
        await_all(spark, [endless, failing])
    assert not endless.isActive


def test_discounts_are_sent_on_as_messages(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    feed.send({"user_id": "a"}, {"user_id": "b"}, {"user_id": "a"}, {"user_id": "z"})
    history = spark.createDataFrame([("a", 150.0), ("b", 100.5)], "user_id string, total_amount_spent double")
    found = user_discounts(feed.stream(spark, columns("user_id string")), history)
    query = emit_events(found, "user_id", "json", {"path": str(tmp_path / "out")}, str(tmp_path / "c"), UNTIL_CAUGHT_UP)
    await_all(spark, [query])
    out = spark.read.schema("key string, value string").json(str(tmp_path / "out"))
    assert rows(out) == [("a", '{"user_id":"a","discount_percentage":30}')] * 2


def test_newest_windows_with_settled_ties(spark):
    at = [datetime(2024, 1, 1, 0, m) for m in (0, 2, 4)]
    df = spark.createDataFrame(
        [("s", 1, "00", str(p), t, t) for t in at for p in range(6)],
        "status string, status_count long, partition_hour string, postal_code string, window_start timestamp, window_end timestamp",
    )
    got = [(r["window_start"], r["postal_code"]) for r in serve.latest_status_count(df.repartition(5)).collect()]
    assert got == [(at[2], str(p)) for p in range(6)] + [(at[1], str(p)) for p in range(4)]
    signal = spark.createDataFrame([("o", 2.5, "00", "1", at[0], at[0])],
                                   "operator string, average_signal double, partition_hour string, postal_code string, "
                                   "window_start timestamp, window_end timestamp")
    assert serve.latest_signal_strength(signal).first()["average_signal"] == 3.0


# -- trips ---------------------------------------------------------------------

def records(spark, *payloads):
    """(sequence, payload) pairs as enveloped records."""
    df = spark.createDataFrame(
        [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in payloads], "sequence long, text string"
    )
    return df.select("sequence", encode_text(F.col("text")).alias("data"))


def start(trip, at="2024-01-01 10:00:00", fare=10):
    return {"trip_id": trip, "pickup_datetime": at, "estimated_fare_amount": fare}


def test_trip_starts_and_ends(spark, tmp_path):
    held = trips.create_trip_table(KeyedTable(spark, str(tmp_path / "trips")))
    trips.apply_start_records(held, records(
        spark, (1, start("abc123")), (2, start("late", fare=1)), (3, start("late", "2024-01-02 00:00:00", 2.5)),
        (4, start("nofare", fare=None)), (5, {"trip_id": "missing"}), (6, start("text", fare="7.25")),
        (7, start("words", fare="cheap")), (8, "[1]"),
    ), 0)
    trips.apply_end_records(held, records(
        spark, (1, {"trip_id": "abc123", "fare_amount": 100, "tip_amount": 20, "total_amount": 120}),
        (2, {"trip_id": "late", "fare_amount": 5}), (3, {"trip_id": "late", "tip_amount": 1, "fare_amount": 6}),
        (4, {"trip_id": "unknown", "fare_amount": 5}), (5, {"trip_id": "text", "fare_amount": None}),
    ), 0)
    out = held.read().drop("pickup_date", "attributes", trips.APPLIED)
    d = Decimal
    assert rows(out) == [
        ("abc123", "2024-01-01 10:00:00", d("10.00"), d("100.00"), d("20.00"), d("120.00")),
        ("late", "2024-01-02 00:00:00", d("2.50"), d("6.00"), d("1.00"), None),
        ("text", "2024-01-01 10:00:00", d("7.25"), None, None, None),
    ]
    # A batch that is run again after a failure changes nothing.
    trips.apply_end_records(held, records(spark, (9, {"trip_id": "text", "fare_amount": 1})), 0)
    assert rows(held.read().drop("pickup_date", "attributes", trips.APPLIED)) == rows(out)


def test_trips_keep_every_attribute(spark, tmp_path):
    held = trips.create_trip_table(KeyedTable(spark, str(tmp_path / "trips")))
    trips.apply_start_records(held, records(spark, (1, start("a") | {"vendor": "v", "zone": {"x": 1}}), (2, start("b"))))
    trips.apply_end_records(held, records(
        spark, (1, {"trip_id": "a", "zone": "w", "paid": "cash"}), (2, {"trip_id": "a", "paid": "card", "fare_amount": 2})))
    got = {r["trip_id"]: ({a["key"]: a["value"] for a in r["attributes"]}, r["fare_amount"]) for r in held.read().collect()}
    assert got == {"a": ({"vendor": "v", "zone": "w", "paid": "card"}, Decimal("2.00")), "b": ({}, None)}


def test_records_not_applied_are_put_aside_and_replayed(spark, tmp_path):
    held = trips.create_trip_table(KeyedTable(spark, str(tmp_path / "trips")))
    aside, report = str(tmp_path / "aside"), str(tmp_path / "report")
    trips.apply_start_records(held, records(spark, (1, start("a")), (2, "no json")), 0, aside=aside)
    ends = records(spark, (1, {"trip_id": "a", "fare_amount": 3}), (2, {"trip_id": "b", "fare_amount": 4}), (3, "[]"))
    for _ in range(2):  # a batch that is run again writes the same folders again
        trips.apply_end_records(held, ends, 0, report, aside)
    got = sorted((r["feed"], r["reason"], r["sequence"]) for r in trips.read_put_aside(spark, aside).collect())
    assert got == [("ends", "failed", "3"), ("ends", "skipped", "2"), ("starts", "failed", "2")]
    trips.apply_start_records(held, records(spark, (3, start("b"))), 1, aside=aside)
    trips.replay_skipped(held, aside, report)
    assert {r["trip_id"]: float(r["fare_amount"]) for r in held.read().collect()} == {"a": 3.0, "b": 4.0}
    (fares,) = trips.latest_fares(spark, report).collect()
    assert (float(fares["v"]["total_fare"]), fares["v"]["count_trips"]) == (7.0, 2)


def test_a_report_needs_no_batch_number(spark, tmp_path):
    held = trips.create_trip_table(KeyedTable(spark, str(tmp_path / "trips")))
    trips.apply_start_records(held, records(spark, (1, start("a")), (2, start("b", "2024-02-01 00:00:00"))))
    for fare in (1, 2):
        trips.apply_end_records(held, records(spark, (1, {"trip_id": "a", "fare_amount": fare})), report_path=str(tmp_path / "r"))
    # Only the date that the batch touched is reported.
    (fares,) = trips.latest_fares(spark, str(tmp_path / "r")).collect()
    assert (fares["date"], float(fares["v"]["total_fare"])) == ("2024-01-01", 2.0)


def test_both_trip_streams_at_once(spark, tmp_path):
    held = trips.create_trip_table(KeyedTable(spark, str(tmp_path / "trips")))
    aside = str(tmp_path / "aside")
    runs = []
    for kind, payloads in (("starts", [start(f"t{i}") for i in range(6)]),
                           ("ends", [{"trip_id": f"t{i}", "fare_amount": i} for i in range(6)])):
        for i, payload in enumerate(payloads):
            records(spark, (i, payload)).coalesce(1).write.mode("append").parquet(str(tmp_path / kind))
        stream = spark.readStream.schema("sequence long, data string").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / kind))
        runs.append(trips.start_lifecycle(stream, held, str(tmp_path / f"{kind}-c"), kind, UNTIL_CAUGHT_UP, aside=aside))
    await_all(spark, runs)
    trips.replay_skipped(held, aside)
    assert {r["trip_id"]: float(r["fare_amount"]) for r in held.read().collect()} == {f"t{i}": float(i) for i in range(6)}


def test_failed_trip_records_stay_as_received(spark):
    data = records(spark, (1, start("a")), (2, {"trip_id": "b"}), (3, "no json"))
    good, bad = trips.decode_starts(data)
    assert [r["trip_id"] for r in good.collect()] == ["a"]
    assert rows(bad) == rows(data.filter("sequence > 1"))


def test_trip_lifecycle_over_several_runs(spark, tmp_path):
    held = trips.create_trip_table(KeyedTable(spark, str(tmp_path / "trips")))

    def feed(kind, *payloads):
        records(spark, *payloads).coalesce(1).write.mode("append").parquet(str(tmp_path / kind))
        stream = spark.readStream.schema("sequence long, data string").parquet(str(tmp_path / kind))
        query = trips.start_lifecycle(
            stream, held, str(tmp_path / f"{kind}-checkpoint"), kind, UNTIL_CAUGHT_UP, str(tmp_path / "report")
        )
        await_all(spark, [query])

    feed("starts", (1, start("a")))
    feed("ends", (1, {"trip_id": "a", "fare_amount": 3}), (2, {"trip_id": "b", "fare_amount": 9}))
    feed("starts", (2, start("b")))
    feed("ends", (3, {"trip_id": "b", "fare_amount": 4}))
    assert {r["trip_id"]: float(r["fare_amount"]) for r in held.read().collect()} == {"a": 3.0, "b": 4.0}
    assert len(storage.listing(spark, str(tmp_path / "report"))) == 2
    (last,) = trips.latest_fares(spark, str(tmp_path / "report")).collect()
    assert (last["date"], float(last["v"]["total_fare"])) == ("2024-01-01", 7.0)


def test_stream_of_pairs_and_ends_without_a_start(spark, tmp_path):
    t = "2024-01-01 "
    starts = spark.createDataFrame(
        [("a", t + "10:00:00"), ("b", t + "10:00:00"), ("z", t + "20:00:00")], "trip_id string, at string"
    ).selectExpr("trip_id", "cast(at as timestamp) started_at")
    ends = spark.createDataFrame(
        [("a", t + "10:30:00"), ("b", t + "09:00:00"), ("c", t + "10:05:00"), ("y", t + "20:00:00")],
        "trip_id string, at string",
    ).selectExpr("trip_id", "cast(at as timestamp) ended_at")
    for name, df in (("s", starts), ("e", ends)):
        df.write.parquet(str(tmp_path / name))
    both = trips.correlate_trips(
        spark.readStream.schema(starts.schema).parquet(str(tmp_path / "s")),
        spark.readStream.schema(ends.schema).parquet(str(tmp_path / "e")), "2 hours",
    )
    out = run(both.select("trip_id", "started_at"), tmp_path)
    assert rows(out) == [("a", datetime(2024, 1, 1, 10)), ("b", None), ("c", None)]


# -- files ------------------------------------------------------------------------

def test_new_files_are_taken_once_and_archived(spark, tmp_path):
    source, archive = tmp_path / "new", tmp_path / "archive"
    source.mkdir()
    seen = []

    def take():
        def apply(batch, _id):
            seen.append(sorted(r[0] for r in batch.collect()))

        await_all(spark, [ingest_new_files(
            spark, str(source), str(archive), str(tmp_path / "checkpoint"), columns("v int"), apply, header="true"
        )])

    (source / "a.csv").write_text("v\n1\n")
    take()
    (source / "b.csv").write_text("v\n2\n")
    take()
    take()
    (source / "c.csv").write_text("v\n3\n")
    take()
    assert [s for s in seen if s] == [[1], [2], [3]]
    deadline = time.time() + 20
    while (source / "a.csv").exists() and time.time() < deadline:
        time.sleep(0.2)
    assert not (source / "a.csv").exists() and list(archive.rglob("a.csv"))
    with pytest.raises(ValueError):
        ingest_new_files(spark, str(source), str(source / "done"), "c", columns("v int"), print)


def test_outcomes_of_more_than_a_hundred_batches(spark, tmp_path):
    from tidemark.sources.envelope import parse_envelope

    n = 115
    records(spark, *[(i, start("a") if i % 5 else "x") for i in range(n)]).repartition(n, "sequence").write.option(
        "maxRecordsPerFile", 1).parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("sequence long, data string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    parsed = parse_envelope(stream, columns("trip_id string"))
    await_all(spark, [trips.start_outcome_counts(parsed, str(tmp_path / "out"), str(tmp_path / "c"), UNTIL_CAUGHT_UP)])
    assert len(storage.listing(spark, str(tmp_path / "out"))) > 100
    assert tuple(trips.outcome_counts(spark, str(tmp_path / "out")).first()) == (92, 23)
    assert tuple(trips.outcome_counts(spark, str(tmp_path / "none")).first()) == (0, 0)


def test_batches_pair_trips_of_any_length(spark):
    starts = spark.createDataFrame([("a", datetime(2020, 1, 1))], "trip_id string, started_at timestamp")
    ends = spark.createDataFrame([("a", datetime(2024, 1, 1))], "trip_id string, ended_at timestamp")
    assert trips.correlate_trips(starts, ends).first()["started_at"] == datetime(2020, 1, 1)
    with pytest.raises(ValueError):
        trips.correlate_trips(spark.readStream.format("rate").load().selectExpr("value trip_id", "timestamp started_at"), ends)


def test_a_replayed_end_does_not_overtake_a_later_one(spark, tmp_path):
    held = trips.create_trip_table(KeyedTable(spark, str(tmp_path / "trips")))
    aside = str(tmp_path / "aside")
    trips.apply_end_records(held, records(spark, (1, {"trip_id": "a", "fare_amount": 10, "tip_amount": 2, "note": "old", "gate": "n"})), aside=aside)
    trips.apply_start_records(held, records(spark, (1, start("a"))))
    trips.apply_end_records(held, records(spark, (5, {"trip_id": "a", "fare_amount": 99, "note": "new"})), aside=aside)
    for _ in range(2):  # the second time there is nothing left
        trips.replay_skipped(held, aside)
        (row,) = held.read().select("fare_amount", "tip_amount", "end_sequence", trips.attribute("note"), trips.attribute("gate")).collect()
        assert (float(row[0]), float(row[1]), *row[2:]) == (99.0, 2.0, 5, "new", "n")
    assert trips.read_put_aside(spark, aside).count() == 0


def test_ends_of_still_unknown_trips_stay_aside_once(spark, tmp_path):
    held = trips.create_trip_table(KeyedTable(spark, str(tmp_path / "trips")))
    aside = str(tmp_path / "aside")
    trips.apply_start_records(held, records(spark, (1, start("a"))))
    trips.apply_end_records(held, records(spark, (1, {"trip_id": "b", "fare_amount": 1})), aside=aside)
    for _ in range(3):
        trips.replay_skipped(held, aside)
    assert [r["sequence"] for r in trips.read_put_aside(spark, aside).collect()] == ["1"]


def test_outcomes_of_each_batch_of_ends(spark, tmp_path):
    held = trips.create_trip_table(KeyedTable(spark, str(tmp_path / "trips")))
    trips.apply_start_records(held, records(spark, (1, start("a")), (2, start("b"))))
    path = str(tmp_path / "counts")
    batch = records(spark, (1, {"trip_id": "a", "fare_amount": 3}), (2, {"trip_id": "b"}), (3, {"trip_id": "c", "fare_amount": 1}), (4, "no json"),
                    (5, {"trip_id": "a", "fare_amount": None}))
    for number, aside in ((0, str(tmp_path / "aside")), (0, str(tmp_path / "aside")), (1, None)):  # batch 0 is run again
        trips.apply_end_records(held, batch, number, aside=aside, counts=path)
    assert tuple(trips.outcome_counts(spark, path, trips.OUTCOMES).first()) == (4, 4, 2, 2)
    held.retain(1)  # the version that the batch was merged into is gone
    trips.apply_end_records(held, batch, 1, counts=path)
    assert tuple(trips.outcome_counts(spark, path, trips.OUTCOMES).first()) == (4, 4, 2, 2)


def test_new_files_go_by_their_headers(spark, tmp_path):
    source, seen = tmp_path / "new", []
    source.mkdir()
    (source / "one.csv").write_text("b,a\n1,2\n")
    (source / "two.csv").write_text("a,b,c\n3,4,5\n")
    (source / "three.csv").write_text('a\n"7"\n')
    await_all(spark, [ingest_new_files(
        spark, str(source), str(tmp_path / "archive"), str(tmp_path / "checkpoint"), columns("a int, b int"),
        lambda batch, _id: seen.extend(map(tuple, batch.collect())), header="true")])
    assert sorted(seen) == [(2, 1), (3, 4), (7, None)]


# -- trips as keyed state ------------------------------------------------------------


def _trip_log(spark, tmp_path, wait="1 hour", **feeds):
    """Send records to the feeds and let the log catch up."""
    for feed in ("starts", "ends"):
        if feed in feeds:
            records(spark, *feeds[feed]).coalesce(1).write.mode("append").parquet(str(tmp_path / feed))
        elif not (tmp_path / feed).exists():
            records(spark).write.parquet(str(tmp_path / feed))
    streams = [spark.readStream.schema("sequence long, data string").parquet(str(tmp_path / feed)) for feed in ("starts", "ends")]
    await_all(spark, [lifecycle.start_trip_log(*streams, str(tmp_path / "log"), str(tmp_path / "log-c"), wait, UNTIL_CAUGHT_UP)])
    table = lifecycle.trip_table(spark, str(tmp_path / "log"))
    return {r.trip_id: r for r in table.collect()}, sorted(tuple(r) for r in lifecycle.records_aside(spark, str(tmp_path / "log")).select(
        "outcome", "feed", "sequence").collect())


def test_ends_wait_for_their_start(spark, tmp_path):
    held, aside = _trip_log(spark, tmp_path, ends=[(1, {"trip_id": "a", "fare_amount": 10, "gate": "n"}), (2, {"trip_id": "x", "fare_amount": 1})])
    assert held == {} and aside == []
    waiting = lifecycle.waiting_ends(spark, str(tmp_path / "log-c"))
    assert sorted((r.trip_id, r.sequence) for r in waiting.collect()) == [("a", 1), ("x", 2)]
    held, aside = _trip_log(spark, tmp_path, starts=[(1, start("a"))])
    assert (float(held["a"].fare_amount), held["a"].attributes["gate"]) == (10.0, "n") and set(held) == {"a"} and aside == []
    # An older end fills what is missing and overtakes nothing; one that comes again changes nothing.
    _trip_log(spark, tmp_path, ends=[(9, {"trip_id": "a", "fare_amount": 99})])
    held, _ = _trip_log(spark, tmp_path, ends=[(5, {"trip_id": "a", "fare_amount": 50, "tip_amount": 7}), (9, {"trip_id": "a", "fare_amount": 99})])
    assert (float(held["a"].fare_amount), float(held["a"].tip_amount)) == (99.0, 7.0)
    changes = spark.read.schema(lifecycle.LOG).parquet(str(tmp_path / "log")).count()
    again, _ = _trip_log(spark, tmp_path, ends=[(9, {"trip_id": "a", "fare_amount": 99})], starts=[(1, start("a"))])
    assert again == held and spark.read.schema(lifecycle.LOG).parquet(str(tmp_path / "log")).count() == changes


def test_ends_without_a_start_are_put_aside_in_time(spark, tmp_path):
    _trip_log(spark, tmp_path, "1 second", ends=[(1, {"trip_id": "a", "fare_amount": 10}), (3, "no json")])
    time.sleep(1.5)
    held, aside = _trip_log(spark, tmp_path, "1 second", starts=[(1, start("b"))])
    assert set(held) == {"b"} and aside == [("failed", "ends", 3), ("skipped", "ends", 1)]
    # The start that comes too late finds none.
    held, aside = _trip_log(spark, tmp_path, "1 second", starts=[(2, start("a"))])
    assert held["a"].fare_amount is None and len(aside) == 2 and lifecycle.waiting_ends(spark, str(tmp_path / "log-c")).count() == 0


def test_trips_of_a_page_share_its_state(spark):
    """With a page for all, the state is called as often for 300 trips as for one."""
    class Held:
        def __init__(self):
            self.calls, self.rows, self.timers = 0, [], set()

        def getValueState(self, *_):
            return self

        def getListState(self, *_):
            waiting = Held()
            waiting.counts, waiting.get = self, lambda: waiting.called() or iter(list(waiting.rows))
            waiting.clear = lambda: waiting.called() or waiting.rows.clear()
            waiting.put = lambda rows: waiting.called() or setattr(waiting, "rows", list(rows))
            waiting.appendList = lambda rows: waiting.called() or waiting.rows.extend(rows)
            self.waiting = waiting
            return waiting

        def called(self):
            getattr(self, "counts", self).calls += 1

        def get(self):
            self.called()
            return self.rows

        def update(self, value):
            self.called()
            self.rows = value

        def registerTimer(self, at):
            self.called()
            self.timers.add(at)

        def deleteTimer(self, at):
            self.called()
            self.timers.remove(at)

    Record, Clock = namedtuple("Record", "record"), namedtuple("Clock", "now")
    Clock.getCurrentProcessingTimeInMs = lambda clock: clock.now

    def sent(held, run, feed, names, now):
        rows_sent = (Record(json.dumps({"trip_id": n, "feed": feed, "sequence": 1, "ok": True, "data": "d", "fare_amount": "2.00"})) for n in names)
        return [(r.trip_id, r.change, str(r.fare_amount)) for r in run.handleInputRows((0,), rows_sent, Clock(now))]

    calls = []
    for n in (1, 300):
        held, run, names = Held(), lifecycle.TripProcessor(10), [f"t{i}" for i in range(n)]
        run.init(held)
        assert sent(held, run, "ends", names, 100) == [] and held.timers == {110} and len(held.waiting.rows) == n
        assert sent(held, run, "ends", ["x"], 105) == [] and held.timers == {110, 115}
        assert sent(held, run, "starts", names, 106) == [(name, 1, "2.00") for name in names]
        # The timer that the other trip waits for stays.
        assert held.timers == {115} and held.waiting.rows == [("x", 1, "d")]
        calls.append(held.calls)
    assert calls[0] == calls[1]


def test_the_newest_windows_are_read_from_few_folders(spark, tmp_path):
    rows_of = lambda *times: spark.createDataFrame([(t, t, "s", i, "1") for i, t in enumerate(times)],
        "window_start timestamp, window_end timestamp, status string, status_count long, postal_code string")

    def written(name, *times):
        df = rows_of(*times).withColumn("partition_hour", F.date_format("window_start", "HH"))
        path = str(tmp_path / name)
        df.write.partitionBy("partition_hour", "postal_code").parquet(f"{path}/status_count")
        return path, df

    # The same hours on two days, a gap over midnight, and a sparse month.
    day = lambda d, h, m: datetime(2023, 1, d, h, m)
    path, df = written("busy", *[day(d, h, m) for d in (1, 2) for h in (0, 22, 23) for m in range(0, 60, 2)])
    recent = serve.read_recent(spark, path, "status_count")
    assert rows(serve.latest_status_count(recent)) == rows(serve.latest_status_count(df))
    assert recent.count() == 30
    scan = recent._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PartitionFilters: .*partition_hour#\d+ IN \(2[23],2[23]\)", scan)
    assert "GreaterThan(window_start," in scan
    path, df = written("sparse", *[day(d, (7 * d) % 24, 0) for d in range(1, 29)])
    for n in (1, 3, 10, 28, 40):
        recent = serve.read_recent(spark, path, "status_count", n)
        assert rows(serve.latest_status_count(recent, n)) == rows(serve.latest_status_count(df, n))
    assert serve.read_recent(spark, path, "status_count", 3).count() < 28
    path, df = written("midnight", day(1, 23, 58), day(2, 0, 0), day(2, 0, 2), day(1, 4, 0))
    assert serve.read_recent(spark, path, "status_count", 3).count() == 3
    empty = str(tmp_path / "none")
    (tmp_path / "none" / "status_count").mkdir(parents=True)
    assert serve.read_recent(spark, empty, "status_count").count() == 0


def test_open_windows_and_late_rows_add_up(spark, tmp_path):
    feed = Feed(tmp_path / "in")
    logs = mobile.with_log_time(feed.stream(spark, MOBILE_LOG))
    metric = mobile.status_count(logs)
    keys = ["window_start", "postal_code", "status"]
    feed.send(log("10:00:00"), log("10:00:30"), log("10:30:00"))
    run(metric, tmp_path)
    held = state.open_windows(spark, str(tmp_path / "checkpoint"))
    assert held.columns == ["window_start", "window_end", "postal_code", "status", "partition_hour", "partial"]
    assert rows(held.select("window_start", "partial.count")) == [(datetime(2023, 1, 1, 10, 30), 1)]
    # Two rows are too late, one meets the window that is open, one opens another.
    feed.send(log("10:00:10"), log("10:02:00", status="t"), log("10:31:00"), log("10:25:00"))
    finished = run(metric, tmp_path)
    held = state.open_windows(spark, str(tmp_path / "checkpoint")).withColumn("status_count", F.col("partial.count"))
    landed = mobile.status_count(mobile.with_log_time(parse_events(spark.read.text(str(tmp_path / "in")), MOBILE_LOG)))
    found = state.late_rows(landed, finished, held, keys, "status_count")
    assert rows(found.select("window_start", "status", "landed", "finished", "open", "late")) == [
        (datetime(2023, 1, 1, 10, 0), "s", 3, 2, 0, 1), (datetime(2023, 1, 1, 10, 2), "t", 1, 0, 0, 1),
        (datetime(2023, 1, 1, 10, 24), "s", 1, 0, 1, 0), (datetime(2023, 1, 1, 10, 30), "s", 2, 0, 2, 0),
    ]
    # State as of an earlier batch.
    first = state.open_windows(spark, str(tmp_path / "checkpoint"), batch_id=0)
    assert rows(first.select("window_start", "partial.count")) == [
        (datetime(2023, 1, 1, 10, 0), 2), (datetime(2023, 1, 1, 10, 30), 1)]
