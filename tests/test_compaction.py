from __future__ import annotations

import pytest

from conftest import rows
from tidemark import storage
from tidemark.schemas import columns
from tidemark.sinks.compaction import CompactedFeed
from tidemark.sinks.streams import UNTIL_CAUGHT_UP, await_all, start_parquet_sink

SCHEMA = columns("id bigint, hour string, text string")


class Streamed:
    """A stream that writes each landing as a batch of its own, a few small files per folder."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.all = spark, folder, []
        self.feed = CompactedFeed(spark, f"{folder}/out", f"{folder}/compacted", SCHEMA, ["hour"], fan_in=2)

    def land(self, *listed):
        landed = [(i, h, f"t{i}") for i, h in listed]
        self.all += landed
        self.spark.createDataFrame(landed, SCHEMA).repartition(4).write.mode("append").parquet(f"{self.folder}/in")
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.folder}/in")
        await_all(self.spark, [start_parquet_sink(
            stream, f"{self.folder}/out", f"{self.folder}/checkpoint", ["hour"], UNTIL_CAUGHT_UP)])

    def check(self):
        assert rows(self.feed.read()) == sorted(self.all, key=lambda r: tuple((v is None, str(v)) for v in r))

    def files(self):
        return len(self.feed.read().inputFiles())


@pytest.fixture
def streamed(spark, tmp_path):
    made = Streamed(spark, tmp_path)
    made.land(*[(i, f"{i % 3:02d}") for i in range(30)], (30, None), (31, "a b*"))
    return made


def test_rows_are_seen_once_before_and_after_each_step(streamed):
    streamed.check()
    before = streamed.files()
    assert streamed.feed.compact()
    streamed.check()
    assert streamed.files() < before
    assert not streamed.feed.compact()  # nothing is new
    streamed.land((40, "00"), (41, "09"))
    streamed.check()
    assert streamed.feed.compact() and streamed.feed.fold()
    streamed.check()
    assert not streamed.feed.fold()
    streamed.land((50, "00"))
    streamed.check()
    assert streamed.feed.drop_old() == 2
    streamed.check()


def test_text_of_the_layout_stays_as_it_is(streamed):
    streamed.feed.compact()
    assert {r["hour"] for r in streamed.feed.read().collect()} == {"00", "01", "02", "a b*", None}


def test_readers_during_a_compaction_see_each_row_once(streamed):
    began = streamed.feed.read()  # planned before anything is published
    publish, seen = streamed.feed._publish, []

    def during(*args):
        seen.append(rows(streamed.feed.read()))  # rows are written, not published
        return publish(*args)

    streamed.feed._publish = during
    assert streamed.feed.compact()
    assert seen[0] == rows(began) == rows(streamed.feed.read())


def test_a_landing_during_a_compaction_is_left_to_the_next(streamed):
    write = streamed.feed._write

    def late(df, generation):
        streamed.feed._write = write
        streamed.land((60, "00"))
        write(df, generation)

    streamed.feed._write = late
    assert streamed.feed.compact()
    streamed.check()
    assert streamed.feed.compact()
    streamed.check()


def test_of_two_compactions_one_is_published(spark, streamed):
    other = CompactedFeed(spark, streamed.feed.source, streamed.feed.target, SCHEMA, ["hour"])
    write = streamed.feed._write

    def overtaken(df, generation):
        write(df, generation)
        assert other.compact()

    streamed.feed._write = overtaken
    assert not streamed.feed.compact()
    streamed.check()
    assert len(storage.listing(spark, f"{streamed.feed.target}/rows")) == 1


def test_files_without_a_commit_are_not_read(spark, streamed):
    loose = spark.createDataFrame([(99, "x")], "id bigint, text string")
    loose.write.mode("append").parquet(f"{streamed.feed.source}/hour=00")
    streamed.feed.compact()
    streamed.check()
