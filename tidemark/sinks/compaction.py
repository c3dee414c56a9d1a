"""Compaction of the folders that streams write.

A stream that writes every few seconds leaves a small file per folder and
batch. A compaction copies the rows of the files that the sink has committed
into few large ones beside the stream, in a generation of its own, and
publishes it together with the list of files it stands for. The stream and its
files are never touched.

A reader takes the published generations, and of the files in the sink's log
those that no generation stands for. It looks at what is published first: what
is published later it reads from the stream's own files, so each row is seen
once before, during and after a compaction.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import storage

FAN_IN = 8


class CompactedFeed:
    """The rows that a stream has written to ``source``, compacted in ``target``.

    ``schema`` has all columns, those of ``partition_by`` too. A retention set
    on the sink must be longer than the time between two compactions.
    """

    def __init__(self, spark: SparkSession, source: str, target: str, schema: StructType,
                 partition_by: list[str] = (), fan_in: int = FAN_IN):
        self.spark, self.source, self.target = spark, source.rstrip("/"), target.rstrip("/")
        self.schema, self.partition_by, self.fan_in = schema, list(partition_by), fan_in

    def read(self) -> DataFrame:
        """All rows the stream has committed, each once."""
        _, live = self._published()
        if not live:
            return self.spark.read.schema(self.schema).parquet(self.source).select(*self.schema.names)
        rows, paths = self._rows(live), _paths(self._not_covered(live))
        return rows.unionByName(self._streamed(paths)) if paths else rows

    def compact(self) -> bool:
        """Copy the rows of files that are new since the last compaction into a
        generation. False if there are none, or if another writer was first."""
        number, live = self._published()
        made = {"name": uuid.uuid4().hex, "level": 0}
        # The list is fixed before the rows are read, as the stream goes on.
        self._not_covered(live).write.parquet(self._list(made))
        paths = _paths(self._listed([made]))
        if not paths:
            self._discard(made)
            return False
        self._write(self._streamed(paths), made)
        return self._publish(number, [*live, made], made)

    def fold(self) -> bool:
        """Make one generation of ``fan_in`` or more of the same level, so a row is
        written again once per level. False if no level has as many."""
        number, live = self._published()
        levels = [g["level"] for g in live]
        full = [level for level in sorted(set(levels)) if levels.count(level) >= self.fan_in]
        if not full:
            return False
        old = [g for g in live if g["level"] == full[0]]
        made = {"name": uuid.uuid4().hex, "level": full[0] + 1}
        self._write(self._rows(old), made)
        # Files that the sink's log no longer names need no mention.
        self._listed(old).join(self._committed(), "path", "left_semi").write.parquet(self._list(made))
        return self._publish(number, [*[g for g in live if g not in old], made], made)

    def drop_old(self, keep: int = 1) -> int:
        """Delete generations that only publications before the last ``keep`` name.
        Readers that began before those may still use them."""
        marks = self._marks()
        held = {g["name"] for mark in marks[-keep:] for g in self._read_mark(mark)}
        gone = {g["name"]: g for mark in marks[:-keep] for g in self._read_mark(mark) if g["name"] not in held}
        for generation in gone.values():
            self._discard(generation)
        for mark in marks[:-keep]:
            storage.delete(self.spark, f"{self.target}/published/{mark}")
        return len(gone)

    # -- what is published --------------------------------------------------------

    def _marks(self) -> list[str]:
        return sorted(e.name for e in storage.listing(self.spark, f"{self.target}/published"))

    def _read_mark(self, mark: str) -> list[dict]:
        return json.loads(storage.read_text(self.spark, f"{self.target}/published/{mark}"))

    def _published(self) -> tuple[int, list[dict]]:
        """Number and generations of the last publication."""
        marks = self._marks()
        return (int(marks[-1].split(".")[0]), self._read_mark(marks[-1])) if marks else (0, [])

    def _publish(self, number: int, live: list[dict], made: dict) -> bool:
        try:
            storage.write_text_once(self.spark, f"{self.target}/published/{number + 1:010d}.json", json.dumps(live))
        except FileExistsError:
            self._discard(made)
            return False
        return True

    def _discard(self, generation: dict) -> None:
        storage.delete(self.spark, self._folder(generation))
        storage.delete(self.spark, self._list(generation))

    # -- rows and files -------------------------------------------------------------

    def _folder(self, generation: dict) -> str:
        return f"{self.target}/rows/generation={generation['name']}"

    def _list(self, generation: dict) -> str:
        return f"{self.target}/files/{generation['name']}"

    def _write(self, rows: DataFrame, generation: dict) -> None:
        # Small folders share a task, large ones are split, by size.
        even = rows.hint("rebalance", *[F.col(c) for c in self.partition_by])
        even.write.partitionBy(*self.partition_by).parquet(self._folder(generation))

    def _rows(self, generations: list[dict]) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", f"{self.target}/rows").parquet(
            *[self._folder(g) for g in generations]).select(*self.schema.names)

    def _streamed(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", self.source).parquet(*paths).select(*self.schema.names)

    def _committed(self) -> DataFrame:
        """path of every file in the sink's log; none is opened."""
        return self.spark.read.format("binaryFile").load(self.source).select("path")

    def _listed(self, generations: list[dict]) -> DataFrame:
        return self.spark.read.schema("path string").parquet(*[self._list(g) for g in generations])

    def _not_covered(self, live: list[dict]) -> DataFrame:
        files = self._committed()
        return files.join(self._listed(live), "path", "left_anti") if live else files


def _paths(files: DataFrame) -> list[str]:
    """Files written since the last compaction; a scan of them lists as many on the driver."""
    return [row[0] for row in files.toLocalIterator()]
