"""A Parquet table that is replaced version by version.

Data of a version lies in a folder of its own, ``data/commit=...``;
``published/N.json`` names the folders that make up version N and is written
last. Readers of an older version are not disturbed and a failed job publishes
nothing. Of several writers of a version one wins; the others merge again into
what it published. A table may be partitioned by one date column, or by a hash of
its keys into buckets; an upsert then rewrites the dates or buckets it touches
and no others. ``retain`` removes versions that are no longer read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from .. import storage
from .merge import merge_all, one_row_per_key
from .staging import staged

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
COMMIT = "commit"
BUCKET = "key_bucket"
ATTEMPTS = 20


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- state ----------------------------------------------------------
    def version(self) -> int:
        """Number of the published version; 0 when there is no table."""
        return max((int(e.name[:-5]) for e in storage.listing(self.spark, f"{self.root}/published")), default=0)

    def exists(self) -> bool:
        return self.version() > 0

    def _published(self, version: int | None = None) -> dict:
        version = version or self.version()
        if not version:
            raise FileNotFoundError(f"no published table at {self.root}")
        return json.loads(storage.read_text(self.spark, f"{self.root}/published/{version:010d}.json"))

    def last_batch(self, feed: str) -> int:
        """Highest micro-batch of a feed that is part of the table; -1 if none."""
        return self._published()["batches"].get(feed, -1) if self.exists() else -1

    def merged_into(self, feed: str) -> int:
        """Version that the last batch of a feed was merged into."""
        return self._published().get("into", {}).get(feed, self.version())

    # -- read -----------------------------------------------------------
    def read(self, dates: list | None = None, version: int | None = None) -> DataFrame:
        """The table, or only the given dates or buckets of it; the newest version unless one is named."""
        state = self._published(version)
        schema = StructType.fromJson(state["schema"])
        slices = state["slices"]
        if dates is not None:
            wanted = {_folder(_layout(state), d) for d in dates}
            slices = {name: commit for name, commit in slices.items() if name in wanted}
        paths = [f"{self.root}/data/{COMMIT}={commit}/{name}".rstrip("/") for name, commit in slices.items()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        with_commit = StructType(list(schema)).add(COMMIT, "string")
        found = self.spark.read.schema(with_commit).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(*schema.names)

    def has(self, version: int) -> bool:
        """Whether a version is still there."""
        return storage.exists(self.spark, f"{self.root}/published/{version:010d}.json")

    # -- write ----------------------------------------------------------
    def _write(self, df: DataFrame, state: dict, version: int) -> dict[str, str]:
        """Write rows as a new commit; give the commit of each folder written."""
        partition_by = _layout(state)
        if partition_by == BUCKET:
            df = df.withColumn(BUCKET, _bucket_of(state))
        commit = f"{version}-{uuid.uuid4().hex}"
        path = f"{self.root}/data/{COMMIT}={commit}"
        if not partition_by:
            df.write.parquet(path)
            return {"": commit}
        # Few files per folder, while one with very many rows is spread out.
        df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path)
        return {e.name: commit for e in storage.listing(self.spark, path) if e.is_dir}

    def _publish(self, version: int, state: dict) -> None:
        storage.write_text_once(self.spark, f"{self.root}/published/{version:010d}.json", json.dumps(state))

    def create(
        self, df: DataFrame, partition_by: str | None = None, buckets: int | None = None, keys: list[str] = (),
    ) -> "KeyedTable":
        """First version of the table, by date, in ``buckets`` by hash of the keys, or in one piece."""
        if partition_by and not isinstance(df.schema[partition_by].dataType, DateType):
            raise ValueError(f"{partition_by} must be a date column")
        if buckets is not None and (partition_by or not keys or buckets < 1 or BUCKET in df.columns):
            raise ValueError(f"buckets need keys, no date column and no column named {BUCKET}")
        if self.exists():
            raise FileExistsError(self.root)
        state = {"partition_by": partition_by, "schema": json.loads(df.schema.json()), "batches": {}}
        if buckets is not None:
            state["buckets"] = {"keys": list(keys), "count": buckets}
        self._publish(1, state | {"slices": self._write(df, state, 1)})
        return self

    def rebucket(self, count: int) -> "KeyedTable":
        """Rewrite the table in another number of buckets, once it has outgrown the first."""
        over = self.version()
        state = self._published(over)
        if not state.get("buckets"):
            raise ValueError(f"the table at {self.root} has no buckets")
        state["buckets"]["count"] = count
        state["slices"] = self._write(self.read(version=over), state, over + 1)
        self._publish(over + 1, state)
        return self

    def replace(
        self, df: DataFrame, dates: list | None = None, feed: str | None = None, batch: int | None = None,
        over: int | None = None,
    ) -> "KeyedTable":
        """Publish new contents for the given dates or buckets, or for the whole table.

        ``over`` is the version the contents were made from; the call fails if
        another has been published since.
        """
        over = over or self.version()
        version, state = over + 1, self._published(over)
        written = self._write(df.select(*StructType.fromJson(state["schema"]).names), state, version)
        gone = set(state["slices"]) if dates is None else {_folder(_layout(state), d) for d in dates}
        state["slices"] = {n: c for n, c in state["slices"].items() if n not in gone} | written
        if feed is not None:
            state.setdefault("into", {})[feed] = over
            if batch is not None:
                state["batches"][feed] = batch
        self._publish(version, state)
        return self

    def upsert(
        self, source: DataFrame, keys: list[str],
        merge: Callable[..., DataFrame] = merge_all, feed: str | None = None, batch: int | None = None, **options,
    ) -> "KeyedTable":
        """Merge a source and publish the result; a batch already in is left out.

        Touched dates are those of the source and those in which the table
        holds one of the source's keys, so a row may move between dates. A
        source without dates can only change rows the table holds. Touched
        buckets follow from the source's keys alone. The source
        is computed once; if another writer publishes first, it is merged into
        the new version.
        """
        if feed is not None and batch is not None and batch <= self.last_batch(feed):
            return self
        source = staged(source, "upsert")
        for _ in range(ATTEMPTS):
            version = self.version()
            dates = self.touched_dates(source, keys, version)
            merged = merge(self.read(dates, version), source, keys, **options)
            try:
                return self.replace(merged, dates, feed, batch, version)
            except FileExistsError:
                if feed is not None and batch is not None and batch <= self.last_batch(feed):
                    return self
        raise FileExistsError(f"{self.root}: other writers published first {ATTEMPTS} times")

    def touched_dates(self, source: DataFrame, keys: list[str], version: int | None = None) -> list | None:
        """Dates or buckets that an upsert of the source rewrites; None if it is the whole table."""
        state = self._published(version)
        partition_by = state["partition_by"]
        if state.get("buckets"):
            if set(keys) != set(state["buckets"]["keys"]):
                return None
            # The table is not read. At most one value per bucket.
            return [row[0] for row in source.select(_bucket_of(state)).distinct().collect()]
        if not partition_by:
            return None
        held = self.read(version=version).select(*keys, partition_by).join(source.select(*keys), keys, "left_semi")
        touched = held.select(partition_by)
        if partition_by in source.columns:
            touched = touched.union(source.select(partition_by))
        # One value per partition folder: bounded by the table's layout.
        return [row[0] for row in touched.distinct().collect()]

    def retain(self, versions: int) -> None:
        """Remove all but the newest versions, and the data that only they name.

        Data of versions that are being written stays. Readers of a removed
        version fail, so keep as many as the longest job needs.
        """
        entries = sorted(storage.listing(self.spark, f"{self.root}/published"), key=lambda e: e.name)
        kept, gone = entries[-versions:], entries[:-versions]
        if versions < 1 or not gone:
            return
        used = {c for e in kept for c in json.loads(storage.read_text(self.spark, e.path))["slices"].values()}
        newest_gone = int(gone[-1].name[:-5])
        for entry in gone:
            storage.delete(self.spark, entry.path)
        for folder in storage.listing(self.spark, f"{self.root}/data"):
            commit = folder.name.partition("=")[2]
            if commit not in used and int(commit.partition("-")[0]) <= newest_gone:
                storage.delete(self.spark, folder.path)


def _layout(state: dict) -> str | None:
    """Column by whose values the folders of a table go."""
    return BUCKET if state.get("buckets") else state["partition_by"]


def _bucket_of(state: dict) -> Column:
    """Bucket of a row. Keys are taken in the table's types, as the hash of a
    number depends on its type."""
    schema, layout = StructType.fromJson(state["schema"]), state["buckets"]
    typed = [F.col(k).cast(schema[k].dataType) for k in layout["keys"]]
    return F.pmod(F.xxhash64(*typed), F.lit(layout["count"])).cast("int")


def _folder(column: str, value) -> str:
    return f"{column}={NULL_FOLDER if value is None else value}"


def create_or_upsert(
    table: KeyedTable, source: DataFrame, keys: list[str], partition_by: str | None = None,
    buckets: int | None = None, **options
) -> KeyedTable:
    """Create the table from the source if there is none, else merge into it."""
    if table.exists():
        return table.upsert(source, keys, **options)
    unique = one_row_per_key(source, keys, options.get("on_duplicate", "error"), options.get("order_by"))
    return table.create(unique, partition_by, buckets, keys)


def run_merge(
    table: KeyedTable, stage: Callable[[], DataFrame], keys: list[str],
    merge: Callable[..., DataFrame] = merge_all, **options,
) -> KeyedTable:
    """Stage, merge, publish. The staged rows live only as a plan: there is no
    staging table to empty, and a failure before publishing changes nothing."""
    return table.upsert(stage(), keys, merge, **options)


def with_date(df: DataFrame, ts_col: str, date_col: str) -> DataFrame:
    """Add the date a table is partitioned by."""
    return df.withColumn(date_col, F.to_date(ts_col))
