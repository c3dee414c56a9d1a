"""File sources. Schemas are given, never inferred."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from itertools import dropwhile, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.tables import KeyedTable
from ..schemas import columns
from ..session import scratch_path

FILE = "file"
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "false"}


def csv_options(multi_line: bool = False) -> dict[str, str]:
    """Reader settings. With ``multi_line`` quoted texts may hold line breaks;
    a file is then one task, so datasets of free text come as many files."""
    return CSV_OPTIONS | {"multiLine": str(multi_line).lower()}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | str, multi_line: bool = False
) -> DataFrame:
    """CSV with a header line; a file, a folder, a glob or a list of them.

    Columns are taken by their names in the header; those the schema does not
    name are left out, one that is missing is an error. All files must have
    the header of the first, or the job fails (``read_many`` takes files whose
    headers differ).
    """
    schema = columns(schema) if isinstance(schema, str) else schema
    options = csv_options(multi_line)
    header = spark.read.options(**options).csv(path).columns
    if not header:  # no file has a line
        return spark.createDataFrame([], schema)
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    layout = StructType([schema[name] if name in schema.names else StructField(name, StringType()) for name in header])
    found = spark.read.schema(layout).options(**options, enforceSchema="false").csv(path)
    return found.select(*[f"`{name}`" for name in schema.names])


def header_index(spark: SparkSession, path: str | list[str], multi_line: bool = False, **options) -> DataFrame:
    """file and header, as an array of names, of every CSV file that has a line.

    A task per file takes its first lines and goes no further, whatever the
    size of the file; the result is written once. The header is the first line
    that is not blank, with ``multi_line`` several if its names hold line breaks.
    """
    def first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The header of the one file whose lines come in."""
        name = None

        def lines() -> Iterator[str]:
            nonlocal name
            for batch in batches:
                if batch.num_rows and batch.column(1)[0].as_py():
                    return  # a later part of a very large file
                for file, line in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                    name = name or file
                    if file != name:
                        raise ValueError("lines of several files in one task")
                    yield line + "\n"

        filled = dropwhile(lambda line: not line.strip(), lines())
        header = next(csv.reader(filled if multi_line else islice(filled, 1)), None)
        if header is not None:
            yield pa.RecordBatch.from_pydict({FILE: [name], "header": [header]})

    # Settings of a session of its own: a file is one split, and each split a task.
    alone = spark.newSession()
    for name in ("maxPartitionBytes", "openCostInBytes"):
        alone.conf.set(f"spark.sql.files.{name}", str(1 << 40))
    alone.conf.set("spark.sql.files.maxPartitionNum", str((1 << 31) - 1))
    alone.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    lines = alone.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("block"), "value")
    found = scratch_path(spark, "headers")
    lines.mapInArrow(first_record, f"{FILE} string, header array<string>").write.parquet(found)
    return spark.read.schema(f"{FILE} string, header array<string>").parquet(found)


def file_cells(spark: SparkSession, path: str | list[str], width: int, multi_line: bool = False, **options) -> DataFrame:
    """Every record below the header lines as an array of ``width`` texts, beside its file.

    What a record has beyond that is left out, what it lacks is null.
    """
    schema = StructType([StructField(f"c{i}", StringType()) for i in range(width)])
    return spark.read.schema(schema).options(**csv_options(multi_line) | options, enforceSchema="true").csv(path).select(
        F.col("_metadata.file_path").alias(FILE), F.array(*schema.names).alias("cells"))


def widest(index: DataFrame) -> int:
    """Cells of the widest header; one number."""
    return index.agg(F.max(F.size("header"))).first()[0] or 1


def value_of(name: str) -> Column:
    """Cell of a column by the file's own header; null where the file lacks the column."""
    # Position 0 means that the file lacks the column.
    return F.try_element_at("cells", F.nullif(F.array_position("header", name), F.lit(0)).cast("int"))


def read_many(
    spark: SparkSession, paths: list[str], schema: StructType, multi_line: bool = False
) -> DataFrame:
    """One dataset from several places whose headers may differ.

    Columns are taken by name from each file's own header; a file that lacks
    one gives nulls. All files are read by one scan, however many there are.
    """
    index = header_index(spark, paths, multi_line)
    return file_cells(spark, paths, widest(index), multi_line).join(index, FILE).select(
        *[value_of(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def load_staging(
    spark: SparkSession, path: str, schema: StructType, table: KeyedTable | None = None, multi_line: bool = False
) -> DataFrame:
    """Bulk load by position: the header is skipped and the schema names the columns."""
    staged = spark.read.schema(schema).options(**csv_options(multi_line), enforceSchema="true").csv(path)
    return table.create(staged).read() if table is not None else staged


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """path, modificationTime and length of every file below a path.

    The content column is not selected, so no file is opened.
    """
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path", "modificationTime", "length")
    )


def latest_snapshot(spark: SparkSession, path: str) -> str:
    """Folder below the path that was written last."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    newest = (
        file_listing(spark, path).groupBy(folder.alias("folder"))
        .agg(F.max("modificationTime").alias("written"))
        .orderBy(F.col("written").desc(), F.col("folder").desc()).first()
    )
    if newest is None:
        raise FileNotFoundError(path)
    return newest["folder"]


def read_latest_snapshot(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """Every part of the newest snapshot under a path."""
    return read_csv(spark, latest_snapshot(spark, path), schema, multi_line)


def read_keyed(table: KeyedTable) -> DataFrame:
    """Full scan of a keyed table, spread over its files."""
    return table.read()
