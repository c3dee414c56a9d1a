"""File checks and readiness gates.

A check gives one row per file of a dataset. The headers come from an index
made of the first lines of each file; the files are then read once, as plain
cells, and wrong values are counted by place. The header tells at the end what
a place holds, so files with different columns, or with columns in another
order, need no separate read, and no record is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import storage
from ..functions.times import strip_utc
from ..sources.files import FILE, file_cells, file_listing, header_index, value_of, widest
from .staging import staged

NO_ROWS = "no rows"
# Every CSV file below a path.
EVERY_CSV = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}


def check_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns the frame lacks; empty when it passes."""
    return [c for c in required if c not in df.columns]


def file_headers(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """file and header, as an array of names, of every CSV file under a path."""
    return header_index(spark, path, multi_line, **EVERY_CSV)


def _fits(value: Column, kind: str, strict: bool) -> Column:
    """Whether a value meets the kind. Timestamps that cannot be read count as
    missing, and text is always fine."""
    if kind == "int":
        # A missing value turns a whole column into fractions: not an int.
        return value.isNotNull() & value.try_cast("bigint").isNotNull() & ~value.contains(".")
    if kind == "float":
        return value.isNull() | value.try_cast("double").isNotNull()
    if kind == "timestamp" and strict:
        return value.isNull() | F.try_to_timestamp(strip_utc(value)).isNotNull()
    return F.lit(True)


def check_format(
    spark: SparkSession, dataset: str, path: str, contract: dict[str, str], strict: bool = False,
    multi_line: bool = False, counts: bool = False,
) -> DataFrame:
    """Report of every file under the path: missing columns, no rows, or the first
    column with values of the wrong kind. ``strict`` also rejects unreadable
    timestamps. ``multi_line`` is for files whose quoted texts hold line breaks;
    ``counts`` adds the rows of each file and its values of the wrong kind."""
    index = file_headers(spark, path, multi_line)
    at = {c: F.array_position("header", c).cast("int") for c in contract}
    # Places that hold a column of the contract in some file, each with its kind: as many as a header has, at most.
    wanted = F.array(*[F.struct(at[c].alias("at"), F.lit(kind).alias("kind")) for c, kind in contract.items()])
    places = [tuple(r) for r in index.select(F.inline(wanted)).filter("at > 0").distinct().orderBy("at", "kind").toLocalIterator()]
    cells = file_cells(spark, path, max([place for place, _ in places], default=1), multi_line, **EVERY_CSV)
    by_file = cells.groupBy(FILE).agg(F.count("*").alias("rows"), *[
        F.count_if(~_fits(F.get("cells", F.lit(place - 1)), kind, strict)).alias(f"{kind}_{place}") for place, kind in places])

    def bad(name: str, kind: str) -> Column:
        # A column that the file lacks is null in every row.
        lacking = F.when(~_fits(F.lit(None).cast("string"), kind, strict) & (at[name] == 0), F.col("rows"))
        held = [F.when(at[name] == place, F.col(f"{kind}_{place}")) for place, of in places if of == kind]
        return F.coalesce(lacking, *held, F.lit(0))

    found = index.join(by_file, FILE, "left").select(
        FILE, "header", F.coalesce("rows", F.lit(0)).alias("rows"), *[bad(c, k).alias(f"bad_{c}") for c, k in contract.items()])
    missing = F.filter(F.array(*[F.lit(c) for c in contract]), lambda c: ~F.array_contains("header", c))
    problem = F.when(
        F.size(missing) > 0, F.concat(F.lit("missing columns: "), F.array_join(missing, ", "))
    ).when(F.col("rows") == 0, F.lit(NO_ROWS)).otherwise(F.coalesce(*[
        F.when(F.col(f"bad_{c}") > 0, F.lit(f"{c}: expected {kind}")) for c, kind in contract.items()
    ]))
    bad = sum((F.col(f"bad_{c}") for c in contract), F.lit(0)).cast("bigint").alias("bad_values")
    return found.select(F.lit(dataset).alias("dataset"), FILE, problem.alias("problem"), "rows", bad).select(
        "dataset", FILE, F.col("problem").isNull().alias("valid"), "problem", *(["rows", "bad_values"] if counts else [])
    )


def check_datasets(
    spark: SparkSession, paths: dict[str, str], contracts: dict[str, dict[str, str]], strict: bool = False
) -> DataFrame:
    """One report over several datasets."""
    parts = [check_format(spark, d, p, contracts[d], strict) for d, p in paths.items()]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def required_columns_present(
    spark: SparkSession, paths: dict[str, str], required: dict[str, list[str]]
) -> dict[str, bool]:
    """Per dataset, whether it has files and all of them have its columns."""
    result = {}
    for dataset, path in paths.items():
        wanted = F.array(*[F.lit(c) for c in required[dataset]])
        complete = F.size(F.array_except(wanted, F.col("header"))) == 0
        # No files give a null, which counts as a failure.
        result[dataset] = storage.exists(spark, path) and bool(
            file_headers(spark, path).agg(F.every(complete)).first()[0]
        )
    return result


def valid_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("dataset").agg(F.count_if("valid").alias("valid_files"))


def _valid_files(report: DataFrame, dataset: str) -> DataFrame:
    return report.filter("valid").filter(F.col("dataset") == dataset).select(FILE)


def read_valid_rows(
    spark: SparkSession, report: DataFrame, dataset: str, path: str, schema: StructType, multi_line: bool = False
) -> DataFrame:
    """Rows of the files that pass, read where they lie; no list of files is made.

    Columns go by each file's own header; a value of another kind is null.
    """
    # The files that pass are found first, a row each; those of no other are joined.
    index = file_headers(spark, path, multi_line)
    passed = index.join(_valid_files(report, dataset), FILE, "left_semi")
    return file_cells(spark, path, widest(index), multi_line, **EVERY_CSV).join(passed, FILE).select(
        *[value_of(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def select_valid_files(report: DataFrame, dataset: str) -> list[str]:
    """Paths to read on; one entry per file."""
    spark = report.sparkSession
    rows = _valid_files(report, dataset).orderBy(FILE).toLocalIterator()
    return [storage.plain_path(spark, row[0]) for row in rows]


def promote_valid_files(spark: SparkSession, report: DataFrame, ready: dict[str, str]) -> dict[str, int]:
    """Move the files that pass into their ready folder; give counts per dataset."""
    counts = dict.fromkeys(ready, 0)
    for dataset, folder in ready.items():
        # The files move while the report is read, so it is fixed first.
        for row in staged(_valid_files(report, dataset), "valid-files").toLocalIterator():
            storage.move_file(spark, storage.plain_path(spark, row[0]), folder)
            counts[dataset] += 1
    return counts


def is_ready(report: DataFrame, expected: list[str]) -> bool:
    """Exactly one valid file of every dataset."""
    counts = {r["dataset"]: r["valid_files"] for r in valid_counts(report).collect()}
    return all(counts.get(d, 0) == 1 for d in expected)


def inputs_present(spark: SparkSession, paths: list[str]) -> bool:
    """Every path has a file that is not empty."""
    return all(
        storage.exists(spark, p) and not file_listing(spark, p).filter(F.col("length") > 0).isEmpty()
        for p in paths
    )
