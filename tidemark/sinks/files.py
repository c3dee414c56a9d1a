"""Batch file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators.tables import KeyedTable, with_date


def write_csv(df: DataFrame, path: str, multi_line: bool = False) -> None:
    """CSV with a header line. A text with a line break fails the job unless
    ``multi_line`` says that its readers expect them."""
    def one_line(name: str):
        text = F.col(f"`{name}`")
        said = F.raise_error(F.lit(f"{name} holds a line break; write and read it with multi_line"))
        return F.when(text.rlike("[\r\n]"), said).otherwise(text).alias(name)

    if not multi_line:
        df = df.select(*[one_line(f.name) if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`") for f in df.schema])
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_extract(df: DataFrame, path: str, multi_line: bool = False) -> bool:
    """CSV export of an extract; an empty extract leaves the path as it is."""
    if df.isEmpty():
        return False
    write_csv(df, path, multi_line)
    return True


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path, mode="overwrite")


def create_table(table: KeyedTable, df: DataFrame, ts_col: str | None = None, date_col: str | None = None) -> KeyedTable:
    """First write of a table, partitioned by the date of ``ts_col`` when given."""
    if ts_col is None:
        return table.create(df)
    return table.create(with_date(df, ts_col, date_col), partition_by=date_col)


def write_json(df: DataFrame, path: str, run_id: str, key: str) -> str:
    """One JSON object per key, under a folder named after the run. A run that
    is repeated writes its folder again."""
    target = f"{path.rstrip('/')}/aggregated_results_{run_id}"
    values = F.struct(*[c for c in df.columns if c != key])
    df.select(F.create_map(F.col(key), values).alias("v")).select(
        F.to_json("v").alias("value")
    ).write.mode("overwrite").text(target)
    return target
