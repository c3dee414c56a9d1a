"""Generated row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..session import shared_folder

ROW_BITS = 33


def next_id(table: DataFrame, id_col: str) -> int:
    return (table.agg(F.max(id_col)).first()[0] or 0) + 1


def assign_ids(df: DataFrame, id_col: str, order_by: list[str], start: int = 1) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in the given order.

    Rows are range-partitioned, sorted inside their partition and checkpointed;
    the sizes of the partitions, one small row each, then give the offset of
    every partition. No task sees all rows, and numbers do not change when a
    task is run again.
    """
    order: list[Column] = [F.col(c) for c in order_by] + [F.xxhash64(*df.columns)]
    shared_folder(df.sparkSession)
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    at = F.monotonically_increasing_id()
    placed = placed.withColumn("__part", F.shiftright(at, ROW_BITS)).withColumn(
        "__row", at.bitwiseAND((1 << ROW_BITS) - 1)
    )
    sizes = placed.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("__part"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")
    )
    # One row per partition: small whatever the size of the data.
    numbered = placed.join(F.broadcast(offsets), "__part")
    new_id = (F.col("__offset") + F.col("__row") + F.lit(start)).cast(LongType())
    return numbered.select(new_id.alias(id_col), *df.columns)
