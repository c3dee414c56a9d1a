"""Named queries over the supplied tables, each beside the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import FILE_PARTITION_BYTES, configure, size_shuffles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TS_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table; shuffles are sized for the largest one that is read."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    size_shuffles(spark, rows, target=FILE_PARTITION_BYTES)
    return rows


def portable(df: DataFrame) -> DataFrame:
    """Columns in types every engine renders alike: doubles, longs, texts."""
    def plain(field: T.StructField):
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(kind, WHOLE):
            col = col.cast("bigint")
        elif isinstance(kind, T.DateType):
            col = col.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, TS_PATTERN)
        return col.alias(field.name)

    return df.select(*[plain(f) for f in df.schema])


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name."""
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return portable(fn(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# SQL spellings of the portable types.
def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def money(expr: str) -> str:
    return f"cast({expr} as decimal(18,2))"


def ratio(total: str, n: str) -> str:
    return f"cast({total} as double) / nullif(cast({n} as double), 0)"
