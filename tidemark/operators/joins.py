"""Joins that keep their shape when one key holds a large share of the rows.

In a batch adaptive execution splits such a key. A stream has no adaptive
plan, so there the large side is salted when the other is too large to
broadcast; the keys worth it are named by a sketch of rows seen before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fits_broadcast

SALT = "__salt"
SALTS = 16
# A frequent-items sketch of this many counters misses no key above the
# smallest share: its error is a ten-thousandth of the rows.
TRACKED = 16384
LISTED = 1024
SMALLEST_SHARE = 1 / 512


def hot_hashes(df: DataFrame, on: list[str], share: float) -> list[int]:
    """Hashes of the keys that may hold more than ``share`` of the rows.

    One pass, in which a task sends one sketch and no rows. No key above the
    share is missed; some just below it may be named. The list has at most
    ``LISTED`` entries whatever the size of the frame.
    """
    if not SMALLEST_SHARE <= share <= 1:
        raise ValueError(f"share must lie between {SMALLEST_SHARE} and 1")
    found = df.select(F.xxhash64(*on).alias("h")).agg(
        F.expr(f"approx_top_k(h, {LISTED}, {TRACKED})").alias("top"), F.count("*").alias("n")
    ).first()
    slack = found["n"] * 4 / TRACKED
    return [item["item"] for item in found["top"] if item["count"] > found["n"] * share - slack]


def hot_keys(df: DataFrame, on: list[str], share: float | None = None) -> Column:
    """Condition on the key columns: true for keys that hold a large share of
    ``df``, by default more than a shuffle partition's. A null is a key too."""
    if share is None:
        share = max(SMALLEST_SHARE, 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hashes = hot_hashes(df, on, share)
    return F.xxhash64(*on).isin(hashes) if hashes else F.lit(False)


def hot_key_counts(df: DataFrame, on: list[str], share: float) -> DataFrame:
    """Each key above ``share`` of the rows with its exact count ``n``: the
    sketch names candidates, and only their rows are counted by key."""
    candidates = df.filter(hot_keys(df, on, share)).groupBy(*on).agg(F.count("*").alias("n"))
    return candidates.filter(F.col("n") > F.lit(df.count()) * F.lit(share))


def salted_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS, hot: Column | None = None
) -> DataFrame:
    """Spread the keys of the left side that are ``hot`` over ``salts`` tasks.

    ``hot`` is a condition on the key columns; without it every key is spread.
    The salt is a hash of the row, so a task that is run again gives the same
    rows. Rows of the right side are repeated once per salt where their key is
    hot, and stay single elsewhere. The copies are always shuffled: the
    optimizer takes them for as small as the rows they were made from, and
    would collect them all on the driver for a broadcast.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted join cannot be {how}")
    if hot is not None and any(left.schema[k].dataType != right.schema[k].dataType for k in on):
        raise ValueError("both sides need keys of one type, as the condition is taken on each")
    is_hot = F.lit(True) if hot is None else F.coalesce(hot, F.lit(False))
    salt = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    spread = left.withColumn(SALT, F.when(is_hot, salt).otherwise(0))
    return spread.join(_copied(right, is_hot, salts).hint("merge"), [*on, SALT], how).drop(SALT)


def _copied(right: DataFrame, is_hot: Column, salts: int) -> DataFrame:
    last = F.when(is_hot, F.lit(salts - 1)).otherwise(0)
    return right.withColumn(SALT, F.explode(F.sequence(F.lit(0), last)))


def join_static(
    stream: DataFrame, static: DataFrame, on: list[str], how: str = "inner", salts: int = SALTS,
    history: DataFrame | None = None,
) -> DataFrame:
    """Join rows as they come with a static table: broadcast while its size
    allows, salted beyond that. The keys to salt are those frequent in
    ``history``, rows of the stream that have landed before; without it all
    are. A key that turns hot later is only slower, until the next start."""
    if fits_broadcast(static):
        return stream.join(F.broadcast(static), on, how)
    if not stream.isStreaming:
        return stream.join(static, on, how)
    hot = None if history is None else hot_keys(history, on)
    return salted_join(stream, static, on, how, salts, hot)


def suffixed(df: DataFrame, suffix: str, keep: list[str]) -> DataFrame:
    """Rename all columns but the kept ones, so that a join has no ambiguous names."""
    return df.select(*[F.col(c).alias(c if c in keep else c + suffix) for c in df.columns])
