"""Upserts of a keyed target by a source, as plain DataFrame jobs.

Keys are always a list of columns. A null in a key matches nothing: target
rows with one are kept and source rows with one are inserted. The keys of the
target are taken to be unique.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import fits_broadcast

SOURCE = "__source_"
IN_SOURCE = "__in_source"
IN_TARGET = "__in_target"


def _check_keys(keys: list[str], *frames: DataFrame) -> None:
    if isinstance(keys, str) or not keys:
        raise ValueError("keys must be a non-empty list of column names")
    for frame in frames:
        missing = [k for k in keys if k not in frame.columns]
        if missing:
            raise ValueError(f"key columns not found: {missing}")


def _all_set(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _guard(source: DataFrame, keys: list[str]) -> DataFrame:
    """No rows, but running it fails when a key occurs more than once."""
    message = F.concat(F.lit("several source rows for key "), F.to_json(F.struct(*keys)))
    repeated = F.when(F.col("__n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(False))
    counted = source.filter(_all_set(keys)).groupBy(*keys).agg(F.count("*").alias("__n"))
    return counted.filter(repeated).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema]
    )


def latest_per_key(source: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The last row of each key; rows with a null key are all kept.

    Equal order values are settled by a hash of the row, so that the choice is
    the same in every run.
    """
    newest = [F.col(c).desc_nulls_last() for c in order_by] + [F.xxhash64(*source.columns).desc()]
    ranked = (
        source.filter(_all_set(keys))
        .withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest)))
        .filter(F.col("__rn") == 1)
        .drop("__rn")
    )
    return ranked.unionByName(source.filter(~_all_set(keys)))


def one_row_per_key(
    source: DataFrame, keys: list[str], on_duplicate: str = "error", order_by: list[str] | None = None
) -> DataFrame:
    """Source with unique keys: ``error`` fails on a repeat, ``latest`` keeps the last."""
    if on_duplicate == "error":
        return source.unionByName(_guard(source, keys))
    if on_duplicate == "latest":
        if not order_by:
            raise ValueError("on_duplicate='latest' needs order_by")
        return latest_per_key(source, keys, order_by)
    raise ValueError(f"unknown on_duplicate: {on_duplicate}")


def _keys_seen(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the source that the target holds: no more than the source has,
    found without a shuffle of the target while the source is small."""
    wanted = source.select(*keys).filter(_all_set(keys))
    return target.select(*keys).join(wanted, keys, "left_semi").distinct()


def _without_keys_of(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the other frame does not hold. Neither side is shuffled
    while one of them is small enough to broadcast."""
    if fits_broadcast(rows) and not fits_broadcast(other):
        others = _keys_seen(other, rows, keys)
    else:
        others = other.select(*keys).filter(_all_set(keys))
    return rows.join(others, keys, "left_anti").select(*rows.columns)


def merge_all(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    on_duplicate: str = "error",
    order_by: list[str] | None = None,
) -> DataFrame:
    """Update every column of matched rows, insert all others."""
    _check_keys(keys, target, source)
    incoming = one_row_per_key(source, keys, on_duplicate, order_by)
    return _without_keys_of(target, source, keys).unionByName(incoming)


def replace_by_key(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Delete target rows with a key of the source, then insert every source row,
    repeated keys included."""
    _check_keys(keys, target, source)
    return _without_keys_of(target, source, keys).unionByName(source)


def put_items(target: DataFrame, source: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Replace whole items by key; the last item of a key wins."""
    return merge_all(target, source, keys, "latest", order_by)


def _merge_pairs(
    target: DataFrame, incoming: DataFrame, keys: list[str], updated: dict[str, Column],
    inserted: dict[str, Column], insert: bool,
) -> DataFrame:
    """Join target and source on the keys and build the merged rows.

    ``updated`` and ``inserted`` give column values in terms of the target's
    columns and of the source's, the latter prefixed with ``SOURCE``.
    """
    renamed = incoming.select(
        *[F.col(c).alias(c if c in keys else SOURCE + c) for c in incoming.columns],
        F.lit(True).alias(IN_SOURCE),
    )
    known = renamed.filter(_all_set(keys))
    nameless = renamed.filter(~_all_set(keys))

    def value(column: str, new: bool) -> Column:
        if column in keys:
            return F.col(column)
        fallback = F.lit(None).cast(target.schema[column].dataType) if new else F.col(column)
        return (inserted if new else updated).get(column, fallback)

    def row(new: bool) -> list[Column]:
        return [value(f.name, new).cast(f.dataType).alias(f.name) for f in target.schema]

    def matched_or_kept(joined: DataFrame) -> DataFrame:
        return joined.select(*[
            F.when(F.col(IN_SOURCE), value(f.name, False)).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ])

    if not insert:
        return matched_or_kept(target.join(known, keys, "left"))
    if fits_broadcast(incoming):
        # Two passes over the target, no shuffle of it.
        new_rows = known.join(_keys_seen(target, known, keys), keys, "left_anti").unionByName(nameless).select(*row(True))
        return matched_or_kept(target.join(known, keys, "left")).unionByName(new_rows)
    # One pass over each side. Rows without a key stay out of the shuffle.
    marked = target.withColumn(IN_TARGET, F.lit(True))
    joined = marked.filter(_all_set(keys)).join(known, keys, "full_outer")
    merged = joined.select(*[
        F.when(F.col(IN_SOURCE) & F.col(IN_TARGET), value(f.name, False))
        .when(F.col(IN_SOURCE), value(f.name, True))
        .otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
        for f in target.schema
    ])
    return merged.unionByName(target.filter(~_all_set(keys))).unionByName(nameless.select(*row(True)))


def merge_columns(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    insert: list[str] | None,
    stamp: dict[str, Column] | None = None,
    on_duplicate: str = "error",
    order_by: list[str] | None = None,
) -> DataFrame:
    """Update some columns of matched rows; insert others with the listed columns.
    With ``insert=None`` others are left out.

    ``stamp`` gives columns set on both, such as a load time chosen by the
    caller. Columns not listed stay as they are, or null in a new row.
    """
    _check_keys(keys, target, source)
    stamp = stamp or {}
    wanted = keys + [c for c in source.columns if c not in keys and c in {*update, *(insert or [])}]
    unique = one_row_per_key(source, keys, on_duplicate, order_by).select(*wanted)
    if not update and not stamp and insert is not None:
        fresh = _without_keys_of(unique, target, keys).select(
            *[(F.col(f.name) if f.name in insert or f.name in keys else F.lit(None)).cast(f.dataType).alias(f.name)
              for f in target.schema]
        )
        return target.unionByName(fresh)

    def taken(names: list[str]) -> dict[str, Column]:
        return {n: F.col(SOURCE + n) for n in names if n not in keys} | stamp

    return _merge_pairs(target, unique, keys, taken(update), taken(insert or []), insert is not None)


def patch_items(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    order_by: list[str] | None = None,
    present: dict[str, Column] | None = None,
    insert: bool = True,
) -> DataFrame:
    """Set the attributes a source row brings; leave the others as they are.

    An attribute is set when it is not null, or when its ``present`` condition
    holds. With ``order_by`` several patches of a key are applied in that
    order, attribute by attribute. Without ``insert``, unknown keys are
    skipped.
    """
    _check_keys(keys, target, source)
    order_by = order_by or []
    attributes = [c for c in source.columns if c not in keys and c in target.columns]
    given = {c: (present or {}).get(c, F.col(c).isNotNull()) for c in attributes}
    boxed = source.select(
        *keys,
        *[F.when(given[c], F.struct(F.col(c).alias("value"))).alias(c) for c in attributes],
        F.struct(*order_by, F.xxhash64(*source.columns).alias("tie")).alias("__order"),
    )
    if order_by:
        # The hash settles equal order values the same way in every run.
        named = boxed.filter(_all_set(keys)).groupBy(*keys).agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("__order"))).alias(c) for c in attributes]
        )
        folded = named.unionByName(boxed.filter(~_all_set(keys)).drop("__order"))
    else:
        folded = one_row_per_key(boxed.drop("__order"), keys)
    set_value = {
        c: F.when(F.col(SOURCE + c).isNotNull(), F.col(SOURCE + c)["value"]).otherwise(F.col(c))
        for c in attributes
    }
    new_value = {c: F.col(SOURCE + c)["value"] for c in attributes}
    return _merge_pairs(target, folded, keys, set_value, new_value, insert)


def unmatched(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target does not know."""
    _check_keys(keys, target, source)
    return _without_keys_of(source, target, keys)
