"""Incremental loads: extract after the mark, land, merge, then move the mark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tables import KeyedTable
from ..operators.watermark import advance_hwm, extract_incremental, get_hwm, mark_of


def incremental_load(
    source: DataFrame, name: str, store: KeyedTable, apply: Callable[[DataFrame], None]
) -> str | None:
    """Extract the rows after the mark, apply them, and then move the mark.

    The new mark is read first and bounds the extract, so rows that arrive
    meanwhile are left to the next run. ``apply`` must have finished when it
    returns; if it fails the mark stays and the next run takes the same rows.
    An empty extract applies nothing.
    """
    column, last = get_hwm(store, name)
    extract = extract_incremental(source, column, last)
    mark = mark_of(extract, column)
    if mark is None:
        return last
    apply(extract.filter(F.col(column) <= F.lit(mark).cast(extract.schema[column].dataType)))
    return advance_hwm(store, name, mark)
