"""Drop lines that many documents share.

Lines are exploded to hashes of their normalised form. A cheap count by a
64-bit hash first finds those that occur often enough to matter; distinct
documents are counted on the rest by 128-bit hash. Both counts are combined
before their shuffle, so a line found in a third of all documents is no hot
key. The texts move once, and only if the list of dropped lines is too large
to broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.staging import staged
from .text import slices

MIN_KEY_CHARS = 20
MIN_DOCUMENTS = 3
_STRIPPED = " \t\n\x0b\x0c\r"
# Rows without an id count as one document whose id is below all others.
_NO_ID = -(1 << 63)


def line_key(line: str, min_chars: int = MIN_KEY_CHARS) -> bytes | None:
    """Hash of the normalised line, or None for a key that is too short."""
    key = line.strip(_STRIPPED)
    return hashlib.md5(key.encode().lower(), usedforsecurity=False).digest() if len(key) >= min_chars else None


def _line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, row, key) for each different key of a document; ``row`` is a hash of its text."""
    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids, rows, keys = [], [], []
            for one, text, row in zip(*(c.to_pylist() for c in part.columns)):
                found = {line_key(line, min_chars) for line in text.split("\n")} if text else set()
                found.discard(None)
                ids += [one] * len(found)
                rows += [row] * len(found)
                keys += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(keys, pa.binary())],
                                             ["id", "row", "key"])

    return docs.select("id", "text", F.xxhash64("text").alias("row")).mapInArrow(hashes, "id long, row long, key binary").withColumn("short", F.xxhash64("key"))


def dropped_lines(docs: DataFrame, min_chars: int, min_documents: int) -> DataFrame:
    """(id, row, keys): the lines each row loses. ``docs`` has the columns id and text.

    Rows are counted as documents by their id, and collect their lines under
    id and text, so many rows that share an id, or have none, are not one group.
    """
    lines = _line_hashes(docs, min_chars)
    often = staged(lines.groupBy("short").count().filter(F.col("count") >= min_documents).select("short"), "often")
    hot = staged(lines.join(often, "short", "left_semi").select("id", "row", "key"), "hot-lines")
    # Written first: a join of two new shuffles splits a line that very many documents hold.
    shared = staged(hot.groupBy("key").agg(F.count_distinct("id").alias("n"), F.max("id").alias("stays"))
                    .filter(F.col("n") >= min_documents).select("key", "stays"), "shared-lines")
    lost = hot.join(shared, "key").filter(F.col("id") != F.col("stays"))
    return staged(lost.groupBy("id", "row").agg(F.collect_set("key").alias("keys")), "lost-lines")


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_chars: int = MIN_KEY_CHARS, min_documents: int = MIN_DOCUMENTS,
                      digest: bool = False) -> DataFrame:
    """The documents without the lines that at least ``min_documents`` share.

    A line's key is the line without ASCII white space at its ends and with
    A-Z in lower case. Of the documents that hold a key of ``min_chars`` code
    points or more, only the one with the largest id keeps its lines of that
    key. Returns all columns with the new text, and ``n_lines`` and
    ``n_dropped`` (replacing columns of those names); with ``digest`` only id,
    counts and ``kept_sha256``.

    A null text is one empty line and stays null if nothing is dropped from
    it. Rows that repeat an id are one document when documents are counted.
    Rows without an id count as one document below all others. An empty table
    gives no rows.
    """
    known = F.coalesce(docs[id_col].cast("bigint"), F.lit(_NO_ID))
    lost = dropped_lines(docs.select(known.alias("id"), docs[text_col].alias("text")), min_chars, min_documents)
    added = {"n_lines", "n_dropped"}
    kept_columns = [c for c in docs.columns if c.lower() not in added] if not digest else [id_col, text_col]
    # Prefixed, as the table may have any names of its own.
    carried = docs.select(known.alias("_id"), F.xxhash64(docs[text_col]).alias("_row"), *[docs[c].alias(f"c_{c}") for c in kept_columns])
    joined = carried.join(lost.select(F.col("id").alias("_id"), F.col("row").alias("_row"), F.col("keys").alias("_keys")),
                          ["_id", "_row"], "left").drop("_id", "_row")
    where = kept_columns.index(text_col)
    fields = [docs.schema[c] for c in kept_columns]
    if digest:
        out = T.StructType([T.StructField(id_col, T.LongType()), T.StructField("n_lines", T.LongType()),
                            T.StructField("n_dropped", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    else:
        out = T.StructType([T.StructField(f.name, f.dataType) for f in fields]
                           + [T.StructField(c, T.LongType()) for c in sorted(added, reverse=False)])

    def rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts, n_lines, n_dropped = [], [], []
            for text, keys in zip(part.column(where).to_pylist(), part.column(len(kept_columns)).to_pylist()):
                lines = (text or "").split("\n")
                gone = set(keys or ())
                stay = [line for line in lines if line_key(line, min_chars) not in gone] if gone else lines
                texts.append(text if len(stay) == len(lines) else "\n".join(stay))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
            counts = {"n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64())}
            if digest:
                sha = [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
                arrays = [part.column(0).cast(pa.int64()), counts["n_lines"], counts["n_dropped"], pa.array(sha, pa.string())]
            else:
                arrays = [part.column(i) for i in range(len(kept_columns))]
                arrays[where] = pa.array(texts, part.column(where).type)
                arrays += [counts[c] for c in sorted(added)]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in out])

    return joined.mapInArrow(rebuilt, out)
