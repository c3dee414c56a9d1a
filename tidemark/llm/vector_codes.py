"""Compress vectors to product codes, exactly and in whole numbers.

Components become whole numbers and each vector is cut into equal parts, with
a codebook per part position. The nearest entry of a part is searched in the
integer Walsh-Hadamard transform of the zero-padded part and entries: for n
points the squared distance of the transforms is n times that of the parts, so
it is summed in sequency order, slowest changes first, and an entry leaves as
soon as its sum is over the whole distance of one that is known. Nothing is
rounded: where 64 bits could overflow, the same steps run on Python's integers.

Vectors are never shuffled. A task sums its parts per entry; the codebooks, the
only state, hold ``entries`` vectors whatever the input.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import staged
from .text import slices

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
SLAB_ROWS = 4096
LIMB_BITS = 32


def whole_numbers(flat: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as int64 where that holds it and else as Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(flat * scale)
    if np.all(np.abs(scaled) < 2.0**62):
        return scaled.astype(np.int64)
    return np.array([math.floor(x * scale) if abs(x) < 1e300 else int(x) * scale for x in flat.tolist()], object)


def whole_vectors(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, filled with zeros up to ``width``."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = whole_numbers(column.flatten().to_numpy(zero_copy_only=False))
    if np.all(sizes == width):
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def sequency(n: int) -> np.ndarray:
    """Rows of the natural Walsh-Hadamard order by their number of sign changes."""
    bits = n.bit_length() - 1
    gray = [i ^ i >> 1 for i in range(n)]
    return np.array([int(f"{g:0{bits}b}"[::-1], 2) if bits else 0 for g in gray], np.int64)


def walsh_hadamard(rows: np.ndarray) -> np.ndarray:
    """Transform of each row in sequency order, zero-padded to a power of two."""
    n = 1 << max(0, rows.shape[1] - 1).bit_length()
    out = np.zeros((len(rows), n), rows.dtype)
    out[:, :rows.shape[1]] = rows
    half = 1
    while half < n:
        pairs = out.reshape(len(out), n // (2 * half), 2, half)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), n)
        half *= 2
    return out[:, sequency(n)]


def _largest(values: np.ndarray) -> int:
    return max((abs(int(values.min())), abs(int(values.max()))), default=0) if values.size else 0


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of each part; ties go to the lower index."""
    n = 1 << max(0, parts.shape[1] - 1).bit_length()
    exact = 4 * n**3 * max(_largest(parts), _largest(entries)) ** 2 < 2**63
    kind = np.int64 if exact else object
    known = walsh_hadamard(entries.astype(kind))
    index, distance = np.zeros(len(parts), np.int64), np.zeros(len(parts), kind)
    for first in range(0, len(parts), SLAB_ROWS):
        found = walsh_hadamard(parts[first:first + SLAB_ROWS].astype(kind))
        total = (found[:, :1] - known[None, :, 0]) ** 2
        likely = np.argmin(total, axis=1)
        bound = ((found - known[likely]) ** 2).sum(axis=1)
        rows, cols = np.nonzero((total <= bound[:, None]).astype(bool))
        total = total[rows, cols]
        for step in range(1, n):
            total = total + (found[rows, step] - known[cols, step]) ** 2
            stay = (total <= bound[rows]).astype(bool)
            rows, cols, total = rows[stay], cols[stay], total[stay]
        # Entries are in order within a row, so the first of the smallest wins.
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        least = np.minimum.reduceat(total, starts)
        best = np.flatnonzero((total == least[rows]).astype(bool))
        best = best[np.diff(rows[best], prepend=-1) > 0]
        index[first:first + SLAB_ROWS], distance[first:first + SLAB_ROWS] = cols[best], least // n
    return index, distance


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, signed digit) in base 2**32, so that sums of digits fit in a long."""
    sign, left, place = (-1 if value < 0 else 1), abs(value), 0
    while left:
        digit = left & ((1 << LIMB_BITS) - 1)
        if digit:
            yield place, sign * digit
        left >>= LIMB_BITS
        place += 1


def _part(vectors: np.ndarray, part: int, parts: int) -> np.ndarray:
    width = vectors.shape[1] // parts
    return vectors[:, part * width:(part + 1) * width]


def _sums(vectors: DataFrame, width: int, books: np.ndarray) -> DataFrame:
    """Per part, entry and place within it (-1: the count) the digits of the sum, one row set per task."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, size = books.shape
        counts = np.zeros((parts, entries), np.int64)
        totals = np.zeros((parts, entries, size), object)
        for batch in slices(batches, SLAB_ROWS):
            rows = whole_vectors(batch.column(0), width)
            for p in range(parts):
                own = _part(rows, p, parts)
                index, _ = nearest(own, books[p])
                counts[p] += np.bincount(index, minlength=entries)
                order = np.argsort(index, kind="stable")
                starts = np.flatnonzero(np.diff(index[order], prepend=-1))
                small = own if _largest(own) < 2**48 else own.astype(object)
                totals[p][index[order][starts]] += np.add.reduceat(small[order], starts, axis=0).astype(object)
        out = [(p, e, -1, 0, int(counts[p, e])) for p, e in zip(*np.nonzero(counts))]
        out += [(p, e, d, place, digit) for p, e in zip(*np.nonzero(counts)) for d in range(size)
                for place, digit in _limbs(int(totals[p, e, d]))]
        columns = list(zip(*out)) or [()] * 5
        names, kinds = ["part", "entry", "place", "limb", "total"], [pa.int32()] * 4 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(map(int, c), k) for c, k in zip(columns, kinds)], names)

    return vectors.mapInArrow(summed, "part int, entry int, place int, limb int, total long")


def _refined(vectors: DataFrame, width: int, books: np.ndarray) -> np.ndarray:
    """Each used entry becomes the floor of the mean of its parts."""
    found: dict[tuple[int, int, int], int] = {}
    sums = _sums(vectors, width, books).groupBy("part", "entry", "place", "limb").agg(F.sum("total").alias("total"))
    for row in sums.toLocalIterator():  # entries x width rows, whatever the input
        key = row.part, row.entry, row.place
        found[key] = found.get(key, 0) + (row.total << LIMB_BITS * row.limb)
    out = books.astype(object)
    for (p, e, place), count in found.items():
        if place < 0:
            out[p, e] = [found.get((p, e, d), 0) // count for d in range(books.shape[2])]
    return _narrow(out)


def _narrow(books: np.ndarray) -> np.ndarray:
    return books.astype(np.int64) if _largest(books) < 2**62 else books


def kept_vectors(rows: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is there and holds finite numbers only."""
    finite = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col(vec_col).isNotNull() & finite)


def codebooks(vectors: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Whole numbers by part, entry and place. ``vectors`` has ``vec_id`` and ``vector``.

    The first entries are the vectors of the smallest ids (a null id comes
    last; rows of one id go by their vectors).
    """
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).select("vector").toArrow()
    rows = whole_vectors(first.column(0).combine_chunks(), width)
    books = np.stack([_part(rows, p, parts) for p in range(parts)])
    for _ in range(rounds):
        books = _refined(vectors.select("vector"), width, books)
    return books


def compress(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` per kept row.

    Rows whose vector is null, or holds null, NaN or infinite components, are
    dropped. Vectors shorter than the longest are filled with zeros, as are all
    up to a multiple of ``parts``; an empty vector is all zeros. Rows that
    repeat are all coded, and count as often as they are there; a null id is
    coded too. Null labels are one label. An error that no long can hold is
    null, as is the sum of such. With fewer rows than ``entries`` there are
    fewer entries; an empty table gives no rows. Other columns are ignored.
    """
    if entries > 256:
        raise ValueError("a code has two hexadecimal digits")
    known = rows.select(rows[id_col].cast("bigint").alias("vec_id"), rows[vec_col].cast("array<double>").alias("vector"),
                        rows[label_col].alias("label"))
    known = kept_vectors(known, "vector")
    longest = known.agg(F.max(F.size("vector"))).first()[0]
    width = max(1, -(-(longest or 0) // parts)) * parts
    if longest is None:
        books = np.zeros((parts, 1, width // parts), np.int64)
    else:
        books = codebooks(known.select("vec_id", "vector"), width, parts, entries, rounds)
    digest = hashlib.sha256(",".join(str(int(v)) for v in books.reshape(-1)).encode()).hexdigest()

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, SLAB_ROWS):
            vectors = whole_vectors(batch.column(1), width)
            codes, errors = np.zeros((len(vectors), parts), np.uint8), np.zeros(len(vectors), object)
            for p in range(parts):
                codes[:, p], found = nearest(_part(vectors, p, parts), books[p])
                errors = errors + found
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                pa.array([int(e) if e < 2**63 else None for e in errors.tolist()], pa.int64())], ["vec_id", "label", "code", "error"])

    label_type = known.schema["label"].dataType.simpleString()
    found = staged(known.mapInArrow(coded, f"vec_id long, label {label_type}, code string, error long"), "vector-codes")
    # A sum with an error missing is missing, too.
    total = F.when(F.count("error") == F.count("*"), F.try_sum("error")).alias("label_error")
    totals = staged(found.groupBy("label").agg(total).withColumnRenamed("label", "of"), "label-errors")
    return found.join(totals, found["label"].eqNullSafe(totals["of"])).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
