"""Find documents that hold passages of a benchmark, also reworded ones.

Texts are TF-IDF vectors over hashed words. A randomised SVD gives their latent
space, scaled so that the corpus is equally wide in all directions. Each
benchmark passage is looked up there by cosine among windows of its own length,
a quarter of it apart: a longer window would drown a short passage, and unscaled
directions that all texts share would hide it. What is near is verified: by the
longest common subsequence of words, and for reworded passages by their answer
too, the last sentence or the end of a single one, which a paraphrase has to
keep.

Word statistics cover all documents. The SVD is fitted on all their windows and
on the whole benchmark; then every window of every document is searched.
Benchmark passages go to the tasks in blocks of bounded size, one block at a
time, so the documents are read once per block and never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import staged
from .substrings import word_bounds, word_hashes
from .text import slices

FEATURES = 1 << 14
STRIDE = 32
WINDOW = 2 * STRIDE
RANK, EXTRA = 128, 8
PASSES = 2
# In the fit, the windows of a document weigh as one for each FIT_SHARE of them;
# those of all documents together as FIT_WINDOWS at most, and so do passages,
# each BENCHMARK_WEIGHT times as much: neither side outgrows the other.
FIT_SHARE, FIT_WINDOWS = 64, 20_000
BENCHMARK_WEIGHT = 4.0
# Rows multiplied at once, and how many of them have a word that goes by a dense matrix.
FIT_ROWS, FIT_OFTEN = 256, 3
# Passages under MIN_WORDS have to be there whole, so their windows are nearer.
MIN_COSINE, MIN_COSINE_WHOLE = 0.5, 0.6
COPIED, REWORDED, ANSWERED = 0.8, 0.5, 0.8
MIN_WORDS = 8
MAX_PASSAGE = 512
BLOCK_PASSAGES = 4096
# Lengths of the windows that passages are compared with.
SCALES = (4, 8, 12, 16, 24, 32, 48, 64)
PIECE_WORDS = 1 << 14
COMPARED = 1 << 22
SLAB = 256

_PARTING = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_CLAUSE = re.compile(r"[,;:?!]\s")
HITS = "doc_id long, item_id long, overlap double, answered boolean, cosine double"


def parted(text: str | None) -> bytes:
    """Lower-case text in UTF-8, with spaces for ASCII marks and white space."""
    return text.lower().encode().translate(_PARTING) if text else b""


def words_of(text: str | None) -> list[bytes]:
    return parted(text).split()


def features_of(words: list[bytes]) -> np.ndarray:
    return features(b" ".join(words))[0]


def features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of a text whose words are parted by spaces, and where they start."""
    starts, stops = word_bounds(data)
    return (word_hashes(data, starts, stops) % np.uint64(FEATURES)).astype(np.int64), starts


def joined_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Hashed words of all texts, the first word of each and one past the last, and the texts as they were hashed."""
    data = [parted(text) for text in texts]
    found, starts = features(b" ".join(data))
    firsts = np.searchsorted(starts, np.concatenate([[0], np.cumsum([len(d) + 1 for d in data])]))
    firsts[-1] = len(found)
    return found, firsts, data


def window_bounds(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where windows start, with the end of the last, and what each weighs: texts
    are parted into windows of nearly one length, as few as WINDOW words each
    allow. ``firsts`` has the first word of each text and one past the last."""
    sizes = np.diff(firsts)
    parts = -(-sizes // WINDOW)
    text = np.repeat(np.arange(len(sizes)), parts)
    place = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.append(firsts[text] + place * sizes[text] // parts[text], firsts[-1]), (-(-parts // FIT_SHARE))[text] / parts[text]


def sentences(text: str) -> list[str]:
    return [s for s in text.replace("\n", ". ").split(". ") if words_of(s)]


def answer_of(text: str) -> list[bytes]:
    """Words that a paraphrase has to keep: the last sentence; of a single
    sentence its last clause, and without one its last quarter, three words at least."""
    words, last = words_of(text), words_of(sentences(text)[-1])
    if len(last) < len(words):
        return last
    clause = words_of(next((c for c in reversed(_CLAUSE.split(text)) if words_of(c)), ""))
    return clause if 3 <= len(clause) < len(words) else words[-max(3, len(words) // 4):]


def passages(item_id: int, text: str | None) -> list[tuple[int, list[bytes], list[bytes], tuple]]:
    """(item, words, answer, context) of each window of an item; its answer is
    in the last. The context, words and answer, is the part of the item up to
    MAX_PASSAGE words that is compared as a whole where one of its windows is
    near, as a paraphrase may keep less of one window than of the next."""
    words = words_of(text)
    if not words:
        return []
    starts = range(0, max(1, len(words) - STRIDE), STRIDE) if len(words) > WINDOW else [0]
    answer = answer_of(text)
    found = []
    for start in starts:
        part = words[start:start + WINDOW]
        own = answer if start == starts[-1] and len(answer) < len(part) else part
        first = max(0, min(start - start % MAX_PASSAGE, len(words) - MAX_PASSAGE))
        whole = words[first:first + MAX_PASSAGE]
        context = (whole, answer if first + len(whole) == len(words) else whole)
        found.append((item_id, part, own, context if len(starts) > 1 else ()))
    return found


def common_length(masks: dict[bytes, int], size: int, words: list[bytes]) -> int:
    """Length of the longest common subsequence; bit i of a mask says that the
    word is the i-th of the other sequence."""
    rows = (1 << size) - 1
    for mask in filter(None, map(masks.get, words)):
        both = rows & mask
        rows = (rows + both) | (rows - both)
    return size - (rows & ((1 << size) - 1)).bit_count()


def masks_of(words: list[bytes]) -> dict[bytes, int]:
    masks: dict[bytes, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


def scale_of(size: int) -> int:
    """The longest window of which a passage fills most."""
    return max((n for n in SCALES if n <= 1.2 * size), default=SCALES[0])


class Passage:
    """A benchmark passage ready to be compared."""

    def __init__(self, item_id: int, words: list[bytes], answer: list[bytes], context: tuple = ()):
        self.item_id, self.size, self.masks = item_id, len(words), masks_of(words)
        self.answer_size, self.answer_masks = len(answer), masks_of(answer)
        self.length = self.size + self.size // 4 + 1  # of the stretches it is compared with
        self.words, self.scale = words, scale_of(self.size)
        self.context = Passage(item_id, *context) if context else None

    def compare(self, words: list[bytes], start: int, stop: int) -> tuple[float, bool]:
        """Best overlap of the passage with a stretch of its own length near
        words[start:stop], and whether that stretch has the answer."""
        low, high = max(0, start - self.size), min(len(words), stop + self.size)
        region = words[low:high]
        if common_length(self.masks, self.size, region) < REWORDED * self.size:
            return 0.0, False
        step = max(1, self.size // 8)
        best, at = -1, 0
        for s in range(0, max(1, len(region) - self.length + step), step):
            n = common_length(self.masks, self.size, region[s:s + self.length])
            if n > best:
                best, at = n, s
        found = common_length(self.answer_masks, self.answer_size, region[at:at + self.length])
        return best / self.size, found >= ANSWERED * self.answer_size

    def holds(self, overlap: float, answered: bool) -> bool:
        if self.size < MIN_WORDS:
            return overlap == 1.0
        return overlap >= COPIED or overlap >= REWORDED and answered


def _counted(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and how often each is there."""
    cells = np.sort(cells)
    starts = np.flatnonzero(np.diff(cells, prepend=-1))
    return cells[starts], np.diff(starts, append=len(cells))


def _statistics(docs: DataFrame) -> DataFrame:
    """The windows that cover each document, every word once, with what they weigh; and per task, documents that hold each feature."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_docs = np.zeros(FEATURES, np.int64), 0
        for part in slices(batches):
            found, firsts, data = joined_features(part.column(1).to_pylist())
            present, _ = _counted(np.repeat(np.arange(len(data), dtype=np.int32) * FEATURES, np.diff(firsts)) + found.astype(np.int32))
            held += np.bincount(present % FEATURES, minlength=FEATURES)
            n_docs += len(data)
            bounds, shares = window_bounds(firsts)
            words = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [
                None, pa.py_buffer((2 * bounds).astype("<i4")), pa.py_buffer(found.astype("<u2"))])
            none = pa.nulls(len(words), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, words, pa.array(shares)], names)
        which = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([
            pa.array([*which.tolist(), -1], pa.int64()), pa.array([*held[which].tolist(), n_docs], pa.int64()),
            pa.nulls(len(which) + 1, pa.binary()), pa.nulls(len(which) + 1, pa.float64())], names)

    names = ["feature", "n", "words", "share"]
    return docs.mapInArrow(counted, "feature long, n long, words binary, share double")


def _features_used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    used = np.zeros(FEATURES, bool)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            used[features(parted(text))[0]] = True
    yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(used), pa.int64())], ["feature"])


def _weighted(windows: list[bytes], weights: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of the weighted TF-IDF rows by row; words without a weight have no value."""
    sizes = np.fromiter(map(len, windows), np.int64, len(windows)) // 2
    cells = np.repeat(np.arange(len(windows), dtype=np.int32) * FEATURES, sizes) + np.frombuffer(b"".join(windows), "<u2")
    cells, times = _counted(cells[idf[cells % FEATURES] > 0])
    row, feature = cells // FEATURES, cells % FEATURES
    values = times * idf[feature]
    scale = weights / np.sqrt(np.maximum(np.bincount(row, values * values, len(windows)), 1e-30))
    return row, feature, (values * scale[row]).astype(np.float32)


def _add_product(total: np.ndarray, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int, basis: np.ndarray) -> None:
    """Add A'A times the basis to the total, A being n rows given by their cells.
    Features that several rows have go by a dense matrix, the others cell by cell."""
    times = np.bincount(feature, minlength=FEATURES)
    often = np.flatnonzero(times >= FIT_OFTEN)
    place = np.full(FEATURES, -1)
    place[often] = np.arange(len(often))
    column = place[feature]
    dense, seldom = column >= 0, np.flatnonzero(column < 0)
    cells = np.zeros((n, len(often)), np.float32)
    cells[row[dense], column[dense]] = value[dense]
    row, feature, value = row[seldom], feature[seldom], value[seldom, None]
    product = cells @ basis[often]
    if len(row):
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        product[row[starts]] += np.add.reduceat(basis[feature] * value, starts, axis=0)
    total[often] += cells.T @ product
    order = np.argsort(feature, kind="stable")
    starts = np.flatnonzero(np.diff(feature[order], prepend=-1))
    nth = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
    for i in range(FIT_OFTEN - 1):  # no feature is there twice in one step
        some = order[nth == i]
        total[feature[some]] += product[row[some]] * value[some]


def _multiplied(rows: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'A times the basis, A being the weighted TF-IDF rows; sums are made by slabs of features."""
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((idf, basis))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, basis = shared.value
        total = np.zeros(basis.shape, np.float32)
        for part in slices(batches, FIT_ROWS):
            cells = _weighted(part.column(0).to_pylist(), part.column(1).to_numpy(), idf)
            _add_product(total, *cells, part.num_rows, basis)
        for i, s in enumerate(range(0, FEATURES, SLAB)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total[s:s + SLAB].tobytes()], pa.binary())], ["slab", "part"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for part in slices(batches, 1):
            slab, sums = part.column(0)[0].as_py(), np.frombuffer(part.column(1)[0].as_py(), np.float32)
            totals[slab] = totals.get(slab, 0) + sums.astype(np.float64)
        for slab, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["slab", "part"])

    # A slab's parts are as many as the tasks, so they are added as they come.
    parts = rows.mapInArrow(partial, "slab int, part binary").repartition("slab").mapInArrow(added, "slab int, part binary")
    slabs = {r.slab: np.frombuffer(r.part, np.float32).reshape(SLAB, -1) for r in parts.toLocalIterator()}
    shared.unpersist()
    nothing = np.zeros((SLAB, basis.shape[1]), np.float32)
    return np.concatenate([slabs.get(i, nothing) for i in range(FEATURES // SLAB)])


def latent_space(rows: DataFrame, idf: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Features by dimensions: leading right singular vectors of the weighted
    TF-IDF rows (words, weight), each divided by its singular value, so that
    what all texts share counts little more than what few have. The mean
    eigenvalue is added first, or directions of single rows would weigh most in a
    small corpus; what has less than the weight of one short document tells parts
    of a passage apart and is left out. The matrices on the driver have FEATURES rows and RANK + EXTRA
    columns, whatever the input."""
    basis = np.random.default_rng(42).standard_normal((FEATURES, rank + EXTRA)).astype(np.float32)
    for _ in range(PASSES):
        basis, _ = np.linalg.qr(basis)
        before, basis = basis, _multiplied(rows, idf, basis)
    # before' A'A before is small and symmetric; its vectors turn the basis.
    size, turn = np.linalg.eigh((before.T @ basis).astype(np.float64))
    size, turn = size[::-1][:rank], turn[:, ::-1][:, :rank]
    used = size > max(1.0, 1e-6 * size[0])
    if not used.any():
        return np.zeros((FEATURES, 1), np.float32)
    size, turn = size[used], turn[:, used]
    return (before @ (turn / np.sqrt(size + size.mean()))).astype(np.float32)


def _unit(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, size, out=np.zeros_like(vectors), where=size > 0)


class Queries:
    """The passages of a block, by the length of the windows they are compared with."""

    def __init__(self, block: list[tuple], space: np.ndarray, min_cosine: float = MIN_COSINE):
        self.passages, self.space = [Passage(*passage) for passage in block], space
        by_scale: dict[int, list[int]] = {}
        for i, passage in enumerate(self.passages):
            by_scale.setdefault(passage.scale, []).append(i)
        self.scales = []
        for scale, which in sorted(by_scale.items()):
            vectors = np.stack([space[features_of(self.passages[i].words)].sum(axis=0) for i in which])
            least = np.array([min_cosine if self.passages[i].size >= MIN_WORDS else max(min_cosine, MIN_COSINE_WHOLE) for i in which], np.float32)
            self.scales.append((scale, np.array(which), _unit(vectors), least))
        # Words are added up by so many first; windows start at multiples of it.
        self.grain = 1 << max(0, min(by_scale, default=4).bit_length() - 3)

    def _sums(self, words: np.ndarray) -> dict[int, np.ndarray]:
        """Sums of 1, 2, 4, ... grains of words from each grain on: longer ones are put together from shorter."""
        own = self.space.take(words[::self.grain], axis=0)
        for i in range(1, self.grain):
            own += self.space.take(words[i::self.grain], axis=0)
        sums, n = {1: own}, 1
        while 2 * n * self.grain <= self.scales[-1][0]:
            sums[2 * n] = sums[n][:-n] + sums[n][n:]
            n *= 2
        return sums

    def near(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, first word, passage, cosine) of the windows near a passage.

        ``words`` are features, FEATURES where there is no word, with as many
        of these at the end as the longest window has.
        """
        longest = SCALES[-1]
        for first in range(0, len(words) - longest, PIECE_WORDS):
            piece = words[first:first + PIECE_WORDS + longest]
            sums = self._sums(piece[:len(piece) // self.grain * self.grain])
            for scale, which, vectors, least in self.scales:
                n, step = scale // self.grain, max(1, scale // 4 // self.grain)
                whole = 1 << n.bit_length() - 1
                last = len(piece) // self.grain - n + 1
                windows = sums[whole][:last:step]
                if whole < n:  # one and a half times a power of two
                    windows = windows + sums[n - whole][whole:][:last:step]
                starts = np.arange(len(windows)) * step * self.grain
                size = np.sqrt(np.einsum("ij,ij->i", windows, windows))
                size[size < 1e-4] = 0  # sums of nothing
                rows = max(1, COMPARED // len(which))
                for at in range(0, len(starts), rows):
                    products = windows[at:at + rows] @ vectors.T
                    found, of = np.nonzero(products > least * size[at:at + rows, None])
                    found, of = found[size[at + found] > 0], of[size[at + found] > 0]
                    if len(found):
                        yield scale, first + starts[at + found], which[of], products[found, of] / size[at + found]


def search(texts: list[str | None], queries: Queries) -> Iterator[tuple[int, int, float, bool, float]]:
    """(text, item, overlap, answered, cosine) of each verified passage."""
    found, firsts, data = joined_features(texts)
    # No window holds words of two texts.
    text_of = np.repeat(np.arange(len(texts)), np.diff(firsts))
    place = np.arange(len(found)) + SCALES[-1] * text_of
    flat = np.full(len(found) + SCALES[-1] * (len(texts) + 1), FEATURES, np.int64)
    flat[place] = found
    hits: dict[tuple[int, int], list[tuple[int, int, float]]] = {}
    for scale, at, which, cosine in queries.near(flat):
        word = np.minimum(np.searchsorted(place, at), len(found) - 1)
        for t, w, q, c in zip(text_of[word].tolist(), word.tolist(), which.tolist(), cosine.tolist()):
            start = w - int(firsts[t])
            hits.setdefault((t, q), []).append((start, start + scale, c))
    words: dict[int, list[bytes]] = {}
    best: dict[tuple[int, int], tuple[float, bool, float]] = {}
    for (t, q), windows in sorted(hits.items()):
        if t not in words:
            words = {t: data[t].split()}
        passage = queries.passages[q]
        for start, stop, cosine in _merged(windows, passage.size):
            for asked in filter(None, (passage, passage.context)):
                overlap, answered = asked.compare(words[t], start, stop)
                if asked.holds(overlap, answered):
                    key, value = (t, passage.item_id), (overlap, answered, cosine)
                    best[key] = max(best.get(key, value), value)
    for (t, item), value in best.items():
        yield (t, item, *value)


def _merged(windows: list[tuple[int, int, float]], gap: int) -> Iterator[tuple[int, int, float]]:
    """Windows less than ``gap`` apart as one stretch, with the highest cosine."""
    start, stop, most = None, None, 0.0
    for a, b, cosine in sorted(windows):
        if start is not None and a <= stop + gap:
            stop, most = max(stop, b), max(most, cosine)
            continue
        if start is not None:
            yield start, stop, most
        start, stop, most = a, b, cosine
    yield start, stop, most


def _query_blocks(benchmark: DataFrame, size: int = BLOCK_PASSAGES) -> Iterator[list[tuple]]:
    """Passages of the items, a block at a time: no more is on the driver at once."""
    block: list[tuple] = []
    for row in benchmark.toLocalIterator():
        for passage in passages(row.item_id, row.text):
            block.append(passage)
            if len(block) == size:
                yield block
                block = []
    if block:
        yield block


def fit(docs: DataFrame, benchmark: DataFrame) -> np.ndarray:
    """Weighted latent space, FEATURES + 1 rows; ``docs`` has id and text, ``benchmark`` item_id and text."""
    counted = staged(_statistics(docs), "term-statistics")
    held = np.zeros(FEATURES + 1)
    for row in counted.filter("feature is not null").groupBy("feature").agg(F.sum("n").alias("n")).toLocalIterator():
        held[row.feature] = row.n  # the last, -1, is the number of documents
    asked = np.zeros(FEATURES, np.float32)
    for row in benchmark.select("text").mapInArrow(_features_used, "feature long").distinct().toLocalIterator():
        asked[row.feature] = 1.0
    # Words that no passage has tell nothing, and would take dimensions.
    idf = asked * (np.log((1.0 + held[-1]) / (1.0 + held[:-1])).astype(np.float32) + np.float32(1e-3))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features_of(words).astype("<u2").tobytes() for item, text in zip(*map(pa.Array.to_pylist, batch.columns))
                    for _, words, *_ in passages(item, text)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["words"])

    # A window that is there several times counts once.
    known = counted.filter("words is not null").groupBy("words").agg(F.max("share").alias("share")).withColumn("asked", F.lit(False))
    searched = benchmark.select("item_id", "text").mapInArrow(windows, "words binary").distinct().select(
        "words", F.lit(1.0).alias("share"), F.lit(True).alias("asked"))
    rows = staged(known.unionByName(searched), "fit-windows")
    sums = {r.asked: r.total for r in rows.groupBy("asked").agg(F.sum("share").alias("total")).collect()}
    scale = {of: min(1.0, FIT_WINDOWS / total) ** 0.5 * (BENCHMARK_WEIGHT if of else 1.0) for of, total in sums.items()}
    rows = rows.select("words", (F.sqrt("share") * F.when(F.col("asked"), scale.get(True)).otherwise(scale.get(False))).alias("weight"))
    space = latent_space(rows, idf)
    return np.vstack([idf[:, None] * space, np.zeros((1, space.shape[1]), np.float32)])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_cosine: float = MIN_COSINE) -> DataFrame:
    """One row per document and benchmark item that it holds: ``doc_id, item_id, overlap, answered, cosine``.

    Verified are the windows from ``min_cosine`` on to a passage of the item. ``overlap`` is the
    share of the passage's words found in order in a stretch of its length. At
    0.8 the item is held; from 0.5 on if its answer is there too. Items under
    eight words must be there whole. Empty and null texts hold nothing and
    empty items are not held; rows that repeat give rows that repeat; a null id
    stays null. An empty table of documents or items gives no rows. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    known = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].cast("string").alias("text"))
    benchmark = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    if benchmark.isEmpty():
        return spark.createDataFrame([], HITS)
    space = spark.sparkContext.broadcast(fit(known, benchmark))
    found = None
    for block in _query_blocks(benchmark):
        asked = spark.sparkContext.broadcast(block)
        part = staged(_searched(known, space, asked, min_cosine), "benchmark-hits")
        asked.unpersist()
        found = part if found is None else found.unionByName(part)
    space.unpersist()
    return spark.createDataFrame([], HITS) if found is None else found


def _searched(docs: DataFrame, space, block, min_cosine: float) -> DataFrame:
    names = [field.split()[0] for field in HITS.split(", ")]

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(block.value, space.value, min_cosine)
        for part in slices(batches, 128):
            ids = part.column(0).to_pylist()
            rows = [(ids[t], *rest) for t, *rest in search(part.column(1).to_pylist(), queries)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.float64()))],
                    names)

    return docs.mapInArrow(hits, HITS)


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_cosine: float = MIN_COSINE) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns; rows without an id stay.

    Rows that repeat an id are one document: if one of them holds an item, all
    go. Null and empty texts stay, as do all documents if the benchmark is empty.
    """
    held = staged(contaminated(docs, benchmark, id_col, text_col, min_cosine).select(F.col("doc_id").alias("_id")).distinct(),
                  "contaminated")
    return docs.join(held, docs[id_col] == held["_id"], "left_anti")
