"""Quality rules: word counts, and bands for how well a text compresses.

Repetitive text compresses far better than prose of its length, encoded or
random text far worse. How well prose compresses depends on how much of it
there is, so the limits depend on the length. The whole text is judged, and so
is each fixed chunk of it, as a long text can hide a bad part of either kind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .text import WHITE, slices, word_blocks

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ZSTD_LEVEL = 3
CHUNK_BYTES = 4096
MAX_ODD_SHARE = 0.25

# (texts of fewer bytes than this, least ratio, greatest ratio); ratio is
# bytes before compression over bytes after. Text in six-bit codes cannot
# pass 8 / 6; below 256 bytes the frame's own bytes hide the difference.
BANDS = (
    (256, 0.0, 4.0),
    (512, 1.05, 4.5),
    (1024, 1.2, 5.0),
    (4096, 1.4, 6.0),
    (16384, 1.4, 8.0),
    (65536, 1.4, 10.0),
    (None, 1.4, 12.0),
)

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, whole_ratio double, odd_share double")


def _numbered(data: bytes) -> tuple[np.ndarray, int]:
    """A number for each word in order, equal for equal words; how many differ."""
    known: dict[bytes, int] = {}
    parts = []
    for words in word_blocks(data):
        for word in set(words).difference(known):
            known[word] = len(known)
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    return (np.concatenate(parts) if parts else np.empty(0, np.int64)), len(known)


def repeated_words(numbers: np.ndarray, n_different: int) -> int:
    """Words that lie in a three-word window found twice or more."""
    if len(numbers) < 4:
        return 0
    pairs = numbers[:-1] * n_different + numbers[1:]
    if n_different ** 3 >= 1 << 62:  # windows would not fit in 64 bits
        _, pairs = np.unique(pairs, return_inverse=True)
    keys = pairs[:-1] * n_different + numbers[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(keys), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    inside = np.zeros(len(numbers), bool)
    for shift in range(3):
        inside[shift:shift + len(again)] |= again
    return int(inside.sum())


def band(n_bytes: int, bands=BANDS) -> tuple[float, float]:
    return next((low, high) for below, low, high in bands if below is None or n_bytes < below)


def compression(data: bytes, bands=BANDS, chunk: int = CHUNK_BYTES, level: int = ZSTD_LEVEL):
    """Ratio of the whole text, whether it lies in its band, and the share of
    bytes in chunks outside theirs."""
    squeeze = zstandard.ZstdCompressor(level=level).compress

    def judged(part: bytes) -> tuple[float, bool]:
        ratio = len(part) / len(squeeze(part))
        low, high = band(len(part), bands)
        return ratio, low <= ratio <= high

    if not data:
        return 0.0, True, 0.0
    ratio, fits = judged(data)
    odd = 0
    if len(data) > chunk:
        for start in range(0, len(data), chunk):
            part = data[start:start + chunk]
            odd += 0 if judged(part)[1] else len(part)
    return ratio, fits, odd / len(data)


def judge(text: str | None, bands=BANDS, chunk: int = CHUNK_BYTES, max_odd_share: float = MAX_ODD_SHARE,
          level: int = ZSTD_LEVEL) -> tuple:
    """The values of ``SCHEMA`` after ``doc_id`` for one text."""
    text = text or ""
    data = text.encode()
    numbers, n_different = _numbered(data)
    n_words = len(numbers)
    n_repeat = repeated_words(numbers, n_different)
    lines = [line for line in data.split(b"\n") if line.strip()]
    failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEAT_PERCENT * n_words
    ratio, fits, odd = compression(data, bands, chunk, level)
    return (n_words, len(text) - sum(map(data.count, WHITE)), sum(map(data.count, SYMBOLS)),
            len(lines) - len(set(lines)), n_repeat, failed, not failed and fits and odd <= max_odd_share, ratio, odd)


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """One row per document: counts over its whole text, and whether it is kept.

    A null or empty text has no words, fails and is not kept. Rows that repeat
    are judged one by one; a null id stays null. Other columns are ignored,
    whatever their names; an empty table gives an empty result. Work is
    narrow: nothing is shuffled. ``limits`` are those of ``judge``.
    """
    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            columns = zip(*(judge(text, **limits) for text in part.column(1).to_pylist()))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), *arrays], names)

    names = [field.split()[0] for field in SCHEMA.split(", ")]
    return docs.select(docs[id_col], docs[text_col]).mapInArrow(verdicts, SCHEMA)


def keep_quality(docs: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """The documents that are kept, with all their columns."""
    where = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            mask = [judge(text, **limits)[6] for text in part.column(where).to_pylist()]
            yield part.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)
