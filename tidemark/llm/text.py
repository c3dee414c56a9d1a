"""Reading texts inside tasks, a bounded part at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

# ASCII white space, the only kind that parts words here: [\x20\x09-\x0D].
# ``bytes.split`` and ``bytes.strip`` use the same set.
WHITE = b" \t\n\x0b\x0c\r"
_WHITE = re.compile(rb"[\x20\x09-\x0D]")
BLOCK_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Parts of the batches, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case and all other letters as they are; null is empty."""
    return text.encode().lower() if text else b""


def word_blocks(data: bytes, block: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words in order, as lists made from about ``block`` bytes each."""
    start, size = 0, len(data)
    while start < size:
        stop = start + block
        if stop >= size:
            stop = size
        else:
            cut = max(data.rfind(bytes([w]), start, stop) for w in WHITE)
            if cut <= start:
                found = _WHITE.search(data, stop)
                cut = found.start() if found else size
            stop = cut
        yield data[start:stop].split()
        start = stop
