"""Remove passages that stand earlier in the corpus, word by word.

Every window of ``words`` consecutive words is a key. Two passes find the
windows that occur more than once:

1. Each chunk of documents has a count-min sketch of its windows. A sketch of
   all windows would be too large to hand to every task, so it has one wide row
   of counters, kept sparse, and is cut into slices: a task merges one slice of
   all chunks' sketches and answers each chunk with a bit per counter it sent.
   Merged counts are never too small, so no repeated window is lost.
2. The windows estimated to occur twice or more, and only these, are grouped
   exactly, by 96 more bits of hash; the earliest place of each stays.

A chunk drops what it can itself before it sends anything: a window that it
holds a thousand times is sent once. So a passage held by a third of all
documents is as many entries as there are chunks. Texts are shuffled once, as
compressed chunks, and both joins on them share that exchange.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import staged

WORDS = 20
# For executors of a few GB. Slices are as many as the windows need; raise both
# with the input, as a chunk sends a row to each slice: 64 MB and 2**26 for 100 TB.
CHUNK_BYTES = 4 << 20
SLICE_WINDOWS = 1 << 20
# The sketch has 2**SPARE_BITS counters per window.
SPARE_BITS = 5
BLOCK_BYTES = 1 << 18
LONG_WORD = 64
# A null id is before all others.
_NO_ID = -(1 << 63)

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_BYTE_BASE, _WORD_BASES = 0x9E3779B97F4A7C15, (0xD1342543DE82EF95, 0xDA942042E4DD58B5)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BYTE_BASE, BLOCK_BYTES + LONG_WORD)
_DOWN = _powers(pow(_BYTE_BASE, -1, 1 << 64), BLOCK_BYTES + LONG_WORD)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of a value changes half of the bits of the result."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and stop; ASCII white space parts them."""
    inside = ~_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return edges[::2], edges[1::2]


def word_hashes(data: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64 bits per word: a polynomial of its bytes, mixed; long words by XXH3.

    Sums run over blocks, and a word's is a difference of two, shifted to its start.
    """
    out = np.empty(len(starts), np.uint64)
    text = np.frombuffer(data, np.uint8)
    ends = np.minimum(stops, starts + LONG_WORD)
    first = 0
    while first < len(starts):
        low = int(starts[first])
        last = int(np.searchsorted(starts, low + BLOCK_BYTES, "left"))
        own = slice(first, last)
        block = text[low:int(ends[last - 1])]
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum((block.astype(np.uint64) + np.uint64(1)) * _UP[:len(block)], out=sums[1:])
        at = starts[own] - low
        out[own] = (sums[ends[own] - low] - sums[at]) * _DOWN[at]
        first = last
    out = _mixed(out ^ ((stops - starts).astype(np.uint64) << np.uint64(56)))
    for i in np.flatnonzero(stops - starts > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[int(starts[i]):int(stops[i])])
    return out


def window_hashes(words: np.ndarray, n: int, base: int) -> np.ndarray:
    """Hash of each ``n`` consecutive words: windows of 1, 2, 4, ... are put together."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    own, size, found, done = words, 1, None, 0
    while True:
        if n & size:
            shift = np.uint64(pow(base, done, 1 << 64))
            found = own if found is None else found[:len(own) - done] + own[done:] * shift
            done += size
        if done == n:
            return _mixed(found[:len(words) - n + 1])
        own = own[:len(own) - size] + own[size:] * np.uint64(pow(base, size, 1 << 64))
        size *= 2


_PRESS, _OPEN = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def dump(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers, by planes of bytes so that high bytes cost little."""
    out = []
    for values in arrays:
        values = np.ascontiguousarray(values, "<u8")
        width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
        planes = _PRESS.compress(values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
        out.append(struct.pack("<IBI", len(values), width, len(planes)) + planes)
    return b"".join(out)


def load(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, width, size = struct.unpack_from("<IBI", data, at)
        planes = np.frombuffer(_OPEN.decompress(data[at + 9:at + 9 + size], max_output_size=n * width or 1), np.uint8)
        values = np.zeros((n, 8), np.uint8)
        values[:, :width] = planes.reshape(width, n).T
        out.append(values.view("<u8").reshape(-1))
        at += 9 + size
    return out


def steps(values: np.ndarray) -> np.ndarray:
    """Differences of values in order, the first from zero (modulo 2**64)."""
    return np.diff(values.astype(np.uint64), prepend=np.uint64(0))


def unsteps(values: np.ndarray) -> np.ndarray:
    return np.cumsum(values, dtype=np.uint64)


class Chunk:
    """Some documents, in the order of their ids, and their words."""

    def __init__(self, packed: bytes):
        rows = pa.ipc.open_stream(packed).read_all()
        self.ids, self.texts = rows.column(0), rows.column(1).to_pylist()
        data = [t if t is not None else b"" for t in self.texts]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        self.data = b"\n".join(data)
        self.starts, self.stops = word_bounds(self.data)
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        # First word of each document, and one past the last.
        self.first = np.searchsorted(self.starts, begins)
        self.first[-1] = len(self.starts)

    def order(self) -> np.ndarray:
        return self.ids.fill_null(_NO_ID).to_numpy()

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, second hash, document, first word in it) of every window."""
        words = word_hashes(self.data, self.starts, self.stops)
        counts = np.diff(self.first)
        doc = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(words)) - np.repeat(self.first[:-1], counts)
        whole = np.flatnonzero(place + n <= np.repeat(counts, counts))
        a, b = (window_hashes(words, n, base)[whole] for base in _WORD_BASES)
        return a, b & np.uint64(0xFFFFFFFF), doc[whole], place[whole]


def _packed(rows: list[pa.RecordBatch], words: int) -> tuple[int, bytes]:
    """Number of windows, and the rows in the order of their ids, compressed."""
    table = pa.Table.from_batches(rows)
    order = pc.sort_indices(table, sort_keys=[("id", "ascending")], null_placement="at_start")
    table = table.take(order).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_table(table)
    data = sink.getvalue().to_pybytes()
    chunk = Chunk(data)
    return int(np.maximum(np.diff(chunk.first) - words + 1, 0).sum()), data


def chunks_of(docs: DataFrame, words: int, chunk_bytes: int) -> DataFrame:
    """(chunk, n_windows, docs): documents together, about ``chunk_bytes`` of text each."""
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            batch = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.large_binary())], ["id", "text"])
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            start = 0
            while start < len(sizes):
                total = np.cumsum(sizes[start:]) + size
                n = min(int(np.searchsorted(total, chunk_bytes)) + 1, len(total))
                held.append(batch.slice(start, n))
                size, start = int(total[n - 1]), start + n
                if size >= chunk_bytes:
                    yield one(held)
                    held, size = [], 0
        if held:
            yield one(held)

    def one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        n, data = _packed(held, words)
        return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([data], pa.binary())], ["n_windows", "docs"])

    rows = docs.mapInArrow(packed, "n_windows long, docs binary")
    return staged(rows.select(F.monotonically_increasing_id().alias("chunk"), "n_windows", "docs"), "passage-chunks")


def _sketches(chunks: DataFrame, words: int, bits: int, slice_bits: int) -> DataFrame:
    """(slice, chunk, counters, twice): the sketch of each chunk, a row per slice.

    ``counters`` are those that are not zero, ``twice`` has a bit for each that counts two or more.
    """
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, docs in zip(batch.column(0).to_pylist(), batch.column(1)):
                found, _, _, _ = Chunk(docs.as_py()).windows(words)
                counters, counts = np.unique(found >> np.uint64(64 - bits), return_counts=True)
                rows = [(s, one, dump(steps(counters[a:b] - np.uint64(s << (bits - slice_bits)))), np.packbits(counts[a:b] > 1).tobytes())
                        for s, a, b in _slices(counters, bits, slice_bits)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                        ["slice", "chunk", "counters", "twice"])

    return chunks.select("chunk", "docs").mapInArrow(sketched, "slice int, chunk long, counters binary, twice binary")


def _slices(values: np.ndarray, bits: int, slice_bits: int) -> list[tuple[int, int, int]]:
    """(slice, start, stop) of the slices that values in order fall in."""
    own = (values >> np.uint64(bits - slice_bits)).astype(np.int64)
    starts = np.flatnonzero(np.diff(own, prepend=-1))
    return list(zip(own[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(own)]))


def _answers(sketches: DataFrame) -> DataFrame:
    """(chunk, slice, often): for each counter a chunk sent, whether all chunks together count two or more."""
    def merged(table: pa.Table) -> pa.Table:
        sent = [unsteps(load(c)[0]) for c in table["counters"].to_pylist()]
        counts = np.concatenate([1 + np.unpackbits(np.frombuffer(t, np.uint8), count=len(c)).astype(np.int64)
                                 for t, c in zip(table["twice"].to_pylist(), sent)])
        _, which = np.unique(np.concatenate(sent), return_inverse=True)
        often = np.bincount(which, counts)[which] > 1
        stops = np.cumsum([len(c) for c in sent])
        answers = [np.packbits(part).tobytes() for part in np.split(often, stops[:-1])]
        return pa.table([table["chunk"], table["slice"], pa.array(answers, pa.binary())], ["chunk", "slice", "often"])

    return sketches.groupBy("slice").applyInArrow(merged, "chunk long, slice int, often binary")


def _first_of_each(keys: list[np.ndarray], ids: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether a window is the earliest of its key: smallest id, then place. Equal places are all earliest."""
    order = np.lexsort((places, ids, *keys[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    lead = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    first = np.empty(len(order), bool)
    first[order] = (ids[order] == ids[lead]) & (places[order] == places[lead])
    return first


def _lost(docs: np.ndarray, places: np.ndarray) -> bytes:
    order = np.lexsort((places, docs))
    return dump(steps(docs[order]), places[order])


_SENT = "slice int, chunk long, kind int, data binary"


def _candidates(joined: DataFrame, words: int, bits: int, slice_bits: int) -> DataFrame:
    """Rows of ``_SENT``: kind 0 has windows to group, kind 1 windows that the chunk itself has earlier."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, docs, answers in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                rows = list(of_chunk(one, Chunk(docs.as_py()), answers.as_py() or []))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.binary()))],
                        ["slice", "chunk", "kind", "data"])

    def of_chunk(one: int, chunk: Chunk, answers: list[dict]) -> Iterator[tuple]:
        a, b, doc, place = chunk.windows(words)
        counters, which = np.unique(a >> np.uint64(64 - bits), return_inverse=True)
        by_slice = {x["slice"]: x["often"] for x in answers}
        often = np.concatenate([np.unpackbits(np.frombuffer(by_slice[s], np.uint8), count=stop - start)
                                for s, start, stop in _slices(counters, bits, slice_bits)] or [np.zeros(0, np.uint8)])
        chosen = np.flatnonzero(often[which])
        a, b, doc, place = a[chosen], b[chosen], doc[chosen], place[chosen]
        ids = chunk.order()
        first = _first_of_each([a, b], ids[doc], place)
        if not first.all():
            yield one % (1 << slice_bits), one, 1, _lost(doc[~first], place[~first])
        a, b, doc, place = a[first], b[first], doc[first], place[first]
        order = np.argsort(a, kind="stable")
        a, b, doc, place = a[order], b[order], doc[order], place[order]
        for s, start, stop in _slices(a, 64, slice_bits):
            used, own = np.unique(doc[start:stop], return_inverse=True)
            yield s, one, 0, dump(steps(a[start:stop] - np.uint64(s << (64 - slice_bits))), b[start:stop], own, place[start:stop],
                                  steps(used), steps(ids[used].astype(np.uint64)))

    return joined.mapInArrow(sent, _SENT)


def _losers(sent: DataFrame) -> DataFrame:
    """(chunk, lost): windows that stand earlier elsewhere."""
    def grouped(table: pa.Table) -> pa.Table:
        chunks, kinds, data = (table[c].to_pylist() for c in ("chunk", "kind", "data"))
        out = [(c, d) for c, k, d in zip(chunks, kinds, data) if k]
        found = [(c, load(d)) for c, k, d in zip(chunks, kinds, data) if not k]
        if found:
            a, b, place = (np.concatenate(x) for x in zip(*[(unsteps(f[0]), f[1], f[3].astype(np.int64)) for _, f in found]))
            ids = np.concatenate([unsteps(f[5]).astype(np.int64)[f[2].astype(np.int64)] for _, f in found])
            gone = ~_first_of_each([a, b], ids, place)
            stops = np.cumsum([len(f[0]) for _, f in found])
            for (c, f), lost in zip(found, np.split(gone, stops[:-1])):
                if lost.any():
                    docs = unsteps(f[4])[f[2].astype(np.int64)]
                    out.append((c, _lost(docs[lost], f[3][lost])))
        return pa.table([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], ["chunk", "lost"])

    return sent.groupBy("slice").applyInArrow(grouped, "chunk long, lost binary")


def _without(joined: DataFrame, words: int, digest: bool) -> DataFrame:
    """The documents of each chunk without the words that its lost windows cover."""
    last = ("kept_sha256", pa.string()) if digest else ("text", pa.string())

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, lost in zip(batch.column(1), batch.column(2)):
                yield of_chunk(Chunk(docs.as_py()), lost.as_py() or [])

    def of_chunk(chunk: Chunk, lost: list[bytes]) -> pa.RecordBatch:
        cover = np.zeros(len(chunk.starts) + 1, np.int64)
        for data in lost:
            docs, places = load(data)
            at = chunk.first[unsteps(docs).astype(np.int64)] + places.astype(np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + words, -1)
        gone = np.cumsum(cover[:-1]) > 0
        n_words, n_removed, texts = np.diff(chunk.first), [], []
        for text, start, stop in zip(chunk.texts, chunk.first[:-1].tolist(), chunk.first[1:].tolist()):
            own = gone[start:stop]
            n_removed.append(int(own.sum()))
            if n_removed[-1]:
                text = b" ".join([w for w, g in zip(text.split(), own.tolist()) if not g])
            if digest:
                joined_words = text if n_removed[-1] else b" ".join((text or b"").split())
                texts.append(hashlib.sha256(joined_words).hexdigest())
            else:
                texts.append(None if text is None else text.decode())
        return pa.RecordBatch.from_arrays(
            [chunk.ids.combine_chunks(), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, last[1])],
            ["doc_id", "n_words", "n_removed", last[0]])

    return joined.mapInArrow(kept, f"doc_id long, n_words long, n_removed long, {last[0]} string")


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                           digest: bool = False, chunk_bytes: int = CHUNK_BYTES, slice_windows: int = SLICE_WINDOWS,
                           spare_bits: int = SPARE_BITS) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` (or ``kept_sha256`` of the words left) of every document.

    Words are parted by ASCII white space. A word goes if a window of ``words``
    words covers it that also starts earlier: in a document with a smaller id,
    or earlier in one with the same id; windows are judged on the input. What
    is left of a text is joined by single spaces, a text that loses nothing
    stays as it is. A null text has no words and stays null, a text of fewer
    words than a window loses none. Rows without an id are before all others,
    and like rows that repeat an id they count as one document: a window at
    the same place in two of them is in neither of them earlier. An empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    known = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].cast("string").alias("text"))
    chunks = chunks_of(known, words, chunk_bytes)
    n = chunks.agg(F.sum("n_windows")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slice_bits = max(1, (n // slice_windows).bit_length(), (parts - 1).bit_length())
    bits = min(56, max(slice_bits + 8, n.bit_length() + spare_bits))

    answers = staged(_answers(_sketches(chunks, words, bits, slice_bits)), "passage-answers")
    heard = answers.groupBy("chunk").agg(F.collect_list(F.struct("slice", "often")).alias("answers"))  # a row per slice
    rows = chunks.select("chunk", "docs")
    sent = _candidates(rows.join(heard, "chunk").select("chunk", "docs", "answers"), words, bits, slice_bits)
    lost = _losers(sent).groupBy("chunk").agg(F.collect_list("lost").alias("lost"))
    return _without(rows.join(lost, "chunk", "left").select("chunk", "docs", "lost"), words, digest)
