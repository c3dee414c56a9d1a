"""Pack documents into training sequences of equal attention cost.

A sequence costs ``linear`` per token and ``quadratic`` per pair of tokens of
one piece, as pieces do not attend to each other. Full pieces of a long
document are sequences by themselves. The other pieces go, longest first, to
the sequence of least cost with room for them; a piece that fits nowhere is
cut to fill the gaps.

Every task packs what it reads, some millions of tokens at a time, so nothing
is shuffled, no key can be hot, and a buffer loses less than one sequence to
padding.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .text import slices

MAX_TOKENS = 2048
END_ID = 1
LINEAR_COST = 1.0
# Of a model whose width is about 4096: pairs weigh as much as tokens at 12 widths.
QUADRATIC_COST = 1.0 / (12 * 4096)
BUFFER_TOKENS = 1 << 22
BLOCK_CHARS = 1 << 20
MEMO_PARTS = 1_000_000
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
IDS_FIELD = "ids array<int>"

# How byte-level tokenizers that name no pattern part a text (a fixed value),
# written without backtracking.
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

# A space between two white spaces, or last after one, may lie inside a token;
# before any other space a token ends. (Python's white space includes theirs.)
_INNER_SPACE = re.compile(r"\s (?:\s|\Z)")
_encoders: dict[str, "Encoder"] = {}


def _printable_bytes() -> dict[str, int]:
    """Character that stands for each byte in the vocabulary of a byte-level
    tokenizer: itself if it prints, else the next one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a byte-level tokenizer file, as little-endian 32-bit bytes.

    Where the file is plain byte-level BPE (no normalizer, merges in the order
    of ids) texts go through ``tiktoken`` on the vocabulary of that file, which
    gives the same ids several times faster, and the ids of parts between
    spaces are remembered; else through ``tokenizers``. Long texts are encoded
    in blocks, cut before spaces that end a token.
    """

    def __init__(self, path: str, most: int = MEMO_PARTS):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(self.library.to_str())
        self.most, self.known = most, {"": b""}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.parted = self._parted(spec)
        self.fast = self._fast(spec) if self.parted else None
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None

    @staticmethod
    def _parted(spec: dict) -> bool:
        """True if tokens begin before spaces, as the byte-level pattern has it."""
        pre = spec.get("pre_tokenizer") or {}
        return (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and spec.get("normalizer") is None
            and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] and any(
                c.isspace() for c in a["content"]) for a in spec["added_tokens"])
        )

    def _fast(self, spec: dict):
        import tiktoken

        model, from_char = spec["model"], _printable_bytes()
        special = set(self.special)
        ranks = {bytes(from_char[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"]["".join(m)] for m in merges]
        plain = (model["type"] == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
                 and not model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix")
                 and made == list(range(256, 256 + len(made))) and len(ranks) == 256 + len(made))
        if not plain:
            return None
        self.widths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.widths[i] = len(token)
        return tiktoken.Encoding("parts", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, unknown: list[str]) -> None:
        """Remember the ids of parts not met before.

        Parts that begin with a space and then something else are encoded
        together, as a token ends before each of them; the lengths of the
        tokens in bytes tell whose they are.
        """
        encode = self.fast.encode_ordinary
        joined = [p for p in unknown if p[0] == " " and not p[1:2].isspace() and len(p) > 1 and not p[-1].isspace()]
        for part in set(unknown).difference(joined):
            self.known[part] = array("I", encode(part)).tobytes()
        if not joined:
            return
        ids = np.array(encode("".join(joined)), "<u4")
        ends = np.cumsum(np.fromiter((len(p.encode()) for p in joined), np.int64, len(joined)))
        after = (np.searchsorted(np.cumsum(self.widths[ids]), ends, "left") + 1) * 4
        data, start = ids.tobytes(), 0
        for part, stop in zip(joined, after.tolist()):
            self.known[part] = data[start:stop]
            start = stop

    def _plain(self, text: str) -> bytes:
        """Ids of a text without strings of special tokens."""
        if not self.fast:
            return self._whole(text)
        if "\0" in text or _INNER_SPACE.search(text):
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        parts = text.replace(" ", "\0 ").split("\0")
        unknown = set(parts).difference(self.known)
        if unknown:
            if len(self.known) > self.most:
                self.known = {"": b""}
                unknown = set(parts).difference(self.known)
            self._learn(list(unknown))
        return b"".join(map(self.known.__getitem__, parts))

    def blocks(self, text: str, size: int = BLOCK_CHARS) -> Iterator[str]:
        """The text in bounded parts, cut before spaces that end a token."""
        start = 0
        while len(text) - start > size:
            cut = next((i for i in range(start + size, start, -1)
                        if text[i] == " " and not text[i - 1].isspace() and not text[i + 1:i + 2].isspace()), None)
            cut = cut or next((i for i in range(start + size, len(text) - 1)
                               if text[i] == " " and not text[i - 1].isspace() and not text[i + 1].isspace()), len(text))
            yield text[start:cut]
            start = cut
        yield text[start:]

    def ids(self, text: str) -> bytes:
        """Ids of the whole text; strings of special tokens give those tokens."""
        if not self.parted:
            return self._whole(text)
        if self.specials and self.specials.search(text):
            parts = self.specials.split(text)
        else:
            parts = [text]
        return b"".join(
            np.array([self.special[part]], "<u4").tobytes() if i % 2 else b"".join(map(self._plain, self.blocks(part)))
            for i, part in enumerate(parts) if part)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def place(lengths: list[int], most: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Sequences, each a list of (piece, start in the piece, length).

    ``lengths`` are in descending order, none over ``most``.
    """
    n = -(-sum(lengths) // most)
    cost, room = np.zeros(n), np.full(n, most)
    sequences: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]

    def put(s: int, piece: int, start: int, length: int) -> None:
        sequences[s].append((piece, start, length))
        cost[s] += linear * length + quadratic * length * length
        room[s] -= length

    homeless = []
    for piece, length in enumerate(lengths):
        s = int(np.argmin(np.where(room >= length, cost, np.inf)))
        if room[s] >= length:
            put(s, piece, 0, length)
        else:
            homeless.append((piece, length))
    for piece, length in homeless:
        start = 0
        while start < length:
            s = int(np.argmax(room))
            part = min(int(room[s]), length - start)
            put(s, piece, start, part)
            start += part
    return sequences


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         max_tokens: int = MAX_TOKENS, end_id: int = END_ID, linear: float = LINEAR_COST,
         quadratic: float = QUADRATIC_COST, buffer_tokens: int = BUFFER_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    A document is the ids of its whole text and then ``end_id``; a null or
    empty text is ``end_id`` alone. Each id lies in exactly one piece, and the
    pieces of a sequence follow each other without gaps. Rows that repeat are
    packed one by one, equal lengths go by the order read; a null id stays
    null; other columns are ignored. ``with_ids`` adds the ids of each piece.
    Sequence ids are unique: the task's number, then a count.
    """
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer_path)
        next_id = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        waiting: list[tuple[int | None, int, int, bytes]] = []
        held = 0

        def add(doc, start, ids, doc_tokens, sequence, offset):
            row = (doc, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, sequence, offset)
            rows.append((*row, np.frombuffer(ids, "<u4").astype(np.int32)) if with_ids else row)

        def flush():
            nonlocal next_id
            waiting.sort(key=lambda piece: -len(piece[3]))
            for pieces in place([len(p[3]) // 4 for p in waiting], max_tokens, linear, quadratic):
                offset = 0
                for which, start, length in pieces:
                    doc, first, doc_tokens, ids = waiting[which]
                    add(doc, first + start, ids[4 * start:4 * (start + length)], doc_tokens, next_id, offset)
                    offset += length
                next_id += 1
            waiting.clear()

        def batch():
            columns = list(zip(*rows))
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

        end = np.array([end_id], "<u4").tobytes()
        for part in slices(batches, 64):
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                ids = (tokens.ids(text) if text else b"") + end
                n = len(ids) // 4
                full = n - n % max_tokens
                for start in range(0, full, max_tokens):
                    add(doc, start, ids[4 * start:4 * (start + max_tokens)], n, next_id, 0)
                    next_id += 1
                if n > full:
                    waiting.append((doc, full, n, ids[4 * full:]))
                    held += n - full
                if held >= buffer_tokens:
                    flush()
                    held = 0
            if len(rows) >= 4096:
                yield batch()
        flush()
        if rows:
            yield batch()

    kinds = [pa.int64()] * 7 + ([pa.list_(pa.int32())] if with_ids else [])
    schema = SCHEMA + (f", {IDS_FIELD}" if with_ids else "")
    names = [field.split()[0] for field in schema.split(", ")]
    return docs.select(docs[id_col].cast("bigint"), docs[text_col]).mapInArrow(packed, schema)
