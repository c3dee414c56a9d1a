"""Exact token counts of texts of any length.

Huge documents are encoded in overlapping chunks. Two neighbouring encodings
are spliced where they share a boundary proven to be stable: white space lies
before it, which this kind of tokenizer drops before it looks for tokens, and
from there on both encodings give the same tokens at the same offsets for a
run of several. If an overlap has no such place it is widened, in the end to
the whole text. So no encoding holds more than a few chunks.

Other documents are counted by the parts between spaces, as no token crosses
a space; each task remembers the counts of parts it has met. Parts not met yet
are encoded together, and their tokens dealt out by offsets.
"""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .text import slices

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 512
MIN_RUN = 8
LIMIT = 2048
MEMO_PARTS = 1_000_000
JOINED_CHARS = 1 << 18
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

# White space for every library that is used here.
_SPACES = " \n\t\r"
_loaded: dict[str, object] = {}


def load(path: str):
    """The tokenizer of a file, once per Python worker."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[path] = tokenizer
    return _loaded[path]


def drops_spaces(tokenizer) -> bool:
    """True if the file says that spaces part tokens and are dropped.

    That is so if the pre-tokenizer first keeps only matches of a pattern
    without white space, and the normalizer maps each side of a space by
    itself (composition, white space to a space, lower case).
    """
    spec = json.loads(tokenizer.to_str())
    normal = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
    first = spec.get("pre_tokenizer") or {}
    steps = first.get("pretokenizers", [first])
    split = steps[0] if steps else {}
    pattern = split.get("pattern", {}).get("Regex", "")
    return (
        split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
        and "\\s" in pattern and not any(c.isspace() for c in pattern)
        and all("\\s" not in part or "[^\\s" in part for part in pattern.split("|"))
        and all(s.get("use_regex") is False and s.get("add_prefix_space") is False for s in steps[1:])
        and all(n["type"] in ("NFC", "Lowercase") or n.get("content") == " " and n["pattern"] == {"Regex": "\\s+"}
                for n in normal.get("normalizers", [normal]))
        and not any(any(c.isspace() for c in a["content"]) or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"])
        and spec.get("post_processor") is None
    )


def _encoded(tokenizer, text: str, start: int, stop: int) -> list[tuple[int, int, int]]:
    """(first character, end, id) of each token, by place in the whole text."""
    found = tokenizer.encode(text[start:stop], add_special_tokens=False)
    return [(a + start, b + start, i) for (a, b), i in zip(found.offsets, found.ids)]


def stable_boundary(text: str, left: list, right: list, begin: int, run: int = MIN_RUN) -> int | None:
    """First place from which ``right``, encoded from ``begin`` on, and
    ``left`` agree for ``run`` tokens after white space."""
    place = bisect.bisect_left(left, (begin, -1, -1))
    where = {}
    for j, token in enumerate(right[:len(left) - place + run]):
        where.setdefault(token[0], j)
    for i in range(place, len(left) - run + 1):
        at = left[i][0]
        j = where.get(at)
        if (j is not None and at > begin and text[at - 1] in _SPACES and (i == 0 or left[i - 1][1] <= at)
                and left[i:i + run] == right[j:j + run]):
            return at
    return None


def spliced_count(tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS,
                  run: int = MIN_RUN) -> int:
    """Tokens of a text that is never encoded in one piece."""
    size, total = len(text), 0
    begin, end = 0, min(chunk, len(text))
    left = _encoded(tokenizer, text, begin, end)
    while end < size:
        width, cut = overlap, None
        while cut is None and end - width > begin:
            right_end = min(end - width + chunk + width, size)
            right = _encoded(tokenizer, text, end - width, right_end)
            cut = stable_boundary(text, left, right, end - width, run)
            width *= 2
        if cut is None:  # nothing to splice at: a longer left chunk
            end = min(begin + 2 * (end - begin), size)
            left = _encoded(tokenizer, text, begin, end)
            continue
        total += bisect.bisect_left(left, (cut, -1, -1))
        left = right[bisect.bisect_left(right, (cut, -1, -1)):]
        begin, end = cut, right_end
    return total + len(left)


class PartCounts:
    """Tokens of the parts of texts between spaces."""

    def __init__(self, tokenizer, most: int = MEMO_PARTS):
        self.tokenizer, self.most, self.known = tokenizer, most, {"": 0}
        spec = json.loads(tokenizer.to_str())
        self.special = [a["content"] for a in spec["added_tokens"]]
        steps = spec["normalizer"] or {}
        self.lowers = any(n["type"] == "Lowercase" for n in steps.get("normalizers", [steps]) if n)

    def plain(self, text: str) -> str:
        """ASCII letters in lower case if the tokenizer does that anyhow and
        it makes no string of a special token."""
        if self.lowers:
            low = text.encode().lower().decode()
            if not any(s in low for s in self.special):
                return low
        return text

    def learn(self, unknown: set[str]) -> None:
        """Count the tokens of parts not met before.

        A comma or full stop after an ASCII letter always begins a token, so
        the word before it and the mark are counted apart.
        """
        marked = [p for p in unknown if p[-1] in ",." and p[-2:-1].isascii() and p[-2:-1].isalpha()]
        if marked:
            unknown.difference_update(marked)
            unknown.update({p[:-1] for p in marked} | {",", "."})
            unknown.difference_update(self.known)
        self.encode(list(unknown))
        self.known.update((p, self.known[p[:-1]] + self.known[p[-1]]) for p in marked)

    def encode(self, parts: list[str]) -> None:
        """Encode parts joined by spaces, some thousands at a time."""
        start = 0
        while start < len(parts):
            ends, size, stop = [], -1, start
            while stop < len(parts) and size < JOINED_CHARS:
                size += 1 + len(parts[stop])
                ends.append(size)
                stop += 1
            found = self.tokenizer.encode(" ".join(parts[start:stop]), add_special_tokens=False)
            counts = [0] * len(ends)
            for first, _ in found.offsets:
                counts[bisect.bisect_right(ends, first)] += 1
            self.known.update(zip(parts[start:stop], counts))
            start = stop

    def count(self, texts: list[str]) -> list[int]:
        if len(self.known) > self.most:
            self.known = {"": 0}
        parts = [self.plain(text).replace("\n", " ").split(" ") for text in texts]
        self.learn({p for some in parts for p in some}.difference(self.known))
        return [sum(map(self.known.__getitem__, some)) for some in parts]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """One row per document: UTF-8 bytes, tokens, and whether they exceed ``limit``.

    Counts equal those of the library over the whole text, without special
    tokens added; strings of special tokens in a text are special tokens, as
    is its default. A null text is empty and has no tokens; rows that repeat
    are counted one by one; a null id stays null; other columns are ignored.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(tokenizer_path)
        parts = PartCounts(tokenizer) if drops_spaces(tokenizer) else None
        for some in slices(batches):
            texts = [text or "" for text in some.column(1).to_pylist()]
            counts = [spliced_count(tokenizer, t, chunk, overlap) if parts and len(t) > 2 * chunk else None for t in texts]
            rest = [t for t, n in zip(texts, counts) if n is None]
            found = iter(parts.count(rest) if parts else
                         [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in rest])
            counts = pa.array([next(found) if n is None else n for n in counts], pa.int64())
            n_bytes = pc.fill_null(pc.binary_length(some.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([some.column(0).cast(pa.int64()), n_bytes, counts, pc.greater(counts, limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(docs[id_col], docs[text_col]).mapInArrow(counted, SCHEMA)
