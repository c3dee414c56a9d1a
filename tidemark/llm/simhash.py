"""Near-duplicates by 64-bit SimHash.

Two fingerprints that differ in at most four bits share at least four of
their eight bytes. The inverted index is keyed by byte positions and values;
as the list of a single byte would hold 1/256 of a corpus, its keys are all
choices of four positions with their bytes, so any pair that reaches the
guaranteed four matches meets under some key, and pairs that only share fewer
bytes are never made. The matches of a pair are tallied, pairs below four are
dropped, and the rest verified bit by bit.

Equal fingerprints are one entry of the index. Lists of up to ``MAX_LIST``
entries give their pairs. Entries of longer lists are linked without pairs:
each is spread to all points within two bits, and all that meet in a point
are linked to the smallest there. They are within four bits of each other, and
any two within four bits meet in some point, so no link is lost and the work
grows with the number of entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.staging import staged
from .components import connected
from .text import lowered, slices, word_blocks

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
POSITIONS = 8
MAX_LIST = 64
# Spark broadcasts by the size of packed files, whose rows take many times as
# much on the driver. So what grows with the corpus is merged, and the keys of
# long lists, of which there may be none, are broadcast up to so many.
BROADCAST_LISTS = 100_000


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Signed 64 bits; each is set if it is set in over half the shingles' hashes."""
    digest = xxhash.xxh64_digest
    counts, total, rest = np.zeros(64, np.int64), 0, []

    def add(shingles: list[bytes]) -> None:
        nonlocal counts, total
        hashes = np.frombuffer(b"".join(shingles), np.uint8).reshape(-1, 8)
        for start in range(0, len(hashes), 1 << 15):
            bits = np.unpackbits(hashes[start:start + (1 << 15)], axis=1)
            counts += np.add.reduce(bits, axis=0, dtype=np.uint32)
        total += len(hashes)

    for block in word_blocks(lowered(text)):
        found = rest + block
        if len(found) >= words:
            joined = b" ".join(found)
            ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
            starts = [0, *(ends[:len(found) - words] + 1).tolist()]
            add([digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1:].tolist())])
        rest = found[-(words - 1):]
    if not total:
        if not rest:
            return 0
        add([digest(b" ".join(rest), seed)])
    return int(np.packbits(counts * 2 > total).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS, seed: int = SEED, hashed: bool = False) -> DataFrame:
    """(id, fp) per document, or (id, text_hash, fp). Texts with fewer words are one shingle; none gives zero."""
    extra = [F.xxhash64(text_col).alias("text_hash")] if hashed else []

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [fingerprint(text, words, seed) for text in part.column(1).to_pylist()]
            columns = [part.column(0), *part.columns[2:], pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "fp"] if hashed else ["id", "fp"])

    known = docs.select(docs[id_col].cast("bigint"), docs[text_col], *extra)
    return known.mapInArrow(printed, "id long, text_hash long, fp long" if hashed else "id long, fp long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _masks() -> list[int]:
    """Bytes at each choice of four of the eight positions."""
    return [_signed(sum(255 << 8 * p for p in chosen)) for chosen in combinations(range(POSITIONS), POSITIONS - MAX_BITS)]


def _near_points() -> list[int]:
    """What to flip to reach every point within two bits."""
    return [0, *(_signed(1 << i) for i in range(64)), *(_signed(1 << i | 1 << j) for i, j in combinations(range(64), 2))]



def _exploded(entries: DataFrame, values: list[int], name: str) -> DataFrame:
    """Each entry with each of the fixed values, and the place of the value."""
    listed = F.from_json(F.lit(str(values)), "array<bigint>")
    return entries.select("fp", F.posexplode(listed).alias("place", name))


def _shared_bytes(a, b):
    """Tally of positions whose bytes are equal."""
    differing = a.bitwiseXOR(b)
    return sum((differing.bitwiseAND(F.lit(_signed(255 << 8 * p))) == 0).cast("int") for p in range(POSITIONS))


def links(entries: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """Pairs (a, b) that connect all fingerprints within four bits; ``entries`` has distinct ``fp``."""
    # The entries are few bytes but become 70 rows each, so they are dealt to all tasks first.
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = _exploded(entries.repartition(parts, "fp"), _masks(), "mask").select(
        "fp", "place", F.col("fp").bitwiseAND(F.col("mask")).alias("shared"))
    long = staged(index.groupBy("place", "shared").count().filter(F.col("count") > max_list).select("place", "shared"),
                  "simhash-long-lists")
    if long.count() > BROADCAST_LISTS:
        long = long.hint("merge")
    crowded = staged(index.join(long, ["place", "shared"], "left_semi").select("fp").distinct(), "simhash-crowded")

    short = index.join(long, ["place", "shared"], "left_anti").repartition(parts, "place", "shared")
    met = short.groupBy("place", "shared").agg(F.collect_list("fp").alias("all"))  # at most max_list each
    met = met.filter(F.size("all") > 1).select("all", F.explode("all").alias("a"))
    # Shared bytes are tallied before bits are compared.
    verified = met.select("a", F.explode(F.filter("all", lambda b: (b > F.col("a")) & (
        _shared_bytes(F.col("a"), b) >= POSITIONS - MAX_BITS) & (
        F.bit_count(b.bitwiseXOR(F.col("a"))) <= MAX_BITS))).alias("b"))

    spread = _exploded(crowded.repartition(parts, "fp"), _near_points(), "flip").select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    first = staged(spread.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
                   .select("point", "a"), "simhash-points")
    starred = spread.join(first.hint("merge"), "point").filter("fp <> a").select("a", F.col("fp").alias("b"))
    return verified.unionByName(starred).distinct()


def _labelled(docs: DataFrame, id_col: str, text_col: str, max_list: int) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, fp) per document, and (fp, group, component_id) per fingerprint."""
    known = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].cast("string").alias("text"))
    marked = staged(fingerprints(known, "id", "text", hashed=True), "fingerprints")
    first = staged(marked.groupBy("fp").agg(F.min("id").alias("first")), "simhash-entries")
    found = staged(links(first.select("fp"), max_list), "simhash-links")
    group = connected(found, "a", "b").withColumnRenamed("node", "fp")
    named = first.join(group.hint("merge"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("group"))
    named = staged(named, "simhash-groups")
    smallest = staged(named.groupBy("group").agg(F.min("first").alias("component_id")), "simhash-smallest")
    return marked, staged(named.join(smallest.hint("merge"), "group").select("fp", "group", "component_id"), "simhash-labels")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_list: int = MAX_LIST) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` and ``component_id``.

    Shingles are four words, parted by ASCII white space, A-Z in lower case.
    Fingerprints of four or fewer differing bits link; a component's id is the
    smallest document id in it. Empty and null texts have fingerprint zero and
    link like any other. Rows that repeat each give a row; a null id stays
    null and is no component's id unless there is no other (then null). An
    empty table gives no rows; other columns are ignored.
    """
    marked, labels = _labelled(docs, id_col, text_col, max_list)
    return marked.join(labels.drop("group").hint("merge"), "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_list: int = MAX_LIST) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id, with all its columns.

    Rows that share an id are told apart by their texts: unlike texts are in
    groups of their own and each stays, of like ones that with the smallest
    hash, and of rows that repeat id and text one. Rows without an id cannot be
    told apart and stay. An empty table gives no rows.
    """
    marked, labels = _labelled(docs, id_col, text_col, max_list)
    chosen = marked.filter("id is not null").join(labels.drop("component_id").hint("merge"), "fp").groupBy("group").agg(
        F.min(F.struct("id", "text_hash")).alias("one"))
    stay = staged(chosen.select(F.col("one.id").alias("_id"), F.col("one.text_hash").alias("_hash")).distinct(), "simhash-stay")
    # A table may have columns of any names, so a row travels as one.
    known = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("_id"),
                        F.xxhash64(docs[text_col].cast("string")).alias("_hash"))
    known = known.join(stay.hint("merge"), ["_id", "_hash"]).dropDuplicates(["_id", "_hash"]).select("row.*")
    return known.unionByName(docs.filter(docs[id_col].isNull()))
