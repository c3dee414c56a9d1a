"""The trie of all conversations' turns: which beginnings they share.

A turn is a fixed-width key: the MD5 of role and text and the length of the
text, 24 bytes, most significant first. A conversation is its turns' keys in a
row. Tasks hold ranges of these keys in adaptive radix trees: nodes of 4, 16,
48 or 256 children that grow as they fill, and paths without branches kept as
one run of bytes. Only byte depths at the end of a turn are nodes of the
result; what several tasks know of a node is summed afterwards.

Conversations are cut into segments of ``SEGMENT`` turns, each keyed by a digest
of all before it, so no row or tree holds an unbounded conversation. A node
belongs to its smallest member, whose own nodes are a path down to its end.
Therefore sums over a subtree are sums over members: of what each of them owns,
but for the node's owner only what lies deeper. A second pass through the trees
sums that, and nothing is repeated per level.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ids import assign_ids
from ..operators.staging import staged

WIDTH = 24  # bytes of a turn: digest, then length
SEGMENT = 128
TREE_BYTES = 4 << 20
IDS_PER_PIECE = 4096
# Turns taken over from the first conversation of a block of five.
BLOCK, MOST_TAKEN = 5, 9
ROOT = bytes(16)


class Small:
    """Up to 4, then up to 16 children beside their sorted bytes."""

    def __init__(self):
        self.limit, self.bytes, self.kids = 4, bytearray(), []

    def get(self, byte: int):
        i = bisect_left(self.bytes, byte)
        return self.kids[i] if i < len(self.bytes) and self.bytes[i] == byte else None

    def put(self, byte: int, kid) -> "Small | Indexed":
        i = bisect_left(self.bytes, byte)
        if i < len(self.bytes) and self.bytes[i] == byte:
            self.kids[i] = kid
            return self
        if len(self.kids) == self.limit:
            if self.limit == 16:
                return Indexed(self).put(byte, kid)
            self.limit = 16
        self.bytes.insert(i, byte)
        self.kids.insert(i, kid)
        return self

    def items(self):
        return zip(self.bytes, self.kids)


class Indexed:
    """Up to 48 children found through a place for each byte."""

    def __init__(self, small: Small):
        self.place, self.kids = bytearray(256), list(small.kids)  # 0: no child
        for i, byte in enumerate(small.bytes):
            self.place[byte] = i + 1

    def get(self, byte: int):
        at = self.place[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid) -> "Indexed | Full":
        at = self.place[byte]
        if at:
            self.kids[at - 1] = kid
            return self
        if len(self.kids) == 48:
            return Full(self).put(byte, kid)
        self.kids.append(kid)
        self.place[byte] = len(self.kids)
        return self

    def items(self):
        return ((byte, self.kids[at - 1]) for byte, at in enumerate(self.place) if at)


class Full:
    """A child for each byte."""

    def __init__(self, indexed: Indexed):
        self.kids: list = [None] * 256
        for byte, kid in indexed.items():
            self.kids[byte] = kid

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid) -> "Full":
        self.kids[byte] = kid
        return self

    def items(self):
        return ((byte, kid) for byte, kid in enumerate(self.kids) if kid is not None)


class Node:
    """A run of bytes, what ends after it, and what goes on."""

    __slots__ = ("run", "value", "kids")

    def __init__(self, run: bytes, value: tuple | None = None, kids=None):
        self.run, self.value, self.kids = run, value, kids


def _common(a: bytes, b: bytes) -> int:
    if a == b[:len(a)]:
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle - 1)
    return low


class RadixTree:
    """Adaptive radix tree from byte strings to values, which ``add`` sums."""

    def __init__(self, add):
        self.add, self.root = add, Node(b"")

    def insert(self, key: bytes, value: tuple) -> None:
        node, at = self.root, 0
        while True:
            same = _common(node.run, key[at:at + len(node.run)])
            if same < len(node.run):
                # The run is cut: what both share stays here, the rest goes below.
                below = Node(node.run[same + 1:], node.value, node.kids)
                byte = node.run[same]
                node.run, node.value, node.kids = node.run[:same], None, Small().put(byte, below)
            at += same
            if at == len(key):
                node.value = value if node.value is None else self.add(node.value, value)
                return
            kid = node.kids.get(key[at]) if node.kids is not None else None
            if kid is None:
                node.kids = (node.kids or Small()).put(key[at], Node(key[at + 1:], value))
                return
            node, at = kid, at + 1

    def paths(self) -> Iterator[tuple[bytes, int, tuple]]:
        """(path, depth of the node above, sum of all values below) for every node, children first."""
        stack: list[tuple[Node, bytes, int, list | None]] = [(self.root, self.root.run, 0, None)]
        done: list[tuple] = []  # sums of finished nodes, taken by the node above
        while stack:
            node, path, above, kids = stack.pop()
            if kids is None:
                kids = list(node.kids.items()) if node.kids is not None else []
                stack.append((node, path, above, kids))
                stack += [(kid, path + bytes([byte]) + kid.run, len(path), None) for byte, kid in reversed(kids)]
                continue
            total = node.value
            for _ in kids:
                below = done.pop()
                total = below if total is None else self.add(total, below)
            if total is not None:
                done.append(total)
                yield path, above, total


def turn_keys(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, key) of each row that has a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    key = F.unhex(F.concat(digest, F.lpad(F.hex(F.octet_length(text).cast("bigint")), 16, "0")))
    return turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                        key.alias("key")).filter("conv_id is not null")


def placed_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n) of the conversations, and (conv_id, pos, key) of their turns.

    Rows are numbered in one distributed sort; a conversation's first number
    gives the places, so a very long one is not sorted in one task.
    """
    numbered = assign_ids(turn_keys(turns), "row", ["conv_id", "turn", "key"])
    firsts = staged(numbered.groupBy("conv_id").agg(F.min("row").alias("first"), F.count("*").alias("n")), "trie-conversations")
    placed = numbered.join(firsts.drop("n"), "conv_id").select("conv_id", (F.col("row") - F.col("first")).alias("pos"), "key")
    return firsts.drop("first"), staged(placed, "trie-turns")


def rebuilt(convs: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of the first of their block of five.

    Conversation c gets the first h turns of c - c % 5, with h the CRC-32 of
    its number in decimal modulo 9, and its own from turn h on.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % MOST_TAKEN
    known = convs.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    known = staged(known.join(bases, "base", "left").select("conv_id", "h", "base", taken.alias("taken"), (
        taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n")), "trie-rebuilt")
    # At most eight turns and five conversations meet under one base.
    heads = turns.filter(F.col("pos") < MOST_TAKEN - 1).withColumnRenamed("conv_id", "base")
    heads = known.filter("h > 0").join(heads, "base").filter("pos < h").select("conv_id", "pos", "key")
    own = turns.join(known.select("conv_id", "h", "taken"), "conv_id").filter("pos >= h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key")
    return known.select("conv_id", "n"), heads.unionByName(own)


def _long_bytes(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))


def segments(convs: DataFrame, turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """(conv_id, prefix, keys, below, ends): the turns by segment, a row at least per conversation.

    ``prefix`` is 16 bytes for all turns before, then the segment's number;
    ``below`` is the prefix of what follows a full segment, and ``ends`` the
    node where the conversation ends, if it does in this segment.
    """
    ids = F.transform(F.array_sort(F.collect_list(F.struct("pos", "key"))), lambda t: F.hex(t["key"]))
    seg = F.floor(F.col("pos") / size).cast("bigint").alias("seg")
    joined = turns.groupBy("conv_id", seg).agg(F.unhex(F.array_join(ids, "")).alias("keys"))  # at most ``size`` turns each
    rows = staged(convs.join(joined, "conv_id", "left").select(
        "conv_id", "n", F.coalesce("seg", F.lit(0)).alias("seg"), F.coalesce("keys", F.lit(b"")).alias("keys")), "trie-segments")
    lanes = [F.xxhash64(F.lit(i), "seg", "keys") for i in (1, 2)]
    long = rows.filter(F.col("n") > size)
    # Digests combine by exclusive or, so a window over one row per segment chains them.
    before = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    chained = [F.coalesce(F.bit_xor(lane).over(before), F.lit(0)).alias(f"p{i}") for i, lane in enumerate(lanes)]
    chain = staged(long.select("conv_id", "seg", *chained), "trie-chains")
    both = long.join(chain, ["conv_id", "seg"]).unionByName(
        rows.filter(F.col("n") <= size).select("*", F.lit(0).cast("bigint").alias("p0"), F.lit(0).cast("bigint").alias("p1")))
    prefix = F.concat(_long_bytes(F.col("p0")), _long_bytes(F.col("p1")), _long_bytes(F.col("seg")))
    below = F.concat(*[_long_bytes(F.col(f"p{i}").bitwiseXOR(lane)) for i, lane in enumerate(lanes)])
    full = F.octet_length("keys") == size * WIDTH
    end = F.when(F.col("n") == 0, F.lit(ROOT)).when(full, F.col("below")).otherwise(F.unhex(F.md5(F.concat("prefix", "keys"))))
    named = both.select("conv_id", "n", "seg", "keys", prefix.alias("prefix"), below.alias("below"))
    return named.select("conv_id", "prefix", "keys", F.when(full, F.col("below")).alias("below"),
                        F.when(F.col("n") <= (F.col("seg") + 1) * size, end).alias("ends"))


def _trees(add):
    """A function that puts rows of (prefix, keys, below, values) into trees of bounded size."""
    def trees(batches: Iterator[pa.RecordBatch]):
        tree, held, bottoms = RadixTree(add), 0, {}
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for prefix, keys, below, *values in zip(*columns):
                path = prefix + keys
                tree.insert(path, tuple(values))
                if below is not None:
                    bottoms[path] = below
                held += len(path)
                if held >= TREE_BYTES:
                    yield tree, bottoms
                    tree, held, bottoms = RadixTree(add), 0, {}
        if held:
            yield tree, bottoms

    return trees


def _aligned(tree: RadixTree, bottoms: dict[bytes, bytes]):
    """(node, parent, depth in the segment, segment, length of the last text, sum) at every turn-aligned byte depth."""
    for path, above, total in tree.paths():
        # Depths above this node's own run belong to the nodes above.
        first = max(WIDTH, (above // WIDTH + 1) * WIDTH)
        if len(path) < first:
            continue
        prefix, seg = path[:16], int.from_bytes(path[16:WIDTH], "big")
        digest = hashlib.md5(path[:first], usedforsecurity=False)
        parent = None
        for end in range(first, len(path) + 1, WIDTH):
            if end > first:
                digest.update(path[end - WIDTH:end])
            if end == WIDTH:
                if not seg:
                    yield ROOT, None, 0, seg, 0, total
                continue
            if parent is None:
                parent = prefix if end == 2 * WIDTH else hashlib.md5(path[:end - WIDTH], usedforsecurity=False).digest()
            node = (bottoms.get(path) if end == len(path) else None) or digest.digest()
            yield node, parent, end // WIDTH - 1, seg, int.from_bytes(path[end - 8:end], "big"), total
            parent = node


def _by_range(rows: DataFrame) -> DataFrame:
    """Neighbours in one task; a hash splits what begins alike, the id what is all alike."""
    return rows.repartitionByRange("prefix", F.substring("keys", 1, 2 * WIDTH), F.xxhash64("keys"), "conv_id")


def _counted(rows: DataFrame, size: int) -> DataFrame:
    """(node, parent, depth, bytes, n_convs, conv_id) of every node."""
    trees = _trees(lambda a, b: (a[0] + b[0], min(a[1], b[1])))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, bottoms in trees(batches):
            out = [(node, parent, seg * size + depth, last, *total) for node, parent, depth, seg, last, total in _aligned(tree, bottoms)]
            kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             ["node", "parent", "depth", "bytes", "n_convs", "conv_id"])

    known = _by_range(rows).select("prefix", "keys", "below", F.lit(1).cast("bigint").alias("one"), "conv_id")
    parts = known.mapInArrow(counted, "node binary, parent binary, depth long, bytes long, n_convs long, conv_id long")
    return parts.groupBy("node").agg(F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("bytes").alias("bytes"),
                                     F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))


def _summed(rows: DataFrame) -> DataFrame:
    """(node, saved, leaves): sums over the members of what they own."""
    trees = _trees(lambda a, b: (a[0] + b[0], a[1] + b[1]))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, bottoms in trees(batches):
            out = [(node, *total) for node, _, _, _, _, total in _aligned(tree, bottoms)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [pa.binary(), pa.int64(), pa.int64()])],
                                             ["node", "saved", "leaves"])

    parts = _by_range(rows).select("prefix", "keys", "below", "saved", "leaves").mapInArrow(
        summed, "node binary, saved long, leaves long")
    return parts.groupBy("node").agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, sha256) over the sorted ids that end in a node, joined by commas.

    Ids are sorted by range and joined to pieces first, so the one task that
    has to see a node's digest through reads pieces, not rows.
    """
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        for batch in batches:
            out = []
            for at, one in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if ids and (at != node or len(ids) == IDS_PER_PIECE):
                    out.append((node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = at
                ids.append(one)
            if out:
                yield _piece_rows(out)
        if ids:
            yield _piece_rows([(node, ids[0], ",".join(map(str, ids)))])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for at, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if digest is not None and at == node:
                    digest.update(b"," + text.encode())
                    continue
                if digest is not None:
                    out.append((node, digest.hexdigest()))
                node, digest = at, hashlib.sha256(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate((pa.binary(), pa.string()))],
                                             ["node", "sha"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()], pa.string())], ["node", "sha"])

    placed = ends.select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = placed.mapInArrow(pieces, "node binary, first long, ids string")
    return joined.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digests, "node binary, sha string")


def _piece_rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))],
                                      ["node", "first", "ids"])


def trie(convs: DataFrame, turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """A row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``.

    ``convs`` has each ``conv_id`` once with its number of turns ``n``, and
    ``turns`` has ``conv_id``, ``pos`` from 0 without gaps, and the turn's ``key``.
    A conversation without turns ends in the root. No conversations give no rows.
    """
    rows = staged(segments(convs, turns, size), "trie-rows")
    nodes = staged(_counted(rows, size), "trie-nodes")
    kids = staged(nodes.filter("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children")), "trie-children")
    nodes = nodes.join(kids, "node", "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)), "block": F.floor(F.col("depth") / size).cast("bigint"),
        "own": (F.col("n_convs") - 1) * F.col("bytes")})
    nodes = staged(nodes, "trie-weighed")

    # What a conversation owns, by blocks of its path, so that a long one is not one group.
    owned = nodes.groupBy("conv_id", "block").agg(F.sum("own").alias("own"), F.min("depth").alias("top"),
                                                 F.sum((F.col("n_children") == 0).cast("bigint")).alias("leaves"))
    whole = Window.partitionBy("conv_id")
    deeper = whole.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    owned = staged(owned.select("conv_id", "block", F.coalesce(F.sum("own").over(deeper), F.lit(0)).alias("deeper"),
                                F.sum("own").over(whole).alias("saved"), F.min("top").over(whole).alias("top"),
                                F.sum("leaves").over(whole).alias("leaves")), "trie-owned")
    members = staged(_summed(rows.join(owned.select("conv_id", "saved", "leaves").distinct(), "conv_id")), "trie-members")
    ends = staged(end_digests(rows.filter("ends is not null").select(F.col("ends").alias("node"), "conv_id")), "trie-ends")

    down = Window.partitionBy("conv_id", "block").orderBy(F.col("depth").desc())
    found = nodes.join(owned.drop("leaves"), ["conv_id", "block"]).withColumn(
        "rest", F.col("deeper") + F.sum("own").over(down) - F.col("saved"))
    found = found.drop("deeper", "saved").join(members, "node").join(ends, "node", "left")
    found = staged(found, "trie-found")
    # Below its topmost node a conversation is its own parent.
    upper = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    tops = found.filter("depth = top").join(upper, "parent", "left")
    found = tops.unionByName(found.filter("depth > top").withColumn("parent_conv_id", F.col("conv_id")))
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        (F.col("saved") + F.col("rest")).alias("saved_tokens"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, size: int = SEGMENT) -> DataFrame:
    """The trie of conversations that begin like the first of their block.

    ``conversations`` has ``conv_id, turn, role, text``; other columns are
    ignored. Turns go by number, a null one first, and equal numbers by their
    keys, so that ties and repeated rows have a place each. A null role or text
    is empty. Rows without a conversation belong to none. An empty table gives
    no rows.
    """
    return trie(*rebuilt(*placed_turns(conversations)), size)
