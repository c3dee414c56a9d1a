"""The prefix trie, repeated passages and vector codes against plain versions, and on unusual inputs."""

from __future__ import annotations

import hashlib
import random
import zlib

import brute
import numpy as np
import pytest

from tidemark.llm import prefix_trie, substrings, vector_codes

TURNS = "conv_id long, turn long, role string, text string"


def _trie(spark, rows, size=prefix_trie.SEGMENT):
    df = spark.createDataFrame([(*r, "x") for r in rows], f"{TURNS}, key string")
    return sorted(tuple(r) for r in prefix_trie.rebuilt_trie(df, size).collect())


def _conversations(draw, n, longest):
    rows = []
    for c in range(n):
        for turn in range(draw.randrange(longest + 1)):
            rows.append((c, turn, draw.choice(["user", "assistant", None]), draw.choice(["a", "bb", "", None, "é" * 3])))
    return rows


@pytest.mark.parametrize("size", [1, 3, 128])
def test_trie_equals_plain_version_at_all_segment_sizes(spark, size):
    rows = _conversations(random.Random(size), 60, 12)
    assert _trie(spark, rows, size) == brute.trie(rows)


def test_trie_of_equal_conversations_and_odd_rows(spark):
    rows = [(c, t, "user", "same") for c in range(-12, 200) for t in range(3)]
    rows += [(7, None, None, None), (7, 0, "user", "same"), (7, 0, "user", "same"), (7, 0, "tool", "tied"), (None, 1, "user", "lost")]
    assert _trie(spark, rows) == brute.trie(rows)


def test_trie_of_one_very_long_conversation(spark):
    rows = [(5, t, "user", str(t)) for t in range(700)] + [(15, t, "user", str(t)) for t in range(500)] + [(16, 0, "user", "0")]
    assert _trie(spark, rows) == brute.trie(rows)


def test_trie_of_no_conversations(spark):
    assert _trie(spark, []) == [] and _trie(spark, [(None, 1, "user", "a")]) == []


def test_turnless_conversation_ends_in_the_root(spark):
    # No conversation 5 is there, and its number makes 6 give up more turns than it has.
    one = next(c for c in range(1, 5000) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    assert _trie(spark, [(one, 0, "user", "a")]) == [(one, 0, None, 1, 0, 1, 0, hashlib.sha256(str(one).encode()).hexdigest())]


def test_ids_in_pieces_give_one_digest(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_PER_PIECE", 3)
    ends = spark.createDataFrame([(b"a", i) for i in range(-5, 40)] + [(b"b", 7)], "node binary, conv_id long")
    got = {bytes(r.node): r.sha for r in prefix_trie.end_digests(ends).collect()}
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got == {b"a": sha(range(-5, 40)), b"b": sha([7])}


def test_tree_layouts_grow_and_paths_stay_compressed():
    tree, seen = prefix_trie.RadixTree(lambda a, b: (a[0] + b[0],)), []
    for n in range(256):
        tree.insert(b"shared" + bytes([n]) + b"rest", (1,))
        seen.append(type(tree.root.kids.get(ord("s")).kids).__name__ if n else None)
    assert [seen[i] for i in (1, 15, 16, 47, 48, 255)] == ["Small", "Small", "Indexed", "Indexed", "Full", "Full"]
    assert tree.root.kids.get(ord("s")).run == b"hared"
    paths = {path: total for path, _, total in tree.paths()}
    assert len(paths) == 258 and paths[b"shared"] == (256,) and paths[b"shared\x07rest"] == (1,)


def test_tree_holds_any_keys():
    draw = random.Random(3)
    keys = [bytes(draw.choices(b"ab", k=draw.randrange(9))) for _ in range(400)]
    tree = prefix_trie.RadixTree(lambda a, b: (a[0] + b[0],))
    for key in keys:
        tree.insert(key, (1,))
    for path, above, total in tree.paths():
        assert total == (sum(k.startswith(path) for k in keys),) and above <= len(path)


# Repeated passages


def _passages(spark, docs, words=4, **sizes):
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, words string, N_WORDS int")
    got = substrings.drop_repeated_passages(df, words=words, **sizes)
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("chunk_bytes, slice_windows, spare_bits", [(1, 1, 1), (50, 7, 0), (1 << 20, 1 << 20, 5)])
def test_passages_equal_plain_version(spark, chunk_bytes, slice_windows, spare_bits):
    draw = random.Random(chunk_bytes)
    docs = [(i, draw.choice([" ", "\n", "\t  "]).join(draw.choices(["a", "b", "ü", "dd", "e" * 70], k=draw.randrange(25)))) for i in range(80)]
    docs += [(i, docs[3][1]) for i in range(100, 130)]
    got = _passages(spark, docs, chunk_bytes=chunk_bytes, slice_windows=slice_windows, spare_bits=spare_bits)
    assert got == sorted(brute.without_passages(docs, 4), key=str)


def test_passages_of_odd_rows(spark):
    docs = [(2, None), (3, ""), (4, " \n "), (None, "a b c d e"), (None, "a b c d e"), (9, "a b c d e"), (9, "x a b c d"), (9, "a b c d e"),
            (1, "q r"), (5, " a b c d e"), (6, "w " * 300)]
    assert _passages(spark, docs) == sorted(brute.without_passages(docs, 4), key=str)


def test_passages_of_an_empty_table_and_of_short_texts(spark):
    assert _passages(spark, []) == []
    assert _passages(spark, [(1, "a b"), (2, "a b")]) == [(1, 2, 0, "a b"), (2, 2, 0, "a b")]


def test_a_very_long_text_and_very_long_words(spark):
    draw = random.Random(1)
    long = " ".join(str(draw.randrange(10**6)) for _ in range(150_000))
    huge = "z" * 600_000
    docs = [(1, long), (2, f"start {long[:70_000]} {huge} a b c d"), (3, f"{huge} a b c e")]
    got = _passages(spark, docs, words=20)
    assert got == sorted(brute.without_passages(docs, 20), key=str)


def test_hashes_do_not_depend_on_place():
    data = b"  one two three " + b"x" * 300_000 + b" one\ntwo three"
    starts, stops = substrings.word_bounds(data)
    found = substrings.word_hashes(data, starts, stops)
    assert [data[a:b] for a, b in zip(starts, stops)] == data.split()
    assert found[:3].tolist() == found[4:].tolist() and len(set(found.tolist())) == 4
    for n in range(1, 8):
        windows = substrings.window_hashes(found, n, 0xD1342543DE82EF95)
        assert len(windows) == max(0, 8 - n) and (n > 3 or windows[0] == windows[4])


def test_dumped_numbers_come_back():
    draw = np.random.default_rng(0)
    arrays = [np.zeros(0, np.uint64), draw.integers(0, 2**64, 100, np.uint64), np.arange(70_000, dtype=np.uint64), np.zeros(5, np.uint64)]
    for before, after in zip(arrays, substrings.load(substrings.dump(*arrays))):
        assert before.tolist() == after.tolist()
    ordered = np.sort(arrays[1])
    assert substrings.unsteps(substrings.steps(ordered)).tolist() == ordered.tolist()


def test_sketch_keeps_all_repeated_windows(spark):
    draw = random.Random(5)
    docs = [(i, " ".join(draw.choices("abcdef", k=30))) for i in range(40)]
    chunks = substrings.chunks_of(spark.createDataFrame(docs, "id long, text string"), 4, 200)
    answers = substrings._answers(substrings._sketches(chunks, 4, 30, 2)).collect()
    often = sum(int(np.unpackbits(np.frombuffer(r.often, np.uint8)).sum()) for r in answers)
    windows = [set(), {}]
    for chunk in chunks.collect():
        found = substrings.Chunk(bytes(chunk.docs)).windows(4)[0] >> np.uint64(34)
        values, counts = np.unique(found, return_counts=True)
        for v, c in zip(values.tolist(), counts.tolist()):
            windows[1].setdefault(v, []).append(c)
    assert often == sum(len(c) for c in windows[1].values() if sum(c) > 1) > 0


# Vector codes


def _codes(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label string, code string")
    return sorted((tuple(r) for r in vector_codes.compress(df, **more).collect()), key=str)


@pytest.mark.parametrize("width, parts, entries", [(64, 16, 64), (48, 16, 8), (30, 4, 5), (16, 16, 3)])
def test_codes_equal_plain_version(spark, width, parts, entries):
    draw = random.Random(width)
    rows = [(i, [draw.gauss(0, 0.3) for _ in range(width)], draw.choice(["a", "b", None])) for i in range(150)]
    rows += [(i, rows[4][1], "copy") for i in range(200, 300)]
    assert _codes(spark, rows, parts=parts, entries=entries) == brute.vector_codes(rows, parts, entries)


def test_codes_of_odd_rows(spark):
    rows = [(3, [0.5] * 8, "a"), (1, None, "a"), (2, [1.0, None], "a"), (4, [float("nan")] * 8, None), (5, [float("inf")] * 8, None),
            (6, [], None), (None, [0.1] * 8, None), (7, [-0.001] * 3, "b"), (3, [0.5] * 8, "a"), (3, [0.25] * 8, "b")]
    assert _codes(spark, rows, parts=4, entries=3) == brute.vector_codes(rows, 4, 3)


def test_codes_of_huge_numbers_are_exact(spark):
    draw = random.Random(2)
    rows = [(i, [draw.uniform(-1, 1) * 10 ** draw.choice([0, 6, 18, 40, 306]) for _ in range(8)], i % 3) for i in range(30)]
    rows = [(i, v, str(label)) for i, v, label in rows]
    assert _codes(spark, rows, parts=4, entries=6) == brute.vector_codes(rows, 4, 6)


def test_codes_of_an_empty_table(spark):
    assert _codes(spark, []) == [] and _codes(spark, [(1, None, "a")]) == []


def test_transform_is_in_sequency_order():
    for n in (1, 2, 4, 8, 16):
        rows = vector_codes.walsh_hadamard(np.eye(n, dtype=np.int64)).T
        changes = [(np.diff(row) != 0).sum() for row in rows]
        assert changes == list(range(n))
        assert (rows @ rows.T == n * np.eye(n)).all()


def test_nearest_has_exact_distances_and_takes_the_lower_of_ties():
    draw = np.random.default_rng(4)
    for width in (1, 3, 4, 7):
        parts, entries = draw.integers(-5, 6, (500, width)), draw.integers(-5, 6, (40, width))
        distances = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        index, distance = vector_codes.nearest(parts, entries)
        assert index.tolist() == distances.argmin(axis=1).tolist() and distance.tolist() == distances.min(axis=1).tolist()
