"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import brute
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import (decontaminate, line_dedup, packing, preferences, pseudonyms, quality, simhash, token_counts,
                          url_trust, warc)
from tidemark.llm.queries import tokenizer_path

LONG = "lorem ipsum Dolor, " * 30_000 + "x" * 70_000
LINE = "a line that several documents have in common"
DOCS = [(1, f"{LINE}\nfirst"), (2, f" {LINE.upper()}\t\nsecond"), (3, f"{LINE}\n{LINE}\nthird"), (3, f"{LINE}\n{LINE}\nthird"),
        (4, None), (5, ""), (None, f"{LINE}\nno id"), (6, LONG), (7, "\n\n"), (8, "wörd " * 60), (9, "nothing like the others is said here"), (9, "nothing like the others is said here")]
# Names that the operators use themselves.
EXTRA = ("id", "fp", "key", "keys", "_id", "_keys", "n_lines", "kept", "fingerprint", "component_id", "found", "made", "n",
         "start", "length", "host", "path", "verdict", "digest", "size", "original", "words", "place", "group", "c_text")


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(DOCS, "doc_id long, text string")
    return plain.select("doc_id", *[F.lit(f"-{name}").alias(name) for name in EXTRA[:12]], "text",
                        *[F.lit(i).alias(name) for i, name in enumerate(EXTRA[12:])])


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.filter("doc_id = 99")


BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
BENCH = [(1, "the quick brown fox jumps over the lazy dog. and then it sleeps"), (2, None), (3, ""), (4, "short one")]


def run_all(spark, docs):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    return {
        2: simhash.near_duplicates(docs), 3: pseudonyms.pseudonymise(docs, "k"), 5: decontaminate.contaminated(docs, bench),
        7: packing.pack(docs, BYTES), 8: line_dedup.drop_shared_lines(docs, digest=True), 9: quality.quality_verdicts(docs),
        10: token_counts.count_tokens(docs, WORDS)}


def test_every_row_gives_its_rows(spark, docs):
    want = sorted((d for d, _ in DOCS), key=str)
    for n, got in run_all(spark, docs).items():
        ids = [r.doc_id for r in got.collect()]
        if n == 7:
            assert set(ids) == set(want)
        elif n != 5:
            assert sorted(ids, key=str) == want, n


def test_empty_tables(spark, nothing):
    for n, got in run_all(spark, nothing).items():
        assert got.count() == 0, n
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(spark.createDataFrame(DOCS, "doc_id long, text string"), bench).count() == 0
    for keep in (quality.keep_quality, simhash.keep_one, line_dedup.drop_shared_lines):
        assert keep(nothing).count() == 0


def test_simhash_of_odd_texts(docs):
    got = simhash.near_duplicates(docs).collect()
    prints = [(one, brute.fingerprint(text)) for one, text in DOCS]
    want = [(one, f"{fp:016x}", c) for (one, fp), c in zip(prints, brute.components(prints))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_one_of_each_group_stays(spark, docs):
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert ids.count(9) == 1 and ids.count(None) == 1
    assert 2 in ids and 3 not in ids  # a near-duplicate
    assert 4 in ids and 5 not in ids and 7 not in ids  # all three have no words


@pytest.mark.parametrize("max_list", [1, 2, 64])
def test_long_lists_lose_no_link(spark, max_list):
    import random

    random.seed(7)
    centre = random.getrandbits(64)
    prints = {centre}
    for _ in range(40):  # a chain and a cloud around one point
        prints.add(random.choice(sorted(prints)) ^ sum(1 << random.randrange(64) for _ in range(4)) & (1 << 64) - 1)
    prints |= {random.getrandbits(64) for _ in range(30)}
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    entries = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = simhash.links(entries, max_list)
    from tidemark.llm.components import connected

    named = {r.node: r.component for r in connected(got, "a", "b").collect()}
    pairs = [(p, p & (1 << 64) - 1) for p in signed]
    assert [named.get(p, p) for p in signed] == brute.components(pairs)


def test_lines(docs):
    got = sorted((tuple(r) for r in line_dedup.drop_shared_lines(docs, digest=True).collect()), key=str)
    # No id counts as the smallest.
    marked = [(-1 if one is None else one, text) for one, text in DOCS]
    want = [(None if one == -1 else one, n, d, brute.sha256(text)) for one, n, d, text in brute.kept_lines(marked)]
    assert got == sorted(want, key=str)


def test_lines_keep_all_columns(docs):
    got = line_dedup.drop_shared_lines(docs)
    assert set(got.columns) == set(docs.columns) | {"n_lines", "n_dropped"}
    row = got.filter("doc_id = 1").first()
    assert (row.text, row.n_dropped, row.key, row.c_text) == ("first", 1, "-key", len(EXTRA) - 13)
    assert got.filter("doc_id = 4").first().text is None


def test_quality_of_odd_texts(docs):
    got = sorted((tuple(r)[:7] for r in quality.quality_verdicts(docs).collect()), key=str)
    assert got == sorted(((one, *brute.base_counts(text)) for one, text in DOCS), key=str)
    assert quality.keep_quality(docs).columns == docs.columns


def test_bands_reject_both_kinds():
    import base64
    import random

    random.seed(1)
    words = ["".join(random.choices("etaoinshrdlu", k=random.randrange(2, 9))) for _ in range(400)]
    prose = " ".join(random.choices(words, k=3000))
    noise = base64.b64encode(random.randbytes(6000)).decode()
    spaced = " ".join(noise[i:i + 7] for i in range(0, len(noise), 7))
    assert quality.compression(prose.encode())[1] and quality.judge(prose)[6]
    assert not quality.compression(noise.encode())[1]
    # Half the text is noise: the whole may pass, the chunks do not.
    assert quality.compression((prose[:8192] + noise).encode())[2] > quality.MAX_ODD_SHARE
    assert not quality.compression(("all work and no play " * 500).encode())[1]
    assert quality.judge(spaced)[0] > 50


@pytest.mark.parametrize("n_different", [1, 3, 1 << 21])
def test_repeated_windows(n_different):
    import numpy as np

    numbers = np.array([0, 0, 0, 0, n_different - 1, 0, 0, 0], np.int64)
    words = " ".join(f"w{n}" for n in numbers)
    assert quality.repeated_words(numbers, n_different) == brute.base_counts(words)[4]


def test_words_of_blocks():
    from tidemark.llm.text import word_blocks

    data = b"  aa \t bbbbbbbbbbbbbb\x0bcc\n" * 5 + b"d" * 40
    for block in (1, 3, 7, 1000):
        assert [w for part in word_blocks(data, block) for w in part] == data.split()


def test_token_counts_of_odd_texts(docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    got = sorted((tuple(r)[:3] for r in token_counts.count_tokens(docs, WORDS, chunk=4096, overlap=16).collect()), key=str)
    want = [(one, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for one, t in DOCS]
    assert got == sorted(want, key=str)


ALPHABET = ["a", "é", "é", "́", " ", "  ", "\n", "\t", " \n", "\x1c", "\x85", "\xa0", "　", "İ", "Σ", "'s", "'", "\0",
            "<|endoftext|>", "<|startoftext|>", "<|ENDoftext|>", "<|", "1", "23", "漢字", "😀", "ß", ".", "!!", ",", "a,", "E.", "각"]


def test_odd_strings_count_as_the_library_counts():
    import random

    random.seed(3)
    words, plain = token_counts.load(WORDS), packing.encoder(BYTES)
    assert token_counts.drops_spaces(words) and not token_counts.drops_spaces(plain.library) and plain.fast
    for _ in range(3000):
        text = "".join(random.choice(ALPHABET) for _ in range(random.randrange(50)))
        n = len(words.encode(text, add_special_tokens=False).ids)
        assert token_counts.PartCounts(words).count([text]) == [n], text
        assert token_counts.spliced_count(words, text, 16, 4, 3) == n, text
        import numpy as np

        ids = plain.library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(plain.ids(text), "<u4").tolist() == ids, text
        assert "".join(plain.blocks(text, 7)) == text
        if "<|endoftext|>" not in text:
            parts = [plain._whole(part) for part in plain.blocks(text, 7)]
            assert np.frombuffer(b"".join(parts), "<u4").tolist() == ids, text


def test_overlaps_widen_until_they_align():
    words = token_counts.load(WORDS)
    text = "ab cd " * 40 + "x" * 500 + " ef gh" * 40
    assert token_counts.spliced_count(words, text, 64, 4, 4) == len(words.encode(text, add_special_tokens=False).ids)


def test_packing_pieces(spark, docs):
    got = packing.pack(docs, BYTES, max_tokens=128, buffer_tokens=1 << 12, with_ids=True).collect()
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == r.length
    assert all(sum(r.length for r in rs) <= 128 for rs in by.values())
    empty = [r for r in got if r.doc_id in (4, 5)]
    assert [(r.length, r.doc_tokens, r.ids) for r in empty] == [(1, 1, [1])] * 2


def test_places_balance_cost():
    import random

    random.seed(2)
    lengths = sorted((random.randrange(1, 2048) for _ in range(500)), reverse=True)
    found = packing.place(lengths, 2048, 1.0, 1e-3)
    assert len(found) == -(-sum(lengths) // 2048)
    covered = {}
    for sequence in found:
        assert sum(n for *_, n in sequence) <= 2048
        for piece, start, n in sequence:
            covered.setdefault(piece, []).append((start, n))
    for piece, length in enumerate(lengths):
        at = 0
        for start, n in sorted(covered[piece]):
            assert start == at
            at += n
        assert at == length


KEY = "secret"


def hidden(spark, text):
    return pseudonyms.pseudonymise(spark.createDataFrame([(1, text)], "doc_id long, text string"), KEY).first()


def test_pseudonyms_against_plain(spark):
    import datetime as dt

    card, ip, day = "4111111111111111", "70.123.182.155", dt.date(1999, 12, 31)
    row = hidden(spark, f"a {card} b {ip} c {day} d {day:%d.%m.%Y} e {card[:4]}-{card[4:8]}-{card[8:12]}-{card[12:]}")
    new, moved = brute.moved_card(card, KEY), brute.moved_day(day, KEY)
    assert row.text == (f"a {new} b {brute.moved_ip(ip, KEY)} c {moved} d {moved:%d.%m.%Y} "
                        f"e {new[:4]}-{new[4:8]}-{new[8:12]}-{new[12:]}")
    assert (row.n_numbers, row.n_dates) == (3, 2) and brute.luhn(new)


@pytest.mark.parametrize("text", ["4111111111111112", "30.02.2001", "666-12-1234", "1.2.3.4.5", "x4111111111111111", "2101-01-01",
                                  "256.1.1.1", "no numbers", "", "12 34", "000-12-1234"])
def test_what_fails_its_check_stays(spark, text):
    assert hidden(spark, text).text == text


@pytest.mark.parametrize("text, shape", [
    ("+1 (988) 555-2485", r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}"), ("123-45-6789", pseudonyms.SSN), ("(212) 555-0100", r"\([2-9]\d\d\) [2-9]\d\d-\d{4}"),
    ("+1 (156) 555-2485", r"\+1 \([01]\d\d\) \d{3}-\d{4}"), ("+1 (456) 155-2485", r"\+1 \([2-9]\d\d\) [01]\d\d-\d{4}"),
    ("+1 456 555 2485", r"\+1 [2-9]\d\d [2-9]\d\d \d{4}"), ("+49 30 1234567", r"\+49 \d\d \d{7}"), ("12/25/1999", pseudonyms.MONTH_DATE.format(g=1)), ("2001/02/28", pseudonyms.ISO_DATE.format(g=1)),
    ("378282246310005", r"\d{15}"), ("10.0.0.1", pseudonyms.IPV4)])
def test_pseudonyms_keep_their_format(spark, text, shape):
    import re

    new = hidden(spark, f"x {text}, y").text
    assert new != f"x {text}, y" and re.fullmatch(f"x (?:{shape}), y", new)


def test_pseudonyms_are_permutations(spark):
    frame = spark.range(73049).select(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd")
                                      .alias("text"), F.col("id").alias("doc_id"))
    got = pseudonyms.pseudonymise(frame, KEY)
    assert got.select("text").distinct().count() == 73049
    assert got.agg(F.min("text"), F.max("text")).first() == ("1900-01-01", "2099-12-31")


def test_word_order_and_answers():
    import random

    random.seed(5)
    for _ in range(200):
        a = [random.choice([b"a", b"b", b"c", b"d"]) for _ in range(random.randrange(1, 70))]
        b = [random.choice([b"a", b"b", b"c", b"e"]) for _ in range(random.randrange(0, 90))]
        assert decontaminate.common_length(decontaminate.masks_of(a), len(a), b) == brute.common_length(a, b)


def test_paraphrases_need_the_answer(spark):
    item = ("a farmer has twelve red hens and buys nine more of them from his old neighbour on a rainy monday morning. "
            "the farmer now owns twenty one red hens")
    reworded = item.replace("red hens and buys", "white hens and gets").replace("old neighbour", "kind uncle").replace(
        "rainy monday morning", "sunny friday evening")
    wrong = reworded.replace("the farmer now owns twenty one red hens", "nobody knows how it all came to an end there")
    filler = " ".join(f"word{i}" for i in range(300))
    texts = [(1, f"{filler} {item.upper()} {filler}"), (2, f"{filler} {reworded} {filler}"), (3, f"{filler} {wrong} {filler}"),
             (4, filler), (5, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contaminated(docs, bench, min_cosine=0.3).collect()}
    assert set(got) == {1, 2} and got[1].overlap == 1.0 and got[2].answered and got[2].overlap < 0.8
    assert {r.doc_id for r in decontaminate.keep_clean(docs, bench, min_cosine=0.3).collect()} == {3, 4, 5}


PAGES = [(1, "http://A.com/x?y", "same"), (2, "https://b.com/z", "same"), (3, "nourl", None), (4, None, ""), (None, "http://c.com", "same"),
         (5, "http://d.com/a\r\nb", "WARC/1.1\r\n\r\n\r\n\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc"), (6, "http://e.com/", "é\n" * 4),
         (2, "https://b.com/z", "same")]


def test_captures_of_odd_pages(spark):
    import base64
    import hashlib

    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("id", F.lit("x"))
    got = sorted((tuple(r) for r in warc.round_trip(frame).collect()), key=str)
    want = []
    for one, _, html in PAGES:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        largest = max((p for p, _, h in PAGES if (h or "") == (html or "") and p is not None), default=None)
        again = one != largest
        want.append((one, len(data), digest, "revisit" if again else "response", largest if again else None))
    assert got == sorted(want, key=str)
    empty = frame.filter("page_id = 99")
    assert warc.round_trip(empty).count() == 0


def test_transactions_tie_in_both_directions(spark):
    fields = "record_id string, record_type string, concurrent_to array<string>"
    records = spark.createDataFrame([
        ("r1", "response", ["q1"]), ("q1", "request", []), ("m1", "metadata", ["q1"]), ("r2", "response", []),
        ("q2", "request", ["r2"]), ("m2", "metadata", ["r2"]), ("m3", "metadata", ["r2"]), ("r3", "revisit", []),
        ("q9", "request", ["nowhere"])], fields)
    for name, kind in (f.split() for f in warc.RECORDS.split(", ")):
        if name not in records.columns:
            records = records.withColumn(name, F.lit(None).cast(kind))
    got = {r.capture_id: ([q.record_id for q in r.requests], [m.record_id for m in r.metadata])
           for r in warc.assemble(records).collect()}
    assert got == {"r1": (["q1"], ["m1"]), "r2": (["q2"], ["m2", "m3"]), "r3": ([], [])}


def test_archives_read_plain_and_damaged():
    import gzip

    record = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 5\r\n\r\nab\r\nc\r\n\r\n"
    for content in (record * 2, gzip.compress(record) + gzip.compress(record)):
        assert [block for _, block in warc.records_of(content)] == [b"ab\r\nc"] * 2
    with pytest.raises(ValueError):
        list(warc.records_of(record[:-8]))
    assert list(warc.records_of(b"")) == []


def link(*hosts):
    return "".join(f'<a class="x" href="https://{h}/p">t</a>' for h in hosts) + '<a href="/local">l</a>'


def test_trust_and_distrust_spread(spark):
    pages = [(1, "http://good.com/", link("friend.org", "Friend.ORG")), (2, "http://friend.org/a", link("pal.org")),
             (3, "http://bad.net/es/x", link()), (4, "http://farm.org/", link("bad.net", "bad.net")), (5, "http://pal.org/", None),
             (6, "http://mixed.org/", link("good.com", "bad.net", "friend.org", "pal.org")), (7, None, None), (8, "nothing", ""),
             (9, "http://www.example.com/en/1", ""), (10, "http://x.example.com/en/1", ""), (11, "ftp://evil.net", "")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("rule", F.lit("x"))
    got = {r.page_id: r for r in url_trust.judge_urls(frame).collect()}
    links = [("good.com", "friend.org", 2), ("friend.org", "pal.org", 1), ("farm.org", "bad.net", 2), ("mixed.org", "good.com", 1),
             ("mixed.org", "bad.net", 1), ("mixed.org", "friend.org", 1), ("mixed.org", "pal.org", 1)]
    seeds = {"trust": {"good.com", "www.example.com"}, "distrust": {"bad.net", "x.example.com"}}
    trust = brute.page_rank(links, seeds["trust"], 0.85, 30)
    distrust = brute.distrust(links, seeds["distrust"], 0.85, 30)
    for r in got.values():
        assert r.trust == pytest.approx(trust.get(r.host, 0), abs=1e-3)
        assert r.distrust == pytest.approx(distrust.get(r.host, 0), abs=1e-3)
    assert {i: r.verdict for i, r in got.items()} == {
        1: "allow", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "allow",  # a quarter of its links
        7: "allow", 8: "allow", 9: "allow", 10: "block", 11: "allow"}
    assert (got[9].rule, got[10].rule, got[7].host, got[8].path) == ("www.example.com/en/", "example.com/en/", "", "")
    assert url_trust.judge_urls(frame.filter("page_id = 99")).count() == 0


def turns(spark, listed):
    return spark.createDataFrame(listed, "pair_id long, turn long, role string, text string").withColumn("side", F.lit("x"))


def test_preferences(spark):
    shared = [(1, 0, "system", "s"), (1, 1, "user", "u <|im_end|>")]
    chosen = turns(spark, [*shared, (1, 2, "assistant", "yes"), (1, 3, None, None), (2, 0, "user", "same"), (3, 0, "user", "only"),
                           (None, 0, "user", "n"), (1, 1, "user", "u <|im_end|>")])
    rejected = turns(spark, [*shared, (1, 2, "assistant", "no"), (2, 0, "user", "same"), (None, 0, "user", "n")])
    got = {r.pair_id: r for r in preferences.format_preferences(chosen, rejected).collect()}
    one = got[1]
    assert one.prompt == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu < |im_end|><|im_end|>\n" and one.n_prompt_turns == 2
    assert [one.chosen[s.start:s.stop] for s in one.chosen_spans] == ["yes<|im_end|>\n"]
    assert [one.rejected[s.start:s.stop] for s in one.rejected_spans] == ["no<|im_end|>\n"]
    assert one.chosen.endswith("<|im_start|>unknown\n<|im_end|>\n")
    assert (got[2].chosen, got[2].rejected, got[2].n_prompt_turns) == ("", "", 1)
    assert (got[3].prompt, got[3].rejected) == ("", "") and got[3].chosen
    assert got[None].n_prompt_turns == 1
    none = turns(spark, [])
    assert preferences.format_preferences(none, none).count() == 0
    long = turns(spark, [(1, i, "user", "t") for i in range(600)])
    assert sorted((r.segment, r.n_prompt_turns) for r in preferences.format_preferences(long, long).collect()) == [(0, 256), (1, 256), (2, 88)]


def test_results_have_the_columns_asked_for(spark, docs):
    assert rows(simhash.near_duplicates(docs).select("doc_id"))
    assert isinstance(pseudonyms.pseudonymise(docs, "k").schema["n_dates"].dataType, T.LongType)
