"""Queries over the smallest tables, against SQL or a plain version."""

from __future__ import annotations

import zlib
from collections import defaultdict

import brute
import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR

from tidemark.llm import quality
from tidemark.llm.queries import ORACLES, QUERIES, tokenizer_path
from test_oracle import TABLES, plain


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents():
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want) and len(got) > 0


def test_all_are_there():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_simhash(spark, documents):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op2_simhash_near_dedup"](spark, SF_DIR).collect()}
    prints = [(one, brute.fingerprint(text)) for one, text in documents]
    want = {one: (f"{fp:016x}", c) for (one, fp), c in zip(prints, brute.components(prints))}
    assert got == want


def test_quality(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op9_quality_rules"](spark, SF_DIR).collect()}
    assert len(got) == len(documents)
    for one, text in documents:
        row = got[one]
        assert tuple(row)[1:7] == brute.base_counts(text)
        assert row.kept == (not row.base_failed and _in_bands(text))


def _in_bands(text):
    import zstandard

    def fits(part):
        ratio = len(part) / len(zstandard.ZstdCompressor(level=3).compress(part))
        low, high = next((lo, hi) for below, lo, hi in quality.BANDS if below is None or len(part) < below)
        return low <= ratio <= high

    data = text.encode()
    chunks = [data[i:i + 4096] for i in range(0, len(data), 4096)]
    odd = sum(len(c) for c in chunks if not fits(c)) if len(chunks) > 1 else 0
    return fits(data) and odd <= 0.25 * len(data)


def test_token_counts(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_token_counts"](spark, SF_DIR).collect()}
    for one, text in documents:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert got[one] == (len((text or "").encode()), n, n > 2048)


def test_packing(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    rows = QUERIES["op7_cost_balanced_packing"](spark, SF_DIR).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for one, text in documents:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces.pop(one), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    assert not pieces
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert 2048 * len(sequences) - total < 0.05 * total


def test_decontamination_finds_what_brute_force_finds(spark, documents):
    items = pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()
    got = {(r.doc_id, r.item_id) for r in QUERIES["op5_latent_decontamination"](spark, SF_DIR).collect()}
    want = brute.held_items(documents, [(i["item_id"], i["text"]) for i in items])
    assert want and got <= want
    assert len(got & want) >= 0.9 * len(want)
    assert got >= {(one, i["item_id"]) for one, text in documents for i in items if i["text"] in text}


def test_pseudonyms_leave_the_rest(spark, documents):
    import re

    got = {r.doc_id: r for r in QUERIES["op3_feistel_pseudonyms"](spark, SF_DIR).collect()}
    digits = re.compile(r"[0-9]")
    for one, text in documents:
        assert digits.sub("", got[one].text).replace(".", "") == digits.sub("", text).replace(".", "")
        if got[one].n_numbers + got[one].n_dates == 0:
            assert got[one].text == text
    assert sum(r.n_numbers for r in got.values()) > 0
