"""The stages one after another, each against a plain version on its own input."""

from __future__ import annotations

import brute
import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR

import corpus_pipeline
from tidemark.llm import quality
from tidemark.operators.staging import staged


@pytest.fixture(scope="module")
def stages(spark):
    """(name, input, output) of each stage."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, SF_DIR), name)
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns and after.dtypes == before.dtypes
            assert 0 < after.count() <= before.count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_rules(stages):
    before, after = map(texts, stages["quality_rules"])
    assert after == {i: t for i, t in before.items() if not brute.base_counts(t)[5] and quality.judge(t)[6]}


def test_line_dedup(stages):
    before, after = stages["line_dedup"]
    assert texts(after) == {one: text for one, _, _, text in brute.kept_lines(list(texts(before).items()))}
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near_dedup(stages):
    before, after = map(texts, stages["near_dedup"])
    ids = list(before)
    named = brute.components([(i, brute.fingerprint(before[i])) for i in ids])
    assert after == {i: before[i] for i, c in zip(ids, named) if i == c}


def test_decontamination(stages):
    before, after = map(texts, stages["decontamination"])
    items = pq.read_table(f"{SF_DIR}/benchmark.parquet").to_pylist()
    for one in set(before) - set(after):  # what goes holds an item
        assert brute.held_items([(one, before[one])], [(i["item_id"], i["text"]) for i in items])
    assert not [one for one, text in after.items() if any(i["text"] in text for i in items)]


def test_packing(stages):
    before, after = stages["packing"]
    got = after.collect()
    tokens = {}
    for r in got:
        tokens.setdefault(r.doc_id, [0, r.doc_tokens])[0] += r.length
    assert set(tokens) == set(texts(before)) and all(a == b for a, b in tokens.values())


def test_run_applies_all_stages(spark, stages):
    got = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    ids = {i for i, *_ in got}
    assert ids == set(texts(stages["packing"][0]))
