from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators import merge

SCHEMA = "k int, j int, a string, b int"
KEYS = ["k", "j"]
key = st.tuples(st.integers(0, 3) | st.none(), st.integers(0, 1) | st.none())
# Broadcast limits under which a local frame counts as small, and as large.
SMALL, LARGE = "10MB", "-1"
SLOW = hypothesis_settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def is_key(k):
    return None not in k


def keyed_rows(unique):
    row = st.tuples(key, st.sampled_from(["x", "y", None]), st.integers(0, 9) | st.none())
    return st.lists(row, max_size=8, unique_by=(lambda r: r[0] if is_key(r[0]) else object()) if unique else None)


def frame(spark, listed):
    return spark.createDataFrame([(*k, a, b) for k, a, b in listed], SCHEMA)


def listed(values):
    return sorted(((*k, a, b) for k, a, b in values), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.fixture(params=["broadcast", "shuffled"])
def path(request, settings):
    settings(autoBroadcastJoinThreshold=LARGE if request.param == "shuffled" else SMALL)
    return request.param


@SLOW
@given(target=keyed_rows(True), source=keyed_rows(True))
def test_merge_all_like_a_dictionary(spark, target, source):
    taken = {k for k, *_ in source if is_key(k)}
    want = [r for r in target if r[0] not in taken] + source
    merged = merge.merge_all(frame(spark, target), frame(spark, source), KEYS)
    assert rows(merged) == listed(want)


@SLOW
@given(target=keyed_rows(True), source=keyed_rows(False))
def test_replace_by_key_keeps_repeated_source_rows(spark, target, source):
    taken = {k for k, *_ in source if is_key(k)}
    want = [r for r in target if r[0] not in taken] + source
    assert rows(merge.replace_by_key(frame(spark, target), frame(spark, source), KEYS)) == listed(want)


def columns_by_hand(target, source):
    given_ = {k: (a, b) for k, a, b in source if is_key(k)}
    known = {k for k, *_ in target}
    want = [(k, given_[k][0] if k in given_ else a, b) for k, a, b in target]
    return want + [(k, None, b) for k, a, b in source if not (is_key(k) and k in known)]


@SLOW
@given(target=keyed_rows(True), source=keyed_rows(True), limit=st.sampled_from([LARGE, SMALL]))
def test_merge_columns_updates_and_inserts_different_columns(spark, target, source, limit):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    merged = merge.merge_columns(frame(spark, target), frame(spark, source), KEYS, update=["a"], insert=["b"])
    assert rows(merged) == listed(columns_by_hand(target, source))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


@SLOW
@given(target=keyed_rows(True), source=keyed_rows(False), limit=st.sampled_from([LARGE, SMALL]), insert=st.booleans())
def test_patches_apply_in_order(spark, target, source, limit, insert):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    state = {k: [a, b] for k, a, b in target if is_key(k)}
    want = [r for r in target if not is_key(r[0])]
    for k, a, b in source:
        if not is_key(k):
            want += [(k, a, b)] if insert else []
        elif k in state or insert:
            old = state.get(k, [None, None])
            state[k] = [old[0] if a is None else a, old[1] if b is None else b]
    want += [(k, a, b) for k, (a, b) in state.items()]
    ordered = spark.createDataFrame(
        [(*k, a, b, i) for i, (k, a, b) in enumerate(source)], SCHEMA + ", at int"
    )
    merged = merge.patch_items(frame(spark, target), ordered, KEYS, ["at"], insert=insert)
    assert rows(merged) == listed(want)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_merging_twice_changes_nothing(spark, path):
    target = frame(spark, [((1, 0), "x", 1), ((2, 0), "x", 1)])
    source = frame(spark, [((2, 0), "y", 2), ((3, 0), "y", 3)])
    once = merge.merge_columns(target, source, KEYS, ["a", "b"], ["a", "b"])
    assert rows(merge.merge_columns(once, source, KEYS, ["a", "b"], ["a", "b"])) == rows(once)
    assert once.count() == 3


def test_repeated_source_key_fails_by_default(spark, path):
    target = frame(spark, [((1, 0), "x", 1)])
    source = frame(spark, [((2, 0), "y", 2), ((2, 0), "z", 3)])
    for merged in (
        merge.merge_all(target, source, KEYS),
        merge.merge_columns(target, source, KEYS, ["a"], ["a"]),
        merge.patch_items(target, source, KEYS),
    ):
        with pytest.raises(Exception, match="several source rows"):
            merged.collect()


def test_repeated_null_keys_are_no_repeat(spark, path):
    source = frame(spark, [((None, 0), "y", 2), ((None, 0), "y", 2)])
    assert merge.merge_all(frame(spark, []), source, KEYS).count() == 2


def test_latest_row_wins(spark, path):
    source = frame(spark, [((2, 0), "old", 1), ((2, 0), "new", 5), ((None, 0), "n", 1), ((None, 0), "n", 1)])
    merged = merge.put_items(frame(spark, [((2, 0), "x", 9)]), source, KEYS, ["b"])
    assert rows(merged) == [(2, 0, "new", 5), (None, 0, "n", 1), (None, 0, "n", 1)]


def test_stamp_marks_updated_and_inserted_rows_only(spark, path):
    target = frame(spark, [((1, 0), "x", 1), ((2, 0), "x", 1)])
    source = frame(spark, [((2, 0), "y", 5), ((3, 0), "y", 5)])
    merged = merge.merge_columns(target, source, KEYS, ["a"], ["a"], stamp={"b": F.lit(99)})
    assert rows(merged) == [(1, 0, "x", 1), (2, 0, "y", 99), (3, 0, "y", 99)]


def test_patch_can_set_null_when_told_it_is_present(spark, path):
    target = frame(spark, [((1, 0), "x", 1)])
    source = frame(spark, [((1, 0), None, None)])
    merged = merge.patch_items(target, source, KEYS, present={"a": F.lit(True)})
    assert rows(merged) == [(1, 0, None, 1)]


def test_unknown_keys_are_reported_not_inserted(spark, path):
    target, source = frame(spark, [((1, 0), "x", 1)]), frame(spark, [((1, 0), "y", 2), ((7, 0), "y", 2)])
    assert rows(merge.patch_items(target, source, KEYS, insert=False)) == [(1, 0, "y", 2)]
    assert rows(merge.unmatched(source, target, KEYS)) == [(7, 0, "y", 2)]


def test_keys_must_be_a_list_of_known_columns(spark):
    df = frame(spark, [])
    for keys in ("k", [], ["nope"]):
        with pytest.raises(ValueError):
            merge.merge_all(df, df, keys)


def test_both_ways_to_merge_are_taken(spark, path):
    merged = merge.merge_columns(frame(spark, []), frame(spark, []), KEYS, ["a"], ["a"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert ("FullOuter" in plan) is (path == "shuffled")


def test_update_without_insert(spark, path):
    target = frame(spark, [((1, 0), "x", 1)])
    source = frame(spark, [((1, 0), "y", 2), ((3, 0), "y", 3), ((None, 0), "y", 3)])
    assert rows(merge.merge_columns(target, source, KEYS, ["a"], None)) == [(1, 0, "y", 1)]


def test_unmatched_of_a_small_frame_against_a_large_one(spark, tmp_path, settings):
    at = str(tmp_path / "large")
    spark.range(5000).select((F.col("id") % 50).cast("int").alias("k"), F.lit(0).alias("j"), F.lit("x").alias("a"),
                             F.lit(1).alias("b")).write.parquet(at)
    settings(autoBroadcastJoinThreshold="2000")
    large = spark.read.parquet(at)
    source = frame(spark, [((1, 0), "y", 2), ((70, 0), "y", 2), ((None, 0), "y", 2), ((70, None), "y", 2)])
    found = merge.unmatched(source, large, KEYS)
    assert rows(found) == [(70, 0, "y", 2), (70, None, "y", 2), (None, 0, "y", 2)]
    assert "LeftSemi" in found._jdf.queryExecution().executedPlan().toString()
