"""Every named query against its SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from conftest import SF_DIR
from tidemark.registry import ORACLES, QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def plain(frame: pd.DataFrame) -> list[tuple]:
    def value(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        return v.item() if hasattr(v, "item") else v

    listed = [tuple(value(v) for v in r) for r in frame[sorted(frame.columns)].itertuples(index=False, name=None)]
    return sorted(listed, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
    assert len(got) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_has_a_stable_schema(spark):
    first, second = entry_points.entry(spark), entry_points.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
