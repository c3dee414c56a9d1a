from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Frames made of local rows count as small.
        .config("spark.sql.defaultSizeInBytes", "1000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from tidemark.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**named):
        for key, value in named.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
