"""From raw documents to packed training sequences.

Each stage takes the documents its predecessor kept and returns those it
keeps, with the columns of ``documents``; the last returns packed pieces.
Between stages the rows are written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.decontaminate import keep_clean
from tidemark.llm.line_dedup import drop_shared_lines
from tidemark.llm.packing import pack
from tidemark.llm.quality import keep_quality
from tidemark.llm.queries import tokenizer_path
from tidemark.llm.simhash import keep_one
from tidemark.operators.staging import staged
from tidemark.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the counts or lie outside the compression bands go."""
    configure(spark)
    return keep_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents share stay in one of them only."""
    configure(spark)
    left = drop_shared_lines(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return left.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    configure(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    configure(spark)
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences."""
    configure(spark)
    return pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Compression ratios, latent search and tokenizers cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
