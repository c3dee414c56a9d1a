"""tidemark: batch and streaming data flows written as Spark DataFrame jobs."""

__version__ = "0.1.0"
