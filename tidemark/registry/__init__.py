"""All named queries."""

from . import files, kpis, relational, stars, streams  # noqa: F401
from .core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
