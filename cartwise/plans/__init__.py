"""Query registry (Spark) and its independent SQL oracle (DuckDB dialect)."""

from .registry import QUERIES
from .oracle import oracle_sql

__all__ = ["QUERIES", "oracle_sql"]
