"""cartwise — repeat-purchase (reorder) analytics as Spark DataFrame plans.

Sub-packages
------------
sources    schemas, derivation of the retail tables, CSV/Parquet ingest and sinks
functions  column expressions and skew-safe building blocks
operators  features, training table, scoring, recommendation, evaluation, model, EDA
plans      the query registry used by ``__spark_entry__`` and its SQL oracle
streaming  request-driven scoring as a Structured Streaming query
"""

__version__ = "0.1.0"
