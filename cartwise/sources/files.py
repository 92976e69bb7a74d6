"""File connectors: CSV ingest (S1-S3), CSV sinks of the training table
(S6, S7) and row counts (S10)."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nan_to_null
from .schemas import RAW_TABLES, TRAIN_MASTER
from .versioned import replace_table

log = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the cluster's Hadoop file system (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a CSV with header and an explicit schema; empty fields and NaN become NULL."""
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    doubles = {f.name for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[nan_to_null(c).alias(c) if c in doubles else F.col(c) for c in df.columns])


def ingest_csv(spark: SparkSession, raw_dir: str, out_dir: str,
               tables: dict[str, T.StructType] = RAW_TABLES) -> dict[str, DataFrame]:
    """S1 + S2 + S3: load ``<raw_dir>/<name>.csv`` for each table into Parquet
    under ``<out_dir>/<name>``, replacing it as a whole (``versioned``).  A missing
    file is skipped with a warning.  Returns the written tables, read back."""
    out = {}
    for name, schema in tables.items():
        src = f"{raw_dir.rstrip('/')}/{name}.csv"
        if not path_exists(spark, src):
            log.warning("input %s not found, skipped", src)
            continue
        dst = f"{out_dir.rstrip('/')}/{name}"
        out[name] = replace_table(read_csv(spark, src, schema), dst)
    return out


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """CSV with header, replacing ``path``; one file per task (no single-writer funnel)."""
    w = df.write.mode("overwrite").option("header", True)
    (w.option("compression", compression) if compression else w).csv(path)


def write_master_csv(master: DataFrame, path: str) -> None:
    """The training table as CSV with header (hand-off to training)."""
    write_csv(master, path)


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the training table back with its explicit schema."""
    return read_csv(spark, path, TRAIN_MASTER)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, all counted in one job (union of global counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
