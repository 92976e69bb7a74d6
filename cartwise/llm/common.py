"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.skew import cut_lineage

# ASCII white space: space, tab, line feed, vertical tab, form feed, return.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    return cut_lineage(df, label=f"llm-{label}")


def held_out(doc_id: str = "doc_id") -> Column:
    """True when crc32 of the id's decimal text leaves remainder 1 modulo 3."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % 3 == 1, F.lit(False))


def trim() -> None:
    """Give memory that earlier tasks of a reused Python worker have freed back
    to the system (workers keep it otherwise, and executors hold several).
    What a worker holds at its first call (the imported libraries, which take
    0.05 s to search) is set aside, so that later calls look at new objects only."""
    import ctypes
    import gc

    import pyarrow
    if not gc.get_freeze_count():
        gc.freeze()
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:          # not glibc
        pass


def tidied(run):
    """``run`` (a mapInArrow function) with memory given back before and after, so
    that a worker waiting for its next task holds little."""
    def tidy(batches):
        trim()
        yield from run(batches)
        trim()
    return tidy


def spare(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
