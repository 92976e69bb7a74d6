"""Skew-safe building blocks.

Every per-key operation here is written so that one key holding a large share
of all rows (a wholesale customer, a best-selling product) is spread over many
tasks instead of landing in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

import contextlib
import contextvars
import uuid

from ..session import scratch_path

# Upper bounds for a side we are willing to ship to every executor.  A retail
# catalogue (tens of thousands of products) fits; anything keyed by user or
# order does not and is left to a shuffle join (AQE may still turn it into a
# broadcast at run time when the materialised side is small).
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20
# A key with more rows than this is not gathered in one task.
HOT_ROWS = 1_000_000


# Tables that cannot change for the rest of the session (written once by the
# loader or the feature store), keyed by (application, semantic plan hash).
# Size checks against them are computed once per session.
_stable: set[tuple] = set()
_checked: dict[tuple, bool] = {}


def _key(df: DataFrame) -> tuple:
    return (df.sparkSession.sparkContext.applicationId, df.semanticHash())


def mark_stable(df: DataFrame) -> DataFrame:
    """Declare ``df`` unchanging for this session (a table written once)."""
    _stable.add(_key(df))
    return df


def _fits(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and, written as JSON, at
    most ``max_bytes`` bytes (reads at most max_rows + 1 rows)."""
    key = _key(df)
    if key in _stable and (key, max_rows, max_bytes) in _checked:
        return _checked[(key, max_rows, max_bytes)]
    size = (df.limit(max_rows + 1)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("b")).first())
    ok = size["n"] <= max_rows and (size["b"] or 0) <= max_bytes
    if key in _stable:
        _checked[(key, max_rows, max_bytes)] = ok
    return ok


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows.  Beyond the bound the
    DataFrame is returned unchanged and the planner picks a shuffle join.
    """
    return F.broadcast(df) if _fits(df, max_rows) else df


def broadcast_bounded(df: DataFrame, bound: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when a cheaper table that bounds its row count is small.

    For a result with at most one row per row of ``bound`` (e.g. product
    features, at most one row per catalogue product), checking ``bound``
    proves the size without computing ``df`` twice.
    """
    return F.broadcast(df) if _fits(bound, max_rows) else df


# The innermost lineage scope of the running thread (or task of an event loop).
_scope: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("lineage_scope", default=None)


@contextlib.contextmanager
def lineage_scope(spark):
    """Collect the folders written by ``cut_lineage`` inside the block and
    delete them when it ends.  Use it around work whose results are written
    elsewhere before the block ends (nothing may still read the copies)."""
    paths: list[str] = []
    outer = _scope.set(paths)
    try:
        yield paths
    finally:
        _scope.reset(outer)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            hp = jvm.org.apache.hadoop.fs.Path(p)
            hp.getFileSystem(conf).delete(hp, True)


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Materialise ``df`` as Parquet in the session's shared checkpoint folder
    and return a DataFrame reading it back.

    Used where later steps depend on values that must not change if a lost
    executor forces a recomputation (partition ids, generated positions).
    A written table is columnar and compressed, much cheaper than an RDD
    checkpoint of rows.
    """
    path = scratch_path(df.sparkSession, "lineage", f"{label}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    if (paths := _scope.get()) is not None:
        paths.append(path)
    return df.sparkSession.read.parquet(path)


def sequence_number(df: DataFrame, key: str, order_by: list[str], name: str,
                    partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1, 2, 3, ... within each ``key`` following ``order_by``.

    Same result as ``row_number() OVER (PARTITION BY key ORDER BY order_by)``
    when ``(key, *order_by)`` is unique, but a hot key does not end up in one
    task: rows are range-partitioned on the full sort key, so a key with many
    rows spans several partitions.  Each partition numbers its run of the key
    locally (generated positions are contiguous after the local sort); the
    per-(partition, key) run lengths — at most one row per partition for any
    key — give each run its starting offset.
    """
    sort_key = [key, *order_by]
    # Without an explicit count AQE sizes the range shuffle by bytes; it only
    # merges adjacent ranges, and partition ids are read after the exchange.
    ranged = df.repartitionByRange(partitions, *sort_key) if partitions else df.repartitionByRange(*sort_key)
    ranged = cut_lineage(
        ranged
        .sortWithinPartitions(*sort_key)
        .withColumn("_sq_part", F.spark_partition_id())
        .withColumn("_sq_pos", F.monotonically_increasing_id()),
        label=f"seq-{name}")
    runs = (ranged.groupBy("_sq_part", key)
            .agg(F.min("_sq_pos").alias("_sq_first"), F.count(F.lit(1)).alias("_sq_len")))
    earlier = Window.partitionBy(key).orderBy("_sq_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (runs.withColumn("_sq_before", F.coalesce(F.sum("_sq_len").over(earlier), F.lit(0)))
            .select(F.col("_sq_part").alias("_sq_rpart"), F.col(key).alias("_sq_rkey"),
                    "_sq_first", "_sq_before"))
    joined = ranged.join(runs, (ranged["_sq_part"] == runs["_sq_rpart"])
                         & ranged[key].eqNullSafe(runs["_sq_rkey"]))
    seq = (F.col("_sq_pos") - F.col("_sq_first") + F.col("_sq_before") + 1).cast("int")
    return (joined.withColumn(name, seq)
            .drop("_sq_part", "_sq_pos", "_sq_rpart", "_sq_rkey", "_sq_first", "_sq_before"))


def has_hot_key(df: DataFrame, key: str, rows: int | None = None) -> bool:
    """True when one ``key`` has more than ``rows`` rows (default HOT_ROWS).

    A table of at most that many rows has none, which its row count (Parquet
    metadata) tells.  Otherwise keys are first counted by groups of their hash, a
    map-side combined aggregate of a few rows a task: a hot key makes its group
    hot, so only the keys of hot groups (none, as a rule) are counted one by one.
    One number reaches the driver.
    """
    bound = HOT_ROWS if rows is None else rows
    total = df.count()
    if total <= bound:
        return False
    group = F.pmod(F.xxhash64(key), F.lit(16 * (total // (bound + 1) + 1)))
    sizes = df.groupBy(group.alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    hot = [r["_g"] for r in sizes.where(F.col("_n") > bound).collect()]        # fewer than total / bound
    if not hot:
        return False
    biggest = (df.where(group.isin(hot)).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
               .agg(F.max("_n").alias("biggest")).first()["biggest"])
    return biggest is not None and biggest > bound


def adaptive_sequence_number(df: DataFrame, key: str, order_by: list[str], name: str,
                             probe: DataFrame | None = None) -> DataFrame:
    """``sequence_number`` when some key is hot, else the plain window.

    Without a hot key every ``key`` group has at most HOT_ROWS rows, so ``row_number() OVER (PARTITION BY key)`` (one shuffle) is
    safe; with one, the range-partitioned numbering spreads it over tasks.
    Both give the same numbers.  ``probe`` (a cheaper frame with a ``key``
    column whose per-key counts bound those of ``df``, e.g. raw lines before
    de-duplication) is checked instead of ``df`` when given.
    """
    if has_hot_key(probe if probe is not None else df, key):
        return sequence_number(df, key, order_by, name)
    return window_number(df, key, order_by, name)


def window_number(df: DataFrame, key: str, order_by: list[str], name: str) -> DataFrame:
    """The numbering by a plain window, for keys known not to be hot."""
    w = Window.partitionBy(key).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(w).cast("int"))


def top_k_per_group(df: DataFrame, key: str | list[str], order: list[Column], k: int,
                    rank_name: str = "rn") -> DataFrame:
    """Rows ranked ``1..k`` within each group.

    ``row_number() <= k`` with a literal ``k`` lets Catalyst put a partial
    ``WindowGroupLimit`` before the shuffle, so every map task forwards at most
    ``k`` rows per key and a hot key costs ``k × tasks`` rows, not its size.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= k)
