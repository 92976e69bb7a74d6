"""Materialised retail tables.

The derivation is an ETL step: it runs once per session and source folder,
writes Parquet under the session's shared checkpoint folder, and every query
reads the written tables back (column pruning, predicate pushdown and
partition pruning on ``eval_set`` apply).  This is also the lineage cut: a
lost executor later recomputes from these files, not from the raw tables.
"""

from __future__ import annotations

import hashlib
import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.skew import has_hot_key, lineage_scope, mark_stable
from ..session import scratch_path
from .derive import (LINE_COLS, RetailTables, derive_lines, derive_orders, derive_products, derive_retail,
                     read_source, split_lines, user_orders)

_lock = threading.Lock()
_memo: dict[tuple, RetailTables] = {}

ORDER_COLS = ["order_id", "user_id", "eval_set", "order_number", "order_dow",
              "order_hour_of_day", "days_since_prior_order"]


def source_state(spark: SparkSession, sf_dir: str, tables=("orders", "lineitem", "part")) -> str:
    """Names, sizes and times of the source files, through the cluster's file
    system: changed files make a new state."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    seen = []
    for name in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for f in path.getFileSystem(conf).listStatus(path):
            seen.append(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return "|".join(sorted(seen))


def _token(spark: SparkSession, sf_dir: str, what: str) -> str:
    """Names the tables of one application, source state and purpose, so that
    applications that share a catalogue or folder keep apart."""
    key = "|".join((spark.sparkContext.applicationId, sf_dir.rstrip("/"), source_state(spark, sf_dir), what))
    return hashlib.sha1(key.encode()).hexdigest()[:12]


# Target rows per bucket of the bucketed tables (about 25 MB of Parquet).  A task
# aggregates or sorts one bucket, so this bounds its memory.
ROWS_PER_BUCKET = 1_000_000


def bucket_count_for(spark: SparkSession, rows: int | None) -> int:
    """Buckets sized by the data: about ``ROWS_PER_BUCKET`` rows each, at least
    the cluster's parallelism.  Beyond the number of buckets Spark allows the
    answer is 0: written without buckets, joined by a shuffle.  Bucketed scans
    are not coalesced by AQE, so a count far above the data's needs costs empty
    tasks on every read."""
    if rows is None:
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(spark.sparkContext.defaultParallelism, -(-int(rows) // ROWS_PER_BUCKET))
    return wanted if wanted <= int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")) else 0


@dataclass
class Layout:
    """Where and how the retail tables are written: external tables under
    ``base``, named ``<prefix>_<table>``, orders and order lines bucketed on
    order_id with ``buckets`` buckets (and partitioned by split)."""
    base: str
    prefix: str
    buckets: int


def materialize(spark: SparkSession, tables: RetailTables, base: str, prefix: str = "cw_materialized",
                buckets: int | None = None) -> RetailTables:
    """Write ``tables`` under ``base`` and return DataFrames reading them."""
    lay = Layout(base, prefix, bucket_count_for(spark, None) if buckets is None else buckets)
    counts: dict = {}
    _write_orders(spark, tables.orders, lay, counts)
    all_lines = (tables.prior.withColumn("eval_set", F.lit("prior"))
                 .unionByName(tables.train.withColumn("eval_set", F.lit("train"))))
    if tables.test is not None:
        all_lines = all_lines.unionByName(tables.test.withColumn("eval_set", F.lit("test")))
    return _write_rest(spark, lay, all_lines, tables.products, tables.aisles, tables.departments, counts)


def _observed(df: DataFrame, name: str, aggs: list) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, *aggs), obs


def _save_by_order(spark: SparkSession, df: DataFrame, lay: Layout, name: str) -> DataFrame:
    """External table bucketed on order_id and partitioned by eval_set.

    Rows are first hash-partitioned into the buckets, so each task writes one
    file per (split, bucket).  A bucket never holds a skewed key: orders have
    one row per id and lines one row per (order, product), so an order brings
    at most a catalogue's worth of rows.  Later joins on order_id (lines ⋈
    orders) read co-partitioned files and shuffle neither side.
    """
    if lay.buckets:
        df = df.repartition(lay.buckets, "order_id")
    w = df.write.mode("overwrite").format("parquet").option("path", f"{lay.base}/{name}").partitionBy("eval_set")
    if lay.buckets:
        w = w.bucketBy(lay.buckets, "order_id").sortBy("order_id")
    w.saveAsTable(f"{lay.prefix}_{name}")
    return spark.table(f"{lay.prefix}_{name}")


def _write_orders(spark: SparkSession, orders: DataFrame, lay: Layout, counts: dict | None = None) -> DataFrame:
    """Write the orders; the row count is observed during the write, not by a
    second pass."""
    out, obs = _observed(orders, "rows_orders", [F.count(F.lit(1)).alias("orders")])
    written = _save_by_order(spark, out, lay, "orders")
    if counts is not None:
        counts.update({k: int(v) for k, v in obs.get.items()})
    return written.select(*ORDER_COLS)


def _write_rest(spark: SparkSession, lay: Layout, lines: DataFrame, products: DataFrame,
                aisles: DataFrame, departments: DataFrame, counts: dict | None = None) -> RetailTables:
    counts = {} if counts is None else counts
    split = lambda name: F.sum(F.when(F.col("eval_set") == name, 1).otherwise(0)).cast("long")
    out, obs = _observed(lines, "rows_lines", [split("prior").alias("order_products__prior"),
                                               split("train").alias("order_products__train"),
                                               split("test").alias("order_products__test")])
    lines_back = _save_by_order(spark, out, lay, "order_lines")
    counts.update({k: int(v) for k, v in obs.get.items()})
    for name, df in (("products", products), ("aisles", aisles), ("departments", departments)):
        out, obs = _observed(df, f"rows_{name}", [F.count(F.lit(1)).alias(name)])
        out.write.mode("overwrite").parquet(f"{lay.base}/{name}")
        counts.update({k: int(v) for k, v in obs.get.items()})
    return RetailTables(
        orders=spark.table(f"{lay.prefix}_orders").select(*ORDER_COLS),
        **split_lines(lines_back),
        # written once for this session: size checks against it are reused
        products=mark_stable(spark.read.parquet(f"{lay.base}/products")),
        aisles=spark.read.parquet(f"{lay.base}/aisles"),
        departments=spark.read.parquet(f"{lay.base}/departments"),
        row_counts=counts,
    )


def load_retail(spark: SparkSession, sf_dir: str, grain: str = "group") -> RetailTables:
    """Retail tables for ``sf_dir``, derived and written once per session and
    state of the source files.

    Orders are written first and the lines are derived from the written
    orders, so the per-user numbering is computed exactly once.  The bucket
    count follows the raw line count (read from Parquet metadata).
    """
    with _lock:
        token = _token(spark, sf_dir, grain)
        key = (spark.sparkContext.applicationId, token)
        if key not in _memo:
            raw_orders, raw_lines, raw_part = (read_source(spark, sf_dir, t) for t in ("orders", "lineitem", "part"))
            lay = Layout(scratch_path(spark, "retail", token), f"cw_{token}",
                         bucket_count_for(spark, raw_lines.count()))
            counts: dict = {}
            hot_user = has_hot_key(user_orders(raw_orders), "user_id")
            # the numbering's intermediate copies are deleted once both tables are written
            with lineage_scope(spark):
                orders = _write_orders(spark, derive_orders(raw_orders, hot_user), lay, counts)
                part = derive_products(raw_part, grain)
                lines = derive_lines(raw_lines, orders, raw_part, grain, hot_user, lay.buckets)
                _memo[key] = _write_rest(
                    spark, lay, lines,
                    part.select("product_id", "product_name", "aisle_id", "department_id"),
                    part.select("aisle_id", F.col("p_brand").alias("aisle")).distinct(),
                    part.select("department_id", F.col("p_type").alias("department")).distinct(),
                    counts)
                _memo[key].hot_user = hot_user
        return _memo[key]


def register_views(spark: SparkSession, tables: RetailTables, extra: dict[str, DataFrame] | None = None,
                   prefix: str = "cartwise_") -> list[str]:
    """Expose the tables to ``spark.sql`` as ``<prefix><table>``, so that a
    caller's own views keep their meaning.  Returns the names."""
    names = []
    for name, df in {**tables.as_dict(), **(extra or {})}.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names


def release(spark: SparkSession) -> None:
    """Drop the catalogue entries this application made (the files go with the
    checkpoint folder) and forget the tables read from them."""
    app = spark.sparkContext.applicationId
    for t in spark.catalog.listTables():
        if t.name.startswith("cw_"):
            spark.sql(f"DROP TABLE IF EXISTS `{t.name}`")
    for key in [k for k in _memo if k[0] == app]:
        del _memo[key]


__all__ = ["load_retail", "materialize", "register_views", "derive_retail"]
