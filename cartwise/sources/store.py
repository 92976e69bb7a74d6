"""Feature tables written once and read by scoring, training and evaluation.

``uxp_features`` and ``user_features`` are bucketed on ``user_id`` with the
same bucket count, so the user joins of candidate generation and scoring
(uxp ⋈ user features) and the per-user ranking windows read co-partitioned
files without a shuffle of the large user×product table.  Product features
are catalogue-sized and broadcast where used.  The training table is written
plainly for the model.

The tables are external (files under the session's shared checkpoint folder)
and registered in the session catalogue, which carries the bucket metadata.
"""

from __future__ import annotations

import threading
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import dataset as D
from ..operators import features as FT
from ..session import scratch_path
from .derive import RetailTables
from .tables import bucket_count_for

_lock = threading.Lock()
_memo: dict[tuple, "FeatureStore"] = {}


@dataclass
class FeatureStore:
    user_features: DataFrame
    product_features: DataFrame
    uxp_features: DataFrame
    train_master: DataFrame
    row_counts: dict = field(default_factory=dict)  # observed while writing
    buckets: int = 0                                # of the user-keyed tables; 0: not bucketed


def _save(df: DataFrame, name: str, path: str, bucket_by: str | None = None, sort_by: list[str] | None = None,
          buckets: int = 0, counts: dict | None = None, count_as: str | None = None, dealt: bool = False) -> DataFrame:
    """Write ``df`` as an external table; its row count is observed during the
    write itself (no second pass) and stored in ``counts[count_as]``.  ``dealt``:
    its partitions are the buckets already."""
    obs = Observation(f"rows_{name}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if bucket_by and buckets and not dealt:
        # one task per bucket, so each bucket is one file (not tasks x buckets);
        # done after the aggregation, so a hot user brings at most a
        # catalogue's worth of rows
        observed = observed.repartition(buckets, bucket_by)
    w = observed.write.mode("overwrite").format("parquet").option("path", path)
    if bucket_by and buckets:
        w = w.bucketBy(buckets, bucket_by).sortBy(*(sort_by or [bucket_by]))
    w.saveAsTable(name)
    if counts is not None:
        counts[count_as or name] = int(obs.get["rows"])
    return df.sparkSession.table(name)


def write_user_features(spark: SparkSession, r: RetailTables, prefix: str, base: str, buckets: int,
                        counts: dict | None = None) -> DataFrame:
    return _save(FT.user_features(r.orders, r.prior), f"{prefix}_user_features", f"{base}/user_features",
                 "user_id", ["user_id"], buckets, counts, "user_features")


def write_uxp_features(spark: SparkSession, r: RetailTables, prefix: str, base: str, buckets: int,
                       counts: dict | None = None) -> DataFrame:
    # without a hot user the lines move to their user's bucket once
    deal = buckets if r.hot_user is False else 0
    return _save(FT.uxp_features(r.orders, r.prior, deal), f"{prefix}_uxp_features", f"{base}/uxp_features",
                 "user_id", ["user_id", "product_id"], buckets, counts, "uxp_features", dealt=bool(deal))


def write_product_features(spark: SparkSession, r: RetailTables, prefix: str, base: str,
                           counts: dict | None = None) -> DataFrame:
    return _save(FT.product_features(r.prior, r.products), f"{prefix}_product_features",
                 f"{base}/product_features", counts=counts, count_as="product_features")


def write_train_master(spark: SparkSession, r: RetailTables, uxp: DataFrame, uf: DataFrame, pf: DataFrame,
                       prefix: str, base: str, buckets: int, counts: dict | None = None) -> DataFrame:
    master = D.train_master(r.orders, uxp, uf, pf, r.train, catalogue=r.products, buckets=buckets)
    return _save(master, f"{prefix}_train_master", f"{base}/train_master", counts=counts,
                 count_as="train_master")


def write_scored(scored: DataFrame, prefix: str, base: str, buckets: int) -> DataFrame:
    """Candidates with their probability, written once and by user, so that the
    lists made of them neither score again nor move a row."""
    return _save(scored, f"{prefix}_scored", f"{base}/scored", "user_id", ["user_id"], buckets)


def bucket_count(spark: SparkSession, r: RetailTables) -> int:
    """Buckets of the user-keyed tables: the prior lines (observed while
    writing) bound the user×product rows."""
    return bucket_count_for(spark, r.row_counts.get("order_products__prior"))


def build_feature_store(spark: SparkSession, r: RetailTables, token: str, buckets: int | None = None,
                        timings: dict | None = None) -> FeatureStore:
    """Write the three feature tables and the training table (once per session
    and token).  ``timings`` receives the seconds of each write."""
    key = (spark.sparkContext.applicationId, token)
    with _lock:
        if key not in _memo:
            n = bucket_count(spark, r) if buckets is None else buckets
            prefix, base = f"cw_{token}", scratch_path(spark, "features", token)
            clock = timings if timings is not None else {}

            def step(name, fn):
                t = time.time()
                out = fn()
                clock[name] = round(time.time() - t, 3)
                return out

            counts: dict = {}
            uxp = step("uxp_features", lambda: write_uxp_features(spark, r, prefix, base, n, counts))
            uf = step("user_features", lambda: write_user_features(spark, r, prefix, base, n, counts))
            pf = step("product_features", lambda: write_product_features(spark, r, prefix, base, counts))
            master = step("train_master", lambda: write_train_master(spark, r, uxp, uf, pf, prefix, base, n, counts))
            _memo[key] = FeatureStore(uf, pf, uxp, master, counts, n)
        return _memo[key]
