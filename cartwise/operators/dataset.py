"""Labelled training table: candidate generation, feature joins, label.

Candidates are the products a user bought before (J3), so the table grows
with the user×product history, never with users × catalogue.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import FEATURES, validation_flag
from ..functions.selection import kth_smallest
from ..functions.skew import broadcast_bounded, sized_broadcast

ID_COLS = ["user_id", "product_id"]
LABEL = "reordered"


def label_orders(orders: DataFrame, eval_set: str = "train") -> DataFrame:
    return (orders.where(F.col("eval_set") == eval_set)
            .select("order_id", "user_id", "order_number", "order_hour_of_day", "order_dow"))


def _to_user_buckets(df: DataFrame, buckets: int | None) -> DataFrame:
    """``df`` dealt by user_id into as many partitions as the bucketed side has,
    so that a join leaves that side in place whatever
    ``spark.sql.shuffle.partitions`` is."""
    return df.repartition(buckets, "user_id") if buckets else df


def candidates(orders: DataFrame, uxp: DataFrame, eval_set: str = "train", buckets: int | None = None) -> DataFrame:
    """Every (label order, product the user bought before).  ``buckets``:
    the bucket count of ``uxp`` if it is bucketed on user_id."""
    return _to_user_buckets(label_orders(orders, eval_set), buckets).join(uxp, "user_id")


def label_join(cands: DataFrame, label_lines: DataFrame, orders: DataFrame, buckets: int | None = None) -> DataFrame:
    """J6 + P9: 1 when the product is in the label order with reordered = 1, else 0.

    The reordered label lines find their user through the orders (read from the
    same buckets) and become one row per user: the (order, product) pairs
    bought again, at most the user's label baskets.  Joined on user_id, only
    that small side moves; candidates stay in their user buckets.
    """
    pairs = (label_lines.where(F.col("reordered") == 1).select("order_id", "product_id")
             .join(orders.select("order_id", "user_id"), "order_id"))
    again = (_to_user_buckets(pairs, buckets).groupBy("user_id")
             .agg(F.collect_set(F.struct("order_id", "product_id")).alias("bought_again")))
    hit = F.array_contains("bought_again", F.struct("order_id", "product_id"))
    return (cands.join(again, "user_id", "left")
            .withColumn(LABEL, F.coalesce(hit, F.lit(False)).cast("int")).drop("bought_again"))


def train_master(orders: DataFrame, uxp: DataFrame, user_feats: DataFrame, prod_feats: DataFrame,
                 label_lines: DataFrame, eval_set: str = "train",
                 catalogue: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """Candidates ⟕ user features ⟕ product features ⟕ label lines, NULL -> 0.

    Left joins keep candidates whose user or product has no features (their
    features become 0).  Product features are catalogue-sized and broadcast
    behind a row-count check; user features share the candidates' user_id
    partitioning.  ``catalogue`` (the products table) bounds the product
    features' row count; without it the features themselves are counted.
    ``buckets``: the count of ``uxp`` and ``user_feats`` if both are bucketed on
    user_id.
    """
    c = candidates(orders, uxp, eval_set, buckets)
    c = c.join(user_feats, "user_id", "left")
    pf = broadcast_bounded(prod_feats, catalogue) if catalogue is not None else sized_broadcast(prod_feats)
    c = c.join(pf, "product_id", "left")
    c = label_join(c, label_lines, orders, buckets)
    c = c.withColumn("orders_since_last_bought",
                     (F.col("order_number") - F.col("uxp_last_order_number")).cast("int"))
    return c.select(*ID_COLS, *FEATURES, LABEL).na.fill(0)


def with_split(master: DataFrame) -> DataFrame:
    """M2: 80/20 split by a digest of the key (stable under any partitioning)."""
    return master.withColumn("is_validation", validation_flag())


def exact_split(master: DataFrame, share: float = 0.2, user: str = "user_id", product: str = "product_id") -> DataFrame:
    """M2 to the row: ``ceil(share * rows)`` validation rows, those whose key digest
    comes first, under any partitioning.

    The digest (52 bits) that ends the held-out part is found by refining range
    counts; rows that share it are taken by user, then product (only these are
    ordered)."""
    key = F.concat(F.col(user).cast("string"), F.lit("|"), F.col(product).cast("string"))
    digest = F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double")
    wanted = math.ceil(share * master.count() - 1e-9)
    found = kth_smallest(master, digest, wanted)
    if found is None:
        return master.withColumn("is_validation", F.lit(False))
    last, below, equal = found
    if below + equal == wanted:
        return master.withColumn("is_validation", F.coalesce(digest <= F.lit(last), F.lit(False)))
    tied = (master.where(digest == F.lit(last)).select(F.col(user).alias("_u"), F.col(product).alias("_p"))
            .orderBy("_u", "_p").limit(wanted - below).withColumn("_in", F.lit(True)))
    marked = master.join(tied, (F.col(user) == F.col("_u")) & (F.col(product) == F.col("_p")), "left")
    flag = F.coalesce((digest < F.lit(last)) | F.col("_in"), F.lit(False))
    return marked.withColumn("is_validation", flag).drop("_u", "_p", "_in")


def split_counts(master: DataFrame, split=with_split) -> DataFrame:
    """Rows and positives per split."""
    return (split(master)
            .groupBy(F.when(F.col("is_validation"), F.lit("validation")).otherwise(F.lit("train")).alias("split"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum(LABEL).cast("long").alias("n_positive")))


def feature_matrix(master: DataFrame, features: list[str] = FEATURES, label: str = LABEL,
                   output: str = "features") -> DataFrame:
    """M1 + P4 + P5: ids, the fixed-order feature vector and a double label."""
    from pyspark.ml.feature import VectorAssembler
    cast = master.select(*ID_COLS, *[F.col(f).cast("double").alias(f) for f in features],
                         F.col(label).cast("double").alias("label"))
    assembled = VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="keep").transform(cast)
    return assembled.select(*ID_COLS, output, "label")
