"""User, product and user×product behaviour features.

Every function is ``DataFrame(s) -> DataFrame`` and lazy.  Aggregations are
decomposable (count, sum, avg, max), so Spark combines them map-side before
the shuffle and a hot user or product costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hour_angle, ratio
from ..functions.skew import broadcast_bounded, top_k_per_group

RECENT_ORDERS = 3


def prior_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("eval_set") == "prior")


def enriched_prior(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """Prior lines with the user and the order's number (inner, N:1 on order_id)."""
    return prior.join(orders.select("order_id", "user_id", "order_number"), "order_id")


def user_basket(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """A1 + P6: per user, lines, distinct orders with lines, and their ratio.

    Lines are counted per order before the join, so the join and the user
    aggregate move one row per order instead of one per line; the distinct
    order count becomes a plain count of those order rows.
    """
    per_order = prior.groupBy("order_id").agg(F.count(F.lit(1)).alias("n_lines"))
    by_user = (per_order.join(orders.select("order_id", "user_id"), "order_id")
               .groupBy("user_id")
               .agg(F.sum("n_lines").cast("long").alias("total_items"),
                    F.count(F.lit(1)).alias("total_orders")))
    return by_user.withColumn("user_avg_basket_size", ratio("total_items", "total_orders"))


def user_order_stats(orders: DataFrame) -> DataFrame:
    """A2: per user over prior orders — max order number and three means."""
    return (prior_orders(orders).where(F.col("user_id").isNotNull())
            .groupBy("user_id")
            .agg(F.max("order_number").alias("user_total_orders"),
                 F.avg("days_since_prior_order").alias("user_avg_days_between"),
                 F.avg("order_hour_of_day").alias("user_avg_hour"),
                 F.avg("order_dow").alias("user_avg_dow")))


def last_k_orders(orders: DataFrame, k: int = RECENT_ORDERS) -> DataFrame:
    """Each user's last ``k`` prior orders by order number (rn 1 = latest)."""
    src = (prior_orders(orders).where(F.col("user_id").isNotNull())
           .select("user_id", "order_id", "order_number", "days_since_prior_order"))
    return top_k_per_group(src, "user_id", [F.desc("order_number"), F.desc("order_id")], k, "recent_rank")


def user_recent_trend(orders: DataFrame, k: int = RECENT_ORDERS, name: str = "user_recent_avg_days") -> DataFrame:
    """A3: mean gap over the user's last ``k`` prior orders (missing gaps skipped)."""
    return (last_k_orders(orders, k).groupBy("user_id")
            .agg(F.avg("days_since_prior_order").alias(name)))


def user_features(orders: DataFrame, prior: DataFrame) -> DataFrame:
    """user_features = A2 ⟕ A1 ⟕ A3 (J8), missing values filled with 0 (P10).

    All three inputs are aggregates hash-partitioned on ``user_id``; the two
    left joins reuse that partitioning.
    """
    general = user_order_stats(orders)
    basket = user_basket(orders, prior).select("user_id", "user_avg_basket_size")
    recent = user_recent_trend(orders)
    values = ["user_total_orders", "user_avg_days_between", "user_avg_hour",
              "user_avg_dow", "user_avg_basket_size", "user_recent_avg_days"]
    out = (general.join(basket, "user_id", "left").join(recent, "user_id", "left")
           .select("user_id", *values))
    # Fill the value columns only: rewriting user_id would drop its hash
    # partitioning and force another shuffle before the next user_id join.
    return out.na.fill(0, subset=values)


def product_features(prior: DataFrame, products: DataFrame) -> DataFrame:
    """J2 + A4 + A6: per product line count, reorder rate, mean cart position.

    Same result as "join lines to products, then group by product": lines are
    aggregated per product first (map-side partials), then joined to the
    catalogue, itself grouped per product id.  A duplicated catalogue row
    multiplies the count exactly as the join would; means are unchanged.
    """
    per_product = (prior.groupBy("product_id")
                   .agg(F.count(F.lit(1)).alias("n_lines"),
                        F.avg("reordered").alias("prod_reorder_rate"),
                        F.avg("add_to_cart_order").alias("prod_avg_position")))
    catalogue = (products.groupBy("product_id")
                 .agg(F.count(F.lit(1)).alias("n_dup"),
                      F.max("aisle_id").alias("aisle_id"),
                      F.max("department_id").alias("department_id")))
    # the grouped catalogue has at most one row per catalogue row
    return (per_product.join(broadcast_bounded(catalogue, products), "product_id")
            .select("product_id", "aisle_id", "department_id",
                    (F.col("n_lines") * F.col("n_dup")).alias("prod_total_orders"),
                    "prod_reorder_rate", "prod_avg_position"))


def uxp_features(orders: DataFrame, prior: DataFrame, deal: int | None = None) -> DataFrame:
    """A5: per (user, product) purchases, reorder ratio, last order number, mean position.

    ``deal``: deal the lines by user into so many partitions before they are
    grouped (no user is hot); the result keeps that partitioning."""
    lines = enriched_prior(orders, prior)
    if deal:
        lines = lines.select("user_id", "product_id", "reordered", "order_number", "add_to_cart_order").repartition(deal, "user_id")
    return (lines
            .groupBy("user_id", "product_id")
            .agg(F.count(F.lit(1)).alias("uxp_total_bought"),
                 F.avg("reordered").alias("uxp_reorder_ratio"),
                 F.max("order_number").alias("uxp_last_order_number"),
                 F.avg("add_to_cart_order").alias("uxp_avg_position")))


# ---- features described in prose only (D1-D3) ---------------------------------

def cyclical_hour(orders: DataFrame, hour: str | Column = "order_hour_of_day") -> DataFrame:
    """Hour of day on the unit circle (sin, cos of 2πh/24)."""
    ang = hour_angle(hour)
    return orders.select("order_id", "user_id", "order_hour_of_day",
                         F.sin(ang).alias("hour_sin"), F.cos(ang).alias("hour_cos"))


def user_dept_share(uxp: DataFrame, products: DataFrame) -> DataFrame:
    """Share of a user's prior lines that fall in each department.

    The lines are already counted per (user, product) in ``uxp_features``, so
    only those counts meet the catalogue.  The per-user total is a window over
    the aggregated (user, department) rows — at most one row per department
    per user.
    """
    from pyspark.sql import Window
    dept = broadcast_bounded(products.select("product_id", "department_id"), products)
    per_dept = (uxp.select("user_id", "product_id", "uxp_total_bought").join(dept, "product_id")
                .groupBy("user_id", "department_id").agg(F.sum("uxp_total_bought").alias("dept_lines")))
    total = F.sum("dept_lines").over(Window.partitionBy("user_id"))
    return per_dept.withColumn("dept_share", F.col("dept_lines") / total)


def candidate_dept_share(candidates: DataFrame, share: DataFrame, products: DataFrame) -> DataFrame:
    """D2 at candidate level: for each (user, product) candidate, the share of
    the user's prior lines that fall in the product's department (0 when the
    user never bought in it or the product is unknown).

    Both joins are equi-joins on bounded or composite keys: the catalogue is
    broadcast behind a size check, the share table joins on (user, department).
    """
    dept = broadcast_bounded(products.select("product_id", "department_id"), products)
    c = candidates.select("user_id", "product_id").join(dept, "product_id", "left")
    return (c.join(share.select("user_id", "department_id", "dept_share"), ["user_id", "department_id"], "left")
            .select("user_id", "product_id", "department_id",
                    F.coalesce(F.col("dept_share"), F.lit(0.0)).alias("uxd_dept_share")))


def user_trend_k(orders: DataFrame, ks: tuple[int, ...] = (3, 5, 10)) -> DataFrame:
    """D3: recent mean gap over the last k prior orders for several k.

    One window for the largest k; smaller k are conditional means on the rank.
    """
    kmax = max(ks)
    ranked = last_k_orders(orders, kmax)
    aggs = [F.avg(F.when(F.col("recent_rank") <= k, F.col("days_since_prior_order"))).alias(f"recent_avg_days_{k}")
            for k in ks]
    return ranked.groupBy("user_id").agg(*aggs).na.fill(0, subset=[f"recent_avg_days_{k}" for k in ks])
