"""Ad-hoc look-ups.

``run_sql`` is the notebook's query helper: SQL over DataFrames passed by name
(``{orders}`` in the text), so no session view is created or replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.skew import broadcast_bounded


def run_sql(spark: SparkSession, sql: str, frames: dict[str, DataFrame] | None = None, **args) -> DataFrame:
    """Run an ad-hoc SQL string over ``frames``, optionally with named parameters."""
    return spark.sql(sql, args=args or None, **(frames or {}))


def list_tables(frames: dict[str, DataFrame]) -> DataFrame:
    """The tables as read back, with their number of columns and rows."""
    rows = [df.agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("n_columns"), "n_rows")
            for name, df in frames.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def eda_head(orders: DataFrame, n: int = 10) -> DataFrame:
    """P2 + O4: the first orders by id (ordered so that the answer is repeatable)."""
    return run_sql(orders.sparkSession, "TABLE {orders} ORDER BY order_id LIMIT :n", {"orders": orders}, n=n)


def eda_totals(orders: DataFrame) -> DataFrame:
    """Distinct users and orders over all splits.

    Orders are counted per user first (map-side combined), so the distinct
    count is a plain count of the user rows.
    """
    per_user = orders.groupBy("user_id").agg(F.count("order_id").alias("n"))
    return per_user.agg(F.count("user_id").alias("total_users"),
                        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_orders"))


def eda_top_products(prior: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    """J2 + A8 + O3: most bought product names (same names merge).

    Lines are counted per product before names are attached, so neither the
    join nor the grouping by name moves a line.
    """
    per_product = prior.groupBy("product_id").agg(F.count(F.lit(1)).alias("lines"))
    names = broadcast_bounded(products.select("product_id", "product_name"), products)
    per_name = (per_product.join(names, "product_id").groupBy("product_name")
                .agg(F.sum("lines").alias("buying_count")))
    return per_name.orderBy(F.desc("buying_count"), F.asc("product_name")).limit(n)
