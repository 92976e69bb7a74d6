"""Derive the retail tables (orders, order lines, products, aisles,
departments) from the TPC-H-like test tables.

Rules (FIXTURES.md §2): an order's customer is its user; orders are numbered
per user by date then key; the gap to the previous order is in days; a user's
last order is the label order ('train', or 'test' for every fourth user) unless
it is the only one; one line per (order, product) keeps its first line number.
Products come in two grains: ``group`` (parts of one brand and type are one
product, so products are bought again) and ``part`` (every part is a product).

Everything is written so that a single user, order or (user, product) pair
holding a large share of the rows is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.skew import cut_lineage, has_hot_key, sequence_number, sized_broadcast, window_number

# Department id by part type, other types -> 6.
DEPARTMENT_OF_TYPE = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5}
OTHER_DEPARTMENT = 6
# Fixed value: product id of a line whose part is unknown.
UNKNOWN_PRODUCT = -1
GRAINS = ("group", "part")


@dataclass
class RetailTables:
    orders: DataFrame
    prior: DataFrame        # order_products__prior
    train: DataFrame        # order_products__train
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame
    test: DataFrame | None = None   # lines of the 'test' orders, in neither of the two
    row_counts: dict = field(default_factory=dict)  # observed while writing, when materialised
    hot_user: bool | None = None    # whether some user has more than HOT_ROWS orders; None: not checked

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "aisles": self.aisles,
            "departments": self.departments,
            "products": self.products,
            "orders": self.orders,
            "order_products__train": self.train,
            "order_products__prior": self.prior,
        }


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_orders(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.select(F.col("o_custkey").alias("user_id"))


def derive_orders(raw_orders: DataFrame, hot_user: bool | None = None) -> DataFrame:
    """orders: one row per order with its per-user number, gap and split.
    ``hot_user``: whether some user is hot (checked when not given)."""
    o = raw_orders.select(F.col("o_orderkey").alias("order_id"),
                          F.col("o_custkey").alias("user_id"),
                          F.to_date("o_orderdate").alias("order_date"))
    hot_user = has_hot_key(user_orders(raw_orders), "user_id") if hot_user is None else hot_user
    g = _neighbours_hot(o) if hot_user else _neighbours_window(o)
    is_prior = (F.col("has_next") == 1) | (F.col("order_number") == 1)
    eval_set = (F.when(is_prior, F.lit("prior"))
                .when(F.col("user_id") % 4 == 0, F.lit("test"))
                .otherwise(F.lit("train")))
    return g.select(
        "order_id", "user_id",
        eval_set.alias("eval_set"),
        F.col("order_number").cast("int").alias("order_number"),
        (F.dayofweek("order_date") - 1).cast("int").alias("order_dow"),
        ((F.col("order_id") * 7) % 24).cast("int").alias("order_hour_of_day"),
        F.datediff("order_date", "prev_date").cast("double").alias("days_since_prior_order"),
    )


def _neighbours_window(o: DataFrame) -> DataFrame:
    """No user outweighs a partition: one per-user window gives the number,
    the previous date and whether a later order exists."""
    w = Window.partitionBy("user_id").orderBy("order_date", "order_id")
    return o.select("user_id", "order_id", "order_date",
                    F.row_number().over(w).alias("order_number"),
                    F.lag("order_date").over(w).alias("prev_date"),
                    F.lead("order_id").over(w).isNotNull().cast("int").alias("has_next"))


def _neighbours_hot(o: DataFrame) -> DataFrame:
    """A hot user: range-partitioned numbering, then the previous date and the
    "has a next order" flag without a per-user window — every order is sent to
    its own slot, to the next slot (as the previous date) and to the slot
    before (as a marker), then regrouped on the composite key
    (user_id, order_number), where no key is hot."""
    o = sequence_number(o, "user_id", ["order_date", "order_id"], "order_number")
    null_date = F.lit(None).cast("date")
    null_id = F.lit(None).cast("long")
    own = o.select("user_id", "order_number", "order_id", "order_date",
                   null_date.alias("prev_date"), F.lit(0).alias("has_next"))
    as_prev = o.select("user_id", (F.col("order_number") + 1).alias("order_number"), null_id.alias("order_id"),
                       null_date.alias("order_date"), F.col("order_date").alias("prev_date"),
                       F.lit(0).alias("has_next"))
    as_next = o.select("user_id", (F.col("order_number") - 1).alias("order_number"), null_id.alias("order_id"),
                       null_date.alias("order_date"), null_date.alias("prev_date"), F.lit(1).alias("has_next"))
    return (own.unionByName(as_prev).unionByName(as_next)
            .groupBy("user_id", "order_number")
            .agg(F.max("order_id").alias("order_id"), F.max("order_date").alias("order_date"),
                 F.max("prev_date").alias("prev_date"), F.max("has_next").alias("has_next"))
            .where(F.col("order_id").isNotNull()))


def _part_products(part: DataFrame) -> DataFrame:
    """Every part with its aisle (brand number), department (type) and the id
    of its brand-and-type group."""
    dept = F.lit(OTHER_DEPARTMENT)
    for name, dep_id in reversed(list(DEPARTMENT_OF_TYPE.items())):
        dept = F.when(F.col("p_type") == name, F.lit(dep_id)).otherwise(dept)
    aisle = F.substring("p_brand", 7, 1 << 20).cast("int")
    return part.select("p_partkey", "p_name", "p_brand", "p_type", aisle.alias("aisle_id"), dept.cast("int").alias("department_id"),
                       (aisle.cast("long") * 10 + dept).alias("group_id"))


def derive_products(part: DataFrame, grain: str = "group") -> DataFrame:
    """products: one row per product of the grain; a group is named by its
    alphabetically first part name."""
    p = _part_products(part)
    if grain == "part":
        return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                        "aisle_id", "department_id", "p_brand", "p_type")
    return (p.groupBy(F.col("group_id").alias("product_id"))
            .agg(F.min("p_name").alias("product_name"), F.min("aisle_id").alias("aisle_id"),
                 F.min("department_id").alias("department_id"), F.min("p_brand").alias("p_brand"),
                 F.min("p_type").alias("p_type")))


def purchases(lineitem: DataFrame, part: DataFrame, grain: str = "group", deal: int | None = None) -> DataFrame:
    """One row per (order, product) with its first line number.  Lines find
    their part by a join from the plain scans, so a hot part is split by the
    adaptive skew join when the parts are too many to broadcast.  ``deal``: deal
    the lines by order into so many partitions before they are grouped (no order
    is hot); whatever follows by order then moves nothing."""
    lines = lineitem.select(F.col("l_orderkey").alias("order_id"), "l_partkey", "l_linenumber")
    if grain == "part":
        lines = lines.withColumnRenamed("l_partkey", "product_id")
    else:
        ids = sized_broadcast(_part_products(part).select(F.col("p_partkey").alias("l_partkey"), "group_id"))
        lines = (lines.join(ids, "l_partkey", "left")
                 .withColumn("product_id", F.coalesce("group_id", F.lit(UNKNOWN_PRODUCT).cast("long"))))
    if deal:
        lines = lines.select("order_id", "product_id", "l_linenumber").repartition(deal, "order_id")
    return lines.groupBy("order_id", "product_id").agg(F.min("l_linenumber").alias("first_line"))


def derive_lines(lineitem: DataFrame, orders: DataFrame, part: DataFrame, grain: str = "group",
                 hot_user: bool | None = None, buckets: int | None = None) -> DataFrame:
    """All order lines with add_to_cart_order and reordered, plus eval_set.
    ``buckets``: the bucket count of ``orders`` if they are bucketed on order_id;
    lines then move to their order once, unless some order is hot."""
    # raw lines per order bound the de-duplicated ones: check the cheap column
    raw_keys = lineitem.select(F.col("l_orderkey").alias("order_id"))
    position = ("order_id", ["first_line", "product_id"], "add_to_cart_order")
    if has_hot_key(raw_keys, "order_id"):
        lines = sequence_number(purchases(lineitem, part, grain), *position)
    else:
        lines = window_number(purchases(lineitem, part, grain, buckets), *position)
    lines = lines.join(orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id")
    # First purchase of each (user, product).  A pair has at most one line per
    # order, so its rows are bounded by the user's order count: without a hot
    # user one window over the pair is safe.  With one, the first numbers are
    # aggregated (map-side combined) and written, so that the join back reads
    # two plain shuffles and the adaptive skew join can split a hot pair; an
    # aggregate directly under the join would rule that out.
    hot_user = has_hot_key(orders.select("user_id"), "user_id") if hot_user is None else hot_user
    if hot_user:
        lines = cut_lineage(lines, label="order-lines")
        first = cut_lineage(lines.groupBy("user_id", "product_id").agg(F.min("order_number").alias("first_number")),
                            label="first-purchase")
        lines = lines.join(first, ["user_id", "product_id"])
    else:
        pair = Window.partitionBy("user_id", "product_id")
        lines = lines.withColumn("first_number", F.min("order_number").over(pair))
    return lines.select("order_id", "product_id",
                        F.col("add_to_cart_order").cast("int").alias("add_to_cart_order"),
                        (F.col("order_number") != F.col("first_number")).cast("int").alias("reordered"),
                        "eval_set")


LINE_COLS = ["order_id", "product_id", "add_to_cart_order", "reordered"]


def split_lines(lines: DataFrame) -> dict[str, DataFrame]:
    return {name: lines.where(F.col("eval_set") == name).select(*LINE_COLS) for name in ("prior", "train", "test")}


def derive_retail(spark: SparkSession, sf_dir: str, grain: str = "group") -> RetailTables:
    orders = derive_orders(read_source(spark, sf_dir, "orders"))
    raw_part = read_source(spark, sf_dir, "part")
    part = derive_products(raw_part, grain)
    lines = derive_lines(read_source(spark, sf_dir, "lineitem"), orders, raw_part, grain)
    return RetailTables(
        orders=orders, **split_lines(lines),
        products=part.select("product_id", "product_name", "aisle_id", "department_id"),
        aisles=part.select("aisle_id", F.col("p_brand").alias("aisle")).distinct(),
        departments=part.select("department_id", F.col("p_type").alias("department")).distinct(),
    )


__all__ = ["RetailTables", "derive_retail", "derive_orders", "derive_lines", "derive_products", "purchases",
           "read_source", "split_lines"]
