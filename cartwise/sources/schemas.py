"""Explicit schemas of the retail tables (never inferred: inference costs a
second pass over the input and drifts between files)."""

from __future__ import annotations

from pyspark.sql import types as T

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("eval_set", T.StringType()),
    T.StructField("order_number", T.IntegerType()),
    T.StructField("order_dow", T.IntegerType()),
    T.StructField("order_hour_of_day", T.IntegerType()),
    T.StructField("days_since_prior_order", T.DoubleType()),
])

ORDER_LINES = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("add_to_cart_order", T.IntegerType()),
    T.StructField("reordered", T.IntegerType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("aisle_id", T.IntegerType()),
    T.StructField("department_id", T.IntegerType()),
])

AISLES = T.StructType([
    T.StructField("aisle_id", T.IntegerType()),
    T.StructField("aisle", T.StringType()),
])

DEPARTMENTS = T.StructType([
    T.StructField("department_id", T.IntegerType()),
    T.StructField("department", T.StringType()),
])

# Raw input files, in load order (largest last), and their schemas.
RAW_TABLES = {
    "aisles": AISLES,
    "departments": DEPARTMENTS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_products__train": ORDER_LINES,
    "order_products__prior": ORDER_LINES,
}

TRAIN_MASTER = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("uxp_total_bought", T.LongType()),
    T.StructField("uxp_reorder_ratio", T.DoubleType()),
    T.StructField("user_total_orders", T.IntegerType()),
    T.StructField("user_avg_days_between", T.DoubleType()),
    T.StructField("prod_total_orders", T.LongType()),
    T.StructField("prod_reorder_rate", T.DoubleType()),
    T.StructField("user_avg_basket_size", T.DoubleType()),
    T.StructField("prod_avg_position", T.DoubleType()),
    T.StructField("uxp_avg_position", T.DoubleType()),
    T.StructField("order_hour_of_day", T.IntegerType()),
    T.StructField("order_dow", T.IntegerType()),
    T.StructField("user_avg_hour", T.DoubleType()),
    T.StructField("user_avg_dow", T.DoubleType()),
    T.StructField("aisle_id", T.IntegerType()),
    T.StructField("department_id", T.IntegerType()),
    T.StructField("user_recent_avg_days", T.DoubleType()),
    T.StructField("orders_since_last_bought", T.IntegerType()),
    T.StructField("reordered", T.IntegerType()),
])
