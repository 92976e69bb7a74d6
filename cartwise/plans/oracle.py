"""Independent SQL (DuckDB dialect) for every SQL-expressible query.

The oracle derives the retail tables from the raw views ``orders``,
``lineitem``, ``part`` and ``customer`` with ordinary window functions and
states each result by its definition.  It shares no code or constant with the
Spark side.
"""

from __future__ import annotations

# Threshold grids in hundredths, and the threshold kept when no F1 is positive.
GRIDS = {"coarse": range(10, 51, 2), "fine": range(10, 51), "narrow": range(15, 46)}
KEPT = {"coarse": 0.0, "fine": 0.0, "narrow": 0.2}

_DEPARTMENT = """CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
                 WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END"""

# Products by grain: parts of one brand and type as one product, or every part.
_PRODUCTS = {
    "group": {
        "ids": f"""
SELECT p_partkey AS part_id, CAST(substring(p_brand, 7) AS BIGINT) * 10 + {_DEPARTMENT} AS product_id FROM part""",
        "r_products": f"""
SELECT product_id, min(p_name) AS product_name, CAST(product_id // 10 AS INTEGER) AS aisle_id,
       CAST(product_id % 10 AS INTEGER) AS department_id
FROM part JOIN ids ON ids.part_id = part.p_partkey GROUP BY product_id""",
    },
    "part": {
        "ids": "SELECT p_partkey AS part_id, p_partkey AS product_id FROM part",
        "r_products": f"""
SELECT p_partkey AS product_id, p_name AS product_name, CAST(substring(p_brand, 7) AS INTEGER) AS aisle_id,
       CAST({_DEPARTMENT} AS INTEGER) AS department_id
FROM part""",
    },
}

_LOGIT = "-3 + 0.3e0 * uxp_total_bought + 2e0 * uxp_reorder_ratio - 0.2e0 * orders_since_last_bought"
_IS_VALIDATION = "substring(md5(CAST(user_id AS VARCHAR) || '|' || CAST(product_id AS VARCHAR)), 1, 4) < '3333'"

# Derived retail tables and feature tables as CTEs (unused ones are ignored).
_CTES = {
    "o_base": """
SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS INTEGER)
         AS order_number
FROM orders""",
    "o_nb": """
SELECT *, lag(order_date) OVER (PARTITION BY user_id ORDER BY order_number) AS prev_date,
       lead(order_id) OVER (PARTITION BY user_id ORDER BY order_number) AS next_id
FROM o_base""",
    "r_orders": """
SELECT order_id, user_id,
       CASE WHEN next_id IS NOT NULL OR order_number = 1 THEN 'prior'
            WHEN user_id % 4 = 0 THEN 'test' ELSE 'train' END AS eval_set,
       order_number,
       CAST(dayofweek(order_date) AS INTEGER) AS order_dow,
       CAST((order_id * 7) % 24 AS INTEGER) AS order_hour_of_day,
       CAST(date_diff('day', prev_date, order_date) AS DOUBLE) AS days_since_prior_order
FROM o_nb""",
    "ids": None,
    "r_products": None,
    "bought": """
SELECT l_orderkey AS order_id, coalesce(product_id, -1) AS product_id, min(l_linenumber) AS first_line
FROM lineitem LEFT JOIN ids ON part_id = l_partkey GROUP BY 1, 2""",
    # every line with its order, cart position and whether the user had the product before
    "lines": """
SELECT b.order_id, b.product_id, r.user_id, r.order_number, r.eval_set,
       CAST(row_number() OVER (PARTITION BY b.order_id ORDER BY b.first_line, b.product_id) AS INTEGER) AS add_to_cart_order,
       CAST(r.order_number > min(r.order_number) OVER (PARTITION BY r.user_id, b.product_id) AS INTEGER) AS reordered
FROM bought b, r_orders r WHERE r.order_id = b.order_id""",
    "r_prior": "SELECT order_id, product_id, add_to_cart_order, reordered FROM lines WHERE eval_set = 'prior'",
    "r_train": "SELECT order_id, product_id, add_to_cart_order, reordered FROM lines WHERE eval_set = 'train'",
    "past": "SELECT * FROM lines WHERE eval_set = 'prior'",
    "baskets": "SELECT user_id, order_id, count(*) AS n FROM past GROUP BY user_id, order_id",
    "f_basket": """
SELECT user_id, CAST(sum(n) AS BIGINT) AS total_items, count(*) AS total_orders,
       CAST(sum(n) AS DOUBLE) / count(*) AS user_avg_basket_size
FROM baskets GROUP BY user_id""",
    "history": "SELECT * FROM r_orders WHERE eval_set = 'prior' AND user_id IS NOT NULL",
    "f_general": """
SELECT user_id, max(order_number) AS user_total_orders,
       avg(days_since_prior_order) AS user_avg_days_between,
       avg(order_hour_of_day) AS user_avg_hour, avg(order_dow) AS user_avg_dow
FROM history GROUP BY user_id""",
    "f_last3": """
SELECT user_id, order_id, order_number, days_since_prior_order,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY order_number DESC, order_id DESC) AS INTEGER)
         AS recent_rank
FROM history QUALIFY recent_rank <= 3""",
    "f_recent": """
SELECT user_id, avg(days_since_prior_order) AS user_recent_avg_days FROM f_last3 GROUP BY user_id""",
    "user_features": """
SELECT user_id, ifnull(user_total_orders, 0) AS user_total_orders,
       ifnull(user_avg_days_between, 0) AS user_avg_days_between, ifnull(user_avg_hour, 0) AS user_avg_hour,
       ifnull(user_avg_dow, 0) AS user_avg_dow, ifnull(user_avg_basket_size, 0) AS user_avg_basket_size,
       ifnull(user_recent_avg_days, 0) AS user_recent_avg_days
FROM f_general LEFT JOIN f_basket USING (user_id) LEFT JOIN f_recent USING (user_id)""",
    "sold": """
SELECT product_id, count(*) AS n, avg(reordered) AS again, avg(add_to_cart_order) AS place FROM past GROUP BY product_id""",
    "product_features": """
SELECT product_id, aisle_id, department_id, n AS prod_total_orders, again AS prod_reorder_rate,
       place AS prod_avg_position
FROM sold JOIN r_products USING (product_id)""",
    "uxp_features": """
SELECT user_id, product_id, count(*) AS uxp_total_bought, avg(reordered) AS uxp_reorder_ratio,
       max(order_number) AS uxp_last_order_number, avg(add_to_cart_order) AS uxp_avg_position
FROM past GROUP BY user_id, product_id""",
    "asked": """
SELECT user_id, order_id, order_number, order_hour_of_day, order_dow FROM r_orders WHERE eval_set = 'train'""",
    "again": "SELECT order_id, product_id FROM r_train WHERE reordered = 1",
    "train_master": """
SELECT u.user_id, u.product_id, u.uxp_total_bought, u.uxp_reorder_ratio,
       ifnull(f.user_total_orders, 0) AS user_total_orders, ifnull(f.user_avg_days_between, 0) AS user_avg_days_between,
       ifnull(g.prod_total_orders, 0) AS prod_total_orders, ifnull(g.prod_reorder_rate, 0) AS prod_reorder_rate,
       ifnull(f.user_avg_basket_size, 0) AS user_avg_basket_size, ifnull(g.prod_avg_position, 0) AS prod_avg_position,
       u.uxp_avg_position, a.order_hour_of_day, a.order_dow,
       ifnull(f.user_avg_hour, 0) AS user_avg_hour, ifnull(f.user_avg_dow, 0) AS user_avg_dow,
       ifnull(g.aisle_id, 0) AS aisle_id, ifnull(g.department_id, 0) AS department_id,
       ifnull(f.user_recent_avg_days, 0) AS user_recent_avg_days,
       CAST(a.order_number - u.uxp_last_order_number AS INTEGER) AS orders_since_last_bought,
       CAST((a.order_id, u.product_id) IN (SELECT (order_id, product_id) FROM again) AS INTEGER) AS reordered
FROM uxp_features u JOIN asked a ON a.user_id = u.user_id
LEFT JOIN product_features g ON g.product_id = u.product_id
LEFT JOIN user_features f ON f.user_id = u.user_id""",
    "val_scored": f"""
SELECT *, 1 / (1 + exp(-({_LOGIT}))) AS probability FROM train_master WHERE {_IS_VALIDATION}""",
    "scored": f"""
SELECT *, 1 / (1 + exp(-({_LOGIT}))) AS probability
FROM (SELECT *, user_avg_hour AS order_hour_of_day, user_avg_dow AS order_dow,
             CAST(1 + user_total_orders - uxp_last_order_number AS INTEGER) AS orders_since_last_bought
      FROM user_features JOIN uxp_features USING (user_id)
      JOIN (SELECT product_features.*, product_name FROM product_features JOIN r_products USING (product_id))
        USING (product_id))""",
    "ranked": """
SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY probability DESC, product_id) AS INTEGER)
            AS rec_rank
FROM scored""",
    "rec_threshold": """
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY probability DESC, product_id) AS INTEGER)
         AS rec_rank,
       product_id, product_name, round(probability, 4) AS probability, CAST(aisle_id AS INTEGER) AS aisle_id
FROM scored WHERE probability > 0.22e0""",
    "dept": """
SELECT user_id, department_id, dept_lines,
       CAST(dept_lines AS DOUBLE) / sum(dept_lines) OVER (PARTITION BY user_id) AS dept_share
FROM (SELECT user_id, department_id, count(*) AS dept_lines FROM past JOIN r_products USING (product_id)
      GROUP BY user_id, department_id)""",
}


def _with(grain: str = "group") -> str:
    ctes = {**_CTES, **_PRODUCTS[grain]}
    return "WITH " + ",\n".join(f"{n} AS ({ctes[n]})" for n in ctes) + "\n"


FEATURE_COLS = ", ".join([
    "uxp_total_bought", "uxp_reorder_ratio", "user_total_orders", "user_avg_days_between",
    "prod_total_orders", "prod_reorder_rate", "user_avg_basket_size", "prod_avg_position",
    "uxp_avg_position", "order_hour_of_day", "order_dow", "user_avg_hour", "user_avg_dow", "aisle_id",
    "department_id", "user_recent_avg_days", "orders_since_last_bought"])


def _sweep_sql() -> str:
    """Sweep as explicit conditional sums, one column set per threshold
    (a different method from the Spark side's histogram)."""
    ks = sorted({k for g in GRIDS.values() for k in g})
    sums = []
    for k in ks:
        t = f"(CAST({k} AS DOUBLE) / 100)"
        sums += [f"CAST(sum(CASE WHEN probability > {t} AND reordered = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp_{k}",
                 f"CAST(sum(CASE WHEN probability > {t} AND reordered <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp_{k}",
                 f"CAST(sum(CASE WHEN probability <= {t} AND reordered = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn_{k}",
                 f"CAST(sum(CASE WHEN probability <= {t} AND reordered <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn_{k}"]
    rows = [f"SELECT '{g}' AS grid, CAST({k} AS DOUBLE) / 100 AS threshold, tp_{k} AS tp, fp_{k} AS fp, "
            f"fn_{k} AS fn, tn_{k} AS tn FROM agg"
            for g, members in GRIDS.items() for k in members]
    return f"""
, agg AS (SELECT {", ".join(sums)} FROM val_scored)
, counts AS ({" UNION ALL ".join(rows)})
, sweep AS (
  SELECT grid, threshold, tp, fp, fn, tn,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1
  FROM counts)
"""


def _best_sql() -> str:
    start = " ".join(f"WHEN '{g}' THEN {v}e0" for g, v in KEPT.items())
    return f"""
, best AS (
  SELECT grid,
         CASE WHEN f1 > 0 THEN threshold ELSE CASE grid {start} END END AS best_threshold,
         f1 AS best_f1
  FROM (SELECT *, row_number() OVER (PARTITION BY grid ORDER BY f1 DESC, threshold) AS r FROM sweep)
  WHERE r = 1)
"""


def _report_sql(threshold_expr: str) -> str:
    return f"""
, cm AS (
  SELECT CAST(sum(CASE WHEN probability > {threshold_expr} AND reordered = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
         CAST(sum(CASE WHEN probability > {threshold_expr} AND reordered <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
         CAST(sum(CASE WHEN probability <= {threshold_expr} AND reordered = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
         CAST(sum(CASE WHEN probability <= {threshold_expr} AND reordered <> 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tn
  FROM val_scored)
, m AS (
  SELECT tp, fp, fn, tn, tp + fp + fn + tn AS n, tp + fn AS s1, tn + fp AS s0,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
         CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_1,
         CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0,
         CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0,
         CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END AS f1_0
  FROM cm)
SELECT '0' AS class, p0 AS precision, r0 AS recall, f1_0 AS f1, CAST(s0 AS BIGINT) AS support FROM m
UNION ALL SELECT '1', p1, r1, f1_1, CAST(s1 AS BIGINT) FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END, CAST(n AS BIGINT) FROM m
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, CAST(n AS BIGINT) FROM m
UNION ALL SELECT 'weighted avg',
       CASE WHEN n = 0 THEN 0.0 ELSE (p0 * s0 + p1 * s1) / n END,
       CASE WHEN n = 0 THEN 0.0 ELSE (r0 * s0 + r1 * s1) / n END,
       CASE WHEN n = 0 THEN 0.0 ELSE (f1_0 * s0 + f1_1 * s1) / n END, CAST(n AS BIGINT) FROM m
"""


def _bulk_sql() -> str:
    """Users at or above the 75 % place of both average basket and concentration."""
    return """,
conc AS (SELECT user_id, round(sum(dept_share * dept_share), 9) AS concentration FROM dept GROUP BY user_id),
sized AS (SELECT user_id, user_avg_basket_size, concentration,
                 row_number() OVER (ORDER BY user_avg_basket_size) AS ks, row_number() OVER (ORDER BY concentration) AS kc,
                 ceil(0.75 * count(*) OVER ()) AS k
          FROM user_features JOIN conc USING (user_id)),
bulk AS (SELECT user_id, concentration FROM sized
         WHERE user_avg_basket_size >= (SELECT min(user_avg_basket_size) FROM sized WHERE ks >= k)
           AND concentration >= (SELECT min(concentration) FROM sized WHERE kc >= k))
"""


def _inferred_sql(name: str, table: str, columns: list[str], texts: tuple, doubles: tuple) -> str:
    """A column's type as a CSV of it reads: text, number with a point, or whole
    numbers, which missing values turn into double."""
    rows = []
    for i, c in enumerate(columns):
        kind = "'string'" if c in texts else "'double'" if c in doubles else f"CASE WHEN count({c}) < count(*) THEN 'double' ELSE 'bigint' END"
        rows.append(f"SELECT '{name}' AS table_name, {i} AS position, '{c}' AS column_name, {kind} AS type, "
                    f"count({c}) AS n_values, count(*) - count({c}) AS n_missing FROM {table}")
    return " UNION ALL ".join(rows)


ORDER_COLS = ("order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, "
              "days_since_prior_order")


def oracle_sql() -> dict[str, str]:
    W, P = _with(), _with("part")
    scored = f"SELECT user_id, product_id, product_name, {FEATURE_COLS}, round(probability, 6) AS probability FROM scored"
    text = lambda *cols: " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in cols)
    q = {
        "ingest_roundtrip": W + f"""
SELECT 'orders' AS table_name, order_id AS k1, user_id AS k2,
       {text('eval_set', 'order_number', 'order_dow', 'order_hour_of_day', 'days_since_prior_order')} AS row_text
FROM r_orders
UNION ALL SELECT 'products', product_id, CAST(aisle_id AS BIGINT), {text('product_name', 'department_id')} FROM r_products
UNION ALL SELECT DISTINCT 'aisles', CAST(aisle_id AS BIGINT), CAST(0 AS BIGINT), 'Brand#' || CAST(aisle_id AS VARCHAR) FROM r_products
UNION ALL SELECT DISTINCT 'departments', CAST({_DEPARTMENT} AS BIGINT), CAST(0 AS BIGINT), p_type FROM part
UNION ALL SELECT 'order_products__prior', order_id, product_id, {text('add_to_cart_order', 'reordered')} FROM r_prior
UNION ALL SELECT 'order_products__train', order_id, product_id, {text('add_to_cart_order', 'reordered')} FROM r_train""",
        "master_csv_roundtrip": W + "SELECT * FROM train_master",
        "table_counts": W + """
SELECT 'aisles' AS table_name, count(DISTINCT aisle_id) AS n_rows FROM r_products
UNION ALL SELECT 'departments', count(DISTINCT department_id) FROM r_products
UNION ALL SELECT 'products', count(*) FROM r_products
UNION ALL SELECT 'orders', count(*) FROM r_orders
UNION ALL SELECT 'order_products__train', count(*) FROM r_train
UNION ALL SELECT 'order_products__prior', count(*) FROM r_prior
UNION ALL SELECT 'user_features', count(*) FROM user_features
UNION ALL SELECT 'product_features', count(*) FROM product_features
UNION ALL SELECT 'uxp_features', count(*) FROM uxp_features
UNION ALL SELECT 'train_master', count(*) FROM train_master""",
        "eda_list_tables": W + """
SELECT 'aisles' AS table_name, 2 AS n_columns, count(DISTINCT aisle_id) AS n_rows FROM r_products
UNION ALL SELECT 'departments', 2, count(DISTINCT department_id) FROM r_products
UNION ALL SELECT 'products', 4, count(*) FROM r_products
UNION ALL SELECT 'orders', 7, count(*) FROM r_orders
UNION ALL SELECT 'order_products__train', 4, count(*) FROM r_train
UNION ALL SELECT 'order_products__prior', 4, count(*) FROM r_prior""",
        "enriched_prior": W + "SELECT order_id, product_id, add_to_cart_order, reordered, user_id, order_number FROM past",
        "user_basket": W + "SELECT user_id, total_items, total_orders, user_avg_basket_size FROM f_basket",
        "user_order_stats": W + "SELECT * FROM f_general",
        "last_k_orders": W + "SELECT * FROM f_last3",
        "user_recent_trend": W + "SELECT * FROM f_recent",
        "user_features": W + "SELECT * FROM user_features",
        "product_features": W + "SELECT * FROM product_features",
        "uxp_features": W + "SELECT * FROM uxp_features",
        "part_product_features": P + "SELECT * FROM product_features",
        "part_uxp_features": P + "SELECT * FROM uxp_features",
        "part_train_master": P + "SELECT * FROM train_master",
        "part_score_candidates": P + scored,
        "candidates": W + "SELECT * FROM asked JOIN uxp_features USING (user_id)",
        "label_join": W + "SELECT order_id, user_id, product_id, CAST((order_id, product_id) IN "
                          "(SELECT (order_id, product_id) FROM again) AS INTEGER) AS reordered "
                          "FROM asked JOIN uxp_features USING (user_id)",
        "train_master": W + "SELECT * FROM train_master",
        "feature_matrix": W + "SELECT user_id, product_id, " + ", ".join(
            f"CAST({c.strip()} AS DOUBLE) AS {c.strip()}" for c in FEATURE_COLS.split(",")) +
            ", CAST(reordered AS DOUBLE) AS label FROM train_master",
        "split_counts": W + f"""
SELECT CASE WHEN {_IS_VALIDATION} THEN 'validation' ELSE 'train' END AS split,
       count(*) AS n_rows, CAST(sum(reordered) AS BIGINT) AS n_positive
FROM train_master GROUP BY 1""",
        "score_candidates": W + scored,
        "score_one_user": W + scored + " WHERE user_id = 42",
        "recommend_threshold": W + "SELECT * FROM rec_threshold",
        "recommend_nested": W + """
SELECT user_id, count(*) AS count,
       CAST(to_json(list({'rec_rank': rec_rank, 'product_name': product_name, 'probability': probability,
                          'aisle_id': aisle_id} ORDER BY rec_rank)) AS VARCHAR) AS recommendations
FROM rec_threshold GROUP BY user_id""",
        "recommend_counts": W + """
SELECT user_id, count(*) AS n_candidates,
       CAST(sum(CASE WHEN probability > 0.22e0 THEN 1 ELSE 0 END) AS BIGINT) AS n_recommended
FROM scored GROUP BY user_id""",
        "users_without_history": W + """
SELECT DISTINCT 2 * c_custkey AS user_id FROM customer
WHERE 2 * c_custkey NOT IN (SELECT user_id FROM scored WHERE user_id IS NOT NULL)""",
        "recommend_by_basket": W + """
SELECT user_id, rec_rank, product_id, product_name, round(probability, 4) AS probability,
       CAST(aisle_id AS INTEGER) AS aisle_id
FROM ranked WHERE rec_rank <= round(user_avg_basket_size)""",
        "bulk_buyers": W + _bulk_sql() + "SELECT user_id, concentration FROM bulk",
        "recommend_personal": W + _bulk_sql() + """
SELECT user_id, rec_rank, product_id, product_name, round(probability, 4) AS probability,
       CAST(aisle_id AS INTEGER) AS aisle_id
FROM ranked WHERE rec_rank <= round(user_avg_basket_size)
   OR (probability > 0.22e0 AND user_id IN (SELECT user_id FROM bulk))""",
        "exact_split": W + """
SELECT CASE WHEN k <= ceil(0.2 * n) THEN 'validation' ELSE 'train' END AS split,
       count(*) AS n_rows, CAST(sum(reordered) AS BIGINT) AS n_positive
FROM (SELECT reordered, count(*) OVER () AS n, row_number() OVER (
        ORDER BY substr(md5(CAST(user_id AS VARCHAR) || '|' || CAST(product_id AS VARCHAR)), 1, 13), user_id, product_id) AS k
      FROM train_master)
GROUP BY 1""",
        "inferred_schema": W + " UNION ALL ".join(_inferred_sql(*t) for t in (
            ("orders", "r_orders", ORDER_COLS.split(", "), ("eval_set",), ("days_since_prior_order",)),
            ("products", "r_products", ["product_id", "product_name", "aisle_id", "department_id"], ("product_name",), ()),
            ("aisles", "(SELECT DISTINCT aisle_id, 'Brand#' || CAST(aisle_id AS VARCHAR) AS aisle FROM r_products)",
             ["aisle_id", "aisle"], ("aisle",), ()),
            ("departments", f"(SELECT DISTINCT CAST({_DEPARTMENT} AS BIGINT) AS department_id, p_type AS department FROM part)",
             ["department_id", "department"], ("department",), ()),
            ("order_products__prior", "r_prior", ["order_id", "product_id", "add_to_cart_order", "reordered"], (), ()),
            ("order_products__train", "r_train", ["order_id", "product_id", "add_to_cart_order", "reordered"], (), ()))),
        "stream_recommend": W + """
SELECT c.c_custkey AS request_id, c.c_custkey AS user_id,
       u.user_id IS NOT NULL AS has_history, coalesce(u.n_recommended, 0) AS count,
       r.rec_rank, r.product_id, r.product_name, r.probability, r.aisle_id
FROM customer c
LEFT JOIN (SELECT user_id, CAST(sum(CASE WHEN probability > 0.22e0 THEN 1 ELSE 0 END) AS BIGINT) AS n_recommended
           FROM scored GROUP BY user_id) u ON c.c_custkey = u.user_id
LEFT JOIN rec_threshold r ON c.c_custkey = r.user_id""",
        "gbt_train": W + "SELECT count(*) AS n_rows, true AS beats_base_rate, true AS rounds_in_range FROM val_scored",
        "gbt_tuned": W + "SELECT count(*) AS n_rows, true AS beats_base_rate, true AS rounds_in_range FROM val_scored",
        "hyper_search": "SELECT CAST(i AS INTEGER) AS trial, true AS in_space, true AS rounds_in_range, "
            "true AS best_at_most_base FROM range(20) t(i)",
        "grid_search": """
SELECT CAST(row_number() OVER (ORDER BY max_depth, learning_rate, gamma) - 1 AS INTEGER) AS trial, max_depth, learning_rate, gamma,
       true AS rounds_in_range, true AS beats_base_rate
FROM (SELECT unnest([4, 6]) AS max_depth), (SELECT unnest([0.05e0, 0.1e0]) AS learning_rate), (SELECT unnest([0e0, 1.5e0]) AS gamma)""",
        "recommend_gbt": W + """
SELECT user_id, count(*) AS n_candidates, true AS ranks_dense, true AS above_threshold FROM scored GROUP BY user_id""",
        "feature_importance": "SELECT unnest(['" + "', '".join(c.strip() for c in FEATURE_COLS.split(",")) +
            "']) AS feature, true AS in_range, true AS sums_agree, true AS sums_to_one",
        "model_roundtrip": W + "SELECT user_id, product_id, true AS same FROM val_scored",
        "threshold_sweep": W.rstrip() + _sweep_sql() + "SELECT * FROM sweep",
        "best_threshold": W.rstrip() + _sweep_sql() + _best_sql() + "SELECT * FROM best",
        "report_default": W.rstrip() + _report_sql("0.5e0"),
        "classification_report": W.rstrip() + _sweep_sql() + _best_sql()
            + _report_sql("(SELECT best_threshold FROM best WHERE grid = 'coarse')"),
        "confusion": W + """
SELECT 0 AS actual, 0 AS predicted, CAST(sum(CASE WHEN probability <= 0.22e0 AND reordered <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS n FROM val_scored
UNION ALL SELECT 0, 1, CAST(sum(CASE WHEN probability > 0.22e0 AND reordered <> 1 THEN 1 ELSE 0 END) AS BIGINT) FROM val_scored
UNION ALL SELECT 1, 0, CAST(sum(CASE WHEN probability <= 0.22e0 AND reordered = 1 THEN 1 ELSE 0 END) AS BIGINT) FROM val_scored
UNION ALL SELECT 1, 1, CAST(sum(CASE WHEN probability > 0.22e0 AND reordered = 1 THEN 1 ELSE 0 END) AS BIGINT) FROM val_scored""",
        "log_loss": W + """
SELECT round(avg(-(reordered * ln(greatest(least(probability, 1 - 1e-15), 1e-15))
                   + (1 - reordered) * ln(1 - greatest(least(probability, 1 - 1e-15), 1e-15)))), 6) AS log_loss,
       count(*) AS n_rows
FROM val_scored""",
        "eda_head": W + f"SELECT {ORDER_COLS} FROM r_orders WHERE order_id IN (SELECT unnest(min(order_id, 10)) FROM r_orders)",
        "eda_totals": W + "SELECT (SELECT count(*) FROM (SELECT DISTINCT user_id FROM r_orders WHERE user_id IS NOT NULL)) AS total_users, "
                          "(SELECT count(*) FROM r_orders WHERE order_id IS NOT NULL) AS total_orders",
        "eda_top_products": W + """
SELECT product_name, CAST(sum(n) AS BIGINT) AS buying_count FROM sold JOIN r_products USING (product_id)
GROUP BY product_name ORDER BY buying_count DESC, product_name LIMIT 5""",
        "cyclical_hour": W + """
SELECT order_id, user_id, order_hour_of_day,
       -- "+ 0.0" turns a rounded -0.0 into 0.0 (Spark's decimal rounding has no signed zero)
       round(sin(order_hour_of_day * (2 * pi() / 24)), 6) + 0.0 AS hour_sin,
       round(cos(order_hour_of_day * (2 * pi() / 24)), 6) + 0.0 AS hour_cos
FROM r_orders""",
        "user_dept_share": W + "SELECT * FROM dept",
        "candidate_dept_share": W + """
SELECT m.user_id, m.product_id, p.department_id, coalesce(s.dept_share, 0.0) AS uxd_dept_share
FROM train_master m LEFT JOIN r_products p USING (product_id)
LEFT JOIN dept s ON s.user_id = m.user_id AND s.department_id = p.department_id""",
        "user_trend_k": W + """
SELECT user_id,
       coalesce(avg(CASE WHEN rk <= 3 THEN days_since_prior_order END), 0) AS recent_avg_days_3,
       coalesce(avg(CASE WHEN rk <= 5 THEN days_since_prior_order END), 0) AS recent_avg_days_5,
       coalesce(avg(CASE WHEN rk <= 10 THEN days_since_prior_order END), 0) AS recent_avg_days_10
FROM (SELECT user_id, days_since_prior_order,
             row_number() OVER (PARTITION BY user_id ORDER BY order_number DESC, order_id DESC) AS rk
      FROM history)
WHERE rk <= 10 GROUP BY user_id""",
    }
    return q
