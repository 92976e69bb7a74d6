"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for right results: the model's
# feature order, used identically for training and scoring (17 features).
FEATURES = [
    "uxp_total_bought",
    "uxp_reorder_ratio",
    "user_total_orders",
    "user_avg_days_between",
    "prod_total_orders",
    "prod_reorder_rate",
    "user_avg_basket_size",
    "prod_avg_position",
    "uxp_avg_position",
    "order_hour_of_day",
    "order_dow",
    "user_avg_hour",
    "user_avg_dow",
    "aisle_id",
    "department_id",
    "user_recent_avg_days",
    "orders_since_last_bought",
]

# Serving threshold and the notebook's default decision cut.
SERVING_THRESHOLD = 0.22
DEFAULT_CUT = 0.5

# The three threshold grids, as integer hundredths
# (0.10-0.50 step 0.02; 0.10-0.50 step 0.01; 0.15-0.45 step 0.01).
THRESHOLD_GRIDS = {
    "coarse": list(range(10, 51, 2)),
    "fine": list(range(10, 51)),
    "narrow": list(range(15, 46)),
}
# Threshold kept when no grid point has a positive F1.
GRID_START = {"coarse": 0.0, "fine": 0.0, "narrow": 0.20}


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN -> NULL so ``avg`` skips it the way a pandas mean does."""
    c = col_or(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double, 0 when the denominator is 0 (library convention)."""
    num, den = col_or(num), col_or(den)
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def standin_logit(total_bought: str | Column = "uxp_total_bought",
                  reorder_ratio: str | Column = "uxp_reorder_ratio",
                  since_last: str | Column = "orders_since_last_bought") -> Column:
    """Linear part of the stand-in score used for oracle tests of everything
    downstream of the model.  It stands in for the model only."""
    return (F.lit(-3.0) + F.lit(0.3) * col_or(total_bought).cast("double")
            + F.lit(2.0) * col_or(reorder_ratio).cast("double")
            - F.lit(0.2) * col_or(since_last).cast("double"))


def standin_probability(**kw) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-standin_logit(**kw)))


# A fifth of all four-digit hex numbers lies below this one.
VALIDATION_BELOW = "3333"


def validation_flag(user: str = "user_id", product: str = "product_id") -> Column:
    """80/20 split by a digest of the key, so rows fall at random but alike in
    every run and engine: True = validation row."""
    key = F.concat(F.col(user).cast("string"), F.lit("|"), F.col(product).cast("string"))
    return F.substring(F.md5(key.cast("binary")), 1, 4) < F.lit(VALIDATION_BELOW)


def hour_angle(hour: str | Column) -> Column:
    return col_or(hour).cast("double") * F.lit(2.0 * math.pi / 24.0)
