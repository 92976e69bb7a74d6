"""Exact order statistics of a column without sorting it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGES = 4096


def kth_smallest(df: DataFrame, value: Column, k: int) -> tuple[float, int, int] | None:
    """The ``k``-th smallest (from 1) non-null ``value`` (double), the number of
    values below it and the number equal to it; None when there are fewer.

    Each pass counts the values in ``RANGES`` equal ranges of the interval that
    holds the answer (a map-side combined count of at most ``RANGES`` rows) and goes
    on in one of them, so a few passes narrow it to a single value."""
    rows = df.select(value.cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)")
    span = rows.agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not 1 <= k <= span["n"]:
        return None
    lo, hi, below, inside = span["lo"], span["hi"], 0, span["n"]
    while lo < hi:
        place = F.floor((F.col("v") - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(RANGES)))
        ranges = sorted((r["r"], r["n"], r["lo"], r["hi"]) for r in
                        rows.where(F.col("v").between(lo, hi))
                        .groupBy(F.least(place, F.lit(RANGES - 1)).alias("r"))
                        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        for _, n, first, last in ranges:
            if below + n >= k:
                lo, hi, inside = first, last, n
                break
            below += n
    return lo, below, inside


def quantile_cut(df: DataFrame, value: Column, share: float) -> float | None:
    """Smallest value that at least ``share`` of the values do not exceed."""
    n = df.select(value.cast("double").alias("v")).where("v IS NOT NULL AND NOT isnan(v)").count()
    got = kth_smallest(df, value, max(1, math.ceil(share * n - 1e-9)))
    return None if got is None else got[0]
