"""Evaluation of reorder probabilities: threshold sweep, best threshold,
confusion counts, classification report and log-loss.

Every metric is one distributed aggregation over the scored rows (partial
sums per task, a single tiny final merge); nothing is collected.  The sweep
counts the rows per threshold step in one pass and derives every threshold
of every grid from that small histogram, instead of looping over thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import DEFAULT_CUT, GRID_START, SERVING_THRESHOLD, THRESHOLD_GRIDS
from .dataset import LABEL, with_split
from .recommend import PROB, Scorer, standin_scorer

EPS = 1e-15


def validation_scored(master: DataFrame, scorer: Scorer = standin_scorer) -> DataFrame:
    """Validation rows of the training table with their probability."""
    val = with_split(master).where(F.col("is_validation")).drop("is_validation")
    return scorer(val)


def _thr(t: float | Column) -> Column:
    return t if isinstance(t, Column) else F.lit(float(t))


def _safe_div(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def _with_rates(df: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (df.withColumn("precision", _safe_div(tp, tp + fp))
            .withColumn("recall", _safe_div(tp, tp + fn))
            .withColumn("f1", _safe_div(2 * tp, 2 * tp + fp + fn)))


def threshold_sweep(scored: DataFrame, grids: dict[str, list[int]] | None = None,
                    label: str = LABEL, prob: str = PROB) -> DataFrame:
    """M7: tp/fp/fn/tn, precision, recall and F1 of class 1 for every threshold
    of every grid (thresholds are integer hundredths: no float drift).

    One pass over the scored rows: each row gets ``m`` = the largest k with
    ``p > k/100`` (clamped to the grid span), the rows are counted per
    (m, label) — a map-side combined aggregate with at most one row per grid
    step — and the counts above each threshold are reverse cumulative sums
    over that tiny histogram, computed in a single row with array functions.
    """
    grids = grids or THRESHOLD_GRIDS
    ks = sorted({k for g in grids.values() for k in g})
    lo, hi = ks[0], ks[-1]
    p = F.col(prob)
    m0 = F.floor(p * F.lit(100.0)).cast("int")
    # exact step: compare with the same doubles the thresholds use (k / 100.0)
    m = (F.when(p > (m0 + 1) / F.lit(100.0), m0 + 1)
         .when(p > m0 / F.lit(100.0), m0)
         .otherwise(m0 - 1))
    m = F.coalesce(F.least(F.greatest(m, F.lit(lo - 1)), F.lit(hi)), F.lit(lo - 1))  # NULL p: below all
    y = F.col(label) == 1
    hist = (scored.groupBy(m.alias("m"))
            .agg(F.sum(F.when(y, 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(y, 0).otherwise(1)).cast("long").alias("neg")))
    one = hist.agg(F.collect_list(F.struct("m", "pos", "neg")).alias("h"),
                   F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    steps = F.array(*[F.struct(F.lit(name).alias("grid"), F.lit(k).alias("k"))
                      for name, members in grids.items() for k in members])

    def above(e, field):
        return F.aggregate(F.filter("h", lambda x: x["m"] >= e["k"]), F.lit(0).cast("long"),
                           lambda acc, x: acc + x[field])

    rows = one.select("P", "N", F.inline(F.transform(steps, lambda e: F.struct(
        e["grid"].alias("grid"), e["k"].alias("k"), above(e, "pos").alias("tp"), above(e, "neg").alias("fp")))))
    out = rows.select("grid", (F.col("k") / F.lit(100.0)).alias("threshold"),
                      F.coalesce(F.col("tp"), F.lit(0)).cast("long").alias("tp"),
                      F.coalesce(F.col("fp"), F.lit(0)).cast("long").alias("fp"),
                      (F.coalesce(F.col("P"), F.lit(0)) - F.col("tp")).cast("long").alias("fn"),
                      (F.coalesce(F.col("N"), F.lit(0)) - F.col("fp")).cast("long").alias("tn"))
    return _with_rates(out)


def best_threshold(sweep: DataFrame) -> DataFrame:
    """M8: per grid the lowest threshold reaching the highest F1; when every F1
    is 0, the loop's initial threshold is kept."""
    start = F.lit(None).cast("double")
    for g, v in GRID_START.items():
        start = F.when(F.col("grid") == g, F.lit(v)).otherwise(start)
    best = (sweep.groupBy("grid")
            .agg(F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("neg_t"))).alias("b")))
    return best.select("grid",
                       F.when(F.col("b.f1") > 0, -F.col("b.neg_t")).otherwise(start).alias("best_threshold"),
                       F.col("b.f1").alias("best_f1"))


def confusion_counts(scored: DataFrame, threshold: float | Column = SERVING_THRESHOLD,
                     label: str = LABEL, prob: str = PROB) -> DataFrame:
    """tp, fp, fn, tn at one threshold (strict ``p > t``), one row.

    The prediction is computed once as a column, so a threshold given as a
    scalar subquery is planned (and run) once, not once per cell."""
    flagged = scored.select((F.col(prob) > _thr(threshold)).alias("_pred"), (F.col(label) == 1).alias("_pos"))
    y, pred = F.col("_pos"), F.col("_pred")
    s = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return flagged.agg(s(pred & y).alias("tp"), s(pred & ~y).alias("fp"),
                       s(~pred & y).alias("fn"), s(~pred & ~y).alias("tn"))


def confusion(scored: DataFrame, threshold: float | Column = SERVING_THRESHOLD, **kw) -> DataFrame:
    """Confusion matrix as (actual, predicted, n) — all four cells, even empty ones."""
    c = confusion_counts(scored, threshold, **kw)
    cells = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(pr).alias("predicted"), F.col(n).alias("n"))
                      for a, pr, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return c.select(F.inline(cells))


def classification_report(scored: DataFrame, threshold: float | Column = SERVING_THRESHOLD, **kw) -> DataFrame:
    """M9: per class precision, recall, F1 and support, plus accuracy, macro
    and weighted averages (0 where a denominator is 0)."""
    c = confusion_counts(scored, threshold, **kw)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    p1, r1, f1_1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn), _safe_div(2 * tp, 2 * tp + fp + fn)
    p0, r0, f1_0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp), _safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _safe_div(tp + tn, n)
    w = lambda a, b: _safe_div(a * s0 + b * s1, n)
    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.cast("long").alias("support"))

    none = F.lit(None).cast("double")
    rows = F.array(
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", none, none, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", w(p0, p1), w(r0, r1), w(f1_0, f1_1), n),
    )
    return c.select(F.inline(rows))


def report_default(scored: DataFrame, **kw) -> DataFrame:
    """M5 + M9: the report of hard predictions at the default 0.5 cut."""
    return classification_report(scored, DEFAULT_CUT, **kw)


def log_loss(scored: DataFrame, label: str = LABEL, prob: str = PROB) -> DataFrame:
    """Mean binary cross-entropy with probabilities clipped to [eps, 1-eps]."""
    p = F.greatest(F.least(F.col(prob), F.lit(1 - EPS)), F.lit(EPS))
    y = F.col(label).cast("double")
    term = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    return scored.agg(F.avg(term).alias("log_loss"), F.count(F.lit(1)).alias("n_rows"))


def best_threshold_value(scored: DataFrame, grid: str = "fine") -> Column:
    """Best threshold of ``grid`` as a scalar-subquery column (no join, no collect)."""
    return (best_threshold(threshold_sweep(scored, {grid: THRESHOLD_GRIDS[grid]}))
            .select("best_threshold").scalar())
