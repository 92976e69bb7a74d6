"""Reorder classifier: fit, score, search, importance, persistence (M3, M4, M6,
M12-M15, S11).

``fit_gbt`` grows a boosted ensemble (``operators/boosting.py``) on the training
rows of the deterministic split; the validation rows choose the round, with the
reference's patience of 50 rounds.  A fitted model is a table, one row per tree
node (feature, cut, children, gain, cover, value), and a base margin.  Scoring
puts its trees into the plan as nested conditions, inside the JVM; no Python worker runs.
Importances are aggregates of the table.  The tuning search proposes settings
from the densities of good and bad trials so far and keeps its trials in a
written table, from which an interrupted search goes on.
"""

from __future__ import annotations

import math
import random
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import FEATURES
from .boosting import Fit, Setting, fit_many, node_rows
from .dataset import with_split
from .evaluate import log_loss
from .recommend import PROB

# The notebook's first configuration, in the booster's terms.
BASE_PARAMS = {"n_estimators": 1000, "learning_rate": 0.05, "max_depth": 6}
# The tuned configuration found by the notebook's search.
TUNED_PARAMS = {
    "n_estimators": 938,
    "learning_rate": 0.03743533184090101,
    "max_depth": 10,
    "subsample": 0.6605204427574461,
    "colsample_bytree": 0.7019846992999667,
    "gamma": 1.54649974715052,
}
# Fixed value: rounds without a better validation loss before boosting ends.
PATIENCE = 50
# The search space of the notebook's tuning.
SEARCH_SPACE = {
    "n_estimators": (500, 1500),
    "learning_rate": (0.01, 0.1),
    "max_depth": (4, 10),
    "subsample": (0.6, 1.0),
    "colsample_bytree": (0.6, 1.0),
    "gamma": (0.0, 5.0),
}
WHOLE = ("n_estimators", "max_depth")
PLAN_NODES = 200_000    # nodes that a scoring plan holds as conditions

NODES = ("tree int, node int, feature int, cut double, left int, right int, gain double, cover double, value double")
TRIALS = ("trial int, n_estimators int, learning_rate double, max_depth int, subsample double, "
          "colsample_bytree double, gamma double, n_trees int, log_loss double")


# ---- the model -----------------------------------------------------------------

class BoostedModel:
    """A fitted ensemble: ``nodes``, a table with one row per tree node, and the
    margin ``base`` that the trees add to."""

    def __init__(self, nodes: DataFrame, base: float, n_trees: int, depth: int, features: list[str] = FEATURES):
        self.nodes, self.base, self.n_trees, self.depth, self.features = nodes, float(base), n_trees, depth, list(features)

    @staticmethod
    def of(spark: SparkSession, fit: Fit, cuts, features: list[str] = FEATURES) -> "BoostedModel":
        nodes = spark.createDataFrame(node_rows(fit, cuts), NODES)
        return BoostedModel(nodes, fit.base, len(fit.trees), fit.setting.max_depth, features)

    def scorer(self):
        """Adds the class-1 probability, from the feature columns (NULL and NaN
        count as 0), in the JVM.

        Trees become nested conditions in the plan, so a row carries its features
        alone and a step is one comparison; a model of more than ``PLAN_NODES``
        nodes, whose plan would be too large, is walked as a table."""
        clean = [F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)) for f in self.features]
        rows = self.nodes.limit(PLAN_NODES + 1).toArrow() if self.n_trees else None
        if rows is not None and rows.num_rows > PLAN_NODES:
            return self._table_scorer(clean)
        trees = _conditions(rows) if self.n_trees else []
        used = [f"_bt_{i}" for i in range(len(clean))]

        def score(df: DataFrame) -> DataFrame:
            with_x = df.select("*", *[c.alias(n) for c, n in zip(clean, used)])
            margin = F.lit(self.base)
            if trees:
                margin = F.aggregate(F.array(*[F.expr(t) for t in trees]), margin, lambda at, value: at + value)
            return with_x.withColumn(PROB, F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).drop(*used)
        return score

    def _table_scorer(self, clean: list):
        """The node table as one array per tree in a scalar subquery; each row walks
        every tree with array functions."""
        per_tree = self.nodes.groupBy("tree").agg(F.sort_array(F.collect_list(
            F.struct("node", "feature", "cut", "left", "right", "value"))).alias("nodes"))
        trees = per_tree.agg(F.sort_array(F.collect_list(F.struct("tree", "nodes"))).alias("trees")).select("trees").scalar()
        steps = F.sequence(F.lit(1), F.lit(max(1, self.depth)))

        def score(df: DataFrame) -> DataFrame:
            def step(tree):
                def go(at, _):
                    n = F.get(tree["nodes"], at)
                    inner = F.get(F.col("_bt_x"), F.greatest(n["feature"], F.lit(0))) <= n["cut"]
                    return F.when(inner, n["left"]).otherwise(n["right"])
                return go

            def add(margin, tree):
                leaf = F.aggregate(steps, F.lit(0), step(tree))
                return margin + F.get(tree["nodes"], leaf)["value"]

            with_x = df.withColumn("_bt_x", F.array(*clean)).withColumn("_bt_trees", trees)
            margin = F.aggregate(F.col("_bt_trees"), F.lit(self.base), add)
            return with_x.withColumn(PROB, F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).drop("_bt_x", "_bt_trees")
        return score


def _conditions(rows) -> list[str]:
    """Each tree of a node table (Arrow) as a nested condition on ``_bt_0``, ``_bt_1``, ..."""
    trees: dict[int, dict] = {}
    for tree, node, feature, cut, left, right, value in zip(*[rows.column(c).to_pylist() for c in (
            "tree", "node", "feature", "cut", "left", "right", "value")]):
        trees.setdefault(tree, {})[node] = (feature, cut, left, right, value)
    number = lambda v: f"{v!r}D" if math.isfinite(v) else f"double('{v}')"

    def text(tree: dict, node: int) -> str:
        feature, cut, left, right, value = tree[node]
        if feature < 0:
            return number(value)
        return f"if(_bt_{feature} <= {number(cut)}, {text(tree, left)}, {text(tree, right)})"
    return [text(trees[t], 0) for t in sorted(trees)]


def fit_gbt(master: DataFrame, params: dict | None = None, seed: int = 42, patience: int = PATIENCE,
            **layout) -> BoostedModel:
    """M3/M4: grow on the training rows, keep the best round on the validation
    rows.  ``params`` override ``BASE_PARAMS``."""
    fits, blocks = fit_many(master, [{**BASE_PARAMS, **(params or {})}], seed, patience, **layout)
    return BoostedModel.of(master.sparkSession, fits[0], blocks.cuts)


def base_rate_log_loss(master: DataFrame) -> DataFrame:
    """Validation log-loss of predicting the training rows' positive rate."""
    split = with_split(master)
    y = F.col("reordered").cast("double")
    rate = F.avg(F.when(~F.col("is_validation"), y))
    pos = F.avg(F.when(F.col("is_validation"), y))
    stats = split.agg(rate.alias("p"), pos.alias("q"))
    clipped = F.greatest(F.least(F.col("p"), F.lit(1 - 1e-15)), F.lit(1e-15))
    return stats.select((-(F.col("q") * F.log(clipped) + (1 - F.col("q")) * F.log(1 - clipped))).alias("base_log_loss"))


@dataclass
class TrainResult:
    model: BoostedModel
    metrics: DataFrame


def evaluate_model(model: BoostedModel, master: DataFrame) -> DataFrame:
    """Log-loss and size of the fitted ensemble on the validation rows."""
    val = with_split(master).where(F.col("is_validation")).drop("is_validation")
    ll = log_loss(model.scorer()(val))
    return ll.select(F.lit(int(model.n_trees)).alias("n_trees"), "log_loss", "n_rows")


def gbt_train(master: DataFrame, params: dict | None = None, seed: int = 42, patience: int = PATIENCE) -> TrainResult:
    model = fit_gbt(master, params, seed, patience)
    return TrainResult(model, evaluate_model(model, master))


# ---- persistence (S11) ------------------------------------------------------------

def save_model(model: BoostedModel, path: str) -> None:
    """The node table and, beside it, a row with base margin, size and features;
    that row is written last, so a folder that has it is whole."""
    spark = model.nodes.sparkSession
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    about = spark.createDataFrame([(model.base, model.n_trees, model.depth, model.features)],
                                  "base double, n_trees int, depth int, features array<string>")
    about.write.mode("overwrite").parquet(f"{path}/about")


def load_model(spark: SparkSession, path: str) -> BoostedModel:
    about = spark.read.parquet(f"{path}/about").first()
    return BoostedModel(spark.read.schema(NODES).parquet(f"{path}/nodes"), about["base"], about["n_trees"],
                        about["depth"], about["features"])


def model_roundtrip(model: BoostedModel, master: DataFrame, path: str) -> DataFrame:
    """Save, load and score the validation rows with the loaded model; each
    row carries both probabilities."""
    save_model(model, path)
    loaded = load_model(master.sparkSession, path)
    val = with_split(master).where(F.col("is_validation")).drop("is_validation")
    a = model.scorer()(val).select("user_id", "product_id", F.col(PROB).alias("p_saved"))
    b = loaded.scorer()(val).select("user_id", "product_id", F.col(PROB).alias("p_loaded"))
    return a.join(b, ["user_id", "product_id"])


# ---- importance (M14) ---------------------------------------------------------------

def split_log(model: BoostedModel) -> DataFrame:
    """Every split of the ensemble: tree, node, feature, cut, gain, cover."""
    names = F.array(*[F.lit(f) for f in model.features])
    return (model.nodes.where("feature >= 0")
            .select("tree", "node", F.get(names, F.col("feature")).alias("feature"), "cut", "gain", "cover"))


def feature_importance(model: BoostedModel, top: int | None = None) -> DataFrame:
    """Per feature: ``weight`` (number of splits), mean and total gain and cover,
    ``importance`` (mean gain as a share, the booster's default), and the ranks by
    importance and by weight (ties by name); ``top`` keeps the first N by weight.

    All aggregates of the split log; features that never split have zeros."""
    spark = model.nodes.sparkSession
    names = spark.createDataFrame([(f,) for f in model.features], "feature string")
    stats = split_log(model).groupBy("feature").agg(
        F.count(F.lit(1)).alias("weight"), F.sum("gain").alias("total_gain"), F.sum("cover").alias("total_cover"),
        F.avg("gain").alias("gain"), F.avg("cover").alias("cover"))
    zeros = {"weight": 0, "total_gain": 0.0, "total_cover": 0.0, "gain": 0.0, "cover": 0.0}
    out = names.join(stats, "feature", "left").na.fill(zeros)
    whole = Window.partitionBy(F.lit(0))                              # one row per feature: 17
    out = out.withColumn("importance", F.when(F.sum("gain").over(whole) > 0, F.col("gain") / F.sum("gain").over(whole))
                         .otherwise(F.lit(0.0)))
    rank = lambda c: F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(c), "feature"))
    out = out.withColumn("importance_rank", rank("importance")).withColumn("weight_rank", rank("weight"))
    return out.where(F.col("weight_rank") <= top) if top else out


# ---- search (M12, M13) ----------------------------------------------------------------

STARTUP = 10        # random draws before the densities propose
WAVE = 5            # proposals that are grown together
CANDIDATES = 24     # draws from the good density that compete for a proposal
GOOD_SHARE = 0.25   # share of the trials, best first, that count as good


def _draw(space: dict, rng: random.Random) -> dict:
    return {k: rng.randint(lo, hi) if k in WHOLE else rng.uniform(lo, hi) for k, (lo, hi) in space.items()}


def _density(x: float, points: list[float], lo: float, hi: float) -> float:
    """Parzen density on [lo, hi]: a normal kernel around every point, cut to the
    range, and a uniform one."""
    width = (hi - lo) / max(2.0, math.sqrt(len(points) + 1))
    cdf = lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2)))
    total = 1.0 / (hi - lo)
    for m in points:
        mass = cdf((hi - m) / width) - cdf((lo - m) / width)
        total += math.exp(-0.5 * ((x - m) / width) ** 2) / (width * math.sqrt(2 * math.pi) * mass)
    return total / (len(points) + 1)


def _sample(points: list[float], lo: float, hi: float, rng: random.Random) -> float:
    i = rng.randrange(len(points) + 1)
    if i == len(points):
        return rng.uniform(lo, hi)
    width = (hi - lo) / max(2.0, math.sqrt(len(points) + 1))
    while True:
        x = rng.gauss(points[i], width)
        if lo <= x <= hi:
            return x


def propose(history: list[dict], trial: int, seed: int = 42, space: dict = SEARCH_SPACE) -> dict:
    """Setting of ``trial``: a random draw while fewer than ``STARTUP`` trials are
    known, else per parameter the candidate drawn from the density of the good
    trials whose ratio of good to bad density is highest.  The same history, trial
    and seed give the same setting."""
    rng = random.Random(f"{seed}-{trial}")
    if len(history) < STARTUP:
        return _draw(space, rng)
    ranked = sorted(history, key=lambda h: (h["log_loss"], h["trial"]))
    n_good = max(1, math.ceil(GOOD_SHARE * len(ranked)))
    out = {}
    for name, (lo, hi) in space.items():
        good, bad = ([float(h[name]) for h in part] for part in (ranked[:n_good], ranked[n_good:]))
        best = max((_sample(good, lo, hi, rng) for _ in range(CANDIDATES)),
                   key=lambda x: _density(x, good, lo, hi) / _density(x, bad, lo, hi))
        out[name] = min(hi, max(lo, round(best))) if name in WHOLE else best
    return out


def hyper_search(master: DataFrame, n_trials: int = 20, seed: int = 42, path: str | None = None,
                 space: dict = SEARCH_SPACE, patience: int = PATIENCE, stop_after: int | None = None,
                 baseline: dict | None = None, wave: int = WAVE) -> DataFrame:
    """``n_trials`` settings of the whole space, each grown with patience and
    scored by validation log-loss, ranked (rank 1 = the study's best).

    Trials run in waves (of ``wave``, the first of ``STARTUP``) that grow together (one scan a level for all); the next
    wave is proposed from the trials so far.  With ``path`` every wave is appended
    to a trial table there, and a search that finds trials goes on after them: the
    outcome is that of one run.  ``stop_after`` ends early (trials stay).
    ``baseline``: a setting grown beside the first wave and reported as trial -1,
    ranked like the others and never a source of proposals."""
    spark = master.sparkSession
    extra: list[dict] = []
    history: list[dict] = []
    if path and _exists(spark, path):
        rows = [r.asDict() for r in spark.read.schema(TRIALS).parquet(path).orderBy("trial").collect()]
        history, extra = [r for r in rows if r["trial"] >= 0], [r for r in rows if r["trial"] < 0]
    until = n_trials if stop_after is None else min(n_trials, stop_after)
    blocks = None       # packed once, grown on by every wave
    while len(history) < until:
        done = len(history)
        size = STARTUP - done if done < STARTUP else wave - (done - STARTUP) % wave
        ids = list(range(done, min(done + size, until)))
        known = history[:STARTUP + (done - STARTUP) // wave * wave] if done >= STARTUP else []
        settings = [propose(known, t, seed, space) for t in ids]
        if baseline is not None and not extra:
            ids, settings = [-1, *ids], [baseline, *settings]
        fits, blocks = fit_many(master, settings, seed, patience, blocks=blocks)
        rows = [_trial(t, s, f) for t, s, f in zip(ids, settings, fits)]
        if path:
            spark.createDataFrame(rows, TRIALS).coalesce(1).write.mode("append").parquet(path)
        history += [r for r in rows if r["trial"] >= 0]
        extra += [r for r in rows if r["trial"] < 0]
    return _ranked_trials(spark.createDataFrame(extra + history, TRIALS))


def _trial(trial: int, setting: dict, fit: Fit) -> dict:
    full = Setting.of(setting)
    return {"trial": trial, **{k: getattr(full, k) for k in SEARCH_SPACE}, "n_trees": len(fit.trees),
            "log_loss": float(fit.losses[len(fit.trees)]) if fit.losses else 0.0}


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _ranked_trials(trials: DataFrame) -> DataFrame:
    """Rank trials by validation log-loss (rank 1 = the study's best)."""
    return trials.withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("log_loss", "trial")))


def grid_settings(grid: dict[str, list]) -> list[dict]:
    """Every combination of the grid's values over ``BASE_PARAMS``."""
    out = [dict(BASE_PARAMS)]
    for key, values in grid.items():
        out = [{**s, key: v} for s in out for v in values]
    return out


def grid_search(master: DataFrame, grid: dict[str, list], seed: int = 42, patience: int = PATIENCE) -> DataFrame:
    """Every setting of the grid, grown in the same scans, with patience;
    each ranked by validation log-loss."""
    settings = grid_settings(grid)
    fits, _ = fit_many(master, settings, seed, patience)
    rows = [_trial(i, s, f) for i, (s, f) in enumerate(zip(settings, fits))]
    return _ranked_trials(master.sparkSession.createDataFrame(rows, TRIALS))
