"""Boosted trees by levels, the model as a table, importances and the searches."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.functions.columns import FEATURES
from cartwise.operators import boosting as B
from cartwise.operators import dataset as D
from cartwise.operators import features as FT
from cartwise.operators import model as M
from cartwise.operators.recommend import PROB


@pytest.fixture(scope="module")
def master_mid(spark):
    from cartwise.sources.tables import load_retail
    r = load_retail(spark, "/root/testdata/sf0.01")
    uxp = FT.uxp_features(r.orders, r.prior)
    return D.train_master(r.orders, uxp, FT.user_features(r.orders, r.prior),
                          FT.product_features(r.prior, r.products), r.train).cache()


@pytest.fixture(scope="module")
def master(spark):
    """3,000 rows whose label depends on three features, with ties and nulls."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(3000):
        x = [float(v) for v in np.round(rng.normal(size=len(FEATURES)), 1)]
        p = 1 / (1 + math.exp(-(1.5 * x[0] - 2 * (x[1] > 0.5) + x[0] * x[2])))
        rows.append((i // 20, i % 20, *(None if i % 97 == 0 and k == 3 else v for k, v in enumerate(x)), int(rng.random() < p)))
    schema = "user_id long, product_id long, " + ", ".join(f"{f} double" for f in FEATURES) + ", reordered int"
    return spark.createDataFrame(rows, schema).cache()


FAST = {"n_estimators": 6, "learning_rate": 0.3, "max_depth": 3}


def same(a, b):
    return a.losses == b.losses and [vars(t) for t in a.trees] == [vars(t) for t in b.trees]


def test_first_tree_against_plain_numpy(master):
    """The root's split, gain and the leaf values by brute force over all cuts."""
    fits, blocks = B.fit_many(master, [{**FAST, "n_estimators": 1, "max_depth": 1}])
    rows = D.with_split(master).where("NOT is_validation").na.fill(0).toPandas()
    y = rows["reordered"].to_numpy(float)
    p = y.mean()
    g, h = np.full(len(y), p) - y, np.full(len(y), p * (1 - p))
    best = (0.0,)
    for f, cuts in zip(FEATURES, blocks.cuts):
        for cut in cuts:
            left = rows[f].to_numpy() <= cut
            gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
            gain = gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
            if hl >= 1 and hr >= 1 and gain > best[0] + 1e-9:
                best = (gain, f, cut, -0.3 * gl / (hl + 1), -0.3 * gr / (hr + 1))
    t = fits[0].trees[0]
    assert FEATURES[t.feature[0]] == best[1] and blocks.cuts[t.feature[0]][t.bin[0]] == best[2]
    assert t.gain[0] == pytest.approx(best[0], rel=1e-4)
    assert [t.value[t.left[0]], t.value[t.right[0]]] == pytest.approx(best[3:], rel=1e-4)


def test_same_fit_under_any_partitioning(master, monkeypatch):
    setting = {**FAST, "subsample": 0.7, "colsample_bytree": 0.6, "gamma": 0.5}
    one, blocks = B.fit_many(master, [setting], partitions=1)
    monkeypatch.setattr(B, "DIRECT_TASKS", 2)            # sums and splits in tasks
    monkeypatch.setattr(B, "KEEP_ROUNDS", 2)
    many, _ = B.fit_many(master, [setting], partitions=7, block_rows=100, cuts=blocks.cuts)
    assert same(one[0], many[0]) and len(one[0].trees) > 1
    assert all(g > 0.5 for t in one[0].trees for f, g in zip(t.feature, t.gain) if f >= 0)      # gamma


def test_settings_grown_together_equal_their_single_fits(master):
    settings = [FAST, {**FAST, "max_depth": 2}, {**FAST, "subsample": 0.6, "n_estimators": 4}, {**FAST, "gamma": 1e9}]
    together, _ = B.fit_many(master, settings, patience=3)
    for s, fit in zip(settings, together):
        assert same(fit, B.fit_many(master, [s], patience=3)[0][0])
    assert len(together[3].trees[0].feature) == 1        # nothing to gain: a single leaf


def test_patience_keeps_the_best_round_without_refit(master):
    fit = B.fit_many(master, [{**FAST, "learning_rate": 1.0, "n_estimators": 40}], patience=5)[0][0]
    best = min(range(1, len(fit.losses)), key=fit.losses.__getitem__)
    assert len(fit.trees) == best and len(fit.losses) - 1 == min(40, best + 5)


def test_samples_follow_the_shares(master):
    key = np.arange(20000, dtype=np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for share in (0.25, 0.66):
        assert abs((B._mix(key, 12345) < share).mean() - share) < 0.02
    g = B._Growing(0, B.Setting(colsample_bytree=0.7), 17, 42)
    g.start()
    assert len(g.columns) == 11 and len(set(g.columns.tolist())) == 11


def test_scorer_gives_the_losses_of_the_fit_in_the_jvm(spark, master):
    fits, blocks = B.fit_many(master, [FAST])
    model = M.BoostedModel.of(spark, fits[0], blocks.cuts)
    assert M.evaluate_model(model, master).first()["log_loss"] == pytest.approx(fits[0].losses[len(fits[0].trees)], abs=1e-6)
    plan = model.scorer()(master)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    probs = model.scorer()(master.select(*FEATURES)).agg(F.min(PROB), F.max(PROB)).first()
    assert 0 < probs[0] < probs[1] < 1


def test_no_rows_and_one_label_give_the_base_rate(spark, master):
    for rows in (master.limit(0), master.withColumn("reordered", F.lit(0))):
        model = M.fit_gbt(rows, FAST)
        assert model.n_trees == 0
        assert model.scorer()(master.limit(3)).select(PROB).distinct().count() == 1


def test_importance_and_roundtrip(spark, master, tmp_dir):
    model = M.fit_gbt(master, FAST)
    rows = {r.feature: r for r in M.feature_importance(model).collect()}
    assert sorted(rows) == sorted(FEATURES)
    log = M.split_log(model).toPandas()
    for f, r in rows.items():
        own = log[log.feature == f]
        assert (r.weight, r.total_gain, r.total_cover) == (len(own), pytest.approx(own.gain.sum()), pytest.approx(own.cover.sum()))
    assert sum(r.importance for r in rows.values()) == pytest.approx(1.0)
    assert [r.weight_rank for r in M.feature_importance(model, top=5).orderBy("weight_rank").collect()] == [1, 2, 3, 4, 5]
    both = M.model_roundtrip(model, master, os.path.join(tmp_dir, "m"))
    assert both.where("p_saved <> p_loaded").count() == 0 and both.count() > 0


def test_log_loss_within_one_percent_of_spark_ml_at_equal_rounds(master_mid):
    from pyspark.ml.classification import GBTClassifier
    rounds = 10
    fits, _ = B.fit_many(master_mid, [{"n_estimators": rounds, "learning_rate": 0.1, "max_depth": 4}])
    base = M.base_rate_log_loss(master_mid).first()["base_log_loss"]
    data = D.with_split(D.feature_matrix(master_mid))
    gbt = GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, stepSize=0.1, maxDepth=4, seed=1)
    theirs = gbt.fit(data.where("NOT is_validation")).evaluateEachIteration(data.where("is_validation"))[-1]
    assert fits[0].losses[rounds] < base
    assert fits[0].losses[rounds] <= 1.01 * theirs


def test_search_proposes_ranks_and_resumes(spark, master, tmp_dir, monkeypatch):
    monkeypatch.setattr(M, "STARTUP", 3)
    space = {**M.SEARCH_SPACE, "n_estimators": (2, 4), "max_depth": (1, 3), "learning_rate": (0.1, 0.9)}
    kw = dict(n_trials=7, space=space, patience=2, baseline=FAST, wave=2)
    whole = M.hyper_search(master, **kw).orderBy("trial").collect()
    path = os.path.join(tmp_dir, "trials")
    part = M.hyper_search(master, path=path, stop_after=4, **kw).collect()
    assert len(part) == 5 and spark.read.parquet(path).count() == 5
    resumed = M.hyper_search(master, path=path, **kw).orderBy("trial").collect()
    assert [r.asDict() for r in resumed] == [r.asDict() for r in whole]
    assert [r.trial for r in whole] == [-1, 0, 1, 2, 3, 4, 5, 6]
    for r in whole[1:]:
        assert all(lo <= r[k] <= hi for k, (lo, hi) in space.items())
    assert sorted(r["rank"] for r in whole) == list(range(1, 9))


def test_proposals_follow_the_good_trials():
    space = {"n_estimators": (500, 1500), "learning_rate": (0.01, 0.1), "max_depth": (4, 10),
             "subsample": (0.6, 1.0), "colsample_bytree": (0.6, 1.0), "gamma": (0.0, 5.0)}
    history = []
    for t in range(40):
        s = M.propose([], t, 1, space)
        history.append({"trial": t, **s, "log_loss": abs(s["learning_rate"] - 0.03)})
    near = [abs(M.propose(history, t, 1, space)["learning_rate"] - 0.03) for t in range(100, 130)]
    far = [abs(M.propose([], t, 1, space)["learning_rate"] - 0.03) for t in range(100, 130)]
    assert np.mean(near) < 0.6 * np.mean(far)


def test_grid_covers_every_combination(master):
    out = M.grid_search(master, {"max_depth": [1, 2], "learning_rate": [0.3, 0.6], "n_estimators": [3]}, patience=2)
    rows = out.orderBy("trial").collect()
    assert [(r.max_depth, r.learning_rate) for r in rows] == [(1, 0.3), (1, 0.6), (2, 0.3), (2, 0.6)]
    assert all(1 <= r.n_trees <= 3 for r in rows)


def test_sums_by_difference_and_few_kept_frames(spark, master, monkeypatch):
    """Only the smaller child is summed, with the same trees; at most two frames
    are kept, and a task's bytes stay bounded whatever the rows and settings."""
    setting = {**FAST, "max_depth": 5, "subsample": 0.8, "n_estimators": 12}
    summed, kept = [], []
    work, settle = B._Growing.work, B.Blocks.settle
    monkeypatch.setattr(B._Growing, "work", lambda g, first: summed.append((len(g.counted), len(g.open))) or work(g, first))
    monkeypatch.setattr(B.Blocks, "settle", lambda b, held: kept.append(len(held)) or settle(b, held))
    halves, blocks = B.fit_many(master, [setting], partitions=3, block_rows=100)
    assert sum(a for a, _ in summed) < 0.7 * sum(b for _, b in summed) and max(kept) <= 2
    monkeypatch.setattr(B, "KEPT_SLOTS", 0)
    assert same(halves[0], B.fit_many(master, [setting], cuts=blocks.cuts)[0][0])
    monkeypatch.setattr(B, "KEPT_SLOTS", 4)
    monkeypatch.setattr(B, "DIRECT_SUMS", 1)
    assert same(halves[0], B.fit_many(master, [setting], cuts=blocks.cuts, partitions=2)[0][0])
    monkeypatch.setattr(B, "TASK_BYTES", 1000)
    assert B.Blocks(master, n_settings=8, cuts=blocks.cuts, block_rows=10).tasks > 3 * spark.sparkContext.defaultParallelism


def test_scored_rows_carry_no_trees(spark, master, monkeypatch):
    """Trees are conditions of the plan, not a column of every row; both ways of
    scoring give the margins of a walk by hand, on missing and infinite values too."""
    model = M.fit_gbt(master, FAST)
    rows = [(i, *[v] * len(FEATURES)) for i, v in enumerate((0.3, -0.7, 0.0, None, math.nan, math.inf, -math.inf, 2.5))]
    odd = spark.createDataFrame(rows, "i int, " + ", ".join(f"{f} double" for f in FEATURES))
    scored = model.scorer()(odd)
    assert scored.columns == [*odd.columns, PROB]
    assert "collect_list" not in scored._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(M, "PLAN_NODES", 3)
    table = {r.i: r[PROB] for r in model.scorer()(odd).collect()}
    nodes = {(r.tree, r.node): r for r in model.nodes.collect()}
    for r in scored.collect():
        x = [0.0 if v is None or math.isnan(v) else v for v in r[1:-1]]
        margin = model.base
        for t in range(model.n_trees):
            n = nodes[t, 0]
            while n.feature >= 0:
                n = nodes[t, n.left if x[n.feature] <= n.cut else n.right]
            margin += n.value
        assert r[PROB] == table[r.i] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-15)


def test_few_rows_grow_in_one_task_a_setting(spark, master, monkeypatch):
    """Without passes by level: the jobs of a fit do not grow with its rounds, the
    trees are those of the passes, and a search packs its rows once."""
    settings = [{**FAST, "max_depth": 5}, {**FAST, "subsample": 0.7, "colsample_bytree": 0.5, "max_depth": 4}]
    blocks = B.Blocks(master)
    spark.sparkContext.setJobGroup("whole-fits", "fits")
    try:
        whole, _ = B.fit_many(master, settings, blocks=blocks)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("whole-fits")) <= 2
    monkeypatch.setattr(blocks, "fits_a_task", False)
    assert all(same(a, b) for a, b in zip(whole, B.fit_many(master, settings, blocks=blocks)[0]))
    packed, init = [], B.Blocks.__init__
    monkeypatch.setattr(B.Blocks, "__init__", lambda b, *a, **k: packed.append(1) or init(b, *a, **k))
    monkeypatch.setattr(M, "STARTUP", 2)
    M.hyper_search(master, n_trials=4, space={**M.SEARCH_SPACE, "n_estimators": (2, 3)}, wave=2).collect()
    assert len(packed) == 1


def test_cuts_are_exact_quantiles_of_few_values_and_close_for_many(spark, monkeypatch):
    rng = np.random.default_rng(3)
    few, many = np.round(rng.normal(size=6000), 1), rng.gamma(0.3, size=6000)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(few, many)], "a double, b double").repartition(5)
    probs = np.arange(1, 257) / 256
    for f, v, got in zip("ab", (few, many), B.quantile_cuts(df, ["a", "b"])):
        assert np.array_equal(got, np.unique(np.quantile(v, probs, method="inverted_cdf"))[:-1]), f
    monkeypatch.setattr(B, "SUMMARY", 256)
    got = B.quantile_cuts(df, ["b"], max_bins=16)[0]
    ranks = np.searchsorted(np.sort(many), got, side="right") / 6000
    assert len(got) == 15 and np.abs(ranks - np.arange(1, 16) / 16).max() < 0.02
    assert [len(c) for c in B.quantile_cuts(df.limit(0), ["a", "b"])] == [0, 0]


def test_rows_without_a_key_train_but_do_not_count_in_the_base_rate(spark, master):
    extra = master.limit(40).withColumn("product_id", F.lit(None).cast("long")).withColumn("reordered", F.lit(1))
    with_extra = B.Blocks(master.unionByName(extra))
    plain = B.Blocks(master)
    assert (with_extra.base, with_extra.n_train, with_extra.n_rows) == (plain.base, plain.n_train, plain.n_rows + 40)
