"""Edge rows (FIXTURES.md §4) through every operator."""

import pytest
from pyspark.sql import functions as F

from cartwise.operators import dataset as D
from cartwise.operators import evaluate as V
from cartwise.operators import features as FT
from cartwise.operators import recommend as R
from fixtures import frames


@pytest.fixture(scope="module")
def t(spark):
    orders, prior, train, products = frames(spark)
    uxp = FT.uxp_features(orders, prior)
    uf = FT.user_features(orders, prior)
    pf = FT.product_features(prior, products)
    master = D.train_master(orders, uxp, uf, pf, train)
    return dict(orders=orders, prior=prior, train=train, products=products, uxp=uxp, uf=uf, pf=pf,
                master=master)


def by_key(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r.asDict() for r in df.collect()}


def test_user_features(t):
    u = by_key(t["uf"], "user_id")
    assert set(u) == {1, 2, 3, 4, 5, 6, 7}
    # one prior order: gap missing -> 0 after the fill
    assert u[1]["user_avg_days_between"] == 0 and u[1]["user_recent_avg_days"] == 0
    assert u[1]["user_avg_basket_size"] == 2.0
    # two prior orders: recent mean over the single non-missing gap
    assert u[2]["user_recent_avg_days"] == 10.0 and u[2]["user_avg_basket_size"] == 1.5
    # five prior orders: recent mean over orders 3-5 only
    assert u[3]["user_recent_avg_days"] == 3.0 and u[3]["user_avg_days_between"] == 2.5
    # order numbers 1, 2, 5: total orders is the max number, not a count
    assert u[4]["user_total_orders"] == 5
    assert u[4]["user_avg_basket_size"] == pytest.approx(4 / 3)
    # prior orders without lines: basket 0
    assert u[5]["user_avg_basket_size"] == 0 and u[5]["user_total_orders"] == 2


def test_basket_ignores_orders_without_lines(t):
    b = by_key(FT.user_basket(t["orders"], t["prior"]), "user_id")
    assert 5 not in b
    assert b[2]["total_orders"] == 2 and b[2]["total_items"] == 3


def test_product_features(t):
    p = by_key(t["pf"], "product_id")
    assert 99 not in p  # unknown product drops out of the inner join
    assert p[10]["prod_total_orders"] == 9 and p[10]["prod_reorder_rate"] == pytest.approx(5 / 9)
    assert p[11]["prod_avg_position"] == 1.5
    assert p[12]["prod_total_orders"] == 4 and p[12]["prod_reorder_rate"] == 0.5


def test_duplicate_catalogue_row_multiplies_like_a_join(spark, t):
    dup = t["products"].unionByName(t["products"].where("product_id = 12"))
    p = by_key(FT.product_features(t["prior"], dup), "product_id")
    assert p[12]["prod_total_orders"] == 8 and p[12]["prod_reorder_rate"] == 0.5


def test_uxp_keeps_unknown_products(t):
    u = by_key(t["uxp"], "user_id", "product_id")
    assert (4, 99) in u
    assert u[(3, 10)]["uxp_total_bought"] == 4 and u[(3, 10)]["uxp_last_order_number"] == 5
    total = t["uxp"].agg(F.sum("uxp_total_bought")).first()[0]
    assert total == t["prior"].count()


def test_train_master(t):
    m = by_key(t["master"], "user_id", "product_id")
    assert set(m) == {(1, 10), (1, 11), (2, 10), (2, 12), (3, 10), (3, 11), (4, 12), (4, 99), (7, 13), (7, 14)}
    assert m[(1, 10)]["reordered"] == 1 and m[(1, 11)]["reordered"] == 0
    assert m[(2, 12)]["reordered"] == 1
    assert (2, 15) not in m                     # never bought before -> no candidate
    assert m[(7, 13)]["reordered"] == 0         # in the basket with reordered = 0
    assert m[(4, 99)]["reordered"] == 1 and m[(4, 99)]["prod_total_orders"] == 0
    assert m[(4, 99)]["aisle_id"] == 0
    assert m[(4, 12)]["orders_since_last_bought"] == 1
    assert m[(3, 11)]["orders_since_last_bought"] == 2
    assert all(k[0] != 6 for k in m)            # 'test' orders never appear
    assert all(k[0] != 5 for k in m)            # no lines -> no candidates
    assert t["master"].columns[2:-1] == D.FEATURES


def test_scoring_drops_unknown_products(t):
    frame = R.scoring_frame(t["uxp"], t["uf"], t["pf"], t["products"])
    keys = {(r.user_id, r.product_id) for r in frame.collect()}
    assert (4, 99) not in keys and len(keys) == 10
    row = frame.where("user_id = 4 AND product_id = 12").first()
    assert row.orders_since_last_bought == 1 + 5 - 5
    assert row.order_hour_of_day == 12.0


def test_scoring_with_explicit_context(t):
    frame = R.scoring_frame(t["uxp"], t["uf"], t["pf"], t["products"], hour=9, dow=2)
    ctx = {(r.order_hour_of_day, r.order_dow) for r in frame.collect()}
    assert ctx == {(9.0, 2.0)}  # supplied context replaces the user's habits


def test_threshold_strict_and_ties(spark):
    scored = spark.createDataFrame(
        [(1, 3, "c", 0.22, 1), (1, 2, "b", 0.5, 1), (1, 1, "a", 0.5, 1), (2, 4, "d", 0.1, 2)],
        "user_id long, product_id long, product_name string, probability double, aisle_id int")
    recs = R.recommend_threshold(scored).orderBy("user_id", "rec_rank").collect()
    assert [(r.user_id, r.product_id, r.rec_rank) for r in recs] == [(1, 1, 1), (1, 2, 2)]
    counts = by_key(R.recommend_counts(scored), "user_id")
    assert counts[2]["n_recommended"] == 0 and counts[2]["n_candidates"] == 1


def test_users_without_history(spark, t):
    frame = R.score_candidates(R.scoring_frame(t["uxp"], t["uf"], t["pf"], t["products"]))
    req = spark.createDataFrame([(1,), (5,), (8,)], "user_id long")
    assert sorted(r.user_id for r in R.users_without_history(req, frame).collect()) == [5, 8]


def test_nested_recommendations(spark):
    scored = spark.createDataFrame(
        [(1, 3, "c", 0.9, 1), (1, 2, "b", 0.5, 1), (2, 4, "d", 0.3, 2)],
        "user_id long, product_id long, product_name string, probability double, aisle_id int")
    nested = {r.user_id: r for r in R.recommend_nested(R.recommend_threshold(scored)).collect()}
    assert nested[1]["count"] == 2
    assert [x.product_name for x in nested[1]["recommendations"]] == ["c", "b"]


def test_basket_recommender(spark):
    scored = spark.createDataFrame(
        [(1, p, "x", 1.0 - p / 10, 1, 2.5) for p in range(1, 6)],
        "user_id long, product_id long, product_name string, probability double, aisle_id int, "
        "user_avg_basket_size double")
    kept = sorted(r.product_id for r in R.recommend_by_basket(scored).collect())
    assert kept == [1, 2, 3]  # round(2.5) = 3
    kept = sorted(r.product_id for r in R.recommend_by_basket(scored, also_above=0.55).collect())
    assert kept == [1, 2, 3, 4]


def test_all_f1_zero_keeps_initial_threshold(spark):
    scored = spark.createDataFrame([(0.9, 0), (0.05, 0), (0.3, 0)], "probability double, reordered int")
    best = by_key(V.best_threshold(V.threshold_sweep(scored)), "grid")
    assert best["coarse"]["best_threshold"] == 0.0 and best["narrow"]["best_threshold"] == 0.20


def test_sweep_invariants(spark):
    rows = [(i / 50.0, int(i % 3 == 0)) for i in range(50)]
    scored = spark.createDataFrame(rows, "probability double, reordered int")
    sweep = V.threshold_sweep(scored).where("grid = 'fine'").orderBy("threshold").collect()
    assert all(r.tp + r.fp + r.fn + r.tn == 50 for r in sweep)
    recalls = [r.recall for r in sweep]
    assert all(a >= b for a, b in zip(recalls, recalls[1:]))
    # brute force against a Python loop
    for r in sweep:
        tp = sum(1 for p, y in rows if p > r.threshold and y == 1)
        fp = sum(1 for p, y in rows if p > r.threshold and y == 0)
        assert (r.tp, r.fp) == (tp, fp)


def test_report_and_confusion(spark):
    scored = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.1, 1), (0.05, 0), (0.6, 1)],
                                   "probability double, reordered int")
    cm = {(r.actual, r.predicted): r.n for r in V.confusion(scored, 0.5).collect()}
    assert cm == {(1, 1): 2, (0, 1): 1, (1, 0): 1, (0, 0): 1}
    rep = by_key(V.classification_report(scored, 0.5), "class")
    assert rep["1"]["precision"] == pytest.approx(2 / 3) and rep["1"]["recall"] == pytest.approx(2 / 3)
    assert rep["0"]["support"] == 2 and rep["accuracy"]["f1"] == pytest.approx(3 / 5)


def test_log_loss(spark):
    import math
    scored = spark.createDataFrame([(0.9, 1), (0.2, 0), (1.0, 0)], "probability double, reordered int")
    got = V.log_loss(scored).first()["log_loss"]
    want = (-math.log(0.9) - math.log(0.8) - math.log(1 - (1 - 1e-15))) / 3  # clipped p
    assert got == pytest.approx(want, rel=1e-9)


def test_top_products_merge_names(t):
    from cartwise.operators import eda as E
    top = {x.product_name: x.buying_count for x in E.eda_top_products(t["prior"], t["products"]).collect()}
    assert top["banana"] == 10  # products 10 and 13 share the name


def test_views_and_sql_leave_the_callers_names_alone(spark, t):
    from cartwise.operators import eda as E
    from cartwise.sources.derive import RetailTables
    from cartwise.sources.tables import register_views
    spark.range(3).createOrReplaceTempView("orders")
    r = RetailTables(t["orders"], t["prior"], t["train"], t["products"],
                     spark.createDataFrame([], "aisle_id int, aisle string"),
                     spark.createDataFrame([], "department_id int, department string"))
    names = register_views(spark, r)
    assert "cartwise_orders" in names and E.eda_head(t["orders"]).count() == 10
    assert spark.table("orders").columns == ["id"]


def test_recent_trend_k(t):
    k = by_key(FT.user_trend_k(t["orders"], (1, 3)), "user_id")
    assert k[3]["recent_avg_days_1"] == 4.0 and k[3]["recent_avg_days_3"] == 3.0
    assert k[1]["recent_avg_days_3"] == 0.0


def test_dept_share_sums_to_one(t):
    share = FT.user_dept_share(FT.uxp_features(t["orders"], t["prior"]), t["products"])
    sums = share.groupBy("user_id").agg(F.sum("dept_share").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in sums)
