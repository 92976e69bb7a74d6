"""Connectors (CSV ingest/sinks), the request stream and the model operators."""

import os

import pytest
from pyspark.sql import functions as F

from cartwise.operators import dataset as D
from cartwise.operators import features as FT
from cartwise.operators import recommend as R
from cartwise.sources import schemas as S
from cartwise.sources.files import ingest_csv, read_master_csv, table_counts, write_master_csv
from fixtures import frames


def test_csv_ingest_nan_and_missing_file(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(os.path.join(raw, "orders.csv"))
    with open(os.path.join(raw, "orders.csv", "part-0.csv"), "w") as f:
        f.write("order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n")
        f.write("1,7,prior,1,0,10,\n")
        f.write("2,7,prior,2,3,11,NaN\n")
        f.write("3,7,train,3,3,11,4.0\n")
    out = ingest_csv(spark, raw, os.path.join(tmp_dir, "out"))
    assert set(out) == {"orders"}  # the five missing files are skipped with a warning
    days = {r.order_id: r.days_since_prior_order for r in out["orders"].collect()}
    assert days == {1: None, 2: None, 3: 4.0}
    assert out["orders"].schema == S.ORDERS


def test_master_csv_roundtrip(spark, tmp_dir):
    orders, prior, train, products = frames(spark)
    uxp = FT.uxp_features(orders, prior)
    master = D.train_master(orders, uxp, FT.user_features(orders, prior), FT.product_features(prior, products), train)
    path = os.path.join(tmp_dir, "master")
    write_master_csv(master, path)
    back = read_master_csv(spark, path)
    assert back.schema == S.TRAIN_MASTER
    assert back.exceptAll(master).count() == 0 and master.exceptAll(back).count() == 0


def test_table_counts(spark):
    orders, prior, train, products = frames(spark)
    counts = {r.table_name: r.n_rows for r in table_counts({"orders": orders, "prior": prior}).collect()}
    assert counts == {"orders": orders.count(), "prior": prior.count()}


def test_counts_observed_on_write_match_table_counts(spark):
    from cartwise.plans.registry import Ctx
    c = Ctx(spark, "/root/testdata/sf0.001")
    observed = {**c.r.row_counts, **c.store.row_counts}
    counted = {r.table_name: r.n_rows for r in table_counts(
        {**c.r.as_dict(), "user_features": c.store.user_features, "product_features": c.store.product_features,
         "uxp_features": c.store.uxp_features, "train_master": c.store.train_master}).collect()}
    assert observed.pop("order_products__test") == c.r.test.count()
    assert observed == counted and counted["train_master"] == 3271


def test_request_stream(spark, tmp_dir):
    from cartwise.streaming import read_answers, run_request_stream, write_answer_tables
    recs = spark.createDataFrame([(1, 1, 10, "banana", 0.9, 24), (1, 2, 11, "apple", 0.5, 24)],
                                 "user_id long, rec_rank int, product_id long, product_name string, "
                                 "probability double, aisle_id int")
    users = spark.createDataFrame([(1, 2), (2, 0)], "user_id long, n_recommended long")
    reqs = spark.createDataFrame([(100, 1), (101, 2), (102, 3)], "request_id long, user_id long")
    reqs.write.parquet(os.path.join(tmp_dir, "reqs"))
    write_answer_tables(recs, users, os.path.join(tmp_dir, "recs"), os.path.join(tmp_dir, "users"), parts=8)
    q = run_request_stream(spark, os.path.join(tmp_dir, "reqs"), os.path.join(tmp_dir, "recs"),
                           os.path.join(tmp_dir, "users"), os.path.join(tmp_dir, "answers"),
                           os.path.join(tmp_dir, "ckpt"), parts=8)
    q.awaitTermination()
    out = read_answers(spark, os.path.join(tmp_dir, "answers"))
    rows = {(r.request_id, r.product_id): r for r in out.collect()}
    assert set(rows) == {(100, 10), (100, 11), (101, None), (102, None)}
    assert rows[(101, None)].has_history and rows[(101, None)]["count"] == 0
    assert not rows[(102, None)].has_history


def test_one_user_reads_only_that_users_rows(spark):
    from cartwise.plans.registry import Ctx
    c = Ctx(spark, "/root/testdata/sf0.001")
    f = c.store
    one = R.score_one_user(f.uxp_features, f.user_features, f.product_features, c.r.products, 42)
    assert {r.user_id for r in one.collect()} <= {42}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "42" in plan and "SortMergeJoin" not in plan
