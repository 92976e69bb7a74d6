"""Physical-plan properties that matter at scale."""

import re

import pytest

from cartwise.operators import recommend as R
from cartwise.plans.registry import Ctx
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ctx(spark):
    return Ctx(spark, SF_SMALL)


def test_scoring_on_bucketed_tables_does_not_shuffle(spark, ctx):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        recs = R.recommend_by_basket(ctx.scored)
        plan = _plan(recs)
        shuffles = re.findall(r"(?<!Broadcast)Exchange ", plan)
        assert not shuffles, plan  # bucketed join + per-user window reuse the buckets
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_split_filter_prunes_partitions(ctx):
    from cartwise.operators.features import user_order_stats
    plan = _plan(user_order_stats(ctx.r.orders))
    assert "PartitionFilters: [isnotnull(eval_set" in plan and "prior" in plan


def test_projection_reaches_the_scan(ctx):
    from cartwise.operators.features import user_order_stats
    plan = _plan(user_order_stats(ctx.r.orders))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "order_id" not in scan.split("ReadSchema")[1]


def test_catalogue_broadcast_is_size_checked(spark, ctx):
    from cartwise.functions.skew import broadcast_bounded
    pf = ctx.store.product_features
    hinted = broadcast_bounded(pf, ctx.r.products, max_rows=1000)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    # beyond the bound the hint is not added
    big = broadcast_bounded(pf, ctx.r.products, max_rows=1)
    joined = ctx.store.uxp_features.join(big, "product_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_lines_orders_join_reads_buckets_without_shuffle(spark, ctx):
    from cartwise.operators.features import enriched_prior
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(enriched_prior(ctx.r.orders, ctx.r.prior))
        assert "SortMergeJoin" in plan
        assert not re.findall(r"(?<!Broadcast)Exchange ", plan), plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def _no_broadcasts(spark):
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(k, "-1")


def _broadcasts(spark):
    for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(k)


def _shuffles(df) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange ", _plan(df)))


@pytest.mark.parametrize("shuffle_partitions", ["2", "same", "64"])
def test_label_join_leaves_candidates_in_their_buckets(spark, ctx, shuffle_partitions):
    from cartwise.operators import dataset as D
    store = ctx.store
    before = spark.conf.get("spark.sql.shuffle.partitions")
    _no_broadcasts(spark)
    try:
        spark.conf.set("spark.sql.shuffle.partitions",
                       str(store.buckets) if shuffle_partitions == "same" else shuffle_partitions)
        cands = D.candidates(ctx.r.orders, store.uxp_features, buckets=store.buckets)
        joined = D.label_join(cands, ctx.r.train, ctx.r.orders, store.buckets)
        # label orders and label lines move to their user; the candidates do not
        assert _shuffles(cands) == 1 and _shuffles(joined) == 2, _plan(joined)
        master = D.train_master(ctx.r.orders, store.uxp_features, store.user_features, store.product_features,
                                ctx.r.train, catalogue=ctx.r.products, buckets=store.buckets)
        assert _shuffles(master) == 2, _plan(master)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        _broadcasts(spark)


def test_top_products_and_shares_move_counts_only(spark, ctx):
    from cartwise.operators import eda as E
    from cartwise.operators import features as FT
    _no_broadcasts(spark)
    try:
        top = _plan(E.eda_top_products(ctx.r.prior, ctx.r.products))
        lowest = top[top.rindex("Exchange hashpartitioning(product_id"):]
        assert "partial_count(1)" in lowest.split("FileScan")[0]
        share = FT.user_dept_share(ctx.store.uxp_features, ctx.r.products)
        assert _shuffles(share) <= 2 and "order_id" not in _plan(share)
    finally:
        _broadcasts(spark)


def test_catalogue_tables_are_not_written_by_one_task():
    import inspect
    from cartwise.sources import store, tables
    assert "coalesce(1)" not in inspect.getsource(tables) + inspect.getsource(store)


@pytest.mark.parametrize("grain", ["group", "part"])
def test_every_part_and_line_is_represented(spark, grain):
    from cartwise.sources.derive import purchases, read_source
    from cartwise.sources.tables import load_retail
    r = load_retail(spark, SF_SMALL, grain)
    part, lines = read_source(spark, SF_SMALL, "part"), read_source(spark, SF_SMALL, "lineitem")
    if grain == "part":
        assert {x.product_id for x in r.products.collect()} == {x.p_partkey for x in part.collect()}
        assert purchases(lines, part, grain).count() == lines.select("l_orderkey", "l_partkey").distinct().count()
    else:
        assert r.products.count() == part.select("p_brand", "p_type").distinct().count()
    kept = r.prior.unionByName(r.train).unionByName(r.test)
    assert kept.count() == purchases(lines, part, grain).count()
    assert kept.select("order_id").distinct().count() == lines.select("l_orderkey").distinct().count()
    assert kept.where("product_id < 0").count() == 0
