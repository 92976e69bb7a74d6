"""Steps that grow with the input: how often rows move, and what a task holds."""

from pyspark.sql import functions as F

from cartwise.operators import features as FT
from cartwise.functions.skew import has_hot_key, window_number
from cartwise.sources import derive as S
from cartwise.sources import tables as T


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _raw(spark):
    orders = spark.createDataFrame([(o, o % 7 if o % 11 else None, f"2020-01-{1 + o % 28:02d}") for o in range(1, 200)],
                                   "o_orderkey long, o_custkey long, o_orderdate string")
    lines = spark.createDataFrame([(o, 1 + (o * n) % 9, n) for o in range(1, 200) for n in range(1, 4)]
                                  + [(None, 1, 1), (5, None, 9), (5, 1, 9)], "l_orderkey long, l_partkey long, l_linenumber int")
    part = spark.createDataFrame([(p, f"part {p}", f"Brand#{p % 3}", "SMALL" if p % 2 else "LARGE") for p in range(1, 10)],
                                 "p_partkey long, p_name string, p_brand string, p_type string")
    return orders, lines, part


def test_lines_move_to_their_order_once(spark):
    orders, lines, part = _raw(spark)
    numbered = S.derive_orders(orders).localCheckpoint()
    plain, dealt = (S.derive_lines(lines, numbered, part, "group", False, n) for n in (None, 5))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, dealt.collect()))
    deal = S.purchases(lines, part, "group", 5)
    assert _exchanges(window_number(deal, "order_id", ["first_line", "product_id"], "n")) == 1
    assert "REPARTITION_BY_NUM" in deal._jdf.queryExecution().executedPlan().toString()


def test_pairs_move_to_their_user_once(spark):
    orders, lines, part = _raw(spark)
    numbered = S.derive_orders(orders).localCheckpoint()
    prior = S.split_lines(S.derive_lines(lines, numbered, part, "group", False).localCheckpoint())["prior"]
    plain, dealt = (FT.uxp_features(numbered, prior, n) for n in (None, 5))
    key = lambda rows: sorted(map(str, rows))
    assert key(plain.collect()) == key(dealt.collect())
    assert "hashpartitioning(user_id" in dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt.rdd.getNumPartitions() == 5


def test_hot_keys_are_sought_among_few_groups(spark):
    """The check shuffles groups of keys; keys are counted only where a group is hot."""
    even = spark.range(3000).select((F.col("id") % 1500).alias("k"))
    hot = even.unionByName(spark.range(400).select(F.lit(None).cast("long").alias("k")))
    assert not has_hot_key(even, "k", 300) and has_hot_key(hot, "k", 300) and not has_hot_key(hot, "k", 400)
    # two keys of one group, neither of them hot: counted one by one
    crowd = spark.range(1000).select((F.col("id") % 100).alias("k"))
    assert not has_hot_key(crowd, "k", 20) and has_hot_key(crowd, "k", 9)


def test_a_bucket_stays_small_at_scale(spark):
    """Ten times the rows make more buckets, not larger ones."""
    for rows in (36_000_000, 216_000_000):
        assert -(-rows // T.bucket_count_for(spark, rows)) <= 1_000_000


def test_packed_csv_reads_as_plain(spark, tmp_dir):
    import glob
    from cartwise.sources.files import write_csv
    from cartwise.sources.infer import inferred_types, read_inferred, read_text_csv
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, None), (3, "c,\"d\"", 1.0)], "i long, s string, d double")
    got = {}
    for how in (None, "gzip"):
        write_csv(df, f"{tmp_dir}/{how}", how)
        got[how] = [sorted(map(str, f(spark, f"{tmp_dir}/{how}").collect())) for f in
                    (lambda s, p: inferred_types(read_text_csv(s, p)), read_inferred)]
    assert got[None] == got["gzip"] and glob.glob(f"{tmp_dir}/gzip/*.gz")


def test_written_scores_serve_both_lists_in_place(spark, tmp_dir):
    """Two aggregates of the written scores: each candidate is scored once and no
    row moves."""
    from cartwise.operators import recommend as R
    from cartwise.sources.store import write_scored
    scored = spark.createDataFrame([(i % 9, i, f"p{i}", i / 100, 1) for i in range(100)],
                                   "user_id long, product_id long, product_name string, probability double, aisle_id int")
    back = write_scored(scored, "cw_test_scale", f"{tmp_dir}/s", 4)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, scored.collect()))
    for df, want in ((R.recommend_counts(back), R.recommend_counts(scored)), (R.recommend_threshold(back), R.recommend_threshold(scored))):
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))
    spark.sql("DROP TABLE cw_test_scale_scored")
