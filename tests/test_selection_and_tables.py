"""Exact order statistics, the exact split, whole replacement and type inference."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from cartwise.functions.selection import kth_smallest, quantile_cut
from cartwise.operators import dataset as D
from cartwise.operators import recommend as R
from cartwise.sources.infer import inferred_types, read_inferred, read_text_csv
from cartwise.sources.versioned import current_version, read_current, replace_table


@pytest.mark.parametrize("seed", range(3))
def test_kth_smallest(spark, seed):
    r = random.Random(seed)
    values = [r.choice([r.uniform(-1e9, 1e9), r.gauss(0, 1e-6), float(r.randrange(5)), 0.0]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "v double").repartition(3 + seed)
    for k in (1, 2, 137, 250, 499, 500):
        v = sorted(values)[k - 1]
        assert kth_smallest(df, F.col("v"), k) == (v, sum(x < v for x in values), sum(x == v for x in values))
    assert kth_smallest(df, F.col("v"), 0) is None and kth_smallest(df, F.col("v"), 501) is None
    assert quantile_cut(df, F.col("v"), 0.75) == sorted(values)[374]
    assert quantile_cut(df.limit(0), F.col("v"), 0.5) is None


@pytest.mark.parametrize("n", [0, 1, 4, 5, 1001])
def test_exact_split_holds_out_a_fifth(spark, n):
    rows = spark.createDataFrame([(i, i % 7, i % 3) for i in range(n)], "user_id long, product_id long, reordered int")
    got = [sorted(r.user_id for r in D.exact_split(rows.repartition(p)).where("is_validation").collect()) for p in (1, 5)]
    assert got[0] == got[1] and len(got[0]) == math.ceil(n / 5)


def test_exact_split_with_equal_keys(spark):
    rows = spark.createDataFrame([(1, 1, 0)] * 10, "user_id long, product_id long, reordered int")
    assert D.exact_split(rows).where("is_validation").count() >= 2      # rows of one key cannot be told apart


def test_bulk_buyers_get_both_rules(spark):
    scored = spark.createDataFrame([(u, p, f"p{p}", 1, 2.0, 0.9 - 0.1 * p) for u in (1, 2) for p in range(5)],
                                   "user_id long, product_id long, product_name string, aisle_id int, "
                                   "user_avg_basket_size double, probability double")
    got = R.recommend_personal(scored, spark.createDataFrame([(1,)], "user_id long"), also_above=0.55).collect()
    assert sorted((r.user_id, r.rec_rank) for r in got) == [(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (2, 2)]
    feats = spark.createDataFrame([(u, float(u)) for u in range(1, 9)], "user_id long, user_avg_basket_size double")
    share = spark.createDataFrame([(u, 1, 1.0 if u in (1, 8) else 0.5) for u in range(1, 9)]
                                  + [(u, 2, 0.5) for u in range(2, 8)], "user_id long, department_id int, dept_share double")
    bulk = {r.user_id: r.concentration for r in R.bulk_buyers(feats, share, narrow=0.8).collect()}
    assert bulk == {8: 1.0}
    assert R.bulk_buyers(feats.limit(0), share).count() == 0


def test_failed_write_leaves_the_old_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    with pytest.raises(FileNotFoundError):
        read_current(spark, path)
    replace_table(spark.range(5), path)
    broken = spark.range(100, numPartitions=4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("killed midway"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed midway"):
        replace_table(broken, path)
    assert sorted(r.id for r in read_current(spark, path).collect()) == list(range(5))
    old = read_current(spark, path)
    new = replace_table(old.select((F.col("id") + 10).alias("id")), path)       # from its own rows
    assert sorted(r.id for r in new.collect()) == list(range(10, 15))
    assert sorted(r.id for r in old.collect()) == list(range(5))                 # a reader of the version before
    assert len(current_version(spark, path)) == 2
    assert len([f for f in os.listdir(path) if f.startswith("v-")]) == 2         # the failed one is gone


def test_types_as_a_data_frame_library_infers_them(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.csv")
    with open(path, "w") as f:
        f.write("i,gap,d,e,b,bm,t,none,big,inf,q\n1,1,1.5,1e3,True,True,a,,9223372036854775807,inf,\"a,b\"\n"
                "-2,,2,.5,False,,1,NA,9223372036854775808,1,NA\n+3,3,NaN,7.,True,False,x,null,1,-inf,c\n")
    got = {r.column_name: r for r in inferred_types(read_text_csv(spark, path)).collect()}
    import pandas as pd
    names = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string", "str": "string", "uint64": "double"}
    want = {c: names[str(t)] for c, t in pd.read_csv(path).dtypes.items()}
    assert {c: r.type for c, r in got.items()} == want
    assert got["none"].n_missing == 3 and got["gap"].n_missing == 1
    rows = read_inferred(spark, path).collect()
    assert [r.gap for r in rows] == [1.0, None, 3.0] and [r.inf for r in rows] == [math.inf, 1.0, -math.inf]
    assert [r.q for r in rows] == ["a,b", None, "c"] and rows[0].b is True
