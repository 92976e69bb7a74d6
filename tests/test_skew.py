"""Skew safety: one key holding a third of all rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwise.functions.skew import sequence_number, sized_broadcast, top_k_per_group


def _hot_frame(spark, n=30_000):
    # key 0 holds a third of the rows, the rest spread over 2,000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        ((F.col("id") * 7919) % 100_003).alias("v"),
        F.col("id"))


def test_sequence_number_matches_row_number_with_hot_key(spark):
    df = _hot_frame(spark)
    got = sequence_number(df, "k", ["v", "id"], "seq", partitions=8)
    want = df.withColumn("seq", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")))
    diff = got.select("id", "seq").exceptAll(want.select("id", "seq"))
    assert diff.count() == 0
    assert got.count() == df.count()


def test_adaptive_numbering_detects_hot_key_and_agrees(spark, monkeypatch):
    from cartwise.functions import skew
    hot = _hot_frame(spark)
    even = spark.range(30_000).select((F.col("id") % 3000).alias("k"), F.col("id").alias("v"), F.col("id"))
    monkeypatch.setattr(skew, "HOT_ROWS", 5_000)        # an absolute number of rows, whatever the partitions
    assert skew.has_hot_key(hot, "k") and not skew.has_hot_key(even, "k")
    for df in (hot, even):
        got = skew.adaptive_sequence_number(df, "k", ["v", "id"], "seq")
        want = df.withColumn("seq", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")))
        assert got.select("id", "seq").exceptAll(want.select("id", "seq")).count() == 0


def test_hot_key_spans_several_partitions(spark):
    df = _hot_frame(spark)
    ranged = df.repartitionByRange(8, "k", "v", "id").withColumn("p", F.spark_partition_id())
    parts = ranged.where("k = 0").select("p").distinct().count()
    assert parts >= 2  # 10,000 rows of one key are not in a single task


def test_sequence_number_with_nulls_and_small_groups(spark):
    rows = [(None, 1), (None, 2), (1, 5), (1, 3), (2, 9)]
    df = spark.createDataFrame(rows, "k long, v long")
    got = {(r.k, r.v): r.seq for r in sequence_number(df, "k", ["v"], "seq", partitions=4).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, (1, 3): 1, (1, 5): 2, (2, 9): 1}


def test_top_k_is_limited_before_the_shuffle(spark):
    df = _hot_frame(spark)
    top = top_k_per_group(df, "k", [F.desc("v")], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert top.where("k = 0").count() == 3


def test_sized_broadcast_respects_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert "ResolvedHint" in small.join(sized_broadcast(small, 100), "id")._jdf.queryExecution().analyzed().toString() \
        or "broadcast" in small.join(sized_broadcast(small, 100), "id")._jdf.queryExecution().optimizedPlan().toString().lower()
    plan = big.join(sized_broadcast(big, 100), "id")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "broadcast" not in plan


def test_sized_broadcast_respects_bytes(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    from cartwise.functions.skew import _fits
    assert _fits(wide, 100, 20_000) and not _fits(wide, 100, 5_000)


def test_bucket_count_follows_data(spark):
    from cartwise.sources.tables import ROWS_PER_BUCKET, bucket_count_for
    assert bucket_count_for(spark, None) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert bucket_count_for(spark, 10) == spark.sparkContext.defaultParallelism
    assert bucket_count_for(spark, ROWS_PER_BUCKET * 10_000) == 10_000      # no cap by shuffle partitions
    assert bucket_count_for(spark, ROWS_PER_BUCKET * 200_000) == 0          # beyond Spark's limit: no buckets


def test_lineage_scopes_of_threads_keep_apart(spark):
    import os
    import threading
    from cartwise.functions.skew import cut_lineage, lineage_scope
    made = {}

    def other():
        with lineage_scope(spark) as paths:
            cut_lineage(spark.range(3), label="other")
            made["other"] = list(paths)

    with lineage_scope(spark) as paths:
        t = threading.Thread(target=other)
        t.start()
        t.join()
        mine = cut_lineage(spark.range(5), label="mine")
        assert len(paths) == 1 and paths[0] not in made["other"] and len(made["other"]) == 1
        assert mine.count() == 5 and not os.path.exists(made["other"][0].replace("file:", ""))


def test_no_machine_local_folder_on_a_cluster():
    import pytest
    from cartwise.session import ensure_checkpoint_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_first_purchase_join_splits_a_hot_pair(spark, monkeypatch):
    """A user who buys one product in most orders: the join that finds the
    first purchase is split by the adaptive skew join."""
    from cartwise.functions import skew
    from cartwise.sources.derive import derive_lines
    monkeypatch.setattr(skew, "HOT_ROWS", 1_000)
    n = 60_000
    orders = spark.range(n).select(F.col("id").alias("order_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
                                   .cast("long").alias("user_id"), (F.col("id") + 1).cast("int").alias("order_number"),
                                   F.lit("prior").alias("eval_set"))
    lines = orders.select(F.col("order_id").alias("l_orderkey"), F.when(F.col("user_id") == 7, 1)
                          .otherwise(F.col("order_id") % 50).cast("long").alias("l_partkey"), F.lit(1).alias("l_linenumber"))
    part = spark.range(50).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
                                  F.lit("PROMO").alias("p_type"))
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.files.maxPartitionBytes": "16k",
            "spark.sql.files.openCostInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = derive_lines(lines, orders, part, "part")
        rows = out.groupBy("reordered").count().collect()
        assert sum(r["count"] for r in rows) == n
        out.write.format("noop").mode("overwrite").save()
        checked = derive_lines(lines, orders, part, "part")
        checked.collect()
        plan = checked._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_hot_key_check_on_empty_input(spark):
    from cartwise.functions.skew import has_hot_key
    assert not has_hot_key(spark.createDataFrame([], "k long"), "k")


def test_settings_in_the_booster_s_terms():
    from cartwise.operators.boosting import Setting
    from cartwise.operators.model import BASE_PARAMS, TUNED_PARAMS
    base, tuned = Setting.of(BASE_PARAMS), Setting.of(TUNED_PARAMS)
    assert (base.n_estimators, base.learning_rate, base.max_depth, base.subsample, base.gamma) == (1000, 0.05, 6, 1.0, 0.0)
    assert (tuned.n_estimators, tuned.max_depth) == (938, 10) and 0.6 < tuned.subsample < 0.7 and tuned.gamma > 1.5


def test_lineage_scope_deletes_intermediate_copies(spark):
    import os
    from cartwise.functions.skew import cut_lineage, lineage_scope
    with lineage_scope(spark) as paths:
        df = cut_lineage(spark.range(10), label="scope-test")
        assert df.count() == 10 and len(paths) == 1
        local = paths[0].replace("file:", "")
        assert os.path.exists(local)
    assert not os.path.exists(local)
