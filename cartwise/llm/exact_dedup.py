"""Exact duplicate removal by skew-safe combining (DataFrame functions only).

Two texts are equal when they are identical after deleting ASCII white space.
The comparison uses the whole normalised text at every stage:

1. *local*: the map side of a hash aggregation on (digest, salt, text) keeps one
   row per distinct text and task, so thousands of copies leave a task as one;
2. *salted merge*: the same aggregation after the shuffle.  Digests holding more
   than a thousandth of all rows (fewer than 1,000 of them, whatever the
   corpus) are dealt over ``SALTS`` salts, so no task meets all their partial
   rows;
3. *global*: the salt winners of those digests are merged on (digest, text).

Defined results: null text counts as empty; all empty texts are one group; the
row with the most code points in its original text stays, then the smallest
doc_id (a null doc_id comes last); of rows repeating the kept doc_id exactly
one is kept; an empty table gives no rows; other columns are ignored.  Two
different texts with one SHA-256 would stop the job with an error rather than
be merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import WHITE, spare, table, text_or_empty, written

SALTS = 32
HOT_SHARE = 1000        # a digest is hot above 1/HOT_SHARE of all rows

_BIG = "100000000000000000000"      # 10^20, above the range of an id's rank


def _normalised(text: str) -> Column:
    return F.regexp_replace(text_or_empty(text), f"{WHITE}+", "")


def _digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _winner(points: Column, doc_id: Column) -> Column:
    """One decimal ordering rows by code points, then by smaller doc_id (null
    last): a fixed-width value that a hash aggregation can update in place."""
    rank = F.coalesce(F.lit(9223372036854775807).cast("decimal(19,0)") - doc_id.cast("decimal(19,0)")
                      + F.lit(1).cast("decimal(1,0)"), F.lit(0).cast("decimal(1,0)"))
    return (points.cast("decimal(10,0)") * F.lit(_BIG).cast("decimal(21,0)") + rank).cast("decimal(38,0)")


def _winner_id(winner: Column) -> Column:
    rank = winner % F.lit(_BIG).cast("decimal(21,0)")
    return F.when(rank > 0, (F.lit(9223372036854775807).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)") - rank)
                  .cast("long"))


def _hot_digests(ids: DataFrame, total: int) -> DataFrame:
    """Digests with more than 1/HOT_SHARE of the rows: fewer than HOT_SHARE."""
    return (ids.groupBy("digest").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") * HOT_SHARE > total).select("digest"))


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per input row: doc_id, digest, keep_id, group_size, kept."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    norm = base.select("doc_id", F.length(text_or_empty()).alias("points"), _normalised("text").alias("norm"))
    norm = norm.withColumn("digest", _digest(F.col("norm")))
    ids = written(norm.select("doc_id", "digest", F.monotonically_increasing_id().alias("row")), "exact-ids")
    hot = written(_hot_digests(ids, ids.count()), "exact-hot")       # < HOT_SHARE rows

    salted = (norm.join(F.broadcast(hot.withColumn("is_hot", F.lit(True))), "digest", "left")
              .withColumn("salt", F.when(F.col("is_hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(-1)))
    merged = (salted.groupBy("digest", "norm", "salt")
              .agg(F.count(F.lit(1)).alias("n"), F.max(_winner(F.col("points"), F.col("doc_id"))).alias("winner")))
    merged = written(merged.select("digest", "salt", "n", "winner",
                                   F.when(F.col("salt") >= 0, F.col("norm")).alias("norm")), "exact-merged")
    cold = merged.where("salt < 0").select("digest", "n", "winner")
    top = (merged.where("salt >= 0").groupBy("digest", "norm")
           .agg(F.sum("n").alias("n"), F.max("winner").alias("winner"))
           .select("digest", "n", "winner"))

    def groups(df: DataFrame) -> DataFrame:
        one = df.groupBy("digest").agg(F.sum("n").alias("group_size"), F.max("winner").alias("winner"),
                                       F.count(F.lit(1)).alias("texts"))
        size = F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share one SHA-256"))).otherwise(F.col("group_size"))
        return one.select("digest", size.cast("long").alias("group_size"), _winner_id(F.col("winner")).alias("keep_id"))

    hot_rows = ids.join(F.broadcast(hot), "digest", "left_semi").join(F.broadcast(groups(top)), "digest")
    cold_rows = ids.join(F.broadcast(hot), "digest", "left_anti").join(groups(cold), "digest")
    rows = written(hot_rows.unionByName(cold_rows), "exact-rows")
    # of rows that repeat the kept id, the first one stays
    first = (rows.where(F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("group_size") > 1))
             .groupBy("digest").agg(F.min("row").alias("first_row")))
    first_hot = first.join(F.broadcast(hot), "digest", "left_semi")
    first_cold = first.join(F.broadcast(hot), "digest", "left_anti")
    out = (rows.join(F.broadcast(hot), "digest", "left_semi").join(F.broadcast(first_hot), "digest", "left")
           .unionByName(rows.join(F.broadcast(hot), "digest", "left_anti").join(first_cold, "digest", "left")))
    kept = F.when(F.col("group_size") == 1, F.lit(True)).otherwise(F.col("row") == F.col("first_row"))
    return out.select("doc_id", "digest", "keep_id", "group_size", kept.alias("kept"))


def deduplicate(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the copies (all columns of the kept rows)."""
    d, f, i = (spare(docs, n) for n in ("_digest", "_first", "_id"))
    # a key without nulls: the join, and the numbering of repeated rows, share one shuffle of the texts
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    kept = exact_groups(docs, text, doc_id).where("kept").select(
        F.col("digest").alias(d), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(i))
    out = docs.withColumn(d, _digest(_normalised(text))).withColumn(i, key).join(kept, [d, i], "left_semi")
    first = F.row_number().over(Window.partitionBy(d, i).orderBy(F.length(text).desc()))
    return out.withColumn(f, first).where(F.col(f) == 1).select(*docs.columns)


def op3(spark, sf_dir: str) -> DataFrame:
    return (exact_groups(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST) = 1 AS kept,
       text_sha256
FROM d
"""
