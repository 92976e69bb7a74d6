"""Mixing sources to target weights by weighted fair queueing (DataFrame
functions only).

Each source's documents are shuffled by a hash of their id and laid end to end,
up to ``max_repeats`` times over.  A copy's *virtual finish time* is the number
of its source's words up to its own end, divided by the source's target.  The
mix is all copies in order of virtual finish time, cut where the total budget
(the sum of the targets) is reached.

Running sums never gather a source in one task: a source is cut into hash
ranges, the ranges' totals give each range its base, and rows are summed
inside a range.  The global order works the same way on ranges of virtual
time, which weighted fair queueing fills evenly.

Defined results: null text has size 0; the null source is a source, last in
order; a source of size 0 has target 0 and nothing of it is taken; documents
of size 0 take 0; rows that repeat a doc_id are mixed as rows of their own;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.skew import sized_broadcast
from .common import WORD, spare, table, text_or_empty, written

WEIGHTS = (1, 2, 3)          # dealt to the sources in code point order, repeating
MAX_REPEATS = 3
ROWS_PER_RANGE = 2_000
MAX_RANGES = 1 << 16
SEED = "mix"


def _ranges(rows: int) -> int:
    n = 1
    while n < MAX_RANGES and n * ROWS_PER_RANGE < rows:
        n *= 2
    return n


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Per source: source, source_rank, source_size, target.

    Targets share the total by weight; one that would exceed ``max_repeats``
    times its source stops there and the rest is shared again.  In order of
    (limit / weight) the stopped sources come first, so running sums give the
    level at which the sharing settles.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("source_rank", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.col("source_rank") - 1) % len(weights) + 1).cast("int")).cast("long")
    per = per.withColumn("weight", weight).withColumn("lim", F.col("source_size") * max_repeats)
    order = Window.orderBy((F.col("lim") / F.col("weight")).asc(), F.col("source_rank"))
    everything = Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("lim").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    per = per.withColumn("level", left.cast("double") / weight_left.cast("double"))
    per = per.withColumn("stopped", F.col("lim").cast("double") / F.col("weight") < F.col("level"))
    settled = F.max(F.when(~F.col("stopped"), F.col("level"))).over(everything)
    return per.select("source", "source_rank", "source_size",
                      F.when(F.col("stopped"), F.col("lim").cast("double"))
                      .otherwise(settled * F.col("weight")).alias("target"))


def _running(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``name`` = running sum of ``value`` over (keys[:-1]) in the order of
    (keys[-1], *order), where keys[-1] is a range number."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_total"))
    w = Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.withColumn("_base", F.coalesce(F.sum("_total").over(w), F.lit(0))).drop("_total")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (df.withColumn("_inside", F.sum(value).over(inside)).join(bases, keys)
            .withColumn(name, F.col("_base") + F.col("_inside")).drop("_base", "_inside"))


def virtual_times(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
                  weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """Written table: doc_id, source, size, hash, source_rank, source_size,
    target, upto (its source's words up to its end, first time round)."""
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    shuffled = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")).cast("binary"))
    sized = written(sized.select("doc_id", "source", word_count().alias("size"), shuffled.alias("hash")), "mix-sizes")
    ranges = _ranges(sized.count())
    targets = written(source_targets(sized, weights, max_repeats), "mix-targets")
    t = targets.withColumnRenamed("source", "_source")
    rows = sized.join(sized_broadcast(t, 100_000), sized["source"].eqNullSafe(t["_source"])).drop("_source")
    at = (F.conv(F.substring("hash", 1, 4), 16, 10).cast("long") * ranges / MAX_RANGES).cast("long")
    rows = rows.withColumn("_range", at)
    rows = _running(rows, ["source_rank", "_range"], ["hash", "doc_id", "size"], "size", "upto")
    return written(rows.drop("_range"), "mix-virtual")


def _finish(k, upto: Column | None = None, of: Column | None = None) -> Column:
    """Virtual finish time of a document's copy ``k`` (0 = the first); null
    when the source has no target.  ``of``: the struct that holds the values."""
    value = (lambda name: of[name]) if of is not None else F.col
    end = value("upto") if upto is None else upto
    return F.when(value("target") > 0, (F.lit(k) * value("source_size") + end).cast("double") / value("target"))


def _place(k, finish: Column) -> Column:
    return F.struct(finish.alias("finish"), F.col("source_rank"), F.col("hash"), F.col("doc_id"), F.col("size"), F.lit(k).alias("k"))


def copies(virtual: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per possible copy with its virtual finish time."""
    each = F.array(*[F.struct(F.lit(k).alias("k"), _finish(k).alias("finish")) for k in range(max_repeats)])
    return (virtual.where("size > 0 AND target > 0").withColumn("_copy", F.explode(each))
            .select("*", F.col("_copy.k").alias("k"), F.col("_copy.finish").alias("finish")).drop("_copy"))


def cutoff(virtual: DataFrame, max_repeats: int = MAX_REPEATS):
    """The place of the last copy in the mix (a Row; None when nothing is).

    A copy is in the mix while the copies before it hold fewer words than the
    budget.  Ranges of virtual time are totalled first; only the range where
    the budget ends is summed row by row.
    """
    stats = virtual.agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("budget")).first()
    if not stats["budget"]:
        return None
    ranges = _ranges(stats["rows"] * max_repeats)
    at = F.least((F.col("finish") * ranges), F.lit(float(4 * ranges))).cast("long")
    every = copies(virtual, max_repeats).withColumn("_range", at)
    totals = every.groupBy("_range").agg(F.sum("size").alias("words"))           # at most 4 * MAX_RANGES rows
    upto = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    crossing = (totals.withColumn("upto_range", F.sum("words").over(upto))
                .where(F.col("upto_range") >= stats["budget"]).orderBy("_range").limit(1)).first()
    before = crossing["upto_range"] - crossing["words"]
    order = ["finish", "source_rank", "hash", "doc_id", "size", "k"]
    run = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = (every.where(F.col("_range") == crossing["_range"])
            .withColumn("_after", F.sum("size").over(run) + F.lit(before))
            .where(F.col("_after") - F.col("size") < stats["budget"])
            .agg(F.max(F.struct(*order)).alias("place")).first())
    return last["place"]


def _taken(place, max_repeats: int) -> Column:
    """How many copies of a row are in the mix."""
    if place is None:
        return F.lit(0)
    values = [F.lit(place["finish"]), F.lit(place["source_rank"]), F.lit(place["hash"]),
              F.lit(place["doc_id"]).cast("long"), F.lit(place["size"]), F.lit(place["k"])]
    names = ["finish", "source_rank", "hash", "doc_id", "size", "k"]
    last = F.struct(*[v.alias(n) for v, n in zip(values, names)])
    return sum((F.when(F.col("size").isNotNull() & (F.col("size") > 0) & _finish(k).isNotNull()
                       & (_place(k, _finish(k)) <= last), 1).otherwise(0) for k in range(max_repeats)), F.lit(0))


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", weights=WEIGHTS,
        max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    virtual = virtual_times(docs, text, doc_id, source, weights, max_repeats, seed)
    n = _taken(cutoff(virtual, max_repeats), max_repeats)
    return (virtual.withColumn("copies", n)
            .withColumn("taken", (F.col("size") * F.col("copies")).cast("long")))


def mixed_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source",
                    weights=WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, repeated as often as they are
    taken, in global order of virtual finish time (range sorted)."""
    chosen = mix(docs, text, doc_id, source, weights, max_repeats, seed).where("copies > 0")
    row, finish, key, group = (spare(docs, n) for n in ("_row", "_finish", "_key", "_group"))

    # The key has no nulls, so numbering and join share one shuffle of the texts.
    def name(i: Column, o: Column, z: Column) -> Column:
        return F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("-")), z.cast("string"),
                           F.when(o.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), o)))

    # Rows that agree in id, source and size follow each other in their source, and earlier
    # ones are taken as often or oftener: how many are taken k times describes them all.
    least = [F.sum(F.when(F.col("copies") > k, 1).otherwise(0)).alias(f"c{k}") for k in range(max_repeats)]
    values = [F.min(c).alias(c) for c in ("upto", "size", "source_size", "target")]
    chosen = (chosen.groupBy(name(F.col("doc_id"), F.col("source"), F.col("size")).alias(key)).agg(*values, *least))
    chosen = chosen.select(key, F.struct(*[c for c in chosen.columns if c != key]).alias(group))
    keyed = docs.withColumn(key, name(F.col(doc_id), F.col(source), word_count(text)))
    keyed = keyed.withColumn(row, F.row_number().over(Window.partitionBy(key).orderBy(F.length(text))))
    out = keyed.join(chosen, key)
    own = F.col(group)
    upto = own["upto"] + (F.col(row) - 1) * own["size"]
    times = F.array(*[F.when(F.col(row) <= own[f"c{k}"], _finish(k, upto, own)) for k in range(max_repeats)])
    out = out.withColumn(finish, F.explode(F.array_compact(times)))
    return out.repartitionByRange(finish, doc_id).sortWithinPartitions(finish, doc_id).select(*docs.columns)


def op7(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':mix') AS hash
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS z, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM d GROUP BY source),
s1 AS (SELECT *, 1 + (rk - 1) % 3 AS w FROM s0),
s2 AS (SELECT *, (3 * z)::DOUBLE / w AS edge,
              ((SELECT sum(z) FROM s1) - coalesce(sum(3 * z) OVER o, 0))::DOUBLE
              / ((SELECT sum(w) FROM s1) - coalesce(sum(w) OVER o, 0))::DOUBLE AS lev
       FROM s1 WINDOW o AS (ORDER BY (3 * z)::DOUBLE / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, rk, z, CASE WHEN edge < lev THEN (3 * z)::DOUBLE
             ELSE (SELECT max(lev) FROM s2 WHERE edge >= lev) * w END AS target FROM s2),
c AS (SELECT d.doc_id, d.size, d.hash, t.rk, t.z, t.target,
             sum(d.size) OVER (PARTITION BY t.rk ORDER BY d.hash, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT c.*, k.k, (k.k * z + upto)::DOUBLE / target AS finish
      FROM c, (VALUES (0), (1), (2)) k(k) WHERE size > 0 AND target > 0),
f AS (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, rk, hash, doc_id, size, k ROWS UNBOUNDED PRECEDING) - size AS before FROM e),
g AS (SELECT doc_id, sum(size)::BIGINT AS taken FROM f WHERE before < (SELECT sum(size) FROM d) GROUP BY doc_id)
SELECT c.doc_id, c.size, c.z AS source_size, c.target, coalesce(g.taken, 0)::BIGINT AS taken
FROM c LEFT JOIN g ON c.doc_id = g.doc_id
"""
