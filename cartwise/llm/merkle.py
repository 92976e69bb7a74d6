"""Merkle manifest of a table: a root that fixes every row, and a proof per row.

Leaves (SHA-256 of a row's length-prefixed fields) are ordered by id within their
source; every ``FAN`` consecutive nodes are hashed into one until one is left, the
source's subroot, and the subroots, ordered by source, give the root the same way.

Method (cogrouped subtree exchange).  Leaves get their place by a range shuffle
(runs of a source are numbered per range and stitched by their lengths, so a
source with a third of all rows spans many tasks).  ``SUPER`` = 16^3 consecutive
leaves are a superblock: one group of a grouped map reduces it to one node, and
the few nodes above are reduced by the same step until each tree has one.  On the
way back every superblock needs only the *outer nodes*, the siblings of its
ancestors: one row a superblock.  Leaves and outer rows are cogrouped by
superblock, and that one function finishes the local reduction, joins local and
outer siblings into each leaf's proof, hashes it, and folds original and tampered
leaves up to the root.  Sources smaller than half a superblock share groups.

Defined results: a null field counts as ``-``; null ids come first within their
source and a null source first among sources; rows with equal ids are ordered by
their leaf, so repeated rows have equal leaves in neighbouring places; a null id is
never tampered; an empty table gives no rows; other columns are ignored.  A group
holds at most about two superblocks of digests, whatever the length of the texts.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.skew import sized_broadcast
from .common import table, written

FAN = 16
DEPTH = 3
SUPER = FAN ** DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OUTER = "tree long, pos long, before array<string>, after array<string>, subroot string, root string"
RESULT = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean")


# ---- leaves and their places -------------------------------------------------------

def _field(value: Column) -> Column:
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_of(text: Column, fields=FIELDS) -> Column:
    """Digest of a row's fields, with ``text`` in place of the last one."""
    return F.unhex(F.sha2(F.concat(*[_field(F.col(f)) for f in fields[:-1]], _field(text)).cast("binary"), 256))


def _ranges(df: DataFrame, order: list[str], label: str) -> DataFrame:
    """``df`` range-sorted and written, with its range and a rising number in it."""
    return written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), label)


def placed(leaves: DataFrame) -> DataFrame:
    """``leaves`` (source, doc_id, leaf, ...) with ``tree`` (rank of the source, from
    0), ``pos`` (place in the source, from 0) and ``n`` (leaves of the source)."""
    ranged = _ranges(leaves, ["source", "doc_id", "leaf"], "merkle-leaves")
    runs = written(ranged.groupBy("_part", "source").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_len")),
                   "merkle-runs")                                  # one row per range and source
    sources = _ranges(runs.select("source").distinct(), ["source"], "merkle-sources")
    parts = sources.groupBy("_part").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_k"))     # a row per range
    parts = parts.withColumn("_base", F.sum("_k").over(Window.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_k"))
    sources = (sources.join(F.broadcast(parts.drop("_k")), "_part")
               .select(F.col("source").alias("_source"), (F.col("_base") + F.col("_at") - F.col("_low")).alias("tree")))
    by_source = Window.partitionBy("source")
    runs = (runs.withColumn("n", F.sum("_len").over(by_source))
            .withColumn("_before", F.sum("_len").over(by_source.orderBy("_part")) - F.col("_len")))
    runs = written(runs.join(sources, runs["source"].eqNullSafe(sources["_source"])).select(
        F.col("_part").alias("_p"), "_source", "_first", "_before", "n", "tree"), "merkle-places")
    at = F.col("_before") + F.col("_at") - F.col("_first")
    return (ranged.join(sized_broadcast(runs), (F.col("_part") == F.col("_p")) & F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("pos", at).drop("_part", "_at", "_p", "_source", "_first", "_before", "source"))


def _unit(nodes: DataFrame, total: int) -> DataFrame:
    """The group of each node: its superblock, or for small trees one of about
    ``total`` / ``SUPER`` shared groups."""
    shared = F.pmod(F.xxhash64("tree"), F.lit(max(1, total // SUPER)))
    block = F.floor(F.col("pos") / SUPER).cast("long")
    return (nodes.withColumn("block", block)
            .withColumn("unit", F.when(F.col("n") > SUPER // 2, F.xxhash64("tree", "block")).otherwise(shared)))


# ---- in tasks ------------------------------------------------------------------------

def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(digests: list[str], whole: bool) -> list[list[str]]:
    """Node digests level by level: ``DEPTH`` levels of a superblock, or up to the
    single node when the block is the whole tree."""
    levels = [digests]
    while len(levels[-1]) > 1 if whole else len(levels) <= DEPTH:
        cur = levels[-1]
        levels.append([_hash("".join(cur[i:i + FAN])) for i in range(0, len(cur), FAN)])
    return levels


def _siblings(levels: list[list[str]], i: int) -> tuple[list[str], list[str]]:
    """Concatenated siblings before and after node ``i``'s ancestors, per level."""
    before, after = [], []
    for cur in levels[:-1]:
        start = i - i % FAN
        before.append("".join(cur[start:i]))
        after.append("".join(cur[i + 1:start + FAN]))
        i //= FAN
    return before, after


def _fold(leaf: str, before, after) -> str:
    for b, a in zip(before, after):
        leaf = _hash(b + leaf + a)
    return leaf


def _by_block(pdf):
    pdf = pdf.sort_values(["tree", "pos"], kind="stable")
    for (tree, block), rows in pdf.groupby(["tree", "block"], sort=False):
        n = int(rows["n"].iloc[0])
        yield int(tree), int(block), n, rows, _levels([bytes(d).hex() for d in rows["digest"]], n <= SUPER)


def _up(pdf):
    import pandas as pd
    out = [(t, b, bytes.fromhex(levels[-1][0]), -(-n // SUPER)) for t, b, n, _, levels in _by_block(pdf)]
    return pd.DataFrame(out, columns=["tree", "pos", "digest", "n"])


def _outer_rows(outer) -> dict:
    return {(int(r.tree), int(r.pos)): r for r in outer.itertuples(index=False)}


def _down(pdf, outer):
    """Outer rows of the nodes themselves: local siblings, then those above."""
    import pandas as pd
    above, out = _outer_rows(outer), []
    for t, b, _, rows, levels in _by_block(pdf):
        up = above[(t, b)]
        for i, pos in enumerate(rows["pos"]):
            before, after = _siblings(levels, i)
            out.append((t, int(pos), before + list(up.before), after + list(up.after), up.subroot, up.root))
    return pd.DataFrame(out, columns=["tree", "pos", "before", "after", "subroot", "root"])


def _prove(pdf, outer):
    import pandas as pd
    above, out = _outer_rows(outer), []
    for t, b, _, rows, levels in _by_block(pdf):
        up = above[(t, b)]
        rest = "".join(x + y for x, y in zip(up.before, up.after))
        up_before, up_after = list(up.before), list(up.after)
        for i, (doc_id, changed) in enumerate(zip(rows["doc_id"], rows["changed"])):
            before, after = _siblings(levels, i)
            proof = _hash("".join(x + y for x, y in zip(before, after)) + rest)
            start = levels[0][i] if changed is None else bytes(changed).hex()
            folded = _fold(start, before + up_before, after + up_after)
            out.append((doc_id, levels[0][i], up.subroot, up.root, proof, folded, folded == up.root))
    return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"doc_id": "Int64"})


# ---- the manifest ----------------------------------------------------------------------

NODE = "tree long, pos long, digest binary, n long"


def _reduced(nodes: DataFrame, total: int) -> tuple[list[DataFrame], DataFrame]:
    """Tables of nodes from ``nodes`` up to one node per tree, which is the last."""
    levels = [nodes]
    while True:
        step = written(_unit(levels[-1].select("tree", "pos", "digest", "n"), total).groupBy("unit").applyInPandas(_up, NODE),
                       "merkle-up")
        levels.append(step)
        total = -(-total // SUPER)
        if (step.agg(F.max("n")).first()[0] or 0) <= 1:
            return levels, step


def _exchanged(nodes: DataFrame, outer: DataFrame, total: int, function, schema: str) -> DataFrame:
    """Nodes and the outer rows of their superblocks, cogrouped by superblock."""
    sizes = nodes.groupBy("tree").agg(F.max("n").alias("n"))
    blocks = outer.join(sizes, "tree").withColumn("at", F.col("pos")).withColumn("pos", F.col("at") * SUPER)
    rows = _unit(blocks, total).select("unit", "tree", F.col("at").alias("pos"), "before", "after", "subroot", "root")
    return _unit(nodes, total).groupBy("unit").cogroup(rows.groupBy("unit")).applyInPandas(function, schema)


def manifest(docs: DataFrame, tampered: Column | None = None, fields=FIELDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, and
    folded_root, the root recomputed through the proof from the row as ``tampered``
    gives its text (null: unchanged); verified where it equals root."""
    text = F.col(fields[-1])
    changed = F.lit(None).cast("binary") if tampered is None else F.when(tampered.isNotNull(), leaf_of(tampered, fields))
    leaves = docs.select(F.col("source"), F.col("doc_id"), leaf_of(text, fields).alias("leaf"), changed.alias("changed"))
    places = written(placed(leaves).withColumnRenamed("leaf", "digest"), "merkle-placed")
    total = places.count()
    levels, subroots = _reduced(places, total)
    n_sources = subroots.count()
    tops = written(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest",
                                   F.lit(n_sources).cast("long").alias("n")), "merkle-subroots")
    above, root = _reduced(tops, n_sources)
    outer = root.select("tree", "pos", F.array().cast("array<string>").alias("before"),
                        F.array().cast("array<string>").alias("after"), F.lit("").alias("subroot"),
                        F.lower(F.hex("digest")).alias("root"))
    for nodes in reversed(above[:-1]):
        outer = written(_exchanged(nodes, outer, n_sources, _down, OUTER), "merkle-outer")
    # a subroot's outer row becomes that of its source's top node
    subs = subroots.select("tree", F.lower(F.hex("digest")).alias("subroot"))
    outer = (outer.select(F.col("pos").alias("tree"), F.lit(0).cast("long").alias("pos"), "before", "after", "root")
             .join(subs, "tree").select("tree", "pos", "before", "after", "subroot", "root"))
    for nodes in reversed(levels[1:-1]):
        outer = written(_exchanged(nodes, outer, total, _down, OUTER), "merkle-outer")
    return _exchanged(levels[0], outer, total, _prove, RESULT)


def lowered_where_chosen(text: str = "text", doc_id: str = "doc_id") -> Column:
    """The tampering of ``op13``: A-Z lower-cased where 5 divides the id's crc32."""
    chosen = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate(text, UPPER, LOWER))


def op13(spark, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), lowered_where_chosen())


# ---- SQL ----------------------------------------------------------------------------------

def _sql(leaf_levels: int = 7, source_levels: int = 4) -> str:
    """Plain restatement, level by level (16^7 leaves a source, 16^4 sources)."""
    field = lambda c, e: f"coalesce(strlen(CAST({e} AS VARCHAR)) || ':' || {e}, '-')"
    head = " || ".join(field(c, c) for c in FIELDS[:-1])
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    bits = "flatten(list_transform(range(1, strlen(s) + 1), lambda i: [ascii(s[i]), -1, -1, -1, -1, -1, -1, -1, -1]))"
    out = [f"""
l AS (SELECT doc_id, source, sha256({head} || {field('text', 'text')}) AS d0, sha256({head} || {field('text', low)}) AS t0,
             CAST(doc_id AS VARCHAR) AS s FROM documents),
c AS (SELECT *, CASE WHEN s IS NULL THEN 1 ELSE xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}),
        lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 5 END AS m FROM l),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, d0) - 1 AS pos,
             count(*) OVER (PARTITION BY source) AS n FROM c),
n0 AS (SELECT source, pos, d0 AS d, n FROM p)"""]
    fold = "SELECT doc_id, d0, source, pos, '' AS proof, CASE WHEN m = 0 THEN t0 ELSE d0 END AS cur FROM p"
    out.append(f"f0 AS ({fold})")

    def level(prefix, k, key):
        same = f"r.{key} IS NOT DISTINCT FROM f.{key}" if key else "true"
        part = f"{key}, " if key else ""
        out.append(f"""{prefix}r{k} AS (SELECT {part}pos // 16 AS pos, n, list(d ORDER BY pos) AS ds FROM {prefix}n{k}
 WHERE n > 1 GROUP BY {part}pos // 16, n)""")
        out.append(f"""{prefix}n{k + 1} AS (SELECT {part}pos, sha256(array_to_string(ds, '')) AS d, (n + 15) // 16 AS n FROM {prefix}r{k}
 UNION ALL SELECT {part}pos, d, n FROM {prefix}n{k} WHERE n <= 1)""")
        before, after = "array_to_string(ds[:f.pos % 16], '')", "array_to_string(ds[f.pos % 16 + 2:], '')"
        keep = "f.source, " + ("" if key else "f.subroot, ")
        out.append(f"""{prefix}f{k + 1} AS (SELECT f.doc_id, f.d0, {keep}f.pos // 16 AS pos,
  CASE WHEN ds IS NULL THEN proof ELSE proof || {before} || {after} END AS proof,
  CASE WHEN ds IS NULL THEN cur ELSE sha256({before} || cur || {after}) END AS cur
 FROM {prefix}f{k} f LEFT JOIN {prefix}r{k} r ON {same} AND r.pos = f.pos // 16)""")

    out[1] = out[1].replace("f0 AS", "xf0 AS")
    out[0] = out[0].replace("\nn0 AS", "\nxn0 AS")
    for k in range(leaf_levels):
        level("x", k, "source")
    out.append(f"""yn0 AS (SELECT source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
 FROM xn{leaf_levels})""")
    out.append(f"""yf0 AS (SELECT f.doc_id, f.d0, f.source, s.d AS subroot, s.pos, f.proof, f.cur
 FROM xf{leaf_levels} f JOIN yn0 s ON s.source IS NOT DISTINCT FROM f.source)""")
    for k in range(source_levels):
        level("y", k, "")
    return "WITH " + ",\n".join(o.strip() for o in out) + f"""
SELECT doc_id, d0 AS leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = r.d AS verified
FROM yf{source_levels}, (SELECT d FROM yn{source_levels}) r"""


OP13_SQL = _sql()
