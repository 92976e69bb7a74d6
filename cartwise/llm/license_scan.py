"""License scan: MinHash bands over overlapping windows, then exact containment
(DataFrame functions only).

A template of n words is a sequence of shingles of min(5, n) words.  A text's
windows for a template are all runs of as many shingles as the template has, one
starting at every word; a text with fewer is one window.  ``bands_for`` chooses
the number of one-row bands so that a window holding 80 % of a template's
shingles (Jaccard at least 0.8 / 1.2) shares a band with probability of at least
1 - ``MISS``; a window that holds the template exactly always does.  Windows that
share a band are verified: the share of the template's distinct shingles in the
window must be at least 0.8.

Signatures are evaluated lazily, with the same outcome as computing them all: a
band of a window can equal a template's only if the window holds the one
shingle that is the template's minimum in that band.  So the shingles of every
text are looked up in the small table of those minima (templates x bands, a
parameter's size, broadcast), and only the windows around a hit are hashed in
that band.  Nothing is shuffled but matches.

Words are runs of letters and digits, in lower case.  Defined results: null or
empty text has no window; repeated rows of one doc_id are reported once; every
template that matches is reported; no templates, or an empty table, give no
rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty

WORDS = 5
SHARE = 0.8
MISS = 1e-6

# The notices that are looked for.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
                 "and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("BSD-text", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
]


def bands_for(share: float = SHARE, miss: float = MISS) -> int:
    """One-row bands needed so that a window with ``share`` of the template (as
    many shingles as it) is missed with probability ``miss`` at most."""
    jaccard = share / (2 - share)
    return max(1, math.ceil(math.log(miss) / math.log(1 - jaccard)))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _shingle(words: Column, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(words, at + k) for k in range(width)])


def _shingles(words: Column, first: Column, last: Column, width: Column, widths: list[int]) -> Column:
    """Hashes of the shingles that start at first..last."""
    def one(i: Column) -> Column:
        out = F.lit(None).cast("long")
        for w in widths:
            out = F.when(width == w, _shingle(words, i, w)).otherwise(out)
        return out
    return F.transform(F.sequence(first, last), one)


def _minima(spark: SparkSession, templates, bands: int) -> tuple[DataFrame, list[int]]:
    """One row per template and band: h (the minimal shingle), low (its hash
    in the band), and the template's width, spans (shingles) and set."""
    rows = spark.createDataFrame([(n, t) for n, t in templates], "license string, body string")
    rows = rows.withColumn("w", _words(F.col("body"))).where(F.size("w") > 0)
    rows = rows.withColumn("width", F.least(F.size("w"), F.lit(WORDS)))
    widths = sorted({r["width"] for r in rows.select("width").distinct().collect()})      # at most WORDS values
    rows = rows.withColumn("spans", F.size("w") - F.col("width") + 1)
    rows = rows.withColumn("all", _shingles(F.col("w"), F.lit(0), F.col("spans") - 1, F.col("width"), widths))
    rows = rows.withColumn("own", F.array_distinct("all"))
    each = (rows.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))
            .withColumn("h", F.explode("own")).withColumn("low", F.xxhash64("h", "band")))
    least = each.groupBy("license", "band").agg(F.min(F.struct("low", "h")).alias("m"))
    out = least.join(rows.select("license", "width", "spans", "own"), "license")
    return out.select("license", "band", F.col("m.h").alias("h"), F.col("m.low").alias("low"), "width", "spans", "own"), widths


def scan(docs: DataFrame, templates=TEMPLATES, text: str = "text", doc_id: str = "doc_id", share: float = SHARE,
         bands: int | None = None) -> DataFrame:
    """One row per document and license found: doc_id, license, containment
    (of the best window), first_word (where the first best window starts),
    n_windows (matching windows)."""
    minima, widths = _minima(docs.sparkSession, templates, bands or bands_for(share))
    texts = docs.select(F.col(doc_id).alias("doc_id"), _words(text_or_empty(text)).alias("w"))
    if not widths:
        widths = [WORDS]
    texts = texts.withColumn("n", F.size("w")).where(F.col("n") >= min(widths))
    at = texts.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - min(widths))))
    hashes = F.array(*[F.when(F.col("i") <= F.col("n") - w, _shingle(F.col("w"), F.col("i"), w)) for w in widths])
    hits = at.withColumn("h", F.explode(hashes)).join(F.broadcast(minima), "h")
    # the windows around a hit; ``w`` is cut to the words they need
    hits = hits.withColumn("count", F.col("n") - F.col("width") + 1)
    hits = hits.withColumn("from", F.greatest(F.lit(0), F.col("i") - F.col("spans") + 1))
    hits = hits.withColumn("to", F.least(F.col("i"), F.greatest(F.lit(0), F.col("count") - F.col("spans"))))
    near = hits.select("doc_id", "license", "band", "low", "width", "spans", "own", "count", "from", "to",
                       F.slice("w", F.col("from") + 1, F.col("spans") * 2 + F.col("width")).alias("w"))
    windows = near.where("from <= to").withColumn("start", F.explode(F.sequence("from", "to")))
    last = F.least(F.col("start") + F.col("spans"), F.col("count")) - 1
    windows = windows.withColumn("s", _shingles(F.col("w"), F.col("start") - F.col("from"), last - F.col("from"),
                                                F.col("width"), widths))
    banded = windows.where(F.array_min(F.transform("s", lambda x: F.xxhash64(x, F.col("band")))) == F.col("low"))
    held = F.size(F.array_intersect("own", "s")) / F.size("own")
    matches = (banded.select("doc_id", "license", "start", held.alias("containment"))
               .where(F.col("containment") >= share).distinct())
    best = F.max(F.struct("containment", (-F.col("start")).alias("back")))
    return (matches.groupBy("doc_id", "license").agg(best.alias("b"), F.count(F.lit(1)).alias("n_windows"))
            .select("doc_id", "license", F.col("b.containment").alias("containment"),
                    (-F.col("b.back")).cast("long").alias("first_word"), "n_windows"))


def op4(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def oracle(templates=TEMPLATES, share: float = SHARE) -> str:
    """SQL for ``scan`` without hashing: every window's exact containment."""
    values = ", ".join(f"('{n}', '{t}')" for n, t in templates)
    return rf"""
WITH t0 AS (SELECT name, [x FOR x IN regexp_split_to_array(lower(body), '[^\p{{L}}\p{{N}}]+') IF x <> ''] AS w
            FROM (VALUES {values}) v(name, body)),
t1 AS (SELECT name, w, least(len(w), {WORDS}) AS width FROM t0),
t AS (SELECT name, width, len(w) - width + 1 AS spans,
             list_distinct([list_aggregate(w[i:i + width - 1], 'string_agg', ' ') FOR i IN range(1, len(w) - width + 2)]) AS own
      FROM t1),
own AS (SELECT name, width, spans, len(own) AS size, unnest(own) AS s FROM t),
d AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+') IF x <> ''] AS w
      FROM documents),
p AS (SELECT doc_id, w, len(w) AS n, unnest(range(1, len(w) + 1)) AS i FROM d),
s AS (SELECT doc_id, n, i - 1 AS i, k.width, list_aggregate(w[i:i + k.width - 1], 'string_agg', ' ') AS s
      FROM p, (SELECT DISTINCT width FROM t) k WHERE i + k.width - 1 <= n),
hit AS (SELECT DISTINCT s.doc_id, s.n - s.width + 1 AS cnt, s.i, s.s, own.name, own.spans, own.size
        FROM s JOIN own ON s.s = own.s AND s.width = own.width),
win AS (SELECT doc_id, name, size, s, unnest(range(greatest(0, i - spans + 1), least(i, greatest(0, cnt - spans)) + 1)) AS start FROM hit),
m AS (SELECT doc_id, name, start, count(DISTINCT s)::DOUBLE / any_value(size) AS containment
      FROM win GROUP BY doc_id, name, start HAVING count(DISTINCT s)::DOUBLE / any_value(size) >= {share})
SELECT doc_id, name AS license, max(containment) AS containment,
       arg_min(start, (-containment, start))::BIGINT AS first_word, count(*) AS n_windows
FROM m GROUP BY doc_id, name
"""


OP4_SQL = oracle()
