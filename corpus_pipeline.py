"""Corpus pipeline: language ID, exact dedup, near dedup, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``:

* ``language_id`` drops documents without a letter or whose language is not
  recognised with a score of at least 0.5;
* ``exact_dedup`` keeps one row of each group of equal texts;
* ``ngram_jaccard`` keeps the smallest doc_id of each near-duplicate component;
* ``source_mixing`` repeats or drops documents until the sources stand in their
  target weights, in the order of the mix;
* ``best_fit_packing`` returns the token pieces with their sequence and offset.
"""

from __future__ import annotations

from cartwise.llm.common import written
from cartwise.llm.exact_dedup import deduplicate
from cartwise.llm.language import confident
from cartwise.llm.mixing import mixed_documents
from cartwise.llm.ngram_join import one_per_component
from cartwise.llm.packing import packed_documents


def language_id(spark, docs, sf_dir):
    return confident(docs)


def exact_dedup(spark, docs, sf_dir):
    return deduplicate(docs)


def ngram_jaccard(spark, docs, sf_dir):
    return one_per_component(docs)


def source_mixing(spark, docs, sf_dir):
    return mixed_documents(docs)


def best_fit_packing(spark, docs, sf_dir):
    return packed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# Language prediction, near-duplicate components and tokenised packing are not SQL.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    """All stages over ``documents``; every stage's result is written and reread."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
