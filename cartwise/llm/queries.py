"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from . import (chat, embedding_dedup, exact_dedup, language, license_scan, merkle, mixing, ngram_join, packing, periodic,
               quality, suffix_dedup, url_filter)

QUERIES = {
    "op1_best_fit_packing": packing.op1,
    "op2_ngram_jaccard": ngram_join.op2,
    "op3_exact_dedup": exact_dedup.op3,
    "op4_license_scan": license_scan.op4,
    "op5_chat_prefix_tree": chat.op5,
    "op6_url_filter": url_filter.op6,
    "op7_source_mixing": mixing.op7,
    "op8_language_crf": language.op8,
    "op9_quality_gam": quality.op9,
    "op10_embedding_graph": embedding_dedup.op10,
    "op11_periodic_runs": periodic.op11,
    "op12_suffix_dedup": suffix_dedup.op12,
    "op13_merkle_manifest": merkle.op13,
}

ORACLE = {
    "op3_exact_dedup": exact_dedup.OP3_SQL,
    "op4_license_scan": license_scan.OP4_SQL,
    "op7_source_mixing": mixing.OP7_SQL,
    "op13_merkle_manifest": merkle.OP13_SQL,
}
