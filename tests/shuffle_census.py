"""Count shuffle exchanges per registered query with automatic broadcasts
disabled (the plan shape at scale, where only size-checked broadcasts stay).

Usage: python tests/shuffle_census.py [sf_dir]
"""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SKIP = {"gbt_train", "hyper_search", "grid_search", "feature_importance", "model_roundtrip", "recommend_gbt",
        "stream_recommend", "ingest_roundtrip", "master_csv_roundtrip", "eda_list_tables"}


def main(sf_dir):
    from cartwise.session import local_session
    from cartwise.plans.registry import QUERIES, Ctx
    spark = local_session(8, extra={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    Ctx(spark, sf_dir).store  # build the tables first
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"(?<!Broadcast)Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        bcast = len(re.findall(r"BroadcastExchange", plan))
        print(f"| `{name}` | {shuffles} | {bcast} |")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
