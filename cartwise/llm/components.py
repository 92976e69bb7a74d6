"""Connected components of a table of links, without gathering any of it.

Smallest-label propagation with pointer jumping: every round each node takes
the smallest label among its own, its neighbours' and its label's label.  The
neighbour minimum is a map-side combined aggregation, so a node with very many
links costs no task more than its share; each round is written to the shared
folder, which also cuts the lineage.  Long chains shrink by jumping, so the
number of rounds grows like the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``links``: a written table (a, b) of long ids.  Returns a written table
    (id, component) for every id that occurs: component is the smallest id
    that can be reached."""
    both = links.select("a", "b").where("a <> b")
    both = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m"))
                     .select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "cc-labels")
    for _ in range(max_rounds):
        near = (both.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy("a").agg(F.min("component").alias("near")))
        hooked = (labels.join(near.withColumnRenamed("a", "id"), "id")
                  .select("id", F.col("component").alias("old"), F.least("component", "near").alias("component")))
        jump = labels.select(F.col("id").alias("component"), F.col("component").alias("further"))
        step = written(hooked.join(jump, "component", "left")
                       .select("id", "old", F.least("component", "further").alias("component")), "cc-round")
        labels = step.select("id", "component")
        if step.where("component <> old").limit(1).count() == 0:
            return labels
    raise RuntimeError("components did not settle")
