"""Connected components of a graph given as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import cut


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, label`` for every node of ``edges`` (columns ``a``, ``b``): the smallest node it is connected with.

    Each round gives a node the smallest label around it and then the label of
    that label, so that a chain of n nodes takes about log n rounds. Labels are
    grouped with partial aggregates, and each round is stored, so neither a
    node with very many edges nor a lost executor hurts.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
               .filter("a <> b").distinct(), f"{name}-edges")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels, both["a"] == labels["node"]).groupBy(F.col("b").alias("node")).agg(F.min("label").alias("near"))
        better = cut(labels.join(near, "node").select("node", F.least("label", "near").alias("label"),
                                                      F.col("label").alias("old")), f"{name}-{step}a")
        to = better.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = cut(better.join(to, "label").select("node", F.col("root").alias("label"), "old"), f"{name}-{step}b")
        labels = jumped.select("node", "label")
        if jumped.filter("label <> old").isEmpty():
            return labels
