"""Connected components of an undirected graph, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import staged


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of
    ``links`` (a, b).

    Each round hooks every node onto its smallest neighbour if that is smaller,
    follows such hooks twice, and replaces the ends of all links by where they
    lead; links inside a node vanish.  Only nodes smaller than all their
    neighbours are left after a round, so the links shrink quickly.
    """
    edges = staged(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
                   .where("lo < hi").distinct(), "edges")
    labels = edges.select(F.col("lo").alias("node")).union(edges.select("hi")).distinct()
    labels = staged(labels.withColumn("component", F.col("node")), "labels")
    while not edges.isEmpty():
        hooks = edges.groupBy(F.col("hi").alias("was")).agg(F.min("lo").alias("now"))
        for _ in range(2):
            further = hooks.select(F.col("was").alias("now"), F.col("now").alias("then"))
            hooks = hooks.join(further, "now", "left").select("was", F.coalesce("then", "now").alias("now"))
        hooks = staged(hooks, "hooks")
        labels = staged(labels.join(hooks, F.col("component") == F.col("was"), "left")
                        .select("node", F.coalesce("now", "component").alias("component")), "labels")
        low = hooks.select(F.col("was").alias("lo"), F.col("now").alias("to_lo"))
        high = hooks.select(F.col("was").alias("hi"), F.col("now").alias("to_hi"))
        moved = edges.join(low, "lo", "left").join(high, "hi", "left").select(
            F.coalesce("to_lo", "lo").alias("a"), F.coalesce("to_hi", "hi").alias("b"))
        edges = staged(moved.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
                       .where("lo < hi").distinct(), "edges")
    return labels
