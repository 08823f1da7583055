"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BROADCAST_ROWS, materialize


def look_up(left: DataFrame, right: DataFrame, key: str, limit: int, how: str = "inner") -> DataFrame:
    """left joined with right, which holds a key once: rows of a key that more than limit rows of left hold stay where they are.

    Counts are combined map-side; a key over the limit holds more than one row in BROADCAST_ROWS of the table, so such keys
    and what is looked up for them are at most BROADCAST_ROWS rows, which are broadcast. All others are joined by a shuffle.
    """
    hot = materialize(left.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).select(key))
    if hot.isEmpty():
        return left.join(right, key, how)
    hot = F.broadcast(hot)
    cold = left.join(hot, key, "left_anti").join(right, key, how)
    return cold.unionByName(left.join(hot, key, "left_semi").join(F.broadcast(right.join(hot, key, "left_semi")), key, how))


def _stars(parent: DataFrame, limit: int) -> DataFrame:
    """Point every node at the end of its chain of parents; each step halves the chains."""
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("far"))
        far = look_up(parent, up, "parent", limit)
        step = materialize(far.select("node", F.col("far").alias("parent"), (F.col("far") != F.col("parent")).alias("moved")))
        parent = step.select("node", "parent")
        if step.filter("moved").isEmpty():
            return parent


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link; root is the smallest node reachable.

    Each round points a node at its smallest neighbour (aggregated map-side, so a node of many links is no hot task), turns
    the chains into stars, and contracts the links to their roots; links within a star go. At least half the nodes that
    still have links go with each round, and the links are read twice in the first round, then only what is left of them.
    Nodes that many others link to or point at are looked up by broadcast, so no hub gathers its rows in one task.
    Every step ends in a reliable checkpoint. An empty table gives an empty result; links to oneself are allowed.
    """
    edges = materialize(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    labels = materialize(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()).withColumn("root", F.col("node"))
    # links and labels only shrink, so a key over the limit is one of at most BROADCAST_ROWS in every later step too
    limit = max(1_000, max(edges.count(), labels.count()) // BROADCAST_ROWS)
    edges = edges.filter("a <> b")
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
        parent = _stars(materialize(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("parent"))), limit)
        up = parent.select(F.col("node").alias("root"), "parent")
        labels = materialize(look_up(labels, up, "root", limit, "left").select("node", F.coalesce("parent", "root").alias("root")))
        left = parent.select(F.col("node").alias("a"), F.col("parent").alias("ra"))
        right = parent.select(F.col("node").alias("b"), F.col("parent").alias("rb"))
        met = look_up(look_up(edges, left, "a", limit), right, "b", limit).filter("ra <> rb")
        edges = materialize(met.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    return labels
