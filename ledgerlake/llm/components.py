"""Union-find grouping of links: connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node of every linked node: (node, component).

    ``links`` has two long columns ``a`` and ``b``; direction, repeats and
    self-links do not matter. Rows with a null end link nothing. Nodes that
    occur in no proper link are not returned.

    Each round points every node at the smallest one it sees (first among all
    neighbours, then among the smaller ones), which halves the height of the
    pointer trees; the rounds end when nothing changes. A node with very many
    neighbours is reduced by a partial ``min`` before any shuffle, and the
    pairs of a round never outnumber its links. Every round is written to the
    shared folder, so a lost executor repeats one round at most.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges, before = _round(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("node"), F.least("hi", "m").alias("m"))
        # Every larger neighbour of a node is pointed at the least it sees.
        large = edges.join(least, edges["lo"] == least["node"]).select(F.col("hi"), F.col("m").alias("lo"))
        large = large.where("hi <> lo").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        # Every smaller neighbour but the least is pointed at the least.
        small = large.join(low, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges, after = _round(small.union(low.select("hi", F.col("m").alias("lo"))).distinct())
        if after == before:
            break
        before = after
    roots = edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return edges.groupBy("hi").agg(F.min("lo").alias("component")).select(F.col("hi").alias("node"), "component").union(roots)


def _round(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = materialise(edges, "links")
    row = edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("hi", "lo"), F.lit(1 << 30)))).first()
    return edges, tuple(row)
