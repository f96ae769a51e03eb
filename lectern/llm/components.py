"""Connected components of an edge list, by alternating large-star and small-star steps.

Every step points the neighbours of a node at the smallest node it knows; large-star moves the larger
neighbours, small-star the smaller ones.  Both keep connectivity, and after O(log n) rounds each component
is a star around its smallest node.  A step is one grouped minimum (added up map-side) and one join on
the node, which AQE splits where a node has very many neighbours; no neighbourhood is collected.
Each round is written to the shared folder, so lineage stays short and a lost executor re-reads files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _smallest(pairs: DataFrame) -> DataFrame:
    """Pairs ``u, v`` with ``m``, the smallest of u and all its v."""
    least = pairs.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return pairs.join(least, F.col("u") == F.col("w")).select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    moved = _smallest(both).filter(F.col("v") > F.col("u"))
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _smallest(down)
    moved = found.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = found.select("u", F.col("m").alias("v"))
    return moved.union(own).distinct()


def components(edges: DataFrame, work: Scratch, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (two columns ``u, v`` of one orderable type).

    ``root`` is the smallest node reachable.  Nodes without an edge are absent; loops and repeated
    edges are allowed; an empty edge list gives an empty result.
    """
    edges = work.write(edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{label}-0")
    signature, round_ = None, 0
    while True:
        round_ += 1
        edges = work.write(_small_star(_large_star(edges)), f"{label}-{round_}")
        work.drop(f"{label}-{round_ - 1}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == signature:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        signature = now
