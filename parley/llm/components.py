"""Connected components of a graph given as an edge table.

Alternates large-star and small-star rounds until the edges stop changing.
Every round is joins and minimum aggregates on columns, so a hub with a
third of all edges is combined before its shuffle and its join partition can
be split; no neighbour list is ever gathered.  Rounds are cut from their
lineage with ``checkpoint()`` in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.session import ensure_checkpoint_dir


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.join(least, "a").where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hooked = (edges.join(least, "a").where("b != m")
              .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return hooked.union(least.select("a", F.col("m").alias("b"))).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """Rows (a, b): every node that is not the smallest of its component, and that smallest.

    ``edges`` has two columns of the same ordered type, ``a`` > ``b``; rows
    with a null are ignored.  An empty table gives an empty result.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.select("a", "b").where("a > b").checkpoint()
    before = None
    while True:
        now = _signature(edges)
        if now == before or not now[0]:
            return edges
        before = now
        edges = _small_star(_large_star(edges)).checkpoint()
