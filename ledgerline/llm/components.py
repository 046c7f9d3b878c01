"""Connected components of a large graph by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import written
from ledgerline.operators.relational import join_lookup


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return join_lookup(both.filter("v > u"), low, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node itself, move to the smallest of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = join_lookup(edges, low, ["u"]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges: one row, whatever their number."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node that has an edge (u, v).

    Large and small stars in turn contract any graph to stars in a number of rounds that
    grows with the logarithm of the longest path, not with the path. Each round's edges are
    written to the shared folder; only their checksum reaches the driver. Loops and NULL
    ends are ignored; no edges give no rows.
    """
    start = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = written(start, "edges")
    before = _state(now)
    while before[0]:
        now = written(_small_star(_large_star(now)), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
