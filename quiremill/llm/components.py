"""Connected components by alternating large-star and small-star steps.

Each step is an aggregate and an equi-join on edges, so no node's neighbours ever meet in one
row: the least neighbour of a hot node is a partial aggregate, and the join that hands it out can
be split by adaptive execution.  Every step is written to the shared folder, the one before is
deleted; the number of steps grows with the logarithm of the number of nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiremill.llm.common import forget, staged


def _tidy(e: DataFrame) -> DataFrame:
    """Edges from the larger node ``u`` to the smaller ``v``, each once."""
    return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")).select("x", F.least("x", "m").alias("m"))
    return both.join(least, both.u == least.x).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
    moved = e.join(least, e.u == least.x).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("x").alias("u"), F.col("m").alias("v")))


def _mark(e: DataFrame) -> tuple:
    """Number of edges, an order-free checksum, and whether the edges are stars already."""
    h = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(e.agg(F.count("*"), F.sum(h)).first())


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component): the smallest node reachable over ``edges``; only nodes with an edge.

    Edges with a null end, loops and repeats are without effect; no edges give no rows.
    """
    spark = edges.sparkSession
    e = staged(_tidy(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u is not null and v is not null")), "cc")
    before = _mark(e)
    while before[0]:
        nxt = staged(_tidy(_small(_tidy(_large(e)))), "cc")
        now = _mark(nxt)
        forget(spark, e)
        e, same = nxt, now == before
        before = now
        if same:
            break
    nodes = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
