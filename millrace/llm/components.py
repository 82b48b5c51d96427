"""Connected components of an edge table, as rounds of joins.

Alternates two steps on edges (hi, lo): every node hands its larger neighbours to its
least neighbour, then its smaller ones. Both keep the components and end in stars around
the least node, in a number of rounds that grows with the logarithm of the component
size. Each step is written to the shared folder, so a lost executor costs one step. The least
neighbours are a table of their own: the join then reads plain shuffles, whose hot partitions (a
node with very many neighbours) adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace.session import written

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in `edges` (columns a, b); component is the least node."""
    e, state = _kept(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    for _ in range(ROUNDS):
        both = e.unionByName(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = written(both.groupBy("hi").agg(F.least(F.min("lo"), F.col("hi")).alias("m")), "least")
        e = written(both.join(least, "hi").where("lo > hi AND lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")), "large")
        least = written(e.groupBy("hi").agg(F.min("lo").alias("m")), "least")
        moved = e.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        before = state
        e, state = _kept(moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())
        if state == before:
            roots = e.select(F.col("lo").alias("node")).distinct()
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
    raise RuntimeError("components did not settle")


def _kept(e: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and a checksum of them taken on the way."""
    seen = Observation()
    e = written(e.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")), "edges")
    return e, (seen.get["n"], seen.get["h"])
