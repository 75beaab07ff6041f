"""Connected components of a large graph (large-star / small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import stable


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v.  Large: every larger
    neighbour is tied to the smallest neighbour (or the node itself); small:
    every smaller neighbour and the node are tied to the smallest one."""
    if large:
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = sides.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = (edges.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(low.select("u", F.col("m").alias("v"))))
    return out.filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    """Count and an order-free checksum of the edges (two numbers)."""
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: bigint, any order, repeats allowed) -> (node, root):
    every node that has an edge to another one, with the smallest node it can
    reach.  Minima are combined map-side and joins can be split by AQE, so a
    hub with a third of the edges is no single task.  Rounds grow with the
    logarithm of the longest chain; each is checkpointed.
    """
    e = stable(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .filter("u <> v").distinct())
    before = _state(e)
    while before[0]:
        e = stable(_star(_star(e, large=True), large=False))
        now = _state(e)
        if now == before:
            break
        before = now
    # A star forest: every u hangs on its root.
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
