"""Connected components of an edge table, by alternating large and small stars.

Each round is two aggregations and two joins over edges; no neighbourhood is ever
collected, and beyond ``LEAST`` edges a node's are dealt to several tasks. Rounds are saved in the shared folder and end when a round changes
nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .skew import weighted_lookup

#: Edges (16 bytes each) that may meet in one task.
LEAST = 100_000


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame, attach) -> DataFrame:
    """Every node hands its larger neighbours the least of its neighbours and itself."""
    both = _both(edges)
    low = both.groupBy("u").agg(F.min("v").alias("m"), F.count_if(F.col("v") > F.col("u")).alias("weight"))
    low = low.where("weight > 0").select("u", F.least("u", "m").alias("m"), "weight")
    moved = attach(both.where("v > u"), low, "low")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame, attach) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, the least of them."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("weight"))
    moved = attach(edges, low, "least").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root): the smallest node of the component of every node that is not its own root.

    ``edges`` holds pairs (a, b) of longs in any order, repeats and loops allowed.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = scratch.save(edges, f"{name}-0")

    def plain(left: DataFrame, low: DataFrame, _: str) -> DataFrame:
        return left.join(low.drop("weight"), "u")

    def dealt(left: DataFrame, low: DataFrame, what: str) -> DataFrame:
        return weighted_lookup(left, scratch.save(low, f"{name}-{what}"), ["u"], "weight", least=LEAST)

    mark, step = None, 0
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark, step = tuple(now), step + 1
        most = _both(edges).groupBy("u").count().agg(F.max("count")).first()[0] if now[0] > LEAST else 0
        if most > LEAST:
            large = scratch.save(_large_star(edges, dealt), f"{name}-large")
            edges = scratch.save(_small_star(large, dealt), f"{name}-{step}")
        else:
            edges = scratch.save(_small_star(_large_star(edges, plain), plain), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}", f"{name}-large", f"{name}-low", f"{name}-least")
