"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .skew import salt


def _star(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least of u and all its neighbours, in two steps for hot nodes."""
    slotted = pairs.withColumn("__h_slot", salt("u", "v"))
    part = slotted.groupBy("u", "__h_slot").agg(F.min("v").alias("m"))
    least = part.groupBy("u").agg(F.least(F.min("m"), F.col("u")).alias("m"), F.collect_set("__h_slot").alias("__h_slots"))
    return slotted.join(least.select("u", "m", F.explode("__h_slots").alias("__h_slot")), ["u", "__h_slot"]).select("u", "v", "m")


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 30) -> DataFrame:
    """(node, component) of every node of the edges, the component being its least node.

    Null ends and loops are ignored. Each round ends in a checkpoint; the loop ends when a round
    changes nothing. Needs about log(diameter) rounds; more than ``rounds`` raises.
    """
    e = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = cut(e)
    before = None
    for _ in range(rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small = _star(large.where("u > v"))
        e = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        before = now
    raise RuntimeError(f"components not settled after {rounds} rounds")
