"""Connected components by alternating large-star and small-star steps.

Every step is a grouped minimum plus a join, so no component is ever gathered
in one task; rounds are cut with reliable checkpoints.  The number of rounds
grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from intake.llm.common import cut


def _attach(pairs: DataFrame, keep: str) -> DataFrame:
    """Each node's smallest neighbour (or itself) takes over the node's neighbours."""
    # cut first: both join sides are then plain shuffles, which AQE can split at a hub
    least = cut(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    moved = pairs.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if keep == "true":
        moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs -> (node, component): the smallest node reachable, for
    every node of a pair with two different ends.  Null ends are ignored; an
    empty table gives an empty table."""
    e = cut(edges.where("a is not null and b is not null and a <> b")
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = cut(_attach(both, "v > u"))
        e = cut(_attach(large, "true"))
        before, state = state, _state(e)
        if before == state:
            break
    ends = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
