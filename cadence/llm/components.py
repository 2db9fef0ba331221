"""Connected components by alternating large-star and small-star rounds.

Every round is two grouped minima and two equi-joins over the edge list, so
no node's neighbourhood is ever gathered in one place: a hub's minimum is a
partial aggregate and AQE splits its join partition.  The edge list is
rewritten as a table in the shared folder after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import materialise


def _digest(edges: DataFrame):
    return edges.agg(F.count("*").alias("n"),
                     F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node that has an edge to another;
    ``component`` is the smallest node reachable.  Loops, repeated edges and
    NULL ends are ignored; an empty edge list gives an empty result."""
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    stars = materialise(edges.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v"))
                        .where(x.isNotNull() & y.isNotNull() & (x != y)).distinct())
    seen = _digest(stars)
    for _ in range(max_rounds):
        if seen["n"] == 0:
            break
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        stars = materialise(small)
        now = _digest(stars)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = stars.select(F.col("v").alias("node")).distinct()
    return (stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
