"""Connected components of edge lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)``: a row ``(node, root)`` for each node on an edge.

    Alternating large-star and small-star contraction (Kiveris et al., 2014): each round is two
    grouped minima, the number of rounds is logarithmic, and no group is gathered. ``root`` is the
    smallest node of the component.
    """
    current = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), folder, f"{name}-0"
    )
    seen = None
    for k in range(1, 64):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low2, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low2.select("u", F.col("m").alias("v")))
        current = materialise(small.where("u > v").distinct(), folder, f"{name}-{k}")
        now = current.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == seen:
            break
        seen = tuple(now)
    else:
        raise RuntimeError("components did not settle in 64 rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
