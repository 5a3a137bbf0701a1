"""Choice of resolution levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def level_resolutions(levels: DataFrame, mpp_x: str = "mpp_x", mpp_y: str = "mpp_y", by: str = "slide_id") -> DataFrame:
    """All columns with ``level_mpp_x, level_mpp_y``: the native resolution scaled by the level's size.

    ``levels`` has ``by, level_idx, size_x, size_y`` with index 0 in full size.
    """
    full = levels.where("level_idx = 0").select(by, F.col("size_x").alias("_fx"), F.col("size_y").alias("_fy"))
    grown = levels.join(full, by)
    scale = lambda m, f, s: F.col(m) * F.col(f) / F.col(s)
    return grown.withColumn("level_mpp_x", scale(mpp_x, "_fx", "size_x")).withColumn("level_mpp_y", scale(mpp_y, "_fy", "size_y")).drop("_fx", "_fy")


def best_level(levels: DataFrame, target_mpp: float, mpp: str = "level_mpp_x", by: str = "slide_id") -> DataFrame:
    """``by, level_idx, level, mpp``: the coarsest level that is still at least as fine as the target.

    The earliest of equally coarse levels counts; level 0 where all are too coarse. ``level`` counts
    from the coarsest.
    """
    fits = F.col(mpp) <= target_mpp
    picked = levels.groupBy(by).agg(
        F.max(F.when(fits, F.struct(F.col(mpp).alias("m"), (-F.col("level_idx")).alias("i")))).alias("_b"), F.count(F.lit(1)).alias("_n"),
        F.max(F.when(F.col("level_idx") == 0, F.col(mpp))).alias("_m0"),
    )
    idx = F.coalesce(-F.col("_b.i"), F.lit(0)).cast("int")
    return picked.select(by, idx.alias("level_idx"), (F.col("_n") - 1 - idx).cast("int").alias("level"), F.coalesce("_b.m", "_m0").alias("mpp"))


def thumbnail_level(levels: DataFrame, least: int = 2000, by: str = "slide_id") -> DataFrame:
    """``by, level_idx``: the coarsest level whose longer edge has ``least`` pixels, else the coarsest."""
    long = F.greatest("size_x", "size_y") >= least
    return levels.groupBy(by).agg(F.coalesce(F.max(F.when(long, F.col("level_idx"))), F.max("level_idx")).cast("int").alias("level_idx"))
