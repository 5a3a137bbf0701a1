"""Connected parts of a mask, with sides (not corners) as neighbours."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir
from .graph import components


def _local_roots(y: np.ndarray, x: np.ndarray) -> np.ndarray:
    """For each pixel of one block the index of the first pixel of its part."""
    order = np.lexsort((x, y))
    yy, xx = y[order] - y.min(), x[order] - x.min()
    grid = np.full((yy.max() + 2, xx.max() + 2), -1, np.int64)
    grid[yy, xx] = np.arange(len(order))
    up = np.arange(len(order))
    pairs = []
    for dy, dx in ((1, 0), (0, 1)):
        other = grid[yy + dy, xx + dx]
        pairs.append(np.stack([np.flatnonzero(other >= 0), other[other >= 0]], 1))
    a, b = np.concatenate(pairs).T
    while True:  # least root of both ends, then every pointer to its end
        low = np.minimum(up[a], up[b])
        before = up.copy()
        np.minimum.at(up, before[a], low)
        np.minimum.at(up, before[b], low)
        while (up[up] != up).any():
            up = up[up]
        if (up == before).all():
            break
    roots = np.empty(len(order), np.int64)
    roots[order] = order[up]
    return roots


def label_parts(mask: DataFrame, flag: str = "white", block: int = 256, by: str = "slide_id") -> DataFrame:
    """``by, y, x, part_y, part_x``: each flagged pixel with the first pixel of its part, by x, y in a row.

    Blocks of ``block`` pixels a side are labelled where they lie; only pixels along block borders
    become edges between local parts, and those are merged by a distributed contraction. Parts may
    span any number of blocks. The name of a part is its smallest (y, x). Repeated pixels count once.
    """
    folder = shared_dir(mask.sparkSession)
    kind = dict(mask.dtypes)[by]
    on = mask.where(F.col(flag)).select(by, "y", "x").distinct()

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        y, x = frame["y"].to_numpy(np.int64), frame["x"].to_numpy(np.int64)
        first = _local_roots(y, x)
        return pd.DataFrame({by: frame[by], "y": y, "x": x, "ly": y[first], "lx": x[first]})

    local = on.groupBy(by, F.expr(f"y div {block}").alias("_by"), F.expr(f"x div {block}").alias("_bx")).applyInPandas(run, f"{by} {kind}, y int, x int, ly int, lx int")
    local = materialise(local, folder, "local")
    name = F.struct(by, "ly", "lx")
    down = local.where(F.col("y") % block == block - 1).select(by, (F.col("y") + 1).alias("y"), "x", name.alias("a"))
    right = local.where(F.col("x") % block == block - 1).select(by, "y", (F.col("x") + 1).alias("x"), name.alias("a"))
    first = local.where((F.col("y") % block == 0) | (F.col("x") % block == 0)).select(by, "y", "x", name.alias("b"))
    edges = down.unionByName(right).join(first, [by, "y", "x"]).select("a", "b")
    edges = materialise(edges.distinct(), folder, "edges")
    if not edges.limit(1).count():
        return local.select(by, "y", "x", F.col("ly").alias("part_y"), F.col("lx").alias("part_x"))
    merged = components(edges, folder, "parts").select(F.col(f"node.{by}").alias(by), F.col("node.ly").alias("ly"), F.col("node.lx").alias("lx"), "root")
    out = local.join(merged, [by, "ly", "lx"], "left")
    return out.select(by, "y", "x", F.coalesce("root.ly", "ly").alias("part_y"), F.coalesce("root.lx", "lx").alias("part_x"))


def part_sizes(parts: DataFrame, by: str = "slide_id") -> DataFrame:
    """``by, part_y, part_x, area``."""
    return parts.groupBy(by, "part_y", "part_x").agg(F.count(F.lit(1)).alias("area"))


def large_parts(mask: DataFrame, flag: str = "white", least: int = 128, block: int = 256, by: str = "slide_id") -> DataFrame:
    """``by, y, x`` of the flagged pixels in parts of at least ``least`` pixels."""
    parts = materialise(label_parts(mask, flag, block, by), shared_dir(mask.sparkSession), "labelled")
    big = part_sizes(parts, by).where(F.col("area") >= least)
    return parts.join(big, [by, "part_y", "part_x"], "left_semi").select(by, "y", "x")
