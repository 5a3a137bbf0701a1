"""Counts over rectangles of a mask from summed areas, at four look-ups a rectangle."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir


def _before(frame: pd.DataFrame, column: str, length: int) -> np.ndarray:
    """For each row the sum of the rows above it; an absent strip counts as zeros."""
    strips = np.stack([np.zeros(length, np.int64) if v is None else np.asarray(v, np.int64) for v in frame[column]])
    return strips.cumsum(0) - strips


def summed_areas(mask: DataFrame, extent: DataFrame, flag: str, cell: int = 64, by: str = "slide_id") -> DataFrame:
    """``by, cy, cx, inner, left, up, corner``: a row for each block of ``cell`` pixels a side of ``extent(by, h, w)``.

    Each array has counts of pixels first, then of flagged ones. ``inner`` are the sums inside the
    block, up to each of its pixels; ``left`` and ``up`` what the blocks of its row and column before
    it add for each of its rows and columns, ``corner`` what those above and left of both add. Only
    one strip a block and axis goes from block to block, so a task has as much as an image is wide
    or high. Pixels may be missing or repeated; a null flag is false.
    """
    kind = dict(mask.dtypes)[by]
    px = mask.where(F.col(by).isNotNull() & (F.col("y") >= 0) & (F.col("x") >= 0))
    px = px.select(by, F.expr(f"cast(y div {cell} as int)").alias("cy"), F.expr(f"cast(x div {cell} as int)").alias("cx"), "y", "x", F.coalesce(F.col(flag), F.lit(False)).cast("int").alias("f"))

    def inside(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        at = frame["y"].to_numpy() - key[1] * cell, frame["x"].to_numpy() - key[2] * cell
        sums = np.zeros((2, cell, cell), np.int64)
        np.add.at(sums[0], at, 1)
        np.add.at(sums[1], at, frame["f"].to_numpy())
        sums = sums.cumsum(1).cumsum(2)
        return pd.DataFrame({by: [key[0]], "cy": key[1], "cx": key[2], "inner": [sums.ravel()], "right": [sums[:, :, -1].ravel()], "bottom": [sums[:, -1].ravel()]})

    def along_row(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cx")
        return pd.DataFrame({by: frame[by], "cy": frame["cy"], "cx": frame["cx"], "left": list(_before(frame, "right", 2 * cell)), "bottom": frame["bottom"]})

    def along_column(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("cy")
        ends = np.stack([np.asarray(v)[[cell - 1, 2 * cell - 1]] for v in frame["left"]])
        return pd.DataFrame({by: frame[by], "cy": frame["cy"], "cx": frame["cx"], "left": frame["left"], "up": list(_before(frame, "bottom", 2 * cell)), "corner": list(ends.cumsum(0) - ends)})

    place = f"{by} {kind}, cy int, cx int"
    blocks = px.groupBy(by, "cy", "cx").applyInPandas(inside, f"{place}, inner array<long>, right array<long>, bottom array<long>")
    blocks = materialise(blocks, shared_dir(mask.sparkSession), "blocks")
    domain = extent.where("h > 0 and w > 0").withColumn("cy", F.explode(F.sequence(F.lit(0), F.expr(f"cast((h - 1) div {cell} as int)"))))
    domain = domain.withColumn("cx", F.explode(F.sequence(F.lit(0), F.expr(f"cast((w - 1) div {cell} as int)")))).select(by, "cy", "cx")
    strips = domain.join(blocks.drop("inner"), [by, "cy", "cx"], "left")
    strips = strips.groupBy(by, "cy").applyInPandas(along_row, f"{place}, left array<long>, bottom array<long>")
    strips = strips.groupBy(by, "cx").applyInPandas(along_column, f"{place}, left array<long>, up array<long>, corner array<long>")
    return strips.join(blocks.select(by, "cy", "cx", "inner"), [by, "cy", "cx"], "left")


def rectangle_counts(spans: DataFrame, mask: DataFrame, flag: str, cell: int = 64, by: str = "slide_id") -> DataFrame:
    """``key, n, f``: pixels and flagged pixels of ``mask`` in each of ``spans(key, by, y0, y1, x0, x1)``, ends exclusive.

    ``spans`` is read twice, so it should be stored; keys differ from row to row, and an empty span
    has no row. However large a rectangle, at most four rows are joined for it.
    """
    full = spans.where("y1 > y0 and x1 > x0")
    extent = full.groupBy(by).agg(F.max("y1").alias("h"), F.max("x1").alias("w"))
    ends = [F.struct(F.col(y).alias("y"), F.col(x).alias("x"), F.lit(sign).alias("sign")) for y, x, sign in (("y1", "x1", 1), ("y0", "x1", -1), ("y1", "x0", -1), ("y0", "x0", 1))]
    corners = full.select("key", by, F.explode(F.array(*ends)).alias("c")).select("key", by, "c.*").where("y > 0 and x > 0")
    corners = corners.select("key", by, "sign", *[F.expr(e).alias(n) for e, n in (
        (f"cast((y - 1) div {cell} as int)", "cy"), (f"cast((x - 1) div {cell} as int)", "cx"), (f"cast((y - 1) % {cell} as int)", "i"), (f"cast((x - 1) % {cell} as int)", "j"),
    )])
    found = corners.join(summed_areas(mask, extent, flag, cell, by), [by, "cy", "cx"])

    def total(k: int) -> Column:
        here = F.expr(f"coalesce(get(inner, {k * cell * cell} + i * {cell} + j), 0L) + get(left, {k * cell} + i) + get(up, {k * cell} + j) + get(corner, {k})")
        return F.sum(F.col("sign") * here)

    return found.groupBy("key").agg(total(0).alias("n"), total(1).alias("f"))
