"""Operators that look at a pixel's neighbours: entropy, resampling, padding and blended windows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def local_entropy(pixels: DataFrame, level: Column, window: int = 9, levels: int = 16, block: int = 256, by: str = "slide_id") -> DataFrame:
    """``by, y, x, entropy``: Shannon entropy (bits) of ``level`` in the window around each pixel.

    Beyond the border the edge pixel repeats. Pixels are dealt once, by blocks of ``block`` pixels a
    side that take a margin of half a window along, so a block is a task's unit of bounded size
    whatever the slide's; sums over a window come from cumulative sums. A missing pixel counts as
    level 0.
    """
    if window % 2 == 0:
        raise ValueError("the window has an odd width")
    half = window // 2
    near = lambda c: F.array_distinct(F.transform(F.array(F.lit(-half), F.lit(0), F.lit(half)), lambda d: F.floor((F.col(c) + d) / F.lit(block)).cast("int")))
    rows = pixels.select(by, "y", "x", F.coalesce(level, F.lit(0)).cast("int").alias("level"))
    dealt = rows.withColumn("by0", F.explode(near("y"))).withColumn("bx0", F.explode(near("x"))).where("by0 >= 0 and bx0 >= 0")

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        y, x = frame["y"].to_numpy(), frame["x"].to_numpy()
        oy, ox = y.min(), x.min()
        patch = np.zeros((y.max() - oy + 1, x.max() - ox + 1), np.int64)
        patch[y - oy, x - ox] = frame["level"].to_numpy()
        own = (y // block == key[1]) & (x // block == key[2])
        if not own.any():  # a margin without a block
            return frame.iloc[:0][[by, "y", "x"]].assign(entropy=0.0)
        y, x = y[own], x[own]
        wide = np.pad(patch, half, mode="edge")
        out = np.zeros(len(y))
        for b in range(levels):
            sums = np.zeros((wide.shape[0] + 1, wide.shape[1] + 1), np.int64)
            sums[1:, 1:] = (wide == b).cumsum(0).cumsum(1)
            i, j = y - oy, x - ox
            share = (sums[i + window, j + window] - sums[i, j + window] - sums[i + window, j] + sums[i, j]) / (window * window)
            out -= np.where(share > 0, share * np.log2(np.where(share > 0, share, 1.0)), 0.0)
        return pd.DataFrame({by: key[0], "y": y, "x": x, "entropy": out})

    kind = dict(pixels.dtypes)[by]
    return dealt.groupBy(by, "by0", "bx0").applyInPandas(run, f"{by} {kind}, y int, x int, entropy double")


def nearest_resize(pixels: DataFrame, values: list[str], in_h: Column, in_w: Column, out_h: Column, out_w: Column, by: str = "slide_id") -> DataFrame:
    """``by, y, x, values`` on the output grid: each pixel takes source ``i * in div out``.

    Every source pixel knows the output pixels it feeds, so nothing is joined or shuffled.
    """

    def span(i: str, n_in: Column, n_out: Column) -> Column:
        low = F.ceil(F.col(i) * n_out / n_in).cast("int")
        high = (F.ceil((F.col(i) + 1) * n_out / n_in) - 1).cast("int")
        return F.when(high >= low, F.sequence(low, high)).otherwise(F.expr("cast(array() as array<int>)"))

    rows = pixels.select(by, *values, span("y", in_h, out_h).alias("_ys"), span("x", in_w, out_w).alias("_xs"))
    return rows.withColumn("y", F.explode("_ys")).withColumn("x", F.explode("_xs")).select(by, "y", "x", *values)


def linear_taps(size: DataFrame, n_in: str, n_out: str) -> DataFrame:
    """``out, src, weight`` and the columns of ``size``: two taps a pixel, ends meet ends."""
    at = F.when(F.col(n_out) > 1, F.col("out").cast("long") * (F.col(n_in) - 1) / (F.col(n_out) - 1).cast("double")).otherwise(0.0)
    rows = size.withColumn("out", F.explode(F.sequence(F.lit(0), F.col(n_out) - 1))).withColumn("_at", at)
    low = F.least(F.floor("_at"), F.col(n_in) - 1).cast("int")
    pair = F.array(F.struct(low.alias("src"), (F.lit(1.0) - (F.col("_at") - low)).alias("weight")), F.struct((low + 1).alias("src"), (F.col("_at") - low).alias("weight")))
    return rows.withColumn("_tap", F.explode(pair)).select(*size.columns, "out", "_tap.*").where((F.col("weight") > 0) & (F.col("src") < F.col(n_in)))


def lanczos_taps(size: DataFrame, n_in: str, n_out: str, lobes: int = 3) -> DataFrame:
    """``out, src, weight`` and the columns of ``size``: a Lanczos kernel, widened when shrinking.

    Pixel centres meet; taps beyond the border fall on the edge pixel; weights sum to 1.
    """
    scale = F.greatest(F.lit(1.0), F.col(n_in) / F.col(n_out).cast("double"))
    rows = size.withColumn("out", F.explode(F.sequence(F.lit(0), F.col(n_out) - 1))).withColumn("_c", (F.col("out") + 0.5) * F.col(n_in) / F.col(n_out).cast("double") - 0.5)
    reach = scale * lobes
    rows = rows.withColumn("_i", F.explode(F.sequence(F.ceil(F.col("_c") - reach).cast("int"), F.floor(F.col("_c") + reach).cast("int"))))
    t = (F.col("_i") - F.col("_c")) / scale
    sinc = lambda z: F.when(F.abs(z) < 1e-12, 1.0).otherwise(F.sin(F.lit(math.pi) * z) / (F.lit(math.pi) * z))
    rows = rows.withColumn("_w", sinc(t) * sinc(t / lobes)).withColumn("src", F.greatest(F.lit(0), F.least(F.col("_i"), F.col(n_in) - 1)))
    taps = rows.groupBy(*size.columns, "out", "src").agg(F.sum("_w").alias("_w"))
    total = taps.groupBy(*size.columns, "out").agg(F.sum("_w").alias("_t"))
    return taps.join(total, [*size.columns, "out"]).select(*size.columns, "out", "src", (F.col("_w") / F.col("_t")).alias("weight"))


def resample(pixels: DataFrame, values: list[str], taps_y: DataFrame, taps_x: DataFrame, by: str = "slide_id") -> DataFrame:
    """``by, y, x, values`` (doubles): separable resampling, one axis after the other.

    ``taps_*`` have ``by, out, src, weight``: as many rows as an axis has pixels times its taps.
    Each pass is an equality join and a sum that combines before its shuffle.
    """
    ty = taps_y.select(F.col(by), F.col("src").alias("y"), F.col("out").alias("_oy"), F.col("weight").alias("_w"))
    tall = pixels.join(ty, [by, "y"]).groupBy(by, "_oy", "x").agg(*[F.sum(F.col(v) * F.col("_w")).alias(v) for v in values])
    tx = taps_x.select(F.col(by), F.col("src").alias("x"), F.col("out").alias("_ox"), F.col("weight").alias("_w"))
    wide = tall.join(tx, [by, "x"]).groupBy(by, "_oy", "_ox").agg(*[F.sum(F.col(v) * F.col("_w")).alias(v) for v in values])
    return wide.select(by, F.col("_oy").alias("y"), F.col("_ox").alias("x"), *values)


def to_u8(value: Column) -> Column:
    """Clipped to 0..255 and truncated; sums that miss a whole number by rounding count as it."""
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), value)) + 1e-9).cast("int")


def reflect_pad(pixels: DataFrame, values: list[str], height: Column, width: Column, multiple: int = 64, by: str = "slide_id") -> DataFrame:
    """``by, y, x, values`` padded to a multiple of ``multiple`` by mirroring; an odd pixel goes to the end.

    Axes shorter than their padding are mirrored to and fro. Each source pixel knows its mirror
    images, so nothing is joined, and counts them out, so work does not depend on the axis' length.
    Coordinates stay relative to the source: padding at the start is negative.
    """

    def mirrored(rows: DataFrame, i: str, n: Column) -> DataFrame:
        """A row for each place of ``i``: ``_a`` and ``_b`` are the first ones whole periods from ``i`` and from ``-i``.

        Steps are columns of their own: one expression of sequences took eight times as long.
        """
        at, pad = F.col(i), F.pmod(-n, F.lit(multiple))
        start, inside = -F.floor(pad / 2).cast("int"), (F.col(i) >= 0) & (F.col(i) < n)
        first = lambda p: F.col("_lo") + F.pmod(p - F.col("_lo"), F.col("_period"))
        rows = rows.withColumns({"_lo": start, "_hi": start + n - 1 + pad, "_period": F.greatest(F.lit(1), 2 * (n - 1))})
        rows = rows.withColumns({"_a": F.when(inside, first(at)).otherwise(at), "_b": first(-at)})
        further = F.when(inside, F.expr("cast((_hi - _a) div _period as int)")).otherwise(0)
        apart = inside & (F.pmod(at + at, F.col("_period")) != 0) & (F.col("_b") <= F.col("_hi"))
        rows = rows.withColumns({"_further": further, "_others": F.when(apart, F.expr("cast((_hi - _b) div _period as int) + 1")).otherwise(0)})
        rows = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_further") + F.col("_others"))))
        place = F.expr("if(_k <= _further, _a + _k * _period, _b + (_k - _further - 1) * _period)")
        return rows.withColumn(i, place).drop("_lo", "_hi", "_period", "_a", "_b", "_further", "_others", "_k")

    rows = pixels.select(by, "y", "x", *values, height.cast("int").alias("_h"), width.cast("int").alias("_w")).where("_h is not null and _w is not null")
    return mirrored(mirrored(rows, "y", F.col("_h")), "x", F.col("_w")).select(by, "y", "x", *values)


def window_starts(size: Column, roi: int, overlap: float) -> Column:
    """Where windows of ``roi`` pixels start along an axis: the last one ends at the border."""
    step = max(1, int(roi * (1 - overlap)))
    count = F.when(size <= roi, 1).otherwise(F.ceil((size - roi) / F.lit(float(step))) + 1).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.greatest(F.lit(0), F.least(i * step, size - roi)).cast("int"))


def windows_of(pixels: DataFrame, height: Column, width: Column, roi: int, overlap: float) -> DataFrame:
    """All columns with ``wy, wx``: a row for each window that covers the pixel.

    The windows of ``window_starts``, found from the pixel's place: work does not depend on how many
    windows an axis has. Of those a whole number of steps from 0 the first and last are known; the
    one that ends at the border comes after them.
    """
    step = max(1, int(roi * (1 - overlap)))

    def covering(rows: DataFrame, i: str, size: Column, out: str) -> DataFrame:
        below = lambda v: v - F.pmod(v, F.lit(step))  # noqa: E731  # the last multiple of step up to v
        border = F.greatest(F.lit(0), size - roi)
        rows = rows.withColumns({"_first": F.greatest(F.lit(0), below(F.col(i) - roi) + step), "_last": F.least(below(F.col(i)), below(border - 1)), "_border": border})
        regular = F.greatest(F.lit(0), F.expr(f"cast((_last - _first + {step}) div {step} as int)"))
        ending = ((F.col("_border") <= F.col(i)) & (F.col(i) < F.col("_border") + roi)).cast("int")
        rows = rows.withColumn("_regular", regular).withColumn("_all", F.col("_regular") + ending).where("_all > 0")
        rows = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_all") - 1)))
        start = F.expr(f"cast(if(_k < _regular, _first + _k * {step}, _border) as int)")
        return rows.withColumn(out, start).drop("_first", "_last", "_border", "_regular", "_all", "_k")

    rows = pixels.withColumns({"_h": height.cast("int"), "_w": width.cast("int")}).where("_h is not null and _w is not null")
    return covering(covering(rows, "y", F.col("_h"), "wy"), "x", F.col("_w"), "wx").drop("_h", "_w")


def importance(roi: int, overlap: float, sigma: float = 0.125) -> Column:
    """A pixel's weight in its window: a Gaussian around the centre, or 1 without overlap."""
    if overlap <= 0:
        return F.lit(1.0)
    d = lambda i, s: F.col(i) - F.col(s) - F.lit((roi - 1) / 2.0)
    return F.greatest(F.exp(-(d("y", "wy") * d("y", "wy") + d("x", "wx") * d("x", "wx")) / F.lit(2 * (sigma * roi) ** 2)), F.lit(1e-3))


def blend(scored: DataFrame, values: list[str], weight: Column, by: str = "slide_id") -> DataFrame:
    """``by, y, x, values``: the weighted mean over the windows that cover a pixel."""
    rows = scored.withColumn("_w", weight)
    sums = rows.groupBy(by, "y", "x").agg(F.sum("_w").alias("_w"), *[F.sum(F.col(v) * F.col("_w")).alias(v) for v in values])
    return sums.select(by, "y", "x", *[(F.col(v) / F.col("_w")).alias(v) for v in values])
