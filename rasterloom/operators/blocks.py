"""Masks as rows of blocks: packed bytes, border strips that neighbours exchange, bit maps.

Pixels are packed once, before their only shuffle, at three bytes each. From then on a row is a
block of ``cell`` pixels a side, and what goes from block to block are strips along its borders,
so nothing is joined by pixel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pixel
from ..scratch import materialise, shared_dir
from .components import _local_roots
from .graph import components
from .stats import with_slide

PALE, BASE, VERY, UNSEEN = 16, 32, 64, 128
LEVELS = 16


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags.ravel()).tobytes()


def _flags(bits: bytes, cell: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=cell * cell).astype(bool).reshape(cell, cell)


def _entropy(levels: np.ndarray, half: int) -> np.ndarray:
    """Bits of entropy of the window around each pixel; beyond the border the edge pixel repeats."""
    wide, window = np.pad(levels, half, mode="edge"), 2 * half + 1
    out = np.zeros(levels.shape)
    for b in range(LEVELS):
        sums = np.zeros((wide.shape[0] + 1, wide.shape[1] + 1), np.int64)
        sums[1:, 1:] = (wide == b).cumsum(0).cumsum(1)
        share = (sums[window:, window:] - sums[:-window, window:] - sums[window:, :-window] + sums[:-window, :-window]) / (window * window)
        out -= np.where(share > 0, share * np.log2(np.where(share > 0, share, 1.0)), 0.0)
    return out


def _packed(coded: DataFrame, by: str, kind: str) -> DataFrame:
    """``by, cy, cx, at, code`` (binary): of each batch the pixels of a block in one row, each once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [
                (*key, part["at"].to_numpy("<u2").tobytes(), part["code"].to_numpy(np.uint8).tobytes())
                for key, part in frame.groupby([by, "cy", "cx", "at"], as_index=False)["code"].max().groupby([by, "cy", "cx"])
            ]
            yield pd.DataFrame(found, columns=[by, "cy", "cx", "at", "code"])

    return coded.mapInPandas(run, f"{by} {kind}, cy int, cx int, at binary, code binary")


def with_halo(packed: DataFrame, cell: int, reach: int, by: str = "slide_id") -> DataFrame:
    """``by, cy, cx, dy, dx, strip``: each block's codes (``dy = dx = 0``) and the strips of its neighbours.

    ``dy, dx`` say where the strip comes from, as seen from the block ``cy, cx`` that gets it. A block
    gives each of its eight neighbours ``reach`` rows or columns, or a corner of that many a side.
    """
    kind = dict(packed.dtypes)[by]

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        plane = np.full(cell * cell, UNSEEN, np.uint8)
        at = np.concatenate([np.frombuffer(a, "<u2") for a in frame["at"]])
        code = np.concatenate([np.frombuffer(c, np.uint8) for c in frame["code"]])
        order = np.lexsort((code, at))
        plane[at[order]] = code[order]
        plane = plane.reshape(cell, cell)
        part = {-1: slice(0, reach), 0: slice(None), 1: slice(cell - reach, cell)}
        out = [
            (key[0], key[1] + dy, key[2] + dx, -dy, -dx, plane[part[dy], part[dx]].tobytes())
            for dy in part for dx in part if key[1] + dy >= 0 and key[2] + dx >= 0
        ]
        return pd.DataFrame(out, columns=[by, "cy", "cx", "dy", "dx", "strip"])

    return packed.groupBy(by, "cy", "cx").applyInPandas(run, f"{by} {kind}, cy int, cx int, dy int, dx int, strip binary")


def white_blocks(
    pixels: DataFrame, bright: float = pixel.BRIGHTNESS, saturated: float = pixel.SATURATION, window: int = 9, even: float = pixel.ENTROPY,
    base_bright: float = pixel.BASE_BRIGHTNESS, base_saturated: float = pixel.BASE_SATURATION, cell: int = 256, by: str = "slide_id",
) -> DataFrame:
    """``by, cy, cx, seen, white`` (bit maps, row by row): white pixels by each slide's own rule.

    ``pixels`` has ``by, y, x, r, g, b`` in 8 bits. Pixels without slide or place, or with a negative
    one, are left out; one with a null channel is seen, of level 0 and never white; of repeated ones
    the one with the largest code counts. A pixel that is missing inside a block counts as level 0.
    """
    if window % 2 == 0 or not window // 2 <= cell <= 256:
        raise ValueError("the window has an odd width and fits in a block, and a block has at most 256 pixels a side")
    half, kind = window // 2, dict(pixels.dtypes)[by]
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    flag = lambda c, bit: F.when(c, bit).otherwise(0)
    level = F.least(F.greatest(F.coalesce(pixel.gray_bin(r, g, b), F.lit(0)), F.lit(0)), F.lit(LEVELS - 1)).cast("int")
    code = level + flag(pixel.is_white(r, g, b, F.lit(-1.0), bright, saturated, 0.0), PALE)
    code = code + flag(pixel.is_base_white(r, g, b, base_bright, base_saturated), BASE) + flag(pixel.brightness(r, g, b) > pixel.VERY_BRIGHT, VERY)
    known = pixels.where(F.col(by).isNotNull() & (F.col("y") >= 0) & (F.col("x") >= 0))
    place = [F.expr(f"cast({c} div {cell} as int)").alias(n) for c, n in (("y", "cy"), ("x", "cx"))]
    coded = known.select(by, *place, F.expr(f"cast((y % {cell}) * {cell} + x % {cell} as int)").alias("at"), code.alias("code"))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        columns = [by, "cy", "cx", "n", "n_textured", "n_plain", "seen", "plain", "textured"]
        parts = {(dy, dx): s for dy, dx, s in zip(frame["dy"], frame["dx"], frame["strip"])}
        if (0, 0) not in parts:  # neighbours of a block that is not there
            return pd.DataFrame([], columns=columns)
        wide = np.full((cell + 2 * half, cell + 2 * half), UNSEEN, np.uint8)
        to = {-1: slice(0, half), 0: slice(half, half + cell), 1: slice(half + cell, cell + 2 * half)}
        for (dy, dx), strip in parts.items():
            rows = half if dy else cell
            wide[to[dy], to[dx]] = np.frombuffer(strip, np.uint8).reshape(rows, -1) if strip else 0
        y, x = np.nonzero(wide != UNSEEN)
        box = slice(y.min(), y.max() + 1), slice(x.min(), x.max() + 1)
        entropy = np.zeros(wide.shape)
        entropy[box] = _entropy(np.where(wide[box] == UNSEEN, 0, wide[box] % LEVELS), half)
        own, entropy = wide[to[0], to[0]], entropy[to[0], to[0]]
        seen = own != UNSEEN
        textured = seen & (own & PALE > 0) & (entropy < even)
        plain = seen & (own & BASE > 0)
        both = textured | (plain & (own & VERY > 0))
        return pd.DataFrame([(*key, int(seen.sum()), int(textured.sum()), int(plain.sum()), _bits(seen), _bits(plain), _bits(both))], columns=columns)

    schema = f"{by} {kind}, cy int, cx int, n long, n_textured long, n_plain long, seen binary, plain binary, textured binary"
    found = with_halo(_packed(coded, by, kind), cell, half, by).groupBy(by, "cy", "cx").applyInPandas(run, schema)
    found = materialise(found, shared_dir(pixels.sparkSession), "flags")
    shares = found.groupBy(by).agg((F.sum("n_textured") / F.sum("n")).alias("_fe"), (F.sum("n_plain") / F.sum("n")).alias("_fb"))
    rule = (F.col("_fe") < 0.01) | (F.col("_fe") > 0.90) | (F.col("_fe") > 1.8 * F.col("_fb") + 1e-6)
    ruled = with_slide(found, shares.select(by, rule.alias("_plain")), by)
    return ruled.select(by, "cy", "cx", "seen", F.when(F.col("_plain"), F.col("plain")).otherwise(F.col("textured")).alias("white"))


def large_block_parts(blocks: DataFrame, least: int = 128, flag: str = "white", cell: int = 256, by: str = "slide_id") -> DataFrame:
    """``by, cy, cx, kept``: of the bit maps ``flag`` the pixels in parts, connected by sides, of at least ``least``.

    A block is labelled where it lies; of each only its parts' areas and its four borders are
    compared with others, and the parts of one slide that touch are merged by contraction.
    """
    folder, kind = shared_dir(blocks.sparkSession), dict(blocks.dtypes)[by]
    sides = ("top", "bottom", "left", "right")
    shape = ", ".join(f"{s} binary" for s in sides)

    def label(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for slide, cy, cx, bits in frame.itertuples(index=False):
                y, x = np.nonzero(_flags(bits, cell))
                if not len(y):
                    continue
                first = _local_roots(y, x)
                plane = np.full((cell, cell), -1, "<i4")
                plane[y, x] = y[first] * cell + x[first]
                roots, areas = np.unique(plane[y, x], return_counts=True)
                out.append((slide, cy, cx, plane.tobytes(), roots.astype(np.int32), areas.astype(np.int32), *(plane[s].tobytes() for s in (0, -1, (slice(None), 0), (slice(None), -1)))))
            yield pd.DataFrame(out, columns=[by, "cy", "cx", "plane", "roots", "areas", *sides])

    def touching(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [np.zeros((0, 2), np.int64)]
            owner = [np.zeros(0, np.int64)]
            for i, (one, other) in enumerate(zip(frame["one"], frame["other"])):
                pair = np.stack([np.frombuffer(one, "<i4"), np.frombuffer(other, "<i4")], 1)
                pair = np.unique(pair[(pair >= 0).all(1)], axis=0)
                out.append(pair)
                owner.append(np.full(len(pair), i))
            pairs, rows = np.concatenate(out), np.concatenate(owner)
            yield frame.iloc[rows][[by, "ay", "ax", "cy", "cx"]].assign(ra=pairs[:, 0], rb=pairs[:, 1])

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            kept = [_bits(np.isin(np.frombuffer(p, "<i4"), np.asarray(r))) for p, r in zip(frame["plane"], frame["big"])]
            yield frame[[by, "cy", "cx"]].assign(kept=kept)

    local = blocks.select(by, "cy", "cx", flag).mapInPandas(label, f"{by} {kind}, cy int, cx int, plane binary, roots array<int>, areas array<int>, {shape}")
    local = materialise(local, folder, "local")
    below = local.select(by, F.col("cy").alias("ay"), F.col("cx").alias("ax"), (F.col("cy") + 1).alias("cy"), "cx", F.col("bottom").alias("one"))
    below = below.join(local.select(by, "cy", "cx", F.col("top").alias("other")), [by, "cy", "cx"])
    beside = local.select(by, F.col("cy").alias("ay"), F.col("cx").alias("ax"), "cy", (F.col("cx") + 1).alias("cx"), F.col("right").alias("one"))
    beside = beside.join(local.select(by, "cy", "cx", F.col("left").alias("other")), [by, "cy", "cx"])
    edges = below.unionByName(beside).mapInPandas(touching, f"{by} {kind}, ay int, ax int, cy int, cx int, ra int, rb int")
    name = lambda y, x, root: F.struct(F.col(by).alias("s"), F.col(y).alias("cy"), F.col(x).alias("cx"), F.col(root).alias("root"))
    merged = components(materialise(edges.select(name("ay", "ax", "ra").alias("a"), name("cy", "cx", "rb").alias("b")), folder, "touching"), folder, "merged")
    parts = local.select(by, "cy", "cx", F.explode(F.arrays_zip("roots", "areas")).alias("p")).select(by, "cy", "cx", F.col("p.roots").alias("root"), F.col("p.areas").alias("area"))
    parts = parts.withColumn("node", name("cy", "cx", "root")).join(merged.select("node", F.col("root").alias("whole")), "node", "left")
    parts = materialise(parts.withColumn("whole", F.coalesce("whole", "node")).drop("node"), folder, "block-parts")
    big = parts.groupBy("whole").agg(F.sum("area").alias("area")).where(F.col("area") >= least).select("whole")
    # at most half as many parts in a block as it has pixels
    chosen = parts.join(big, "whole", "left_semi").groupBy(by, "cy", "cx").agg(F.collect_list("root").alias("big"))
    return local.select(by, "cy", "cx", "plane").join(chosen, [by, "cy", "cx"]).mapInPandas(keep, f"{by} {kind}, cy int, cx int, kept binary")


def background_blocks(pixels: DataFrame, least_area: int = 128, cell: int = 256, by: str = "slide_id", **options) -> DataFrame:
    """``by, cy, cx, seen, background`` (bit maps): what ``background.detect_background`` finds, by blocks."""
    white = materialise(white_blocks(pixels, cell=cell, by=by, **options), shared_dir(pixels.sparkSession), "white")
    found = large_block_parts(white, least_area, cell=cell, by=by)
    none = F.lit(bytes(-(-cell * cell // 8)))
    return white.join(found, [by, "cy", "cx"], "left").select(by, "cy", "cx", "seen", F.coalesce("kept", none).alias("background"))


def block_pixels(blocks: DataFrame, flag: str = "background", cell: int = 256, by: str = "slide_id") -> DataFrame:
    """``by, y, x, flag``: the seen pixels of the blocks again, without a shuffle."""
    kind = dict(blocks.dtypes)[by]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for slide, cy, cx, seen, bits in frame.itertuples(index=False):
                y, x = np.nonzero(_flags(seen, cell))
                yield pd.DataFrame({by: slide, "y": y + cy * cell, "x": x + cx * cell, flag: _flags(bits, cell)[y, x]})

    return blocks.select(by, "cy", "cx", "seen", flag).mapInPandas(run, f"{by} {kind}, y int, x int, {flag} boolean")
