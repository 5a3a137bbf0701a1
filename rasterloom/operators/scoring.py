"""Scoring images with a model of the user's, window by window, and putting tiles together."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pixel
from .neighbourhood import blend, importance, windows_of

#: A scorer gets a float32 image (height, width, 3) and gives logits (height, width, 3) in the
#: order epithelium, stroma, background.
Scorer = Callable[[np.ndarray], np.ndarray]


def placeholder_scorer(image: np.ndarray) -> np.ndarray:
    """Fixed arithmetic on the channels. It is no trained model and its labels mean nothing."""
    e, h, od = (image[..., i].astype(np.float32) for i in range(3))
    return np.stack([4 * (0.6 - h), 4 * (0.6 - e), 6 * (od - 0.75)], -1)


_loaded: dict[str, Scorer] = {}


def once(name: str, load: Callable[[], Scorer]) -> Scorer:
    """The scorer that ``load`` gives, loaded once in each worker."""

    def score(image: np.ndarray) -> np.ndarray:
        if name not in _loaded:
            _loaded[name] = load()
        return _loaded[name](image)

    return score


def patches_per_call(roi: int, device: str = "cpu", memory_gb: float | None = None) -> int:
    """How many windows of ``roi`` pixels a side a model call takes."""
    factor = {"cuda": 2.0}.get(device)
    if factor is None and device == "mps":
        factor = min(8.0, max(1.5, memory_gb / 8)) if memory_gb else 3.0
    if factor is None:
        factor = min(2.0, max(0.5, memory_gb / 32)) if memory_gb else 0.5
    return min(1024, max(1, int(16 * (512**2 / roi**2) * factor)))


def score_patch(patch: np.ndarray, scorer: Scorer, multiple: int = 64) -> np.ndarray:
    """Logits of one window, padded by reflection to ``multiple`` for the call."""
    h, w = patch.shape[:2]
    pads = [((-n % multiple) // 2, -n % multiple - (-n % multiple) // 2) for n in (h, w)]
    z = scorer(np.pad(patch, [*pads, (0, 0)], mode="reflect" if min(h, w) > 1 else "edge"))
    return z[pads[0][0] : pads[0][0] + h, pads[1][0] : pads[1][0] + w]


def score_windows(
    images: DataFrame, columns: list[str], scorer: Scorer, roi: int = 512, overlap: float = 0.25, multiple: int = 64, height: str = "h", width: str = "w", by: str = "slide_id",
) -> DataFrame:
    """``by, y, x, z_epi, z_stroma, z_bg``: logits blended over overlapping windows.

    Pixels are dealt once to the windows that cover them; a window is scored in one call (padded by
    reflection to ``multiple``) and its logits are summed with Gaussian weights, combined before
    the shuffle. A missing pixel counts as 0.
    """
    kind = dict(images.dtypes)[by]
    dealt = windows_of(images.select(by, "y", "x", *columns, height, width), F.col(height), F.col(width), roi, overlap)

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        y, x = frame["y"].to_numpy(), frame["x"].to_numpy()
        i, j = y - key[1], x - key[2]
        patch = np.zeros((i.max() + 1, j.max() + 1, len(columns)), np.float32)
        patch[i, j] = frame[columns].to_numpy(np.float32)
        z = score_patch(patch, scorer, multiple)[i, j].astype(float)
        return pd.DataFrame({by: key[0], "y": y, "x": x, "wy": key[1], "wx": key[2], "z_epi": z[:, 0], "z_stroma": z[:, 1], "z_bg": z[:, 2]})

    scored = dealt.groupBy(by, "wy", "wx").applyInPandas(run, f"{by} {kind}, y int, x int, wy int, wx int, z_epi double, z_stroma double, z_bg double")
    return blend(scored, ["z_epi", "z_stroma", "z_bg"], importance(roi, overlap), by)


def labels(logits: DataFrame, mask: DataFrame | None = None, by: str = "slide_id") -> DataFrame:
    """``by, y, x, label``; with a mask (``by, y, x, tissue``) what is no tissue gets 0."""
    found = logits.select(by, "y", "x", pixel.label(F.col("z_epi"), F.col("z_stroma"), F.col("z_bg")).alias("label"))
    if mask is None:
        return found
    tissue = mask.where("tissue").select(by, "y", "x", F.lit(True).alias("_t"))
    return found.join(tissue, [by, "y", "x"], "left").select(by, "y", "x", F.when(F.col("_t"), F.col("label")).otherwise(pixel.BACKGROUND).alias("label"))


def keep_part(tile_pixels: DataFrame) -> DataFrame:
    """The pixels (``y, x`` within the image) that lie in their tile's keep part."""
    inside = lambda i, o, skip, n: (F.col(i) >= F.col(o) + F.col(skip)) & (F.col(i) < F.col(o) + F.col(skip) + F.col(n))
    return tile_pixels.where(inside("y", "oy0", "keep_y0", "keep_h") & inside("x", "ox0", "keep_x0", "keep_w"))


def tiles_of(pixels: DataFrame, tiles: DataFrame, tile: int, stride: int, by: str = "slide_id") -> DataFrame:
    """Pixels with each tile that covers them, by the grid cells (an equality join).

    ``tile`` and ``stride`` are the grid's; a last tile may reach further, hence the exact test.
    """
    ends = lambda o, n: F.sequence(F.expr(f"{o} div {stride}"), F.expr(f"({o} + {n} - 1) div {stride}"))
    cells = tiles.withColumn("_cy", F.explode(ends("oy0", "oh"))).withColumn("_cx", F.explode(ends("ox0", "ow")))
    placed = pixels.withColumn("_cy", F.expr(f"y div {stride}")).withColumn("_cx", F.expr(f"x div {stride}"))
    joined = placed.join(cells, [by, "_cy", "_cx"])
    return joined.where("y >= oy0 and y < oy0 + oh and x >= ox0 and x < ox0 + ow").drop("_cy", "_cx")


def stitch(domain: DataFrame, tile_pixels: DataFrame, value: str = "label", default: int = 0, by: str = "slide_id") -> DataFrame:
    """``by, y, x, value`` for every pixel of ``domain``: from the tile that keeps it, else ``default``."""
    kept = keep_part(tile_pixels).select(by, "y", "x", value)
    return domain.select(by, "y", "x").join(kept, [by, "y", "x"], "left").select(by, "y", "x", F.coalesce(value, F.lit(default)).alias(value))


def canvas(domain: DataFrame, tile_pixels: DataFrame, values: list[str], default: int = 255, by: str = "slide_id") -> DataFrame:
    """``by, y, x, values`` for every pixel of ``domain``: from the whole tiles over it, else ``default``.

    Overlapping tiles are taken to agree; where they don't, the largest value counts.
    """
    seen = tile_pixels.groupBy(by, "y", "x").agg(*[F.max(v).alias(v) for v in values])
    return domain.select(by, "y", "x").join(seen, [by, "y", "x"], "left").select(by, "y", "x", *[F.coalesce(v, F.lit(default)).alias(v) for v in values])
