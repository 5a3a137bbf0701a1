"""From the pixels of slides to a label for each pixel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import scoring, stain, stats
from ..operators.background import detect_background
from ..operators.neighbourhood import nearest_resize
from ..scratch import materialise, shared_dir


def preprocess(pixels: DataFrame, by: str = "slide_id", **options) -> DataFrame:
    """``by, y, x, e, h, od, tissue``: the separated image and where it shows tissue."""
    marked = materialise(detect_background(pixels, by=by, **options), shared_dir(pixels.sparkSession), "background")
    image = stain.eho_image(marked, by=by)
    return image.join(marked.select(by, "y", "x", (~F.col("background")).alias("tissue")), [by, "y", "x"])


def label_image(image: DataFrame, scorer: scoring.Scorer, roi: int = 512, overlap: float = 0.25, apply_tissue_mask: bool = True, by: str = "slide_id") -> DataFrame:
    """``by, y, x, label`` of what ``preprocess`` gives (stored, since it is read several times)."""
    size = materialise(image.groupBy(by).agg((F.max("y") + 1).alias("_h"), (F.max("x") + 1).alias("_w")), shared_dir(image.sparkSession), "size")
    channels = stats.with_slide(stats.normalise(image.select(by, "y", "x", "e", "h", "od"), ["e", "h", "od"], by), size, by)
    logits = scoring.score_windows(channels, ["e", "h", "od"], scorer, roi, overlap, height="_h", width="_w", by=by)
    return scoring.labels(logits, image if apply_tissue_mask else None, by)


def segment(
    pixels: DataFrame, scorer: scoring.Scorer, roi: int = 512, overlap: float = 0.25, apply_tissue_mask: bool = True, output_size: tuple[int, int] | None = None, by: str = "slide_id",
) -> DataFrame:
    """``by, y, x, label`` of every pixel: 0 background, 1 epithelium, 2 stroma.

    The scorer is the user's; nothing trained comes with the library. ``apply_tissue_mask`` sets
    what is no tissue to 0; ``output_size`` (height, width) resizes the labels, nearest pixel.
    """
    ready = materialise(preprocess(pixels, by), shared_dir(pixels.sparkSession), "ready")
    found = label_image(ready, scorer, roi, overlap, apply_tissue_mask, by)
    if output_size is None:
        return found
    size = ready.groupBy(by).agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    return nearest_resize(stats.with_slide(found, size, by), ["label"], F.col("h"), F.col("w"), F.lit(output_size[0]), F.lit(output_size[1]), by)
