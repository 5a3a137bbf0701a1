"""Which pixels of an image show no tissue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pixel
from ..scratch import materialise, shared_dir
from .components import large_parts
from .gate import white_rule
from .neighbourhood import local_entropy


def white_pixels(
    pixels: DataFrame, bright: float = pixel.BRIGHTNESS, saturated: float = pixel.SATURATION, window: int = 9, even: float = pixel.ENTROPY, by: str = "slide_id",
) -> DataFrame:
    """All columns with ``entropy_white``, ``base_white`` and ``white``, by each slide's own rule."""
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    entropy = local_entropy(pixels, pixel.gray_bin(r, g, b), window, by=by)
    flags = pixels.join(entropy, [by, "y", "x"]).withColumn("entropy_white", pixel.is_white(r, g, b, F.col("entropy"), bright, saturated, even))
    flags = materialise(flags.withColumn("base_white", pixel.is_base_white(r, g, b)).drop("entropy"), shared_dir(pixels.sparkSession), "flags")
    return white_rule(flags, by=by)


def detect_background(pixels: DataFrame, least_area: int = 128, by: str = "slide_id", **options) -> DataFrame:
    """All columns with ``background``: white pixels in connected parts of at least ``least_area``."""
    white = white_pixels(pixels, by=by, **options).where("white")
    found = large_parts(white, least=least_area, by=by).withColumn("background", F.lit(True))
    return pixels.join(found, [by, "y", "x"], "left").select(*pixels.columns, F.coalesce("background", F.lit(False)).alias("background"))


def tissue_mask(pixels: DataFrame, by: str = "slide_id", **options) -> DataFrame:
    """``by, y, x, tissue``: all that is no background."""
    return detect_background(pixels, by=by, **options).select(by, "y", "x", (~F.col("background")).alias("tissue"))
