"""Joins of tiles with the mask below them, and the choice of a whole image's white rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pixel
from ..scratch import materialise, shared_dir
from .areas import rectangle_counts
from .stats import fraction, with_slide


def _span(origin: str, length: str, out: str, thumb: str) -> tuple[Column, Column]:
    """First and last (exclusive) thumbnail pixel under a span of output pixels.

    Products of two positions need more than 32 bits.
    """
    at = lambda place: F.expr(f"cast(({place}) * {thumb} div {out} as int)")
    wide = f"cast({origin} as bigint)"
    return at(wide), F.least(F.col(thumb), at(f"{wide} + {length}") + 1)


def gate_tiles(tiles: DataFrame, mask: DataFrame, flag: str = "tissue", least: float = 0.01, cell: int = 64, by: str = "slide_id") -> DataFrame:
    """All columns of ``tiles`` with ``n_px``, ``n_tissue``, ``tissue_fraction`` and ``tissue``.

    ``tiles`` has the tile (``oy0, ox0, oh, ow``) in an image of ``h`` x ``w`` pixels; ``mask`` has
    ``by, y, x`` and a boolean of a thumbnail of ``th`` x ``tw``, columns of ``tiles`` too. The
    2-D range join is four look-ups a tile in summed areas of the mask (``areas``). Repeated tiles
    have the same counts; a tile over no mask pixel has no tissue.
    """
    y0, y1 = _span("oy0", "oh", "h", "th")
    x0, x1 = _span("ox0", "ow", "w", "tw")
    whole = F.struct(*[F.col(f"`{c}`") for c in tiles.columns])
    spans = tiles.select(whole.alias("key"), F.col(by).alias("slide"), y0.alias("y0"), y1.alias("y1"), x0.alias("x0"), x1.alias("x1"))
    spans = materialise(spans, shared_dir(tiles.sparkSession), "spans")
    counts = rectangle_counts(spans.distinct(), mask.select(F.col(by).alias("slide"), "y", "x", flag), flag, cell, "slide")
    every = spans.select("key").join(counts, "key", "left")
    share = F.when(F.col("n") > 0, F.col("f") / F.col("n")).otherwise(0.0)
    out = every.select("key.*", F.coalesce("n", F.lit(0)).alias("n_px"), F.coalesce("f", F.lit(0)).alias("n_tissue"), share.alias("tissue_fraction"))
    return out.withColumn("tissue", (F.col("n_px") > 0) & (F.col("tissue_fraction") >= least))


def white_rule(pixels: DataFrame, entropy_white: str = "entropy_white", base_white: str = "base_white", by: str = "slide_id") -> DataFrame:
    """All columns with ``white``: each slide takes the rule that its own shares of white pixels call for.

    The plain rule is used where the textured one finds under 1 %, over 90 % or far more than the
    plain one; else the textured one, together with very bright pixels of the plain one.
    """
    shares = pixels.groupBy(by).agg(fraction(F.col(entropy_white)).alias("_fe"), fraction(F.col(base_white)).alias("_fb"))
    plain = (F.col("_fe") < 0.01) | (F.col("_fe") > 0.90) | (F.col("_fe") > 1.8 * F.col("_fb") + 1e-6)
    bright = pixel.brightness(F.col("r"), F.col("g"), F.col("b")) > pixel.VERY_BRIGHT
    both = F.col(entropy_white) | (F.col(base_white) & bright)
    return with_slide(pixels, shares, by).withColumn("white", F.when(plain, F.col(base_white)).otherwise(both)).select(*pixels.columns, "white")
