"""Per-pixel arithmetic as Column expressions: everything here stays in whole-stage codegen.

Colours are integers 0 to 255, real values are doubles. Nulls in give nulls out unless said
otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the two grey conversions and the thresholds of the white rules.
GRAY_WEIGHTS = (0.2989, 0.5870, 0.1140)
BRIGHTNESS, SATURATION, ENTROPY = 0.82, 0.25, 2.4
BASE_BRIGHTNESS, BASE_SATURATION, VERY_BRIGHT = 0.83, 0.12, 0.94
BACKGROUND, EPITHELIUM, STROMA = 0, 1, 2


def clip(c: Column, low, high) -> Column:
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.least(F.greatest(c, low), high)


def brightness(r: Column, g: Column, b: Column) -> Column:
    """HSV value, 0 to 1."""
    return F.greatest(r, g, b) / F.lit(255.0)


def saturation(r: Column, g: Column, b: Column) -> Column:
    """HSV saturation, 0 for black."""
    top = F.greatest(r, g, b)
    return F.when(top > 0, (top - F.least(r, g, b)) / top.cast("double")).when(top.isNotNull(), F.lit(0.0))


def gray(r: Column, g: Column, b: Column) -> Column:
    """Luminance as a double."""
    return r * F.lit(GRAY_WEIGHTS[0]) + g * F.lit(GRAY_WEIGHTS[1]) + b * F.lit(GRAY_WEIGHTS[2])


def gray_bin(r: Column, g: Column, b: Column) -> Column:
    """One of 16 grey levels, from integer thousandths so that no rounding can move a level."""
    return F.shiftright(((r * 299 + g * 587 + b * 114) / F.lit(1000)).cast("int"), 4)


def optical_density(v: Column, io: Column) -> Column:
    """``-log10(clip(v, 1, io) / io)``."""
    return F.lit(0.0) - F.log10(F.least(F.greatest(v.cast("double"), F.lit(1.0)), io) / io)


def concentration(density: Sequence[Column], row: Sequence[Column]) -> Column:
    """The product of a pixel's densities with one row of the inverted stain matrix."""
    return sum((d * w for d, w in zip(density[1:], row[1:])), density[0] * row[0])


def mean_density(density: Sequence[Column]) -> Column:
    return sum(density[1:], density[0]) / F.lit(float(len(density)))


def stretch(v: Column, low: Column, high: Column) -> Column:
    """Clipped position between two percentiles, 0 to 255, truncated."""
    return (F.lit(255.0) * clip((v - low) / (high - low + F.lit(1e-8)), 0.0, 1.0)).cast("int")


def stretch_inverted(v: Column, low: Column, high: Column) -> Column:
    """The same from 255 down to 0: strong stain is dark."""
    return (F.lit(255.0) - F.lit(255.0) * clip((v - low) / (high - low + F.lit(1e-8)), 0.0, 1.0)).cast("int")


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def label(z_epithelium: Column, z_stroma: Column, z_background: Column) -> Column:
    """Class of a pixel: a class needs more than one half and more than the background has.

    Epithelium wins over stroma whatever their order; this is no argmax. Null logits are background.
    """
    p0, p1, p2 = (sigmoid(z) for z in (z_epithelium, z_stroma, z_background))
    return F.when((p0 > 0.5) & (p0 > p2), EPITHELIUM).when((p1 > 0.5) & (p1 > p2), STROMA).otherwise(BACKGROUND)


def is_white(r: Column, g: Column, b: Column, entropy: Column, bright: float = BRIGHTNESS, saturated: float = SATURATION, even: float = ENTROPY) -> Column:
    """Bright, pale and of little texture."""
    return (brightness(r, g, b) > bright) & (saturation(r, g, b) < saturated) & (entropy < even)


def is_base_white(r: Column, g: Column, b: Column, bright: float = BASE_BRIGHTNESS, saturated: float = BASE_SATURATION) -> Column:
    """Bright and nearly colourless, whatever the texture."""
    return (brightness(r, g, b) > bright) & (saturation(r, g, b) < saturated)


def is_pure_white(r: Column, g: Column, b: Column) -> Column:
    return (r == 255) & (g == 255) & (b == 255)


def as_rgb(bands: Column) -> Column:
    """Three bands of an array of any length: one is repeated, a fourth and later ones are left out.

    Two bands, none and null give null.
    """
    one = F.array(F.get(bands, F.lit(0)), F.get(bands, F.lit(0)), F.get(bands, F.lit(0)))
    return F.when(F.size(bands) == 1, one).when(F.size(bands) >= 3, F.slice(bands, 1, 3))
