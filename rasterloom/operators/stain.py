"""Stain separation: vectors by masked principal components, concentrations and the E/H/density image."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pixel
from ..functions.symmetric import at, bind, cross, dot, main_axes, normal, turned, unit
from ..scratch import materialise, shared_dir
from .stats import background_intensity, percentiles, with_slide

# Published optical densities of the two dyes.
HEMATOXYLIN = (0.65, 0.70, 0.29)
EOSIN = (0.07, 0.99, 0.11)

_DENSITY = ["_d0", "_d1", "_d2"]


def with_density(pixels: DataFrame, io: str = "io") -> DataFrame:
    """All columns with the three channels' optical densities ``_d0, _d1, _d2``."""
    return pixels.withColumns({d: pixel.optical_density(F.col(c), F.col(io)) for d, c in zip(_DENSITY, "rgb")})


def density_moments(densities: DataFrame, columns: list[str] = _DENSITY, use: Column | None = None, by: str = "slide_id") -> DataFrame:
    """``by, n`` with means ``m<i>`` and covariances ``c<i><j>`` (population) over the rows to use: one combined pass."""
    keep = F.coalesce(use, F.lit(False)) if use is not None else F.lit(True)
    col = [F.when(keep, F.col(c)) for c in columns]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    return densities.groupBy(by).agg(
        F.count_if(keep).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(col)], *[F.covar_pop(col[i], col[j]).alias(f"c{i}{j}") for i, j in pairs]
    )


def _stains(low: Column, high: Column) -> Column:
    """``(h, e, rest)``: haematoxylin-like, eosin-like and residual, of unit length, from two directions."""
    def ordered(p: Column) -> Column:  # haematoxylin absorbs more red
        swap = F.get(p["a"], F.lit(0)) < F.get(p["b"], F.lit(0))
        return F.struct(F.when(swap, p["b"]).otherwise(p["a"]).alias("h"), F.when(swap, p["a"]).otherwise(p["b"]).alias("e"))

    def whole(p: Column) -> Column:
        flat = lambda n: dot(at(n), at(n)) <= 1e-18
        rest = bind(normal(p["h"], p["e"]), lambda n: F.when(flat(n), F.array(*[F.lit(0.0)] * 3)).otherwise(unit(n)))
        return F.struct(p["h"].alias("h"), p["e"].alias("e"), rest.alias("rest"))

    pair = F.struct(turned(unit(low)).alias("a"), turned(unit(high)).alias("b"))
    return bind(bind(pair, ordered), whole)


def _inverse(w: Column) -> Column:
    """Rows that give the amounts of the three; of parallel stains each takes half."""
    h, e, rest = (at(w[c]) for c in ("h", "e", "rest"))
    flat = dot(rest, rest) == 0
    rows = []
    for mine, other in ((h, cross(e, rest)), (e, cross(rest, h))):
        scale = dot(mine, other)
        rows.append(F.when(flat, F.array(*[c / 2.0 for c in mine])).otherwise(F.array(*[c / scale for c in other])))
    return F.array(*rows, F.array(*rest))


def stain_index(stains: Column) -> Column:
    """``(e_idx, h_idx)``: which of three vectors is closest to each published colour, else 1 and 0."""
    def closest(colour: Sequence[float]) -> Column:
        size = math.sqrt(sum(c * c for c in colour))
        like = F.transform(stains, lambda v: F.abs(dot([F.lit(c / size) for c in colour], at(v))))
        return F.array_position(like, F.array_max(like)).cast("int") - 1

    def settled(k: Column) -> Column:
        unclear = (k["e"] == k["h"]) | (k["e"] == 2) | (k["h"] == 2)
        return F.struct(F.when(unclear, 1).otherwise(k["e"]).alias("e_idx"), F.when(unclear, 0).otherwise(k["h"]).alias("h_idx"))

    return bind(F.struct(closest(EOSIN).alias("e"), closest(HEMATOXYLIN).alias("h")), settled)


def stain_vectors(densities: DataFrame, tissue: Column, least_density: float = 0.15, percent: float = 1.0, by: str = "slide_id") -> DataFrame:
    """``by, stains, inverse, e_idx, h_idx`` (Macenko et al., ISBI 2009).

    Tissue pixels whose densities all reach ``least_density`` span a plane (the two main axes of
    their covariance); the extreme directions in it, by percentiles of the angle, are the stains.
    Pixels are never gathered: two grouped passes give a row a slide, and 3 x 3 algebra, in closed
    form, runs on those rows. A slide without such pixels gets the published vectors.
    """
    dense = tissue & F.least(*_DENSITY).__ge__(least_density)
    moments = density_moments(densities, use=dense, by=by)
    matrix = F.array(*[F.col(c) for c in ("c00", "c01", "c02", "c11", "c12", "c22")])
    planes = moments.withColumn("axes", F.when(F.col("n") >= 3, main_axes(matrix))).select(by, "axes")
    planes = materialise(planes, shared_dir(densities.sparkSession), "planes")
    density = [F.col(d) for d in _DENSITY]
    along = lambda a: dot(density, at(F.col(f"axes.{a}")))
    angled = with_slide(densities.where(dense), planes, by, stored=True).select(by, F.atan2(along("second"), along("first")).alias("angle"))
    angles = percentiles(angled, ["angle"], (percent / 100, 1 - percent / 100), by)

    def direction(angle: Column) -> Column:
        pairs = zip(at(F.col("axes.first")), at(F.col("axes.second")))
        return F.array(*[F.cos(angle) * x + F.sin(angle) * y for x, y in pairs])

    known = F.col("axes").isNotNull() & F.col("angle_p").isNotNull()
    fixed = [F.array(*[F.lit(c) for c in v]) for v in (HEMATOXYLIN, EOSIN)]
    ends = [F.when(known, direction(F.get("angle_p", F.lit(i)))).otherwise(fixed[i]) for i in (0, 1)]
    found = planes.join(angles, by, "left").select(by, _stains(*ends).alias("w"))
    across = F.array(*[F.array(*[F.get(F.col(f"w.{c}"), F.lit(i)) for c in ("h", "e", "rest")]) for i in range(3)])
    index = stain_index(F.array("w.h", "w.e", "w.rest"))
    return found.select(by, across.alias("stains"), _inverse(F.col("w")).alias("inverse"), index.alias("k")).select(by, "stains", "inverse", "k.e_idx", "k.h_idx")


def _concentrations(densities: DataFrame) -> DataFrame:
    d = [F.col(c) for c in _DENSITY]
    row = lambda idx: [F.col("inverse")[F.col(idx)][i] for i in range(3)]
    return densities.withColumns({"_e": pixel.concentration(d, row("e_idx")), "_h": pixel.concentration(d, row("h_idx")), "_od": pixel.mean_density(d)})


def stain_params(pixels: DataFrame, background: str = "background", io: float | DataFrame | None = None, by: str = "slide_id") -> DataFrame:
    """A row a slide: ``by, io, stains, inverse, e_idx, h_idx, e_lo, e_hi, h_lo, h_hi, od_lo, od_hi``.

    ``io`` is measured on the background unless given, as a number or a table ``by, io``. The 1st and 99th percentiles cover all
    pixels, background too; a stain without range gets 0 to 1.
    """
    if io is None:
        light = background_intensity(pixels, background, by)
    elif isinstance(io, DataFrame):
        light = io.select(by, "io")
    else:
        light = pixels.select(by).distinct().withColumn("io", F.lit(float(io)))
    light = materialise(light, shared_dir(pixels.sparkSession), "io")
    dense = with_density(with_slide(pixels.select(by, "r", "g", "b", F.coalesce(F.col(background), F.lit(False)).alias("_back")), light, by, stored=True))
    vectors = materialise(stain_vectors(dense, ~F.col("_back"), by=by), shared_dir(pixels.sparkSession), "vectors")
    ranges = percentiles(_concentrations(with_slide(dense, vectors, by, stored=True)), ["_e", "_h", "_od"], (0.01, 0.99), by)
    out = vectors.join(light, by).join(ranges, by)
    flat = lambda c: F.col(c)[1] <= F.col(c)[0] + 1e-8
    stain = lambda c, i: F.when(flat(c), float(i)).otherwise(F.col(c)[i])
    return out.select(
        by, "io", "stains", "inverse", "e_idx", "h_idx", stain("_e_p", 0).alias("e_lo"), stain("_e_p", 1).alias("e_hi"), stain("_h_p", 0).alias("h_lo"),
        stain("_h_p", 1).alias("h_hi"), F.col("_od_p")[0].alias("od_lo"), F.col("_od_p")[1].alias("od_hi"),
    )


def apply_params(pixels: DataFrame, params: DataFrame, by: str = "slide_id") -> DataFrame:
    """``by, y, x, e, h, od``: stretched and inverted, 0 to 255. One narrow pass, parameters broadcast."""
    found = _concentrations(with_density(with_slide(pixels, params, by)))
    scaled = [pixel.stretch_inverted(F.col(f"_{c}"), F.col(f"{c}_lo"), F.col(f"{c}_hi")).alias(c) for c in ("e", "h", "od")]
    return found.select(by, "y", "x", *scaled)


def eho_image(pixels: DataFrame, background: str = "background", sample_over: int | None = None, by: str = "slide_id") -> DataFrame:
    """``by, y, x, e, h, od`` with each slide's own parameters.

    Every pixel is measured. With ``sample_over``, slides of more pixels than that are measured on
    every fourth row and column, a fixed sample; they are converted in full.
    """
    measured = pixels
    if sample_over is not None:
        sizes = pixels.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
        every = (F.col("y") % 4 == 0) & (F.col("x") % 4 == 0)
        measured = with_slide(pixels, sizes, by).where((F.col("_n") <= sample_over) | every).drop("_n")
    params = materialise(stain_params(measured, background, by=by), shared_dir(pixels.sparkSession), "params")
    return apply_params(pixels, params, by)


def deconvolve(pixels: DataFrame, params: DataFrame, residual: bool = False, gray: bool = False, by: str = "slide_id") -> DataFrame:
    """``by, y, x, haematoxylin, eosin`` as real concentrations, and on demand a third channel.

    ``residual``: what neither stain explains; ``gray``: the luminance in its place.
    """
    found = with_density(with_slide(pixels, params, by))
    d = [F.col(c) for c in _DENSITY]
    row = lambda idx: [F.col("inverse")[idx][i] for i in range(3)]
    out = [pixel.concentration(d, row(F.col("h_idx"))).alias("haematoxylin"), pixel.concentration(d, row(F.col("e_idx"))).alias("eosin")]
    if gray:
        out.append(pixel.gray(F.col("r"), F.col("g"), F.col("b")).alias("gray"))
    elif residual:
        out.append(pixel.concentration(d, row(F.lit(2))).alias("residual"))
    return found.select(by, "y", "x", *out)
