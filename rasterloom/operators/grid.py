"""Overlapping tile grids, the part of each tile that counts, and picks from a grid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """``tile`` pixels a side, neighbours sharing ``overlap``.

    A negative overlap counts as none, one of half a tile or more as a quarter. ``close_gaps``: a
    last tile shorter than the overlap would leave pixels that no tile keeps; such a tile is left
    out and the one before it reaches to the border. Without it they stay uncovered.
    """

    tile: int = 2048
    overlap: int = 128
    close_gaps: bool = True

    def __post_init__(self):
        if self.tile < 1:
            raise ValueError("a tile has at least one pixel")
        overlap = max(0, self.overlap)
        object.__setattr__(self, "overlap", self.tile // 4 if overlap >= self.tile // 2 and overlap else overlap)

    @property
    def stride(self) -> int:
        return max(1, self.tile - self.overlap)


def _axis(size: Column, g: Grid) -> Column:
    """Array of ``struct(i, o, n, skip, keep, last)`` along one axis of ``size`` pixels.

    ``skip``: pixels at the start that the tile before keeps; ``keep``: how many follow them.
    """
    half = g.overlap // 2
    origins = F.when(size > 0, F.sequence(F.lit(0), (size - 1).cast("int"), F.lit(g.stride))).otherwise(F.expr("cast(array() as array<int>)"))
    if g.close_gaps:
        short = (F.size(origins) >= 2) & (size - F.element_at(origins, -1) < g.overlap)
        origins = F.when(short, F.slice(origins, 1, F.greatest(F.size(origins) - 1, F.lit(0)))).otherwise(origins)
    last = F.size(origins) - 1

    def one(o: Column, i: Column) -> Column:
        n = F.least(F.lit(g.tile), size - o)
        if g.close_gaps:
            n = F.when(i == last, size - o).otherwise(n)
        skip = F.when(i == 0, 0).otherwise(half)
        trim = F.when(i == last, 0).otherwise(F.least(F.lit(g.overlap - half), n - skip - 1))
        return F.struct(i.alias("i"), o.alias("o"), n.cast("int").alias("n"), skip.alias("skip"), (n - skip - trim).cast("int").alias("keep"), (i == last).alias("last"))

    return F.transform(origins, one)


def tile_grid(images: DataFrame, g: Grid = Grid(), height: str = "h", width: str = "w") -> DataFrame:
    """All columns of ``images`` with a row a tile.

    Added: ``ri, ci`` (place in the grid), ``oy0, ox0, oh, ow`` (the tile), ``keep_y0, keep_x0,
    keep_h, keep_w`` (the part, relative to the tile, that it alone provides). Keep parts never
    overlap. An image without pixels, or of unknown size, has no tiles.
    """
    rows = images.withColumn("_y", F.explode(_axis(F.col(height).cast("int"), g))).withColumn("_x", F.explode(_axis(F.col(width).cast("int"), g)))
    place = [("ri", "_y.i"), ("ci", "_x.i"), ("oy0", "_y.o"), ("ox0", "_x.o"), ("oh", "_y.n"), ("ow", "_x.n")]
    keep = [("keep_y0", "_y.skip"), ("keep_x0", "_x.skip"), ("keep_h", "_y.keep"), ("keep_w", "_x.keep")]
    return rows.select(*[F.col(f"`{c}`") for c in images.columns], *[F.col(a).alias(n) for n, a in place + keep])


def axis_gaps(sizes: DataFrame, g: Grid, size: str = "dim") -> DataFrame:
    """All columns of ``sizes`` with ``tiles``, ``kept`` and ``gap``: pixels of the axis in no keep part."""
    axis = sizes.withColumn("_a", _axis(F.col(size).cast("int"), g))
    kept = F.aggregate("_a", F.lit(0), lambda s, t: s + F.greatest(t["keep"], F.lit(0)))
    rows = axis.select(*sizes.columns, F.size("_a").alias("tiles"), kept.alias("kept"))
    return rows.withColumn("gap", (F.col(size).cast("int") - F.col("kept")).cast("int"))


def strided_pick(tiles: DataFrame, k: int, by: str = "slide_id", row: str = "ri", col: str = "ci") -> DataFrame:
    """At most ``k`` tiles of each slide, evenly spaced in raster order: every ``max(1, n div k)``-th.

    One row a tile, so ranking a slide's tiles in one task is small; slides are dealt by key.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    order, every = Window.partitionBy(by).orderBy(row, col), Window.partitionBy(by)
    ranked = tiles.withColumn("_p", F.row_number().over(order) - 1).withColumn("_n", F.count(F.lit(1)).over(every))
    ranked = ranked.withColumn("_s", F.greatest(F.lit(1).cast("long"), F.expr(f"_n div {k}")))
    return ranked.where((F.col("_p") % F.col("_s") == 0) & (F.expr("_p div _s") < k)).drop("_p", "_n", "_s")


def output_size(level_size: Column, level_mpp: Column, target_mpp: Column) -> Column:
    """Pixels of one axis at the target resolution: at least 1, halves to even."""
    return F.greatest(F.lit(1), F.rint(level_size * (level_mpp / target_mpp)).cast("int"))


def level_span(origin: Column, length: Column, out_size: Column, level_size: Column, reach: int = 0) -> Column:
    """``struct(lo, hi)`` in level pixels of a span in output pixels, halves to even, within the level.

    ``reach``: how far a resampling kernel reaches beyond, in pixels of the coarser of both grids.
    """
    scale = level_size / out_size.cast("double")
    more = F.lit(reach) * F.ceil(F.greatest(F.lit(1.0), scale))
    lo = F.greatest(F.lit(0), (F.rint(origin * scale) - more).cast("int"))
    hi = F.least(level_size, (F.rint((origin + length) * scale) + more).cast("int"))
    return F.struct(lo.alias("lo"), hi.alias("hi"))


def morton(i: Column, j: Column) -> Column:
    """The rank of row ``i`` and column ``j`` along a Morton curve: their bits in turn, 31 of each."""

    def spread(v: Column) -> Column:
        v = v.cast("long")
        for step, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, step)).bitwiseAND(F.lit(mask))
        return v

    return F.shiftleft(spread(i), 1).bitwiseOR(spread(j))
