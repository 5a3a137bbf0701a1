"""The two ways from stored images to stored labels: image files, and tiled stores of several levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gate, grid, neighbourhood, pyramid, scoring, stain, stats
from ..operators.background import detect_background
from ..scratch import materialise, shared_dir
from ..sources import files, raster
from .segment import label_image, preprocess

RGB = ["r", "g", "b"]
BOX = ["oy0", "ox0", "oh", "ow"]
SAME = 1e-6


def _resized(pixels: DataFrame, sizes: DataFrame, taps) -> DataFrame:
    """``slide_id, y, x, r, g, b`` at ``sizes(slide_id, h0, w0, h, w)``; slides of that size pass as they are."""
    changed = sizes.where("h0 <> h or w0 <> w").select("slide_id", "h0", "w0", "h", "w")
    ty = taps(changed.select("slide_id", F.col("h0").alias("n_in"), F.col("h").alias("n_out")), "n_in", "n_out")
    tx = taps(changed.select("slide_id", F.col("w0").alias("n_in"), F.col("w").alias("n_out")), "n_in", "n_out")
    marked = stats.with_slide(pixels.select("slide_id", "y", "x", *RGB), changed.select("slide_id", F.lit(True).alias("_new")))
    new = neighbourhood.resample(marked.where("_new").drop("_new"), RGB, ty, tx)
    return marked.where("_new is null").drop("_new").unionByName(new.select("slide_id", "y", "x", *[neighbourhood.to_u8(F.col(c)).alias(c) for c in RGB]))


def segment_images(
    spark: SparkSession, path: str, output: str, scorer: scoring.Scorer, target_mpp: float = 1.0, mpp: float | None = None, resolutions: DataFrame | None = None,
    save_image: str | None = None, roi: int = 2048, overlap: float = 0.25, apply_tissue_mask: bool = True,
) -> DataFrame:
    """Label the TIFF, PGM and PPM files at ``path``, write ``slide_id, y, x, label`` to ``output`` and return it.

    Images are brought to ``target_mpp`` micrometres a pixel (Lanczos) and the labels back to the
    original size (nearest pixel). Sizes come from the files' heads. An image's resolution is ``mpp``
    if given, else what ``resolutions(slide_id, mpp_x, mpp_y)`` has for both axes if that is given, else
    what its head has, else its pixels are taken as they are.
    ``save_image``: where the separated image (``e, h, od``) is written too.
    """
    folder = shared_dir(spark)
    pixels, known = files.read_images(spark, path)
    pixels = materialise(pixels, folder, "pixels")
    sizes = known.where("level_idx = 0").select("slide_id", F.col("size_y").alias("h0"), F.col("size_x").alias("w0"), "mpp_x", "mpp_y")
    if mpp is not None:
        sizes = sizes.withColumns({c: F.lit(float(mpp)) for c in ("mpp_x", "mpp_y")})
    elif resolutions is not None:
        sizes = sizes.drop("mpp_x", "mpp_y")
        sizes = sizes.join(resolutions.select("slide_id", *[F.expr(f"if({c} > 0, cast({c} as double), null)").alias(c) for c in ("mpp_x", "mpp_y")]), "slide_id", "left")
    fits = [F.abs(F.col(c) / target_mpp - 1) < SAME for c in ("mpp_x", "mpp_y")]
    near = F.col("mpp_x").isNull() | F.col("mpp_y").isNull() | (fits[0] & fits[1])
    scaled = lambda size, m: F.when(near, F.col(size)).otherwise(grid.output_size(F.col(size), F.col(m), F.lit(target_mpp)))
    sizes = materialise(sizes.select("slide_id", "h0", "w0", scaled("h0", "mpp_y").alias("h"), scaled("w0", "mpp_x").alias("w")), folder, "sizes")
    image = materialise(preprocess(_resized(pixels, sizes, neighbourhood.lanczos_taps)), folder, "image")
    if save_image:
        image.select("slide_id", "y", "x", "e", "h", "od").write.mode("overwrite").partitionBy("slide_id").parquet(save_image)
    found = stats.with_slide(label_image(image, scorer, roi, overlap, apply_tissue_mask), sizes)
    raster.write_labels(neighbourhood.nearest_resize(found, ["label"], F.col("h"), F.col("w"), F.col("h0"), F.col("w0")), output)
    return spark.read.schema("y int, x int, label int, slide_id string").parquet(output)


def _empty_tiles(images: DataFrame, thumbnail: DataFrame, tile: int, count: int) -> DataFrame:
    """``slide_id, oy0, ox0, oh, ow`` of ``count`` tiles without tissue of each slide, where it has them."""
    tiles = gate.gate_tiles(grid.tile_grid(images, grid.Grid(tile, 0)), thumbnail, least=0.001)
    return grid.strided_pick(tiles.where("not tissue"), count).select("slide_id", *BOX)


def _background_light(pixels: DataFrame, empty: DataFrame, thumbnail: DataFrame, tile: int) -> DataFrame:
    """``slide_id, io`` from tiles without tissue, or the thumbnail where a slide has none."""
    found = scoring.tiles_of(pixels, empty, tile, tile).select("slide_id", *RGB, F.lit(True).alias("background"))
    measured = stats.background_intensity(found).withColumnRenamed("io", "_io")
    return stats.background_intensity(thumbnail).join(measured, "slide_id", "left").select("slide_id", F.coalesce("_io", "io").alias("io"))


def level_regions(tiles: DataFrame, images: DataFrame, reach: int = 3) -> DataFrame:
    """``slide_id, y0, y1, x0, x1``: what linear zoom needs of a level of ``size_y`` x ``size_x`` for tiles of ``h`` x ``w``."""
    placed = stats.with_slide(tiles.select("slide_id", *BOX), images.select("slide_id", "h", "w", "size_y", "size_x"), stored=True)
    span = lambda o, n, out, size: grid.level_span(F.col(o), F.col(n), F.col(out), F.col(size), reach)
    spans = placed.select("slide_id", span("oy0", "oh", "h", "size_y").alias("_y"), span("ox0", "ow", "w", "size_x").alias("_x"))
    return spans.select("slide_id", F.col("_y.lo").alias("y0"), F.col("_y.hi").alias("y1"), F.col("_x.lo").alias("x0"), F.col("_x.hi").alias("x1"))


def segment_store(
    spark: SparkSession, store: str, levels: DataFrame, output: str, scorer: scoring.Scorer, target_mpp: float = 1.0, tile: int = 2048, tile_overlap: int = 128,
    roi: int = 2048, overlap: float = 0.25, tissue_only: bool = True, background_tiles: int = 4, thumbnail_edge: int = 2000, least_tissue: float = 0.01, save_image: str | None = None,
) -> DataFrame:
    """Label all slides of ``levels`` in a tiled store, write ``slide_id, y, x, label`` and return it.

    ``levels``: ``slide_id, level_idx, size_x, size_y, mpp_x, mpp_y`` with index 0 in full size; an
    unknown resolution is 1. For each slide the coarsest level as fine as the target is read; a
    thumbnail shows where tissue is and gives the stain parameters; tiles without tissue give the
    light. Tiles over at least ``least_tissue`` tissue (all, if not ``tissue_only``) are scored on
    their own and keep their part; every other pixel has label 0. Labels stay in the target's size.
    Of the level only the stored tiles under tiles to score, and under those for the light, are read.
    ``save_image``: where the separated image (``e, h, od``) of scored tiles is written, 255 elsewhere.
    """
    folder = shared_dir(spark)
    known = levels.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(1.0)) for c in ("mpp_x", "mpp_y")})
    fine = pyramid.level_resolutions(known)
    best = pyramid.best_level(fine, target_mpp).select("slide_id", "level_idx").join(fine, ["slide_id", "level_idx"])
    coarse = pyramid.thumbnail_level(known, thumbnail_edge).join(known.select("slide_id", "level_idx", "size_x", "size_y"), ["slide_id", "level_idx"])
    size = lambda s, m: grid.output_size(F.col(s), F.col(m), F.lit(target_mpp))
    images = best.select("slide_id", "level_idx", "size_y", "size_x", size("size_y", "level_mpp_y").alias("h"), size("size_x", "level_mpp_x").alias("w"))
    images = materialise(images.join(coarse.select("slide_id", F.col("size_y").alias("th"), F.col("size_x").alias("tw")), "slide_id"), folder, "images")

    thumbnail = materialise(raster.read_levels(spark, store, coarse), folder, "thumbnail")
    thumbnail = materialise(detect_background(thumbnail).withColumn("tissue", ~F.col("background")), folder, "mask")
    extent = images.select("slide_id", "h", "w", "th", "tw")
    cut = grid.Grid(tile, tile_overlap)
    tiles = grid.tile_grid(extent, cut)
    if tissue_only:
        tiles = gate.gate_tiles(tiles, thumbnail, least=least_tissue).where("tissue").drop("n_px", "n_tissue", "tissue_fraction", "tissue")
    tiles = materialise(tiles.drop("h", "w", "th", "tw").withColumn("tile_id", F.concat_ws("/", "slide_id", "ri", "ci")), folder, "tiles")
    empty = materialise(_empty_tiles(extent, thumbnail, tile, background_tiles), folder, "empty")
    regions = level_regions(tiles.select("slide_id", *BOX).unionByName(empty), images)
    # pixels along the border of what is read lack a part of their kernel; they lie outside the tiles
    pixels = _resized(raster.read_levels(spark, store, images, regions=regions), images.withColumnsRenamed({"size_y": "h0", "size_x": "w0"}), neighbourhood.linear_taps)
    pixels = materialise(pixels, folder, "pixels")
    light = materialise(_background_light(pixels, empty, thumbnail, tile), folder, "light")
    params = materialise(stain.stain_params(thumbnail, io=light), folder, "params")
    image = stain.apply_params(pixels, params)
    domain = extent.select("slide_id", F.explode(F.sequence(F.lit(0), F.col("h") - 1)).alias("y"), "w").withColumn("x", F.explode(F.sequence(F.lit(0), F.col("w") - 1)))
    inside = scoring.tiles_of(image, tiles.select("slide_id", "tile_id", *BOX), tile, cut.stride)
    if save_image:
        scoring.canvas(domain, inside, ["e", "h", "od"]).write.mode("overwrite").partitionBy("slide_id").parquet(save_image)
    inside = inside.select("tile_id", (F.col("y") - F.col("oy0")).alias("y"), (F.col("x") - F.col("ox0")).alias("x"), "e", "h", "od", "oh", "ow")
    inside = materialise(inside, folder, "tile-pixels")
    extents = tiles.select("tile_id", "oh", "ow")
    ready = stats.with_slide(stats.normalise(inside.select("tile_id", "y", "x", "e", "h", "od"), ["e", "h", "od"], "tile_id"), extents, "tile_id")
    scored = scoring.labels(scoring.score_windows(ready, ["e", "h", "od"], scorer, roi, overlap, height="oh", width="ow", by="tile_id"), by="tile_id")
    placed = stats.with_slide(scored, tiles, "tile_id").withColumns({"y": F.col("y") + F.col("oy0"), "x": F.col("x") + F.col("ox0")})
    raster.write_labels(scoring.stitch(domain, placed), output)
    return spark.read.schema("y int, x int, label int, slide_id string").parquet(output)
