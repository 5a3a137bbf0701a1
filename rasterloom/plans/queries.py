"""Queries of the raster operators, by name, and the SQL that must give the same rows.

There are no images among the tables, so the vectors of ``embeddings`` are read as one (see
``sources.raster``); formulas make a second one with large connected parts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsing, pixel
from ..operators import blocks, components, gate, grid, neighbourhood, pyramid, runs, scoring, stain, stats
from ..operators.background import detect_background
from ..operators.grid import Grid
from ..scratch import materialise, shared_dir
from ..sources.raster import embedding_raster, synthetic_raster
from ..streaming import arrivals
from . import oracle
from .segment import segment

DIMS = (1, 1920, 1970, 2000, 2020, 2048, 3840, 3900, 4000, 5000)
DISCS = (96, 120)
INVERSE = ((1.8, -0.3, -0.6), (-0.9, 1.5, -0.2))  # rows: eosin, haematoxylin
LIGHT = 240.0
_RGB = ["r", "g", "b"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embedding raster in 8 bits."""
    return stats.stretch_u8(embedding_raster(table(spark, sf_dir, "embeddings")), _RGB)


def sized(pixels: DataFrame) -> DataFrame:
    return stats.with_slide(pixels, pixels.groupBy("slide_id").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w")))


def _colours() -> tuple[Column, Column, Column]:
    return F.col("r"), F.col("g"), F.col("b")


def pale(pixels: DataFrame) -> DataFrame:
    """With ``white`` by the plain rule at wide thresholds, so that both outcomes occur."""
    return pixels.withColumn("white", pixel.is_base_white(*_colours(), 0.55, 0.5))


def tile_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = spark.createDataFrame([(d,) for d in DIMS], "h int")
    tiles = grid.tile_grid(images.withColumn("w", F.col("h")), Grid(2048, 128))
    return tiles.drop("w")


def tile_keep_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = spark.createDataFrame([(d,) for d in DIMS], "h int").withColumn("w", F.lit(2500))
    return grid.tile_grid(images, Grid(2048, 128, close_gaps=False)).drop("w")


def tile_cover_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = spark.createDataFrame([(d,) for d in DIMS], "dim int")
    old = grid.axis_gaps(sizes, Grid(2048, 128, close_gaps=False)).select("dim", F.col("tiles").alias("tiles_open"), F.col("gap").alias("gap_open"))
    return old.join(grid.axis_gaps(sizes, Grid(2048, 128)).select("dim", "tiles", "gap"), "dim")


def u8_stretch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster(spark, sf_dir).select("y", "x", *_RGB)


def gray_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _colours()
    gray = (pixel.gray(*c) + F.lit(1e-9)).cast("int").alias("gray")
    return raster(spark, sf_dir).select("y", "x", gray, pixel.gray_bin(*c).alias("level"))


def white_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _colours()
    value, colour = F.round(pixel.brightness(*c), 6).alias("brightness"), F.round(pixel.saturation(*c), 6).alias("saturation")
    return raster(spark, sf_dir).select("y", "x", value, colour, pixel.is_base_white(*c).alias("base_white"), pixel.is_pure_white(*c).alias("pure_white"))


def local_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbourhood.local_entropy(raster(spark, sf_dir), pixel.gray_bin(*_colours()))
    return found.select("y", "x", F.round("entropy", 6).alias("entropy"))


def white_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = raster(spark, sf_dir)
    entropy = neighbourhood.local_entropy(px, pixel.gray_bin(*_colours()))
    flags = px.join(entropy, ["slide_id", "y", "x"]).withColumn("entropy_white", pixel.is_white(*_colours(), F.round("entropy", 6), 0.6, 0.45, 2.95))
    flags = materialise(flags.withColumn("base_white", pixel.is_base_white(*_colours(), 0.6, 0.4)), shared_dir(spark), "flags")
    return gate.white_rule(flags).select("y", "x", "entropy_white", "base_white", "white")


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = raster(spark, sf_dir)
    mask = pale(px).select("slide_id", "y", "x", (~F.col("white")).alias("tissue"))
    images = px.groupBy("slide_id").agg((F.max("y") + 1).alias("th"), (F.max("x") + 1).alias("tw"))
    images = images.select("slide_id", "th", "tw", (F.col("th") * 4).alias("h"), (F.col("tw") * 4).alias("w"))
    return gate.gate_tiles(grid.tile_grid(images, Grid(64, 16)), mask, least=0.65)


def tissue_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).where("tissue").select("ri", "ci", "n_px", "n_tissue").orderBy("ri", "ci")


def tile_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = stats.tile_counters(_gated(spark, sf_dir))
    return counted.select("tiles_total", "tiles_kept", F.round("skipped_percent", 6).alias("skipped_percent"))


def bg_tile_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.strided_pick(_gated(spark, sf_dir).where("not tissue"), 4).select("ri", "ci", "oy0", "ox0")


def components_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    discs = synthetic_raster(spark, *DISCS).withColumn("white", pixel.is_base_white(*_colours()))
    return components.part_sizes(components.label_parts(discs, block=32)).select("part_y", "part_x", "area")


def white_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.row_runs(pale(raster(spark, sf_dir)), "white").select("y", "x0", "x1", "white")


def white_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part's runs and pixels, by runs: on the vectors' image, so that the work grows with the table."""
    found = runs.part_runs(pale(raster(spark, sf_dir)))
    sizes = found.groupBy("slide_id", "part_y", "part_x").agg(F.count(F.lit(1)).alias("n_runs"), F.max("y").alias("last_y"))
    return runs.part_areas(found).join(sizes, ["slide_id", "part_y", "part_x"]).select("part_y", "part_x", "n_runs", "last_y", "area")


def background_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect_background(synthetic_raster(spark, *DISCS))
    return found.select("y", "x", "background")


def background_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The background of the vectors' image by blocks of 48 pixels: white parts of at least 3."""
    found = blocks.background_blocks(raster(spark, sf_dir), 3, 48, bright=0.6, saturated=0.45, even=2.95, base_bright=0.6, base_saturated=0.4)
    return blocks.block_pixels(found, cell=48).select("y", "x", "background")


def background_intensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = pale(raster(spark, sf_dir)).withColumnRenamed("white", "background").select("slide_id", *_RGB, "background")
    discs = synthetic_raster(spark, *DISCS).withColumn("background", pixel.is_base_white(*_colours())).select("slide_id", *_RGB, "background")
    return stats.background_intensity(both.unionByName(discs)).select("slide_id", F.round("io", 6).alias("io"))


def optical_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = stain.with_density(raster(spark, sf_dir).withColumn("io", F.lit(LIGHT)))
    d = [F.col(f"_d{i}") for i in range(3)]
    return dense.select("y", "x", *[F.round(c, 6).alias(f"od_{n}") for c, n in zip(d, _RGB)], F.round(pixel.mean_density(d), 6).alias("od"))


def _separated(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = stain.with_density(raster(spark, sf_dir).withColumn("io", F.lit(LIGHT)))
    d = [F.col(f"_d{i}") for i in range(3)]
    e, h = (pixel.concentration(d, [F.lit(v) for v in row]) for row in INVERSE)
    return dense.select("slide_id", "y", "x", e.alias("e"), h.alias("h"), pixel.mean_density(d).alias("od"))


def concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _separated(spark, sf_dir).select("y", "x", *[F.round(c, 6).alias(c) for c in ("e", "h")])


def stain_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.percentiles(_separated(spark, sf_dir), ["e", "h", "od"], (0.01, 0.99))
    return found.select(*[F.round(F.col(f"{c}_p")[i], 6).alias(f"{c}_{n}") for c in ("e", "h", "od") for i, n in ((0, "lo"), (1, "hi"))])


def eho_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = _separated(spark, sf_dir)
    found = stats.with_slide(px, stats.percentiles(px, ["e", "h", "od"], (0.01, 0.99)), stored=True)
    return found.select("y", "x", *[pixel.stretch_inverted(F.col(c), F.col(f"{c}_p")[0], F.col(f"{c}_p")[1]).alias(c) for c in ("e", "h", "od")])


def masked_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.normalise(raster(spark, sf_dir), _RGB).select("y", "x", *[F.round(c, 6).alias(c) for c in _RGB])


def od_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = stain.with_density(pale(raster(spark, sf_dir)).withColumn("io", F.lit(LIGHT)))
    found = stain.density_moments(dense, use=~F.col("white"))
    names = ["m0", "m1", "m2", "c00", "c01", "c02", "c11", "c12", "c22"]
    return found.select("n", *[F.round(c, 8).alias(c) for c in names])


def stain_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stain.stain_params(pale(raster(spark, sf_dir)).withColumnRenamed("white", "background"))
    stains = [F.round(F.col("stains")[i][j], 6).alias(f"w{i}{j}") for i in range(3) for j in range(3)]
    ends = [F.round(c, 6).alias(c) for c in ("e_lo", "e_hi", "h_lo", "h_hi", "od_lo", "od_hi")]
    return found.select(F.round("io", 6).alias("io"), *stains, "e_idx", "h_idx", *ends)


def label_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = [F.col("embedding")[i].cast("double") for i in range(3)]
    return table(spark, sf_dir, "embeddings").select("vec_id", pixel.label(*z).alias("label"))


def nearest_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = sized(raster(spark, sf_dir))
    return neighbourhood.nearest_resize(px, _RGB, F.col("h"), F.col("w"), F.expr("h * 3 div 7"), F.lit(100)).select("y", "x", *_RGB)


def _sizes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    px = raster(spark, sf_dir)
    size = px.groupBy("slide_id").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    return px, size.select("slide_id", F.col("h").alias("n_in"), F.expr("cast(h * 3 div 7 as int)").alias("n_out")), size.select("slide_id", F.col("w").alias("n_in"), F.lit(100).alias("n_out"))


def linear_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    px, tall, wide = _sizes(spark, sf_dir)
    found = neighbourhood.resample(px, _RGB, neighbourhood.linear_taps(tall, "n_in", "n_out"), neighbourhood.linear_taps(wide, "n_in", "n_out"))
    return found.select("y", "x", *[F.round(c, 6).alias(c) for c in _RGB])


def lanczos_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    px, tall, wide = _sizes(spark, sf_dir)
    found = neighbourhood.resample(px, ["r"], neighbourhood.lanczos_taps(tall, "n_in", "n_out"), neighbourhood.lanczos_taps(wide, "n_in", "n_out"))
    return found.select("y", "x", F.round("r", 6).alias("r"))


def reflect_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbourhood.reflect_pad(sized(raster(spark, sf_dir)), ["r"], F.col("h"), F.col("w"), 96).select("y", "x", "r")


def window_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = neighbourhood.windows_of(sized(raster(spark, sf_dir)), F.col("h"), F.col("w"), 32, 0.25)
    scored = placed.withColumn("z", F.col("r") / 255.0 + F.col("wx") / 67.0 - F.col("wy") / 509.0)
    return neighbourhood.blend(scored, ["z"], neighbourhood.importance(32, 0.25)).select("y", "x", F.round("z", 6).alias("z"))


def stitch_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = sized(raster(spark, sf_dir))
    tiles = grid.tile_grid(px.select("slide_id", "h", "w").distinct(), Grid(16, 4))
    tiles = tiles.where("(ri + ci) % 5 <> 3").drop("h", "w")
    scored = scoring.tiles_of(px, tiles, 16, 12).withColumn("label", ((F.col("r") + F.col("ri") * 3 + F.col("ci")) % 3).cast("int"))
    return scoring.stitch(px, scored).select("y", "x", "label")


def segment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from pixels to labels, with a scorer that is no trained model."""
    return segment(synthetic_raster(spark, *DISCS), scoring.placeholder_scorer, roi=64).select("y", "x", "label")


def threshold_scorer(image: np.ndarray) -> np.ndarray:
    """Which of two channels exceeds its bound: no trained model, but SQL can follow it."""
    z = [20 * (image[..., i] - bound) for i, bound in enumerate(oracle.BOUNDS)]
    return np.stack([*z, np.full_like(z[0], -30)], -1)


def _packed_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors' image in tiles of 16 pixels, three colours as the channels to score."""
    px = raster(spark, sf_dir)
    tiles = grid.tile_grid(sized(px).select("slide_id", "h", "w").distinct(), Grid(16, 4)).drop("h", "w")
    return arrivals.pack_tiles(scoring.tiles_of(px.toDF("slide_id", "y", "x", *arrivals.CHANNELS), tiles, 16, 12))


def arriving_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of tiles that come as files, four of sixteen a batch, by a stream that runs until all are done."""
    folder = shared_dir(spark)
    _packed_tiles(spark, sf_dir).repartition(16, "oy0", "ox0").write.parquet(f"{folder}/arriving")
    arrivals.label_arrivals(spark, f"{folder}/arriving", f"{folder}/labelled", f"{folder}/progress", threshold_scorer, files_per_batch=4).awaitTermination()
    return arrivals.read_arrivals(spark, f"{folder}/labelled").select("y", "x", "label")


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.expr("cast(row_number() over (partition by p_brand order by p_partkey) - 1 as int)")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("slide_id"), rank.alias("level_idx"), (F.col("p_size") * 100).cast("int").alias("size_x"), (F.col("p_partkey") % 3000).cast("int").alias("size_y"), F.expr("p_retailprice / 100").alias("level_mpp_x")
    )


def pyramid_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pyramid.best_level(_levels(spark, sf_dir), 12.0).select("slide_id", "level_idx", "level", F.round("mpp", 6).alias("mpp"))


def thumb_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pyramid.thumbnail_level(_levels(spark, sf_dir), 4990)


def metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stats.metric_summary(table(spark, sf_dir, "events"), ["value", "user_id"], ["event_type"])
    return found.select("event_type", "metric", "min", F.round("avg", 6).alias("avg"), "median", "max")


def metric_lag_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = table(spark, sf_dir, "events").select("event_id", "user_id", "value", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    return stats.lag_rate(samples, "t", "value", ["user_id"], ["event_id"]).select("event_id", F.round("rate", 6).alias("rate"))


def csv_metric_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.expr("concat(user_id, case when event_id % 3 = 1 then '' else ' , ' || event_id end, ',', case when event_id % 5 = 2 then 'n/a' else ' ' || event_id % 97 end, '\n1, 2, 3')")
    parsed = parsing.meter_line(line).alias("m")
    return table(spark, sf_dir, "events").select("event_id", parsed).select("event_id", "m.*")


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", parsing.address(F.col("url")).alias("a")).select("page_id", "a.*")


def registry_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = {str(i): f"weights-{i}.bin" for i in range(5)}
    key = F.when(F.col("n_nationkey") % 7 != 0, F.col("n_regionkey").cast("string"))
    return table(spark, sf_dir, "nation").select("n_nationkey", parsing.lookup(key, files, "4").alias("file"))


def label_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = table(spark, sf_dir, "embeddings").select(pixel.label(*[F.col("embedding")[i].cast("double") for i in range(3)]).alias("label"))
    return px.distinct().orderBy("label")


_QUERIES = (
    tile_grid, tile_keep_regions, tile_cover_gaps, u8_stretch, gray_bins, white_base, local_entropy, white_rule, tissue_tiles, tile_counters, bg_tile_pick,
    components_sizes, white_runs, white_regions, background_mask, background_blocks, background_intensity, optical_density, concentration, stain_percentiles, eho_pixels, masked_normalize, od_covariance,
    stain_estimate, label_rule, nearest_resize, linear_resize, lanczos_resize, reflect_pad, window_blend, stitch_keep, segment_labels, arriving_labels, pyramid_level,
    thumb_level, metric_summary, metric_lag_rate, csv_metric_parse, url_parts, registry_lookup, label_distinct,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    """``segment_labels`` (a scorer) is tested otherwise."""
    return oracle.sql(DIMS, DISCS, INVERSE, LIGHT)
