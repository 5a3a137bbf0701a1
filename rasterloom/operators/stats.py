"""Aggregates over pixels, tiles and meter samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pixel
from ..scratch import materialise, shared_dir
from .ranks import quantiles

# Bounds of the background intensity and the pixels that each tier needs.
IO_LOW, IO_HIGH, IO_DEFAULT, IO_PIXELS = 200.0, 255.0, 240.0, 100


def percentiles(rows: DataFrame, columns: Sequence[str], ps: Sequence[float], by: str = "slide_id") -> DataFrame:
    """``by, <column>_p``: exact percentiles (linear interpolation) of each column as an array.

    Equal values are counted before anything else, and the counts are written; ranks are then found
    by histograms (see ``ranks``), so that no task sorts a slide. Nulls and NaN don't count; a
    column with no value has null percentiles.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])
    long = rows.select(by, F.explode(pairs).alias("x")).select(by, "x.*")
    counts = long.groupBy(by, "i", "v").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, shared_dir(rows.sparkSession), "counts")
    each = quantiles(counts.where(F.col("v").isNotNull() & ~F.isnan("v")), [by, "i"], ps)
    wide = each.groupBy(by).agg(*[F.max(F.when(F.col("i") == i, F.col("p"))).alias(f"{c}_p") for i, c in enumerate(columns)])
    return wide


def with_slide(rows: DataFrame, per_slide: DataFrame, by: str = "slide_id", limit: int = 100_000, stored: bool = False) -> DataFrame:
    """``rows`` with a slide's parameters: broadcast up to ``limit`` slides, a shuffle beyond.

    The parameters are written first, so that counting them and joining them take one run of
    what they are made of; not if they are ``stored``, or little work from what is.
    """
    if not stored:
        per_slide = materialise(per_slide, shared_dir(rows.sparkSession), "slides")
    small = per_slide.limit(limit + 1).count() <= limit
    return rows.join(F.broadcast(per_slide) if small else per_slide, by, "left")


def stretch_u8(rows: DataFrame, columns: Sequence[str], by: str = "slide_id", low: float = 0.01, high: float = 0.99) -> DataFrame:
    """The columns stretched to 0..255 between two percentiles of each slide and channel."""
    found = with_slide(rows, percentiles(rows, columns, (low, high), by), by, stored=True)
    new = {c: pixel.stretch(F.col(c), F.col(f"{c}_p")[0], F.col(f"{c}_p")[1]) for c in columns}
    return found.withColumns(new).select(*rows.columns)


def fraction(flag: Column) -> Column:
    """The share of rows for which ``flag`` is true; null counts as false."""
    return F.avg(F.coalesce(flag, F.lit(False)).cast("int"))


def background_intensity(pixels: DataFrame, background: str = "background", by: str = "slide_id") -> DataFrame:
    """``by, io``: the light that reaches the sensor through no tissue.

    The mean over background pixels and channels, clipped to 200..255: of pixels that aren't pure
    white if there are 100 such, else of all background pixels if there are 100, else 240.
    """
    back = F.coalesce(F.col(background), F.lit(False))
    mean = (F.col("r") + F.col("g") + F.col("b")) / F.lit(3.0)
    stained = back & ~pixel.is_pure_white(F.col("r"), F.col("g"), F.col("b"))
    sums = pixels.groupBy(by).agg(
        F.count_if(stained).alias("n1"), F.avg(F.when(stained, mean)).alias("m1"), F.count_if(back).alias("n2"), F.avg(F.when(back, mean)).alias("m2")
    )
    tiers = F.when(F.col("n1") >= IO_PIXELS, pixel.clip(F.col("m1"), IO_LOW, IO_HIGH)).when(F.col("n2") >= IO_PIXELS, pixel.clip(F.col("m2"), IO_LOW, IO_HIGH))
    return sums.select(by, tiers.otherwise(IO_DEFAULT).alias("io"))


def normalise(pixels: DataFrame, columns: Sequence[str], by: str = "slide_id") -> DataFrame:
    """Channels scaled from 0..255 to 0..1, standardised over nonzero values, then to 0..1 by range.

    A channel without spread is centred only; one with a single value becomes 0. Zeros stay 0 until
    the last step, which covers all pixels. Two grouped passes, each one row a slide.
    """
    scaled = pixels.withColumns({c: pixel.clip(F.col(c) / F.lit(255.0), 0.0, 1.0) for c in columns})
    nonzero = {c: F.when(F.col(c) != 0, F.col(c)) for c in columns}
    moments = scaled.groupBy(by).agg(*[f(nonzero[c]).alias(f"{c}_{n}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))])
    spread = lambda c: F.when(F.col(f"{c}_std") > 0, F.col(f"{c}_std")).otherwise(1.0)
    standard = with_slide(scaled, moments, by).withColumns({c: F.when(F.col(c) != 0, (F.col(c) - F.col(f"{c}_mean")) / spread(c)).otherwise(F.col(c)) for c in columns})
    standard = standard.select(*pixels.columns)
    ranges = standard.groupBy(by).agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))])
    ranged = {c: F.when(F.col(f"{c}_hi") > F.col(f"{c}_lo"), (F.col(c) - F.col(f"{c}_lo")) / (F.col(f"{c}_hi") - F.col(f"{c}_lo"))).when(F.col(c).isNotNull(), 0.0) for c in columns}
    return with_slide(standard, ranges, by).withColumns(ranged).select(*pixels.columns)


def metric_summary(samples: DataFrame, metrics: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``by, metric, min, avg, median, max`` of each column: nulls don't count; all null where none is left."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])
    long = samples.select(*by, F.explode(pairs).alias("x")).select(*by, "x.*")
    return long.groupBy(*by, "metric").agg(F.min("v").alias("min"), F.avg("v").alias("avg"), F.median("v").alias("median"), F.max("v").alias("max"))


def lag_rate(samples: DataFrame, time: str, value: str, by: Sequence[str], order: Sequence[str] = (), scale: float = 100.0, start: tuple[float, float] | None = None) -> DataFrame:
    """``rate``: the change of ``value`` for each second since the sample before, times ``scale``.

    0 where no time has passed. The first sample of a group compares with ``start`` (time, value),
    or has no rate. Samples are dealt by ranges of group and time, so a long series lies in many
    parts; a part is worked on by itself, and gets the last sample of the part before it. Null
    groups are a group, and samples without a time come first.
    """
    t, v = F.col(time).cast("double"), F.col(value).cast("double")
    ranged = samples.repartitionByRange(*[F.col(c) for c in (*by, time, *order)]).withColumn("_part", F.spark_partition_id())
    parts = materialise(ranged, shared_dir(samples.sparkSession), "series")
    last = F.max_by(F.struct(t.alias("t"), v.alias("v")), F.struct(time, *order))
    ends = parts.groupBy("_part", *by).agg(last.alias("_end"))  # a row a part of a group
    ends = ends.withColumn("_before", F.lag("_end").over(Window.partitionBy(*by).orderBy("_part"))).select(
        F.col("_part").alias("_p"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], "_before"
    )
    same = F.col("_part") == F.col("_p")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    w = Window.partitionBy("_part", *by).orderBy(time, *order)
    found = parts.join(ends, same, "left").withColumn("_first", F.row_number().over(w) == 1)
    before = lambda c, x, other: F.coalesce(F.when(F.col("_first"), F.col("_before")[c]).otherwise(F.lag(x).over(w)), F.lit(other).cast("double"))
    dt, dv = (x - before(c, x, other) for c, x, other in zip("tv", (t, v), start or (None, None)))
    found = found.withColumn("_dt", dt).withColumn("_dv", dv)
    rate = F.when(F.col("_dt") > 0, F.lit(scale) * F.col("_dv") / F.col("_dt")).when(F.col("_dt").isNotNull(), 0.0)
    return found.select(*samples.columns, rate.alias("rate"))


def tile_counters(tiles: DataFrame, tissue: str = "tissue", by: str = "slide_id") -> DataFrame:
    """``by, tiles_total, tiles_kept, skipped_percent``."""
    counted = tiles.groupBy(by).agg(F.count(F.lit(1)).alias("tiles_total"), F.count_if(F.col(tissue)).alias("tiles_kept"))
    return counted.withColumn("skipped_percent", (F.col("tiles_total") - F.col("tiles_kept")) * F.lit(100.0) / F.col("tiles_total"))
