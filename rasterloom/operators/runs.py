"""Run-length regions: pixels of a row that follow each other and have one value are one row of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir
from .graph import components


def row_runs(pixels: DataFrame, value: str, by: str = "slide_id") -> DataFrame:
    """``by, y, x0, x1, value``: the longest stretches (``x1`` exclusive) of one value in each row.

    Repeated pixels count once; a pixel with two values is in a run of each; null is a value too. A
    window holds the pixels of one row of an image with one value.
    """
    order = Window.partitionBy(by, "y", value).orderBy("x")
    ranked = pixels.select(by, "y", "x", value).distinct().withColumn("_run", F.col("x") - F.row_number().over(order))
    found = ranked.groupBy(by, "y", value, "_run").agg(F.min("x").alias("x0"), (F.max("x") + 1).alias("x1"))
    return found.select(by, "y", "x0", "x1", value)


def run_pixels(runs: DataFrame, by: str = "slide_id", values: tuple[str, ...] = ()) -> DataFrame:
    """``by, y, x, values``: the runs' pixels again."""
    return runs.select(by, "y", F.explode(F.sequence(F.col("x0"), F.col("x1") - 1)).alias("x"), *values)


def touching_runs(runs: DataFrame, by: str = "slide_id", width: int = 256) -> DataFrame:
    """``a, b``: pairs of runs ``struct(by, y, x0)`` in rows that follow each other and share a column.

    The interval join is one by equality of strips of ``width`` columns that runs are dealt to: a
    strip of a row has at most half as many runs as columns.
    """
    strips = runs.select(by, "y", "x0", "x1", F.explode(F.sequence(F.expr(f"x0 div {width}"), F.expr(f"(x1 - 1) div {width}"))).alias("_s"))
    name = F.struct(by, "y", "x0")
    above = strips.select(by, (F.col("y") + 1).alias("y"), "_s", name.alias("a"), F.col("x0").alias("_a0"), F.col("x1").alias("_a1"))
    below = strips.select(by, "y", "_s", name.alias("b"), F.col("x0").alias("_b0"), F.col("x1").alias("_b1"))
    return above.join(below, [by, "y", "_s"]).where("_a0 < _b1 and _b0 < _a1").select("a", "b").distinct()


def part_runs(mask: DataFrame, flag: str = "white", by: str = "slide_id") -> DataFrame:
    """``by, y, x0, x1, part_y, part_x``: the runs of flagged pixels with the first pixel of their part.

    Parts are connected by sides, as in ``components``, whose names they have. The nodes are runs, so
    parts of long runs have few; for masks of single pixels ``components`` has fewer.
    """
    folder = shared_dir(mask.sparkSession)
    runs = materialise(row_runs(mask.where(F.col(flag)), flag, by).drop(flag), folder, "runs")
    merged = components(materialise(touching_runs(runs, by), folder, "touching"), folder, "parts")
    merged = merged.select(F.col(f"node.{by}").alias(by), F.col("node.y").alias("y"), F.col("node.x0").alias("x0"), F.col("root.y").alias("_y"), F.col("root.x0").alias("_x"))
    found = runs.join(merged, [by, "y", "x0"], "left")
    return found.select(by, "y", "x0", "x1", F.coalesce("_y", "y").alias("part_y"), F.coalesce("_x", "x0").alias("part_x"))


def part_areas(parts: DataFrame, by: str = "slide_id") -> DataFrame:
    """``by, part_y, part_x, area`` by the runs' lengths."""
    return parts.groupBy(by, "part_y", "part_x").agg(F.sum((F.col("x1") - F.col("x0")).cast("long")).alias("area"))


def write_runs(labels: DataFrame, path: str, value: str = "label", by: str = "slide_id", band: int = 512) -> None:
    """A label image as Parquet of its runs, a folder a slide, in bands of rows."""
    runs = row_runs(labels, value, by).repartition(by, F.expr(f"y div {band}")).sortWithinPartitions(by, "y", "x0")
    runs.write.mode("overwrite").partitionBy(by).parquet(path)


def read_runs(spark: SparkSession, path: str, value: str = "label", by: str = "slide_id") -> DataFrame:
    """``by, y, x, value`` of what ``write_runs`` has written."""
    runs = spark.read.schema(f"y int, x0 int, x1 int, {value} int, {by} string").parquet(path)
    return run_pixels(runs, by, (value,))
