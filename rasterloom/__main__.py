"""Command line: ``spark-submit`` or ``python -m rasterloom`` with ``images``, ``store`` or ``metrics``.

A scorer is named ``module:function``; it takes an image and gives logits (see ``operators.scoring``).
"""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import scoring, stats
from .plans import infer
from .sources.samples import METRICS, SAMPLES, read_samples

LEVELS = "slide_id string, level_idx int, size_x int, size_y int, mpp_x double, mpp_y double"


def scorer(name: str) -> scoring.Scorer:
    """The function at ``module:function``, imported once in each worker."""
    module, _, function = name.partition(":")
    if not function:
        raise argparse.ArgumentTypeError(f"{name!r} is not module:function")
    return scoring.once(name, lambda: getattr(importlib.import_module(module), function))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rasterloom", description="Label slides, or summarise resource samples.")
    commands = top.add_subparsers(dest="command", required=True)
    images = commands.add_parser("images", help="label TIFF, PGM and PPM files")
    store = commands.add_parser("store", help="label the slides of a tiled store")
    for p in (images, store):
        p.add_argument("--input", required=True)
        p.add_argument("--output", required=True)
        p.add_argument("--scorer", required=True, type=scorer, help="module:function")
        p.add_argument("--target-mpp", type=float, default=1.0)
        p.add_argument("--save-image", help="where the separated image goes")
        p.add_argument("--roi", type=int, default=2048)
        p.add_argument("--overlap", type=float, default=0.25)
    images.add_argument("--mpp", type=float, help="resolution of all images, in place of what their heads say")
    images.add_argument("--no-tissue-mask", action="store_true")
    store.add_argument("--levels", required=True, help=f"CSV with a header: {LEVELS}")
    store.add_argument("--tile", type=int, default=2048)
    store.add_argument("--tile-overlap", type=int, default=128)
    store.add_argument("--background-tiles", type=int, default=4)
    store.add_argument("--thumbnail-edge", type=int, default=2000)
    store.add_argument("--least-tissue", type=float, default=0.01)
    store.add_argument("--no-tissue-crop", action="store_true")
    metrics = commands.add_parser("metrics", help="minimum, mean, median and maximum of resource samples")
    metrics.add_argument("--input", required=True, help=f"CSV with a header: {SAMPLES}")
    metrics.add_argument("--output", help="where the summary goes as JSON")
    return top


def main(arguments: Sequence[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"rasterloom {a.command}").getOrCreate()
    if a.command == "metrics":
        samples = read_samples(spark, a.input)
        found = stats.metric_summary(samples, METRICS)
        if a.output:
            found.write.mode("overwrite").json(a.output)
        found.orderBy("metric").show(truncate=False)
        return
    if a.command == "images":
        labels = infer.segment_images(
            spark, a.input, a.output, a.scorer, a.target_mpp, a.mpp, save_image=a.save_image, roi=a.roi, overlap=a.overlap, apply_tissue_mask=not a.no_tissue_mask
        )
    else:
        levels = spark.read.csv(a.levels, header=True, enforceSchema=False, schema=LEVELS)
        labels = infer.segment_store(
            spark, a.input, levels, a.output, a.scorer, a.target_mpp, a.tile, a.tile_overlap, a.roi, a.overlap, not a.no_tissue_crop,
            a.background_tiles, a.thumbnail_edge, a.least_tissue, a.save_image,
        )
    labels.groupBy("slide_id", "label").agg(F.count(F.lit(1)).alias("pixels")).orderBy("slide_id", "label").show(truncate=False)


if __name__ == "__main__":
    main()
