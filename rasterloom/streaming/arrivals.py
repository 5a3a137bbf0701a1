"""Labels for tiles as they arrive: a stream of files of packed tiles, committed batch by batch.

``<output>/labels/batch=k`` has the labels of a micro-batch, ``<output>/tiles/batch=k`` its tiles. The
second is written last and is the mark that the first is whole; labels without it count for nothing
and are written again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import pixel
from ..operators import neighbourhood, scoring
from ..scratch import materialise, shared_dir

CHANNELS = ["e", "h", "od"]
KEY = ["slide_id", "oy0", "ox0"]
PLACE = ["oh", "ow", "keep_y0", "keep_x0", "keep_h", "keep_w"]
KEYS = "slide_id string, oy0 int, ox0 int"
TILES = KEYS + "".join(f", {c} int" for c in PLACE) + "".join(f", {c} binary" for c in CHANNELS)
LABELS = "slide_id string, y int, x int, label int"


def pack_tiles(tile_pixels: DataFrame) -> DataFrame:
    """A row a tile, as the stream takes them, of ``slide_id, y, x, e, h, od`` with the tile's place.

    Channels are 8 bits; a missing pixel and a null channel are 0; of repeated pixels any one counts.
    """

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        place = dict(zip(KEY + PLACE, key))
        body = np.zeros((len(CHANNELS), place["oh"], place["ow"]), np.uint8)
        body[:, frame["y"] - place["oy0"], frame["x"] - place["ox0"]] = frame[CHANNELS].fillna(0).to_numpy(np.uint8).T
        return pd.DataFrame([{**place, **{c: b.tobytes() for c, b in zip(CHANNELS, body)}}])

    return tile_pixels.groupBy(*KEY, *PLACE).applyInPandas(run, TILES)


def _normalised(values: np.ndarray) -> np.ndarray:
    """One channel of one tile as ``stats.normalise`` has it."""
    scaled = values / 255.0
    some = scaled != 0
    if some.any():
        scaled[some] = (scaled[some] - scaled[some].mean()) / (scaled[some].std() or 1.0)
    low, high = scaled.min(), scaled.max()
    return (scaled - low) / (high - low) if high > low else np.zeros_like(scaled)


def _logits(image: np.ndarray, starts: tuple[np.ndarray, np.ndarray], scorer: scoring.Scorer, roi: int, overlap: float, sigma: float = 0.125) -> np.ndarray:
    """Logits of a tile, blended over its windows as ``scoring.score_windows`` does."""
    d = (np.arange(roi) - (roi - 1) / 2) ** 2
    weight = np.maximum(np.exp(-(d[:, None] + d) / (2 * (sigma * roi) ** 2)), 1e-3) if overlap > 0 else np.ones((roi, roi))
    total, weights = np.zeros(image.shape), np.zeros((*image.shape[:2], 1))
    for y in starts[0]:
        for x in starts[1]:
            patch = image[y : y + roi, x : x + roi]
            w = weight[: patch.shape[0], : patch.shape[1], None]
            total[y : y + roi, x : x + roi] += w * scoring.score_patch(patch, scorer)
            weights[y : y + roi, x : x + roi] += w
    return total / weights


def label_tiles(tiles: DataFrame, scorer: scoring.Scorer, roi: int = 512, overlap: float = 0.25) -> DataFrame:
    """``slide_id, y, x, label`` of the tiles' keep parts; each tile is normalised and scored on its own.

    ``tiles`` are packed, one row each: a tile is a task's unit of bounded size, and no pixel is
    shuffled. Tiles without slide, place or a channel, or without pixels, have no labels.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                bands = [np.frombuffer(getattr(r, c), np.uint8).reshape(r.oh, r.ow) for c in CHANNELS]
                image = np.stack([_normalised(b) for b in bands], -1).astype(np.float32)
                p = 1 / (1 + np.exp(-_logits(image, (r.ys, r.xs), scorer, roi, overlap)))
                over = lambda k: (p[..., k] > 0.5) & (p[..., k] > p[..., 2])
                label = np.where(over(0), pixel.EPITHELIUM, np.where(over(1), pixel.STROMA, pixel.BACKGROUND))
                label = label[r.keep_y0 : r.keep_y0 + r.keep_h, r.keep_x0 : r.keep_x0 + r.keep_w]
                y, x = np.indices(label.shape).reshape(2, -1)
                yield pd.DataFrame({"slide_id": r.slide_id, "y": y + r.oy0 + r.keep_y0, "x": x + r.ox0 + r.keep_x0, "label": label.ravel()})

    known = tiles.na.drop(subset=[*KEY, *PLACE, *CHANNELS]).where("oh > 0 and ow > 0")
    starts = [neighbourhood.window_starts(F.col(n), roi, overlap).alias(s) for n, s in (("oh", "ys"), ("ow", "xs"))]
    return known.select(*KEY, *PLACE, *CHANNELS, *starts).mapInPandas(run, LABELS)


def committed(spark: SparkSession, output: str) -> DataFrame:
    """``slide_id, oy0, ox0, batch`` of the tiles whose labels are whole."""
    return spark.read.schema(f"{KEYS}, batch long").parquet(f"{output}/tiles")


def read_arrivals(spark: SparkSession, output: str) -> DataFrame:
    """``slide_id, y, x, label`` of the committed batches."""
    marked = committed(spark, output).select("batch").distinct()
    return spark.read.schema(f"{LABELS}, batch long").parquet(f"{output}/labels").join(marked, "batch", "left_semi").drop("batch")


def _mark(tiles: DataFrame, output: str, batch: int) -> None:
    tiles.select(*KEY).coalesce(1).write.mode("overwrite").parquet(f"{output}/tiles/batch={batch}")


def label_arrivals(
    spark: SparkSession, source: str, output: str, checkpoint: str, scorer: scoring.Scorer, roi: int = 512, overlap: float = 0.25, files_per_batch: int = 8, until_empty: bool = True,
) -> StreamingQuery:
    """Start labelling the Parquet files of packed tiles in ``source``, at most ``files_per_batch`` at once.

    With ``until_empty`` the query ends when it has seen all files there are; else it waits for more.
    Started again with the same ``checkpoint`` and ``output`` it goes on behind the last batch. A batch
    that is given again after its mark is left out; one that broke off before it is scored again and
    replaces what it wrote. A tile that arrives again, in the same batch or later, is not scored.
    """
    spark.createDataFrame([], f"{KEYS}, batch long").write.mode("append").partitionBy("batch").parquet(f"{output}/tiles")
    spark.createDataFrame([], f"{LABELS}, batch long").write.mode("append").partitionBy("batch").parquet(f"{output}/labels")

    def commit(arrived: DataFrame, batch: int) -> None:
        session = arrived.sparkSession
        known = committed(session, output)
        if known.where(F.col("batch") == batch).limit(1).count():
            return
        # only keys of earlier tiles are compared, however many pixels those have
        fresh = arrived.dropDuplicates(KEY).join(known.select(*KEY), KEY, "left_anti")
        fresh = materialise(fresh.select(*KEY, *PLACE, *CHANNELS), shared_dir(session), "fresh")
        label_tiles(fresh, scorer, roi, overlap).write.mode("overwrite").parquet(f"{output}/labels/batch={batch}")
        _mark(fresh, output, batch)

    tiles = spark.readStream.schema(TILES).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    writer = tiles.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_empty else writer).start()
