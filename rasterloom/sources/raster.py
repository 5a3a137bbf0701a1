"""Where pixels come from and go to: adapters, image files and tiled stores.

A pixel table has ``slide_id, y, x`` and a column a channel. A tile store is Parquet, partitioned
by slide, level and cell, with the tile's place in plain columns: a region reaches the scan as
filters. A cell holds 64 neighbouring tiles, a range of their order along a Morton curve; its name is
a hash with slide and level, so that one set of names prunes the cells of many slides at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pixel
from ..operators.grid import morton
from ..operators.pyramid import thumbnail_level
from ..operators.stats import with_slide
from ..scratch import materialise, shared_dir

PIXELS = "slide_id string, y int, x int, r int, g int, b int"
TILES = "slide_id string, level_idx int, channel int, oy0 int, ox0 int, oh int, ow int, pixels binary"
STORED = TILES + ", edge int, z long, cell long"
EDGE = 512
PLACE = ["slide_id", "level_idx", "z"]


def embedding_raster(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", slide: str = "embeddings") -> DataFrame:
    """Vectors as an image: a row of pixels each, three neighbouring components a pixel (doubles).

    Null vectors and identifiers have no pixels; a null component is a null channel.
    """
    n = "size(v)"
    cells = f"transform(v, (e, i) -> struct(i as x, cast(e as double) as r, cast(v[(i + 1) % {n}] as double) as g, cast(v[(i + 2) % {n}] as double) as b))"
    rows = embeddings.select(F.col(id_col).cast("int").alias("y"), F.col(vector_col).alias("v")).where("y is not null and v is not null")
    return rows.select(F.lit(slide).alias("slide_id"), "y", F.expr(f"inline({cells})"))


def synthetic_raster(spark: SparkSession, height: int, width: int, slide: str = "discs", cell: int = 24) -> DataFrame:
    """White discs of several sizes on mottled tissue, by integer formulas."""
    rows = spark.range(height * width).select(F.lit(slide).alias("slide_id"), F.expr(f"cast(id div {width} as int)").alias("y"), F.expr(f"cast(id % {width} as int)").alias("x"))
    radius = f"(4 + ((y div {cell}) * 7 + (x div {cell}) * 5) % 9)"
    dist = f"((y % {cell} - {cell // 2}) * (y % {cell} - {cell // 2}) + (x % {cell} - {cell // 2}) * (x % {cell} - {cell // 2}))"
    inside = F.expr(f"{dist} <= {radius} * {radius}")
    colours = {"r": (250, "150 + (y * 7 + x * 13) % 40"), "g": (248, "90 + (y * 5 + x * 3) % 50"), "b": (249, "140 + (y * 11 + x) % 60")}
    return rows.select("slide_id", "y", "x", *[F.when(inside, white).otherwise(F.expr(f"cast({tissue} as int)")).cast("int").alias(c) for c, (white, tissue) in colours.items()])


def decode_netpbm(raw: bytes) -> np.ndarray:
    """Height x width x 3 of a binary PGM or PPM file, 8 or 16 bits; one band is repeated."""
    head, at = [], 0
    while len(head) < 4:
        end = at
        while raw[end : end + 1] not in (b" ", b"\n", b"\t", b"\r", b"#", b""):
            end += 1
        if end > at:
            head.append(raw[at:end])
        at = raw.index(b"\n", end) + 1 if raw[end : end + 1] == b"#" else end + 1
        if end >= len(raw):
            raise ValueError("not a PGM or PPM image")
    if head[0] not in (b"P5", b"P6"):
        raise ValueError("not a binary PGM or PPM image")
    width, height, top = map(int, head[1:])
    bands = 1 if head[0] == b"P5" else 3
    body = np.frombuffer(raw, np.dtype(">u2") if top > 255 else np.uint8, width * height * bands, at).reshape(height, width, bands)
    return np.repeat(body, 3, 2) if bands == 1 else body


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """``slide_id, y, x, r, g, b`` of the PGM and PPM files at ``path``; the file's name is the slide.

    Spark reads the files, so any store it knows will do; a file is a task's unit. Rows are given
    out by bands of the image, so no more than a band is a batch.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, raw in zip(f["slide_id"], f["content"]):
                image = decode_netpbm(raw)
                step = max(1, 200_000 // image.shape[1])
                for top in range(0, len(image), step):
                    part = image[top : top + step].astype(np.int32)
                    y, x = np.divmod(np.arange(part.shape[0] * part.shape[1]), part.shape[1])
                    r, g, b = part.reshape(-1, 3).T
                    yield pd.DataFrame({"slide_id": name, "y": y + top, "x": x, "r": r, "g": g, "b": b})

    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("slide_id"), "content")
    return files.mapInPandas(run, PIXELS)


def _placed(tiles: DataFrame, i: Column, j: Column) -> DataFrame:
    """All columns with ``z``, the tile's rank along the curve, and ``cell``, the folder it lies in."""
    return tiles.withColumn("z", morton(i, j)).withColumn("cell", F.xxhash64("slide_id", "level_idx", F.shiftright("z", 6)))


def write_tiles(pixels: DataFrame, path: str, tile: int = EDGE, level_idx: int = 0, channels: Sequence[str] = ("r", "g", "b")) -> None:
    """Write a level of 8-bit channels as tiles; missing pixels are white. Other levels are kept.

    A level of a slide has tiles of one size. A cell is written by one task, in the curve's order.
    """
    long = pixels.select("slide_id", "y", "x", F.posexplode(F.array(*channels)).alias("channel", "v"))
    place = long.withColumn("oy0", F.expr(f"y - y % {tile}")).withColumn("ox0", F.expr(f"x - x % {tile}"))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        i, j = frame["y"].to_numpy() - key[2], frame["x"].to_numpy() - key[3]
        body = np.full((i.max() + 1, j.max() + 1), 255, np.uint8)
        body[i, j] = frame["v"].to_numpy()
        return pd.DataFrame({"slide_id": [key[0]], "level_idx": level_idx, "channel": key[1], "oy0": key[2], "ox0": key[3], "oh": body.shape[0], "ow": body.shape[1], "pixels": [body.tobytes()]})

    tiles = place.groupBy("slide_id", "channel", "oy0", "ox0").applyInPandas(run, TILES)
    tiles = _placed(tiles.withColumn("edge", F.lit(tile)), F.expr("oy0 div edge"), F.expr("ox0 div edge"))
    tiles = tiles.repartition("slide_id", "cell").sortWithinPartitions("slide_id", "level_idx", "cell", "z", "channel")
    tiles.write.mode("append").partitionBy("slide_id", "level_idx", "cell").parquet(path)


def read_region(spark: SparkSession, path: str, slide_id: str, level_idx: int, y0: int, y1: int, x0: int, x1: int, channels: Sequence[str] = ("r", "g", "b")) -> DataFrame:
    """``slide_id, y, x, channels`` of a region; what the store doesn't have is white.

    Slide and level prune folders, the region prunes row groups, and a tile that only touches the
    region gives only the pixels inside.
    """
    found = spark.read.schema(TILES).parquet(path).where((F.col("slide_id") == slide_id) & (F.col("level_idx") == level_idx))
    found = found.where((F.col("oy0") < y1) & (F.col("oy0") + F.col("oh") > y0) & (F.col("ox0") < x1) & (F.col("ox0") + F.col("ow") > x0) & F.col("channel").isin(list(range(len(channels)))))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                body = np.frombuffer(r.pixels, np.uint8).reshape(r.oh, r.ow)
                top, left = max(0, y0 - r.oy0), max(0, x0 - r.ox0)
                body = body[top : y1 - r.oy0, left : x1 - r.ox0]
                y, x = np.divmod(np.arange(body.size), body.shape[1])
                yield pd.DataFrame({"y": y + r.oy0 + top, "x": x + r.ox0 + left, "channel": r.channel, "v": body.reshape(-1).astype(np.int32)})

    long = found.select("channel", "oy0", "ox0", "oh", "ow", "pixels").mapInPandas(run, "y int, x int, channel int, v int")
    wide = long.groupBy("y", "x").agg(*[F.max(F.when(F.col("channel") == i, F.col("v"))).alias(c) for i, c in enumerate(channels)])
    width = max(0, x1 - x0)
    domain = spark.range(max(0, y1 - y0) * width).select(F.expr(f"cast(id div {max(1, width)} as int) + {y0}").alias("y"), F.expr(f"cast(id % {max(1, width)} as int) + {x0}").alias("x"))
    return domain.join(wide, ["y", "x"], "left").select(F.lit(slide_id).alias("slide_id"), "y", "x", *[F.coalesce(c, F.lit(255)).alias(c) for c in channels])


def tiles_under(levels: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """``slide_id, level_idx, z, cell, oy0, ox0, oh, ow``: the stored tiles that regions touch, each once.

    ``levels`` has ``slide_id, level_idx, size_y, size_x, edge``, one level a slide; ``regions`` has
    ``slide_id, y0, y1, x0, x1`` (ends exclusive) in pixels of that level and may overlap or reach
    beyond it. Without regions every tile of the level is meant.
    """
    whole = {"y0": F.lit(0), "y1": F.col("size_y"), "x0": F.lit(0), "x1": F.col("size_x")}
    rows = levels.withColumns(whole) if regions is None else levels.join(regions.select("slide_id", *whole), "slide_id")
    ends = lambda lo, hi, size: F.sequence(F.expr(f"greatest({lo}, 0) div edge"), F.expr(f"(least({hi}, {size}) - 1) div edge"))
    rows = rows.where("least(y1, size_y) > greatest(y0, 0) and least(x1, size_x) > greatest(x0, 0)")
    rows = rows.withColumn("_i", F.explode(ends("y0", "y1", "size_y"))).withColumn("_j", F.explode(ends("x0", "x1", "size_x")))
    rows = rows.select("slide_id", "level_idx", "size_y", "size_x", "edge", "_i", "_j").distinct()
    rows = _placed(rows, F.col("_i"), F.col("_j")).withColumns({"oy0": F.expr("cast(_i * edge as int)"), "ox0": F.expr("cast(_j * edge as int)")})
    clipped = [F.expr(f"cast(least(edge, {size} - {o}) as int)").alias(n) for size, o, n in (("size_y", "oy0", "oh"), ("size_x", "ox0", "ow"))]
    return rows.select(*PLACE, "cell", "oy0", "ox0", *clipped)


def _edges(stored: DataFrame, levels: DataFrame) -> DataFrame:
    """``levels`` with ``edge``, the size of their tiles in the store: one narrow column is read."""
    found = with_slide(stored.select("slide_id", "level_idx", "edge"), levels.select("slide_id", F.col("level_idx").alias("_l")), stored=True)
    found = found.where("level_idx = _l").groupBy("slide_id").agg(F.max("edge").alias("edge"))
    return levels.join(found, "slide_id", "left").fillna(EDGE, "edge")


def read_levels(
    spark: SparkSession, path: str, wanted: DataFrame, channels: Sequence[str] = ("r", "g", "b"), regions: DataFrame | None = None, limit: int = 300_000,
) -> DataFrame:
    """``slide_id, y, x, channels`` of one level of each slide of ``wanted(slide_id, level_idx, size_y, size_x)``.

    With ``regions`` (see ``tiles_under``) only tiles that a region touches are read, each once and
    with all its pixels; the cells of other tiles are not opened. A tile's channels meet before
    they are unpacked, so packed bytes are shuffled rather than pixels. What the store doesn't have
    is white; pixels beyond the level's size are left out. The list of tiles is broadcast up to
    ``limit`` rows, then that of cells; beyond, both sides are shuffled.
    """
    small = lambda rows: rows.limit(limit + 1).count() <= limit
    hint = lambda rows: F.broadcast(rows) if small(rows) else rows
    stored = spark.read.schema(STORED).parquet(path)
    levels = _edges(stored, wanted.select("slide_id", "level_idx", "size_y", "size_x"))
    planned = materialise(tiles_under(levels, regions), shared_dir(spark), "planned")
    schema = "slide_id string, y int, x int, " + ", ".join(f"{c} int" for c in channels)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                body = np.full((len(channels), r.oh, r.ow), 255, np.int32)
                for part in r.parts if r.parts is not None else ():
                    have = np.frombuffer(part["pixels"], np.uint8).reshape(part["oh"], part["ow"])[: r.oh, : r.ow]
                    body[part["channel"], : have.shape[0], : have.shape[1]] = have
                y, x = np.divmod(np.arange(r.oh * r.ow), r.ow)
                yield pd.DataFrame({"slide_id": r.slide_id, "y": y + r.oy0, "x": x + r.ox0, **dict(zip(channels, body.reshape(len(channels), -1)))})

    chosen = planned.where("z >= 0")  # always true; a comparison lets the join prune folders when it runs
    kept = stored.where(F.col("channel").isin(list(range(len(channels)))))
    if small(chosen):
        kept = kept.join(F.broadcast(chosen), [*PLACE, "cell"], "left_semi")
    else:
        kept = kept.join(hint(chosen.select("slide_id", "level_idx", "cell").distinct()), ["slide_id", "level_idx", "cell"], "left_semi")
        kept = kept.join(chosen, PLACE, "left_semi")
    tiles = kept.groupBy(*PLACE).agg(F.collect_list(F.struct("channel", "oh", "ow", "pixels")).alias("parts"))  # a part a channel
    return planned.join(tiles, PLACE, "left").select("slide_id", "oy0", "ox0", "oh", "ow", "parts").mapInPandas(run, schema)


def read_thumbnail(spark: SparkSession, path: str, levels: DataFrame, slide_id: str, least: int = 2000) -> DataFrame:
    """The coarsest level with an edge of ``least`` pixels, whole; an unknown slide is an error."""
    mine = levels.where(F.col("slide_id") == slide_id)
    chosen = mine.join(thumbnail_level(mine, least), ["slide_id", "level_idx"]).select("level_idx", "size_x", "size_y").first()
    if chosen is None:
        raise ValueError(f"no slide {slide_id!r}")
    return read_region(spark, path, slide_id, chosen["level_idx"], 0, chosen["size_y"], 0, chosen["size_x"])


def write_labels(labels: DataFrame, path: str) -> None:
    """Labels as Parquet, a folder a slide."""
    labels.repartition("slide_id", F.expr("y div 512"), F.expr("x div 512")).sortWithinPartitions("y", "x").write.mode("overwrite").partitionBy("slide_id").parquet(path)


def all_background(domain: DataFrame) -> DataFrame:
    """``slide_id, y, x, label`` with label 0: what an image without tissue gets."""
    return domain.select("slide_id", "y", "x", F.lit(pixel.BACKGROUND).alias("label"))
