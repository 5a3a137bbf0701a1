"""Image files of any size: tiled and striped TIFF, and binary PGM and PPM, read by byte ranges.

What is read first is an index: a row a tile (a strip and a band of rows count as one), with its place
in the image and in the file. It comes from the files' heads alone. Tasks then get shares of the
index and read their own ranges, so one file is spread over many tasks, and a filter on the index
(level, region, tiles with tissue) is a filter on what is read.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator, Sequence
from typing import Any, BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir

INDEX = (
    "slide_id string, path string, level_idx int, size_x int, size_y int, mpp_x double, mpp_y double, oy0 int, ox0 int, oh int, ow int, "
    "offsets array<long>, sizes array<long>, tile_h int, tile_w int, samples int, bits int, big boolean, packing string, predictor int"
)
_COLUMNS = [c.split()[0] for c in INDEX.split(", ")]
#: Pixels of a band of a file without tiles.
BAND = 1 << 18
#: File bytes that a task reads, about.
TASK_BYTES = 64 << 20

# Fixed values of the TIFF format: tags, types (letter of ``struct``, bytes), compressions, units in micrometres.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, STRIP_ROWS, STRIP_SIZES = 256, 257, 258, 259, 273, 277, 278, 279
X_RES, Y_RES, PLANES, UNIT, PREDICTOR, TILE_W, TILE_H, TILES, TILE_SIZES, CHILDREN = 282, 283, 284, 296, 317, 322, 323, 324, 325, 330
TYPES = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 6: ("b", 1), 7: ("s", 1), 8: ("h", 2), 9: ("i", 4), 13: ("I", 4), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
PACKINGS = {1: "none", 8: "zlib", 32946: "zlib", 32773: "packbits"}
UNITS = {2: 25_400.0, 3: 10_000.0}


def open_file(path: str) -> BinaryIO:
    """A seekable file of a store that pyarrow knows (local, HDFS, S3, GCS, Azure)."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", path)
    store, inner = fs.FileSystem.from_uri(uri)
    return store.open_input_file(inner)


class _Tags:
    """The directories of a TIFF file, read by seeking: only heads and lists of tiles are touched."""

    def __init__(self, file: BinaryIO, order: str):
        self.file, self.order = file, order
        self.wide = self._numbers(2, "H", 1)[0] == 43
        self.first = self._numbers(8, "Q", 1)[0] if self.wide else self._numbers(4, "I", 1)[0]

    def _numbers(self, at: int, kind: str, n: int) -> tuple:
        size = struct.calcsize(self.order + kind)
        self.file.seek(at)
        return struct.unpack(f"{self.order}{n}{kind}", self.file.read(size * n))

    def directory(self, at: int) -> tuple[dict[int, tuple], int]:
        """Tags with their values, and where the next directory is (0: none)."""
        head, count, entry = (8, "Q", 20) if self.wide else (2, "H", 12)
        n = self._numbers(at, count, 1)[0]
        self.file.seek(at + head)
        body = self.file.read(n * entry + (8 if self.wide else 4))
        tags = {}
        for k in range(n):
            raw = body[k * entry : (k + 1) * entry]
            tag, kind = struct.unpack(self.order + "HH", raw[:4])
            if kind not in TYPES:
                continue
            letter, size = TYPES[kind]
            m = struct.unpack(self.order + ("Q" if self.wide else "I"), raw[4 : 12 if self.wide else 8])[0]
            inline = raw[12:] if self.wide else raw[8:]
            if m * size > len(inline):
                self.file.seek(struct.unpack(self.order + ("Q" if self.wide else "I"), inline)[0])
                inline = self.file.read(m * size)
            many = m * len(letter) if letter != "s" else m
            tags[tag] = struct.unpack(f"{self.order}{many}{letter[0]}", inline[: m * size])
        return tags, struct.unpack(self.order + ("Q" if self.wide else "I"), body[n * entry :])[0]

    def all(self) -> list[dict[int, tuple]]:
        """All directories, those below another one too; a chain that bites its tail ends."""
        found, seen, todo = [], set(), [self.first]
        while todo:
            at = todo.pop(0)
            if not at or at in seen:
                continue
            seen.add(at)
            tags, after = self.directory(at)
            found.append(tags)
            todo += [*tags.get(CHILDREN, ()), after]
        return found


def _mpp(tags: dict[int, tuple], axis: int) -> float | None:
    """Micrometres a pixel by the resolution tag; None where it is missing, zero or without a unit."""
    up, down = tags.get(axis, (0, 0))[:2]
    unit = UNITS.get(tags.get(UNIT, (2,))[0])
    return unit * down / up if up and down and unit else None


def _tiff_levels(file: BinaryIO, order: str) -> list[dict[str, Any]]:
    """What is known of each level, largest first; pictures of another shape (labels, overviews) are no levels."""
    every = [t for t in _Tags(file, order).all() if WIDTH in t and HEIGHT in t and (TILES in t or STRIPS in t)]
    if not every:
        raise ValueError("no image in this TIFF file")
    full = max(every, key=lambda t: t[WIDTH][0] * t[HEIGHT][0])
    w0, h0 = full[WIDTH][0], full[HEIGHT][0]
    same = [t for t in every if abs(t[WIDTH][0] * h0 - t[HEIGHT][0] * w0) <= max(w0, h0)]
    levels = []
    for k, t in enumerate(sorted(same, key=lambda t: -t[WIDTH][0])):
        w, h = t[WIDTH][0], t[HEIGHT][0]
        packing = PACKINGS.get(t.get(COMPRESSION, (1,))[0])
        bits = set(t.get(BITS, (1,)))
        if packing is None or bits not in ({8}, {16}):
            raise ValueError(f"TIFF compression {t.get(COMPRESSION, (1,))[0]} with {sorted(bits)} bits a sample is not supported")
        tiled, planes = TILES in t, t.get(PLANES, (1,))[0] == 2
        th, tw = (t[TILE_H][0], t[TILE_W][0]) if tiled else (min(t.get(STRIP_ROWS, (h,))[0], h), w)
        mpp = [_mpp(full, axis) for axis in (X_RES, Y_RES)]
        levels.append({
            "level_idx": k, "size_x": w, "size_y": h, "mpp_x": mpp[0] and mpp[0] * w0 / w, "mpp_y": mpp[1] and mpp[1] * h0 / h, "tile_h": th, "tile_w": tw,
            "samples": t.get(SAMPLES, (1,))[0], "planes": planes, "bits": bits.pop(), "big": order == ">", "packing": packing, "predictor": t.get(PREDICTOR, (1,))[0],
            "at": t[TILES if tiled else STRIPS], "bytes": t[TILE_SIZES if tiled else STRIP_SIZES], "tiled": tiled,
        })
        levels[-1] = _in_bands(levels[-1])
    return levels


def _in_bands(level: dict[str, Any]) -> dict[str, Any]:
    """Uncompressed strips cut into bands of whole rows, so that no task has to hold a long strip."""
    rows = max(1, BAND // max(1, level["size_x"]))
    if level["tiled"] or level["packing"] != "none" or level["tile_h"] <= rows:
        return level
    if level["tile_h"] < level["size_y"]:  # bands of every strip must fall on one grid
        rows = next(d for d in range(rows, 0, -1) if level["tile_h"] % d == 0)
    row = level["size_x"] * level["bits"] // 8 * (1 if level["planes"] else level["samples"])
    bands = [(at + y * row, min(rows * row, n - y * row)) for at, n in zip(level["at"], level["bytes"]) for y in range(0, n // row, rows)]
    return level | {"tile_h": rows, "at": [a for a, _ in bands], "bytes": [n for _, n in bands]}


def _netpbm_level(file: BinaryIO) -> dict[str, Any]:
    """A PGM or PPM file as one level of uncompressed bands, by its head."""
    file.seek(0)
    head = file.read(1 << 16)
    found = re.match(rb"P([56])" + rb"(?:\s|#[^\n]*\n)+(\d+)" * 3 + rb"\s", head)
    if not found:
        raise ValueError("not a TIFF file, and not a binary PGM or PPM image")
    w, h, top = (int(x) for x in found.groups()[1:])
    samples, bits = (1 if found[1] == b"5" else 3), (16 if top > 255 else 8)
    row, rows = w * samples * bits // 8, max(1, BAND // max(1, w))
    tops = range(0, h, rows)
    return {
        "level_idx": 0, "size_x": w, "size_y": h, "mpp_x": None, "mpp_y": None, "tile_h": rows, "tile_w": w, "samples": samples, "planes": False, "bits": bits, "big": True,
        "packing": "none", "predictor": 1, "at": [found.end() + y * row for y in tops], "bytes": [min(rows, h - y) * row for y in tops], "tiled": False,
    }


def image_levels(path: str) -> list[dict[str, Any]]:
    """Levels of one file."""
    with open_file(path) as file:
        mark = file.read(4)
        if mark[:2] in (b"II", b"MM") and mark[2:] in (b"*\x00", b"\x00*", b"+\x00", b"\x00+"):
            return _tiff_levels(file, "<" if mark[:2] == b"II" else ">")
        return [_netpbm_level(file)]


def _index_rows(path: str, level: dict[str, Any]) -> Iterator[pd.DataFrame]:
    across, down = -(-level["size_x"] // level["tile_w"]), -(-level["size_y"] // level["tile_h"])
    at, sizes = np.asarray(level["at"], np.int64), np.asarray(level["bytes"], np.int64)
    parts = level["samples"] if level["planes"] else 1
    if len(at) != across * down * parts or len(sizes) != len(at):
        raise ValueError(f"{path}: level {level['level_idx']} lists {len(at)} tiles, not {across * down * parts}")
    at, sizes = at.reshape(parts, -1).T, sizes.reshape(parts, -1).T
    fixed = {c: level[c] for c in ("level_idx", "size_x", "size_y", "mpp_x", "mpp_y", "tile_w", "samples", "bits", "big", "packing", "predictor")}
    for lo in range(0, across * down, 10_000):
        k = np.arange(lo, min(lo + 10_000, across * down))
        y, x = k // across * level["tile_h"], k % across * level["tile_w"]
        oh, ow = np.minimum(level["tile_h"], level["size_y"] - y), np.minimum(level["tile_w"], level["size_x"] - x)
        stored = np.full(len(k), level["tile_h"]) if level["tiled"] else oh  # strips end with the image, tiles don't
        rows = {"oy0": y, "ox0": x, "oh": oh, "ow": ow, "tile_h": stored, "offsets": list(at[k]), "sizes": list(sizes[k])}
        yield pd.DataFrame({"slide_id": path.rsplit("/", 1)[-1], "path": path, **fixed, **rows})[_COLUMNS]


def tile_index(spark: SparkSession, path: str) -> DataFrame:
    """A row a tile of every level of the files at ``path``: its place in the image and in the file.

    ``path`` is a file, folder or pattern of names; the file's name is the slide. Files are listed
    without reading them, and of each only the head is read; a slide may be larger than any task.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name in f["path"]:
                for level in image_levels(name):
                    yield from _index_rows(name, level)

    files = spark.read.format("binaryFile").load(path).select("path")
    return files.mapInPandas(run, INDEX)


def levels(index: DataFrame) -> DataFrame:
    """``slide_id, level_idx, size_x, size_y, mpp_x, mpp_y``: what the heads say, 0 is the full size."""
    return index.select("slide_id", "level_idx", "size_x", "size_y", "mpp_x", "mpp_y").distinct()


def unpack_bits(raw: bytes) -> bytes:
    """Runs of equal bytes spelled out: a count below 128 and that many bytes more, or one byte repeated."""
    out, at = bytearray(), 0
    while at < len(raw):
        n = raw[at]
        if n < 128:
            out += raw[at + 1 : at + 2 + n]
            at += 2 + n
        elif n > 128:
            out += raw[at + 1 : at + 2] * (257 - n)
            at += 2
        else:
            at += 1
    return bytes(out)


def decode_tile(parts: Sequence[bytes], tile_h: int, tile_w: int, samples: int, bits: int, big: bool, packing: str, predictor: int) -> np.ndarray:
    """``tile_h`` x ``tile_w`` x 3 of a stored tile; one or two samples count as grey, more than three as colours and the rest."""
    unpack = {"none": bytes, "zlib": zlib.decompress, "packbits": unpack_bits}[packing]
    each = samples if len(parts) == 1 else 1
    kind = np.dtype(np.uint8 if bits == 8 else np.uint16).newbyteorder(">" if big else "<")
    planes = []
    for raw in parts:
        body = np.frombuffer(unpack(raw), kind, tile_h * tile_w * each).reshape(tile_h, tile_w, each)
        planes.append(np.add.accumulate(body.astype(body.dtype.newbyteorder("=")), axis=1, dtype=body.dtype.newbyteorder("=")) if predictor == 2 else body)
    body = planes[0] if len(parts) == 1 else np.concatenate(planes, 2)
    return np.repeat(body[..., :1], 3, 2) if samples < 3 else body[..., :3]


def read_tiles(index: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``slide_id, level_idx, y, x, r, g, b`` of the tiles of ``index``, which may be any part of one.

    Neighbouring tiles of a file go to one task, about ``task_bytes`` each; a task holds one tile at
    a time (of a compressed file in few strips, a strip). Tiles without bytes, which some writers
    leave out, are white.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, file = None, None
        for f in frames:
            for t in f.itertuples(index=False):
                if t.path != name:
                    if file is not None:
                        file.close()
                    name, file = t.path, open_file(t.path)
                parts = []
                for at, size in zip(t.offsets, t.sizes):
                    file.seek(int(at))
                    parts.append(file.read(int(size)))
                if any(len(p) != s for p, s in zip(parts, t.sizes)):
                    raise ValueError(f"{t.path} ends before its last tile")
                if all(s == 0 for s in t.sizes):
                    body = np.full((t.oh, t.ow, 3), (1 << t.bits) - 1)
                else:
                    body = decode_tile(parts, t.tile_h, t.tile_w, t.samples, t.bits, t.big, t.packing, t.predictor)[: t.oh, : t.ow]
                y, x = np.divmod(np.arange(t.oh * t.ow), t.ow)
                r, g, b = body.reshape(-1, 3).astype(np.int32).T
                yield pd.DataFrame({"slide_id": t.slide_id, "level_idx": t.level_idx, "y": y + t.oy0, "x": x + t.ox0, "r": r, "g": g, "b": b})
        if file is not None:
            file.close()

    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)
    total = index.agg(F.sum(F.greatest(size, F.col("oh").cast("long") * F.col("ow")))).first()[0] or 0
    dealt = index.repartitionByRange(max(1, -(-total // task_bytes)), "path", F.get("offsets", F.lit(0)))
    return dealt.sortWithinPartitions("path", F.get("offsets", F.lit(0))).mapInPandas(run, "slide_id string, level_idx int, y int, x int, r int, g int, b int")


def read_images(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``slide_id, y, x, r, g, b`` of the full size of the images at ``path``, and their ``levels``."""
    index = materialise(tile_index(spark, path), shared_dir(spark), "index")
    return read_tiles(index.where("level_idx = 0")).drop("level_idx"), levels(index)
