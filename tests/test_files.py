"""Image files by byte ranges: each layout against the array it was written from."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.operators import scoring
from rasterloom.plans import infer
from rasterloom.sources import files


def pack_bits(raw: bytes) -> bytes:
    """Runs of three and more as one byte and a count, the rest as it is."""
    out, at = bytearray(), 0
    while at < len(raw):
        n = 1
        while at + n < len(raw) and n < 128 and raw[at + n] == raw[at]:
            n += 1
        if n > 2:
            out += bytes([257 - n, raw[at]])
        else:
            n = min(5, len(raw) - at)
            out += bytes([n - 1]) + raw[at : at + n]
        at += n
    return bytes(out)


def tiff(levels, order="<", wide=False, tile=(16, 32), packing=1, predictor=1, planar=False, strips=None, resolution=None, children=False) -> bytes:
    """A TIFF file of the given arrays, written from the format's description."""
    offset, count = ("Q", "Q") if wide else ("I", "H")
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + ("HHHQ" if wide else "HI"), *((43, 8, 0, 0) if wide else (42, 0))))
    places = []
    for k, image in enumerate(levels):
        h, w, s = image.shape
        th, tw = (strips, w) if strips else tile
        ats, sizes = [], []
        for plane in [image[..., i : i + 1] for i in range(s)] if planar else [image]:
            for y in range(0, h, th):
                for x in range(0, w, tw):
                    body = plane[y : y + th, x : x + tw]
                    if not strips:
                        body = np.pad(body, ((0, th - body.shape[0]), (0, tw - body.shape[1]), (0, 0)))
                    if predictor == 2:
                        body = np.concatenate([body[:, :1], np.diff(body, axis=1)], 1)
                    raw = body.astype(body.dtype.newbyteorder(order)).tobytes()
                    raw = {1: bytes, 8: zlib.compress, 32773: pack_bits}[packing](raw)
                    ats.append(len(out))
                    sizes.append(len(raw))
                    out += raw
        tags = [(256, "I", [w]), (257, "I", [h]), (258, "H", [image.dtype.itemsize * 8] * s), (259, "H", [packing]), (277, "H", [s]), (284, "H", [2 if planar else 1]), (317, "H", [predictor])]
        tags += [(273, offset, ats), (278, "H", [strips]), (279, "I", sizes)] if strips else [(322, "H", [tw]), (323, "H", [th]), (324, offset, ats), (325, "I", sizes)]
        if resolution and not k:
            tags += [(282, "II", [resolution[0], 1]), (283, "II", [resolution[1], 1]), (296, "H", [3])]
        places.append((sorted(tags), len(out)))
        if children and not k:
            tags.append((330, offset, [0] * (len(levels) - 1)))
        out += b"\0" * 4000  # room for the directory and its lists
    starts = [p for _, p in places]
    for k, (tags, at) in enumerate(places):
        if children and not k:
            tags = sorted([*tags, (330, offset, starts[1:])])
        entry, extra = (20, 8) if wide else (12, 4)
        body, spare = bytearray(struct.pack(order + count, len(tags))), at + 8 + len(tags) * entry + 16
        for tag, letter, values in tags:
            kind = {"H": 3, "I": 4, "II": 5, "Q": 16}[letter]
            raw = struct.pack(f"{order}{len(values)}{letter[0]}", *values)
            body += struct.pack(order + "HH" + offset, tag, kind, len(values) // len(letter))
            if len(raw) > extra:
                out[spare : spare + len(raw)] = raw
                body += struct.pack(order + offset, spare)
                spare += len(raw)
            else:
                body += raw.ljust(extra, b"\0")
        assert spare < at + 4000
        after = 0 if children or k + 1 == len(levels) else starts[k + 1]
        body += struct.pack(order + offset, after)
        out[at : at + len(body)] = body
    struct.pack_into(order + offset, out, 8 if wide else 4, starts[0])
    return bytes(out)


def picture(h: int, w: int, samples: int = 3, kind=np.uint8, seed: int = 1) -> np.ndarray:
    rng = np.random.default_rng(seed)
    body = rng.integers(0, np.iinfo(kind).max, (h, w, samples), dtype=kind)
    body[: h // 2] = body[0, 0]  # long runs as well
    return body


def array(df) -> np.ndarray:
    found = df.toPandas()
    out = np.full((found["y"].max() + 1, found["x"].max() + 1, 3), -1)
    out[found["y"], found["x"]] = found[["r", "g", "b"]].to_numpy()
    assert len(found) == out.shape[0] * out.shape[1]
    return out


LAYOUTS = {
    "plain": {}, "big": dict(order=">", wide=True, packing=8), "packed": dict(packing=32773), "predicted": dict(packing=8, predictor=2, order=">"),
    "strips": dict(strips=7), "planes": dict(planar=True, packing=8), "grey": dict(samples=1), "alpha": dict(samples=4), "deep": dict(kind=np.uint16, order=">", predictor=2), "wide": dict(wide=True),
}


def test_layouts_equal_numpy(spark, tmp_path):
    """Every layout, each as a slide of its own, and levels by size with their resolution."""
    want = {}
    for k, (name, options) in enumerate(LAYOUTS.items()):
        options = dict(options)
        body = picture(37, 70, options.pop("samples", 3), options.pop("kind", np.uint8), k)
        (tmp_path / f"{name}.tif").write_bytes(tiff([body, body[::2, ::2]], resolution=(20_000, 40_000), children=k % 2 == 1, **options))
        want[f"{name}.tif"] = np.repeat(body, 3, 2) if body.shape[2] == 1 else body[..., :3]
    index = files.tile_index(spark, str(tmp_path / "*.tif")).cache()
    found = {(r["slide_id"], r["level_idx"]): tuple(r)[2:] for r in files.levels(index).collect()}
    assert found == {(s, k): x for s in want for k, x in ((0, (70, 37, 0.5, 0.25)), (1, (35, 19, 1.0, 0.25 * 37 / 19)))}
    pixels = files.read_tiles(index, task_bytes=3000).cache()
    for name, body in want.items():
        assert (array(pixels.where((F.col("slide_id") == name) & (F.col("level_idx") == 0))) == body).all(), name
        assert (array(pixels.where((F.col("slide_id") == name) & (F.col("level_idx") == 1))) == body[::2, ::2]).all(), name


def test_long_strips_are_cut_into_bands(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "BAND", 210)
    body = picture(37, 70)
    for strips, rows in ((37, 3), (8, 2), (2, 2)):
        (tmp_path / "s.tif").write_bytes(tiff([body], strips=strips))
        level = files.image_levels(f"file:{tmp_path}/s.tif")[0]
        assert level["tile_h"] == rows and sum(level["bytes"]) == body.size
        frames = [f for f in files._index_rows("s", level)]
        assert sum(f["oh"].sum() for f in frames) == 37
    for planar in (False, True):
        (tmp_path / "s.tif").write_bytes(tiff([body], strips=37, planar=planar, predictor=2))
        frame = next(files._index_rows(f"file:{tmp_path}/s.tif", files.image_levels(f"file:{tmp_path}/s.tif")[0]))
        frame["offsets"], frame["sizes"] = [x.tolist() for x in frame["offsets"]], [x.tolist() for x in frame["sizes"]]
        assert len(frame) == 13 and (array(files.read_tiles(spark.createDataFrame(frame, files.INDEX))) == body).all()


def test_a_file_larger_than_a_task(spark, tmp_path):
    """Of a file of over 3 GB with holes, what is asked for is read, by many tasks, from beyond 2 GB."""
    w, h = 40_000, 27_000
    with open(tmp_path / "large.ppm", "wb") as out:
        out.write(b"P6\n# holes\n%d %d\n255\n" % (w, h))
        start = out.tell()
        out.seek(start + (h - 1) * w * 3)
        out.write(bytes(range(250)) * (w * 3 // 250))
    index = files.tile_index(spark, str(tmp_path / "large.ppm")).cache()
    assert files.levels(index).first()["size_y"] == h and index.count() == -(-h // (files.BAND // w))
    assert files.read_tiles(index).rdd.getNumPartitions() >= 48  # about 64 MB each
    rows = files.read_tiles(index.where(F.col("oy0") + F.col("oh") == h)).where(F.col("y") == h - 1).orderBy("x").limit(200).collect()
    assert [(r["r"], r["g"], r["b"]) for r in rows] == [tuple((3 * x + c) % 250 for c in range(3)) for x in range(200)]


def test_odd_files(spark, tmp_path):
    (tmp_path / "a.pgm").write_bytes(b"P5 # two\n3 2\n65535\n" + np.arange(6, dtype=">u2").tobytes())
    assert (array(files.read_images(spark, str(tmp_path / "a.pgm"))[0])[..., 0] == np.arange(6).reshape(2, 3)).all()
    for name, body in (("b", b"no image"), ("c", tiff([picture(9, 9)]).replace(struct.pack("<HHII", 259, 3, 1, 1), struct.pack("<HHII", 259, 3, 1, 7)))):
        (tmp_path / name).write_bytes(body)
        with pytest.raises(Exception, match="not a TIFF file|not supported"):
            files.tile_index(spark, str(tmp_path / name)).count()
    (tmp_path / "d.ppm").write_bytes(b"P6 4 4 255\n" + bytes(40))
    with pytest.raises(Exception, match="ends before its last tile"):
        files.read_images(spark, str(tmp_path / "d.ppm"))[0].count()


def test_images_are_brought_to_the_resolution_in_their_head(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/s.tif").write_bytes(tiff([picture(24, 40)], resolution=(20_000, 20_000)))
    out = infer.segment_images(spark, str(tmp_path / "in/*"), str(tmp_path / "out"), scoring.placeholder_scorer, roi=16, save_image=str(tmp_path / "image"), apply_tissue_mask=False)
    assert out.count() == 24 * 40 and spark.read.parquet(str(tmp_path / "image")).count() == 12 * 20
