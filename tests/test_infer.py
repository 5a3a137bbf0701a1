"""The ways from stored images to stored labels, on small made-up slides."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom import __main__ as command
from rasterloom.operators import grid, neighbourhood, scoring
from rasterloom.plans import infer
from rasterloom.sources import raster as sources
from rasterloom.sources import samples


def slide(height: int, width: int) -> np.ndarray:
    """Tissue on the left, light on the right."""
    rng = np.random.default_rng(8)
    body = np.full((height, width, 3), 246) + rng.integers(0, 4, (height, width, 3))
    body[:, : width // 2] = np.array([170, 90, 160]) + rng.integers(-30, 30, (height, width // 2, 3))
    return body.astype(np.uint8)


def write_ppm(path, values: np.ndarray) -> None:
    path.write_bytes(b"P6\n%d %d\n255\n" % (values.shape[1], values.shape[0]) + values.tobytes())


def side(image: np.ndarray) -> np.ndarray:
    """A scorer of single pixels: always stroma."""
    z = np.zeros((*image.shape[:2], 3), np.float32)
    z[..., 1] = 5
    return z


def test_images_are_labelled_in_their_own_size(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_ppm(tmp_path / "in/a.ppm", slide(40, 60))
    write_ppm(tmp_path / "in/b.ppm", slide(24, 30))
    known = spark.createDataFrame([("a.ppm", 0.5, 0.5), ("b.ppm", None, 0.5)], "slide_id string, mpp_x double, mpp_y double")
    out = infer.segment_images(spark, str(tmp_path / "in/*.ppm"), str(tmp_path / "out"), side, resolutions=known, roi=32, save_image=str(tmp_path / "image"))
    counts = {(r["slide_id"], r["h"], r["w"]): r["n"] for r in out.groupBy("slide_id").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"), F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {("a.ppm", 40, 60): 2400, ("b.ppm", 24, 30): 720}
    half = spark.read.parquet(str(tmp_path / "image")).groupBy("slide_id").count().collect()
    assert {r["slide_id"]: r["count"] for r in half} == {"a.ppm": 600, "b.ppm": 720}  # b's resolution is unknown
    labels = {r["slide_id"]: (r["l"], r["r"]) for r in out.groupBy("slide_id").agg(F.sum(F.when(F.col("x") < 10, F.col("label"))).alias("l"), F.sum(F.when(F.col("x") > 50, F.col("label"))).alias("r")).collect()}
    assert labels["a.ppm"] == (2 * 400, 0)


def test_store_is_labelled_tile_by_tile(spark, tmp_path):
    """Tissue tiles are scored and kept without gaps, empty ones stay 0, and missing tiles are white."""
    store, values = str(tmp_path / "store"), slide(64, 96)
    (tmp_path / "in").mkdir()
    write_ppm(tmp_path / "in/s", values)
    write_ppm(tmp_path / "in/t", np.full((32, 32, 3), 255, np.uint8))
    pixels = sources.read_images(spark, str(tmp_path / "in/*"))
    sources.write_tiles(pixels, store, tile=16)
    sources.write_tiles(pixels.where("y % 2 = 0 and x % 2 = 0").withColumns({"y": F.expr("y div 2"), "x": F.expr("x div 2")}), store, tile=16, level_idx=1)
    levels = [("s", 0, 96, 64, 0.5, 0.5), ("s", 1, 48, 32, 0.5, 0.5), ("t", 0, 32, 48, None, None)]  # t's last 16 rows aren't stored
    levels = spark.createDataFrame(levels, "slide_id string, level_idx int, size_x int, size_y int, mpp_x double, mpp_y double")
    whole = sources.read_levels(spark, store, levels.where("level_idx = 0"))
    assert whole.groupBy("slide_id").count().orderBy("slide_id").collect() == [("s", 64 * 96), ("t", 32 * 48)]
    assert whole.where("slide_id = 't' and y >= 32 and (r <> 255 or g <> 255 or b <> 255)").count() == 0
    got = np.zeros((64, 96), int)
    for r in whole.where("slide_id = 's'").collect():
        got[r["y"], r["x"]] = r["g"]
    assert (got == values[..., 1]).all()

    options = dict(tile=16, tile_overlap=4, roi=16, thumbnail_edge=20)
    out = infer.segment_store(spark, store, levels, str(tmp_path / "one"), side, target_mpp=1.0, save_image=str(tmp_path / "eho"), **options)
    saved = spark.read.parquet(str(tmp_path / "eho"))
    assert saved.groupBy("slide_id").count().orderBy("slide_id").collect() == [("s", 32 * 48), ("t", 32 * 48)]
    assert saved.where("slide_id = 't' and (e <> 255 or h <> 255 or od <> 255)").count() == 0
    assert saved.where("slide_id = 's' and x < 20 and od < 255").count() > 500
    table = {(r["slide_id"], r["y"], r["x"]): r["label"] for r in out.collect()}
    assert len(table) == 32 * 48 + 32 * 48  # half of s, t as it is
    assert all(v == 0 for (s, _, _), v in table.items() if s == "t")
    mine = np.array([[table["s", y, x] for x in range(48)] for y in range(32)])
    assert (mine[:, :24] == 2).all() and (mine[:, 40:] == 0).all()
    every = infer.segment_store(spark, store, levels.where("slide_id = 's'"), str(tmp_path / "two"), side, target_mpp=0.7, tissue_only=False, **options)
    assert every.count() == 46 * 69 and every.where("label <> 2").count() == 0


def test_only_tiles_under_regions_are_opened(spark, tmp_path):
    """Cells without a wanted tile are filled with rubbish; overlapping regions give each tile once."""
    store, rng = str(tmp_path / "store"), np.random.default_rng(3)
    (tmp_path / "in").mkdir()
    values = {s: rng.integers(0, 256, (100, 140, 3)).astype(np.uint8) for s in "ab"}
    for s, v in values.items():
        write_ppm(tmp_path / "in" / s, v)
    sources.write_tiles(sources.read_images(spark, str(tmp_path / "in/*")), store, tile=4)
    wanted = spark.createDataFrame([("a", 0, 100, 140), ("b", 0, 100, 140)], "slide_id string, level_idx int, size_y int, size_x int")
    places = [("a", 5, 20, 34, 50), ("a", 0, 9, 30, 41), ("a", 90, 120, 130, 200), ("a", 30, 30, 0, 9), ("b", -5, 3, 60, 61)]
    regions = spark.createDataFrame(places, "slide_id string, y0 int, y1 int, x0 int, x1 int")
    expected = {(s, y // 4, x // 4) for s, y0, y1, x0, x1 in places for y in range(max(0, y0), min(100, y1)) for x in range(x0, min(140, x1))}
    planned = sources.tiles_under(wanted.withColumn("edge", F.lit(4)), regions).collect()
    assert sorted((r["slide_id"], r["oy0"] // 4, r["ox0"] // 4) for r in planned) == sorted(expected)
    cells, spoiled = {(r["slide_id"], r["cell"]) for r in planned}, 0
    for folder in (tmp_path / "store").glob("slide_id=*/level_idx=0/cell=*"):
        slide_id, cell = folder.parts[-3].split("=")[1], int(folder.name.split("=")[1])
        if (slide_id, cell) not in cells:
            spoiled += 1
            for f in folder.glob("*.parquet"):
                f.write_bytes(b"PAR1 no table")
    assert spoiled > len(cells) and len(cells) > 3
    # the tiles' size is known from one small table, so that the spoiled files needn't tell it
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sources, "_edges", lambda stored, levels: levels.withColumn("edge", F.lit(4)))
        for limit in (300_000, len(cells)):
            got = sources.read_levels(spark, store, wanted, regions=regions, limit=limit).collect()
            assert len(got) == 16 * len(expected) and {(r["slide_id"], r["y"] // 4, r["x"] // 4) for r in got} == expected
            assert all(tuple(values[r["slide_id"]][r["y"], r["x"]]) == (r["r"], r["g"], r["b"]) for r in got)


def test_spans_hold_every_tap(spark):
    """The level pixels planned for a tile hold all that linear zoom takes for it."""
    sizes = [(n, m) for n in (1, 2, 7, 40, 41, 97) for m in (1, 2, 9, 40, 57, 97)]
    table = spark.createDataFrame(sizes, "n_in int, n_out int")
    taps = neighbourhood.linear_taps(table, "n_in", "n_out")
    span = grid.level_span(F.expr("out - out % 8"), F.least(F.lit(8), F.expr("n_out - (out - out % 8)")), F.col("n_out"), F.col("n_in"), 3)
    assert taps.withColumn("s", span).where("src < s.lo or src >= s.hi").count() == 0
    wide = taps.withColumn("s", span).where("s.lo < 0 or s.hi > n_in")
    assert wide.count() == 0


def test_share_of_the_store_that_is_read(spark):
    """A tenth of a slide is tissue: at most 15 % of the stored tiles are planned, at each scale of level and target."""
    side = 65536
    edge = int(side * 0.1**0.5)
    for level in (side, 2 * side, side // 2):
        images = spark.createDataFrame([("s", 0, side, side, level, level)], "slide_id string, level_idx int, h int, w int, size_y int, size_x int")
        tiles = grid.tile_grid(images.select("slide_id", "h", "w"), grid.Grid(2048, 128)).where(f"oy0 + oh > 7000 and oy0 < 7000 + {edge} and ox0 + ow > 9000 and ox0 < 9000 + {edge}")
        regions = infer.level_regions(tiles, images)
        planned = sources.tiles_under(images.withColumn("edge", F.lit(512)), regions)
        share = planned.count() / (level // 512) ** 2
        assert 0.10 <= share <= 0.15
        assert planned.select("z").distinct().count() == planned.count()


def test_curve(spark):
    rank = spark.range(64).select(grid.morton(F.expr("id div 8"), F.expr("id % 8")).alias("z"), F.expr("id div 8").alias("i"), F.expr("id % 8").alias("j")).collect()
    want = {(i, j): sum(((i >> k & 1) << (2 * k + 1)) | ((j >> k & 1) << (2 * k)) for k in range(31)) for i in range(8) for j in range(8)}
    assert {(r["i"], r["j"]): r["z"] for r in rank} == want
    top = spark.range(1).select(grid.morton(F.lit(2**31 - 1), F.lit(0)).alias("z")).first()["z"]
    assert top == sum(1 << (2 * k + 1) for k in range(31))


def test_resolution_of_the_placeholder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_ppm(tmp_path / "in/a", slide(20, 20))
    out = infer.segment_images(spark, str(tmp_path / "in/*"), str(tmp_path / "out"), scoring.placeholder_scorer, mpp=1.0, roi=16, apply_tissue_mask=False)
    assert out.count() == 400 and {r[0] for r in out.select("label").distinct().collect()} <= {0, 1, 2}


def test_samples_there_and_back(spark, tmp_path):
    kinds = "t double, proc_cpu_pct double, note string, mac_gpu_model string, proc_rss_bytes long"
    some = spark.createDataFrame([(2.0, None, "x", "a, \"b\" model", 5), (1.0, 3.5, "y", None, None)], kinds)
    samples.write_samples(some.repartition(3), str(tmp_path / "s"))
    back = samples.read_samples(spark, str(tmp_path / "s")).orderBy("t").collect()
    assert [tuple(r) for r in back] == [(1.0, 3.5, *[None] * 8), (2.0, None, 5.0, *[None] * 4, 'a, "b" model', None, None)]
    samples.write_samples(some.limit(0), str(tmp_path / "none"))
    assert samples.read_samples(spark, str(tmp_path / "none")).count() == 0
    assert [f.read_text().strip().count(",") for f in (tmp_path / "none").glob("*.csv")] == [9]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    write_ppm(tmp_path / "in/a", slide(20, 20))
    command.main(["images", "--input", str(tmp_path / "in/*"), "--output", str(tmp_path / "out"), "--scorer", "rasterloom.operators.scoring:placeholder_scorer", "--mpp", "2", "--roi", "64"])
    assert spark.read.parquet(str(tmp_path / "out")).count() == 400
    (tmp_path / "s.csv").write_text("t,proc_cpu_pct,proc_rss_bytes,system_cpu_pct,gpu_util_pct,gpu_mem_used_mib,gpu_mem_total_mib,mac_gpu_model,mac_gpu_vram_mib,mac_process_uses_metal\n0,1,10,,,,,,,\n1,3,20,5,,,,a model,,True\n")
    command.main(["metrics", "--input", str(tmp_path / "s.csv"), "--output", str(tmp_path / "json")])
    got = {r["metric"]: (r["min"], r["avg"], r["median"], r["max"]) for r in spark.read.schema("metric string, min double, avg double, median double, max double").json(str(tmp_path / "json")).collect()}
    assert got["proc_cpu_pct"] == (1, 2, 2, 3) and got["system_cpu_pct"] == (5, 5, 5, 5) and got["gpu_mem_used_mib"] == (None,) * 4
    with pytest.raises(SystemExit):
        command.parser().parse_args(["images", "--input", "a", "--output", "b", "--scorer", "nothing"])
