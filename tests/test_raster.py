"""Raster operators: every query against its SQL, and hand cases against numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rasterloom.functions import parsing, pixel
from rasterloom.operators import areas, components, gate, neighbourhood, runs, scoring, stain, stats
from rasterloom.operators.background import detect_background
from rasterloom.operators.grid import Grid, axis_gaps, strided_pick, tile_grid
from rasterloom.plans import queries as raster
from rasterloom.plans.segment import segment
from rasterloom.sources import raster as sources

from .conftest import SF_DIR

ORACLE = raster.oracle_sql()


def image(spark, values: np.ndarray, slide: str = "s"):
    """A pixel table of an (h, w, 3) array."""
    h, w = values.shape[:2]
    return spark.createDataFrame([(slide, y, x, *map(int, values[y, x])) for y in range(h) for x in range(w)], sources.PIXELS)


def array(df, column: str, shape: tuple[int, int]) -> np.ndarray:
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["y"], r["x"]] = r[column]
    return out


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(name, same):
    same(raster.queries()[name], ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(raster.queries()) - set(ORACLE)))
def test_query_without_sql_runs(name, spark):
    assert raster.queries()[name](spark, SF_DIR).count() > 0


def test_keep_parts_cover_once(spark):
    sizes = spark.createDataFrame([(h, h + 3) for h in range(1, 60)], "h int, w int")
    for close in (True, False):
        tiles = tile_grid(sizes, Grid(16, 4, close))
        bad = tiles.where("keep_h <= 0 and ri = 0")
        assert bad.count() == 0
    whole = tile_grid(sizes, Grid(16, 4)).groupBy("h", "w").agg(F.sum(F.col("keep_h") * F.col("keep_w")).alias("n"))
    assert whole.where("n <> h * w").count() == 0
    gaps = {r["dim"]: r["gap"] for r in axis_gaps(spark.createDataFrame([(d,) for d in raster.DIMS], "dim int"), Grid(2048, 128, False)).collect()}
    assert (gaps[1970], gaps[2000], gaps[2020], gaps[2048], gaps[3900]) == (64, 48, 28, 0, 64)
    assert tile_grid(spark.createDataFrame([(0, 5), (None, 5)], "h int, w int")).count() == 0
    assert Grid(16, 8).overlap == 4 and Grid(16, -3).overlap == 0


@pytest.mark.parametrize("cell", [4, 7, 64])
def test_gate_equals_counting(spark, cell):
    """Missing, repeated and null mask pixels, absent slides, repeated tiles and dots in names."""
    rng = np.random.default_rng(cell)
    size = {"a": (23, 41), "b": (1, 30), "c": (12, 5)}
    mask = [(s, int(y), int(x), [True, False, None][rng.integers(3)]) for s, (h, w) in size.items() if s != "c" for y in range(h) for x in range(w) if rng.random() < 0.6 and not (8 <= y < 16 and x < 20)]
    mask += [*mask[:9], ("a", -1, 3, True), ("a", 3, 500, True), (None, 1, 1, True)]
    images = [(s, 4 * h + 3, 4 * w, h, w, s) for s, (h, w) in size.items()]
    tiles = tile_grid(spark.createDataFrame(images, "slide_id string, h int, w int, th int, tw int, `a.b` string"), Grid(17, 5))
    tiles = tiles.unionByName(tiles.where("ri = 1"))
    got = gate.gate_tiles(tiles, spark.createDataFrame(mask, "slide_id string, y int, x int, tissue boolean"), least=0.3, cell=cell).collect()
    assert len(got) == tiles.count() and got[0]["a.b"] == got[0]["slide_id"]
    for r in got:
        y0, x0 = r["oy0"] * r["th"] // r["h"], r["ox0"] * r["tw"] // r["w"]
        y1, x1 = min(r["th"], (r["oy0"] + r["oh"]) * r["th"] // r["h"] + 1), min(r["tw"], (r["ox0"] + r["ow"]) * r["tw"] // r["w"] + 1)
        under = [t for s, y, x, t in mask if s == r["slide_id"] and y0 <= y < y1 and x0 <= x < x1]
        assert (r["n_px"], r["n_tissue"]) == (len(under), sum(t is True for t in under))
        assert r["tissue"] == (len(under) > 0 and r["n_tissue"] / len(under) >= 0.3)


def test_gate_joins_four_rows_a_tile(spark):
    """A tile as large as the image looks up four corners, three of which lie at its edges and fall out."""
    mask = spark.range(300 * 200).select(F.lit("s").alias("slide_id"), F.expr("cast(id div 200 as int)").alias("y"), F.expr("cast(id % 200 as int)").alias("x"), F.expr("id % 3 = 0").alias("tissue"))
    spans = spark.createDataFrame([(0, "s", 0, 300, 0, 200), (1, "s", 10, 290, 5, 150), (2, "s", 7, 7, 0, 9), (3, "t", 0, 5, 0, 5)], "key int, slide_id string, y0 int, y1 int, x0 int, x1 int")
    got = {r["key"]: (r["n"], r["f"]) for r in areas.rectangle_counts(spans, mask, "tissue").collect()}
    want = sum((y * 200 + x) % 3 == 0 for y in range(10, 290) for x in range(5, 150))
    assert got == {0: (60000, 20000), 1: (280 * 145, want), 3: (0, 0)}
    assert areas.summed_areas(mask, spark.createDataFrame([("s", 300, 200)], "slide_id string, h int, w int"), "tissue").count() == 5 * 4


def test_gate_of_a_tall_image(spark):
    """positions of a tile times the mask's height were once cut to 32 bits, which is an error."""
    h, th = 100_000, 24_000
    tiles = tile_grid(spark.createDataFrame([("s", h, 8, th, 2)], "slide_id string, h int, w int, th int, tw int"), Grid(64, 16))
    mask = spark.createDataFrame([("s", y, x, y >= 50) for y in (0, 1, 50, 23_990, th - 1) for x in (0, 1)], "slide_id string, y int, x int, tissue boolean")
    gated = gate.gate_tiles(tiles, mask, least=0.65, cell=256)
    gated = spark.createDataFrame(gated.collect(), gated.schema)
    got = {r["ri"]: (r["n_px"], r["n_tissue"]) for r in gated.where("n_px > 0").collect()}
    under = {r["ri"]: [y for y in (0, 1, 50, 23_990, th - 1) if r["oy0"] * th // h <= y < min(th, (r["oy0"] + r["oh"]) * th // h + 1)] for r in tiles.collect()}
    assert got == {ri: (2 * len(ys), 2 * sum(y >= 50 for y in ys)) for ri, ys in under.items() if ys}
    kept = sum(bool(ys) and sum(y >= 50 for y in ys) / len(ys) >= 0.65 for ys in under.values())
    assert gated.where("tissue").count() == kept  # as tissue_tiles lists
    assert stats.tile_counters(gated).select("tiles_total", "tiles_kept").first() == (len(under), kept)
    some = len(under) - kept
    picked = sorted(r["ri"] for r in strided_pick(gated.where("not tissue"), 4).collect())
    assert picked == [sorted(ri for ri, ys in under.items() if not ys or sum(y >= 50 for y in ys) / len(ys) < 0.65)[i * (some // 4)] for i in range(4)]


def test_strided_pick_needs_a_number(spark):
    tiles = spark.createDataFrame([("s", 0, i) for i in range(10)], "slide_id string, ri int, ci int")
    assert [r["ci"] for r in strided_pick(tiles, 3).orderBy("ci").collect()] == [0, 3, 6]
    with pytest.raises(ValueError):
        strided_pick(tiles, 0)


@pytest.mark.parametrize("block", [3, 64])
def test_components_against_flood_fill(spark, block):
    rng = np.random.default_rng(3)
    mask = rng.random((20, 17)) < 0.55
    df = spark.createDataFrame([("s", y, x, bool(mask[y, x])) for y in range(20) for x in range(17)], "slide_id string, y int, x int, white boolean")
    found = {(r["y"], r["x"]): (r["part_y"], r["part_x"]) for r in components.label_parts(df, block=block).collect()}
    want, seen = {}, set()
    for start in zip(*np.nonzero(mask)):
        if start in seen:
            continue
        todo, part = [start], []
        seen.add(start)
        while todo:
            y, x = todo.pop()
            part.append((int(y), int(x)))
            for n in ((y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)):
                if 0 <= n[0] < 20 and 0 <= n[1] < 17 and mask[n] and n not in seen:
                    seen.add(n)
                    todo.append(n)
        want |= {p: min(part) for p in part}
    assert found == want
    by_runs = runs.part_runs(df)
    assert {(r["y"], x): (r["part_y"], r["part_x"]) for r in by_runs.collect() for x in range(r["x0"], r["x1"])} == want
    areas_of = {(r["part_y"], r["part_x"]): r["area"] for r in runs.part_areas(by_runs).collect()}
    assert areas_of == {p: list(want.values()).count(p) for p in set(want.values())}


def test_runs_of_large_parts(spark, tmp_path):
    """Large parts have tens of times fewer runs than pixels, long runs cross strips, labels read back equal."""
    wide = spark.range(40 * 900).select(F.lit("s").alias("slide_id"), F.expr("cast(id div 900 as int)").alias("y"), F.expr("cast(id % 900 as int)").alias("x"))
    wide = wide.withColumn("label", F.expr("case when y between 3 and 30 and x between 10 and 700 then 1 when y > 32 and x > 300 then 2 else 0 end"))
    found = runs.row_runs(wide, "label")
    assert found.count() * 30 < wide.count()
    parts = runs.part_runs(wide.withColumn("white", F.col("label") > 0))
    assert sorted((r["part_y"], r["part_x"], r["area"]) for r in runs.part_areas(parts).collect()) == [(3, 10, 28 * 691), (33, 301, 7 * 599)]
    assert runs.touching_runs(found.where("label = 1")).count() == 27
    runs.write_runs(wide.unionByName(wide.where("y = 5")), str(tmp_path / "runs"))
    back = runs.read_runs(spark, str(tmp_path / "runs"))
    assert back.exceptAll(wide).count() == 0 and wide.exceptAll(back).count() == 0
    odd = spark.createDataFrame([("s", 0, 0, None), ("s", 0, 1, None), ("s", 0, 2, 1), ("s", 0, 2, 2)], "slide_id string, y int, x int, label int")
    assert sorted(tuple(r)[2:] for r in runs.row_runs(odd, "label").collect()) == [(0, 2, None), (2, 3, 1), (2, 3, 2)]
    assert runs.part_runs(odd.withColumn("white", F.lit(False))).count() == 0


def test_large_parts_keep_exactly_128(spark):
    wide = [("s", 0, x) for x in range(127)] + [("s", 2, x) for x in range(128)]
    df = spark.createDataFrame([(*p, True) for p in wide], "slide_id string, y int, x int, white boolean")
    assert {r["y"] for r in components.large_parts(df).collect()} == {2}
    assert components.large_parts(df.where("y > 5")).count() == 0


def test_background_of_plain_images(spark):
    white, black = np.full((12, 12, 3), 255), np.zeros((12, 12, 3), int)
    both = image(spark, white, "white").unionByName(image(spark, black, "black"))
    found = {r["slide_id"]: r["n"] for r in detect_background(both).groupBy("slide_id").agg(F.count_if("background").alias("n")).collect()}
    assert found == {"white": 144, "black": 0}
    one = detect_background(image(spark, white[:1, :1]), least_area=1).collect()
    assert len(one) == 1 and one[0]["background"]


@pytest.mark.parametrize("block", [4, 256])
def test_entropy_against_numpy(spark, block):
    level = np.random.default_rng(5).integers(0, 16, (11, 9))
    df = image(spark, np.repeat(level[..., None], 3, 2))
    got = array(neighbourhood.local_entropy(df, F.col("r"), block=block), "entropy", level.shape)
    wide = np.pad(level, 4, mode="edge")
    for y, x in np.ndindex(*level.shape):
        p = np.bincount(wide[y : y + 9, x : x + 9].ravel(), minlength=16) / 81
        assert got[y, x] == pytest.approx(-(p[p > 0] * np.log2(p[p > 0])).sum(), abs=1e-9)


def test_percentiles_against_numpy(spark):
    rng = np.random.default_rng(1)
    v = [float(x) for x in rng.integers(0, 30, 101)]
    df = spark.createDataFrame([("s", x) for x in v] + [("s", None), ("s", float("nan")), ("t", None)], "slide_id string, v double")
    got = {r["slide_id"]: r["v_p"] for r in stats.percentiles(df, ["v"], (0.01, 0.5, 0.99)).collect()}
    assert got == {"s": pytest.approx(np.percentile(v, [1, 50, 99]).tolist())}


def test_background_intensity_tiers(spark):
    grey = [("a", 210, 210, 210, True)] * 100 + [("a", 255, 255, 255, True)] * 50
    pure = [("b", 255, 255, 255, True)] * 100
    few = [("c", 220, 220, 220, True)] * 99 + [("c", 0, 0, 0, None)]
    df = spark.createDataFrame(grey + pure + few, "slide_id string, r int, g int, b int, background boolean")
    assert {r["slide_id"]: r["io"] for r in stats.background_intensity(df).collect()} == {"a": 210.0, "b": 255.0, "c": 240.0}


def test_stain_vectors_are_found(spark):
    """Pixels mixed of two known dyes give these dyes back."""
    dyes = np.array([stain.HEMATOXYLIN, stain.EOSIN]).T
    dyes = dyes / np.linalg.norm(dyes, axis=0)
    rng = np.random.default_rng(2)
    amounts = rng.dirichlet([0.15, 0.15], 1500) * rng.uniform(0.6, 1.0, (1500, 1))
    rgb = np.clip(np.rint(240 * 10 ** -(amounts @ dyes.T)), 1, 255).astype(int)
    df = image(spark, rgb.reshape(30, 50, 3)).withColumn("io", F.lit(240.0))
    got = stain.stain_vectors(stain.with_density(df), F.lit(True), least_density=0.02).first()
    found = np.array(got["stains"])
    assert (got["h_idx"], got["e_idx"]) == (0, 1)
    assert np.abs(found[:, :2] - dyes).max() < 0.08
    assert np.allclose(np.array(got["inverse"]) @ found, np.eye(3), atol=1e-6)


def test_deconvolution_against_numpy(spark):
    """Concentrations solve a pixel's densities for the stains; the third channel is as asked."""
    stains = np.array([[0.65, 0.07, 0.3], [0.70, 0.99, 0.1], [0.29, 0.11, 0.9]])
    inverse = np.linalg.inv(stains)
    rgb = np.random.default_rng(6).integers(0, 256, (5, 7, 3))
    params = spark.createDataFrame([("a", 240.0, inverse.tolist(), 1, 0)], "slide_id string, io double, inverse array<array<double>>, e_idx int, h_idx int")
    pixels = image(spark, rgb)
    params = params.withColumn("slide_id", F.lit(pixels.first()["slide_id"]))
    density = -np.log10(np.clip(rgb, 1, 240) / 240.0)
    want = np.einsum("ij,yxj->yxi", inverse, density)
    for options, third in (({}, None), ({"residual": True}, "residual"), ({"gray": True}, "gray")):
        got = stain.deconvolve(pixels, params, **options)
        assert got.columns == ["slide_id", "y", "x", "haematoxylin", "eosin"] + ([third] if third else [])
        for r in got.collect():
            assert np.allclose([r["haematoxylin"], r["eosin"]], want[r["y"], r["x"], :2])
            if third == "residual":
                assert np.isclose(r["residual"], want[r["y"], r["x"], 2])
            if third == "gray":
                assert abs(r["gray"] - rgb[r["y"], r["x"]] @ [0.299, 0.587, 0.114]) < 1


def test_stain_params_without_tissue(spark):
    params = stain.stain_params(image(spark, np.full((4, 4, 3), 255)).withColumn("background", F.lit(True))).first()
    assert (params["io"], params["e_lo"], params["e_hi"]) == (240.0, 0.0, 1.0)


def test_labels_and_priority(spark):
    df = spark.createDataFrame([(2.0, 2.0, -1.0), (-1.0, 2.0, 1.0), (2.0, 1.0, 3.0), (0.0, 0.0, -9.0), (None, None, None)], "a double, b double, c double")
    assert [r[0] for r in df.select(pixel.label(F.col("a"), F.col("b"), F.col("c"))).collect()] == [1, 2, 0, 0, 0]


def test_resampling_keeps_a_constant(spark):
    df = image(spark, np.full((9, 7, 3), 80))
    size = lambda n, m: spark.createDataFrame([("s", n, m)], "slide_id string, n_in int, n_out int")
    for taps in (neighbourhood.linear_taps, neighbourhood.lanczos_taps):
        out = neighbourhood.resample(df, ["r"], taps(size(9, 4), "n_in", "n_out"), taps(size(7, 15), "n_in", "n_out"))
        assert out.count() == 60 and {r[0] for r in out.select(neighbourhood.to_u8(F.col("r"))).distinct().collect()} == {80}


def test_linear_taps_of_a_long_axis(spark):
    """a place times the axis' length was once cut to 32 bits, which is an error."""
    n_in, n_out = 102_564, 43_956
    taps = neighbourhood.linear_taps(spark.createDataFrame([("s", n_in, n_out)], "slide_id string, n_in int, n_out int"), "n_in", "n_out")
    got = taps.groupBy("out").agg(F.sum("weight").alias("w"), F.sum(F.col("src") * F.col("weight")).alias("at")).orderBy("out").collect()
    assert np.allclose([r["w"] for r in got], 1) and np.allclose([r["at"] for r in got], np.linspace(0, n_in - 1, n_out))


def test_padding_against_numpy(spark):
    values = np.random.default_rng(4).integers(0, 99, (10, 7))
    out = neighbourhood.reflect_pad(image(spark, np.repeat(values[..., None], 3, 2)), ["r"], F.lit(10), F.lit(7), 8)
    want = np.pad(values, [(3, 3), (0, 1)], mode="reflect")
    assert (array(out.withColumn("y", F.col("y") + 3), "r", want.shape) == want).all()


@pytest.mark.parametrize("shape", [(1, 2), (2, 3), (5, 64), (65, 7)])
def test_padding_of_short_and_long_axes_against_numpy(spark, shape):
    """Also axes mirrored to and fro several times, with each place once."""
    values = np.arange(shape[0] * shape[1]).reshape(shape)
    out = neighbourhood.reflect_pad(image(spark, np.repeat(values[..., None], 3, 2)), ["r"], F.lit(shape[0]), F.lit(shape[1]), 64)
    pads = [((-n % 64) // 2, -n % 64 - (-n % 64) // 2) for n in shape]
    want = np.pad(values, pads, mode="reflect")
    assert out.count() == want.size and dict(out.dtypes)["y"] == "int"
    assert (array(out.withColumn("y", F.col("y") + pads[0][0]).withColumn("x", F.col("x") + pads[1][0]), "r", want.shape) == want).all()


def test_padding_takes_no_work_for_the_length_of_an_axis(spark):
    """an array as long as the axis was once made for each pixel."""
    n = 900_000_001  # 31 pixels are added before it and 32 behind it
    rows = spark.createDataFrame([("s", y, x, 5) for y in (0, 1, 40, n - 1, n - 3) for x in (0, 1)], "slide_id string, y int, x int, r int").withColumns({"h": F.lit(n), "w": F.col("x") * 0 + 64})
    got = {(r["y"], r["x"]) for r in neighbourhood.reflect_pad(rows, ["r"], F.col("h"), F.col("w")).collect()}
    assert got == {(y, x) for y in (0, 1, -1, 40, n - 1, n - 3, n + 1) for x in (0, 1)}


@pytest.mark.parametrize("roi, overlap", [(8, 0.25), (5, 0.8), (4, 0.0), (1, 0.5), (6, -0.5)])
def test_windows_over_each_pixel_are_those_of_the_axis(spark, roi, overlap):
    """Also beside the image, of unknown place and in images of unknown size."""
    sizes = [1, 2, roi, roi + 1, 3 * roi + 2, 40, None]
    rows = spark.createDataFrame([(n, y, 0, 1) for n in sizes for y in (None, *range(-2, (n or 3) + roi))], "h int, y int, x int, w int")
    starts = {r["h"]: r["s"] or [] for r in rows.select("h", neighbourhood.window_starts(F.col("h"), roi, overlap).alias("s")).distinct().collect()}
    got = sorted((r["h"], r["y"], r["wy"], r["wx"]) for r in neighbourhood.windows_of(rows, F.col("h"), F.col("w"), roi, overlap).collect())
    assert got == sorted((r["h"], r["y"], s, 0) for r in rows.collect() if r["y"] is not None for s in starts[r["h"]] if s <= r["y"] < s + roi)


def test_windows_take_no_work_for_the_length_of_an_axis(spark):
    """an array of all windows of the axis was once made for each pixel."""
    n = 1_900_000_001
    rows = spark.createDataFrame([(y, 0, n, 4) for y in (0, 9, n - 9, n - 1)], "y int, x int, h int, w int")
    got = sorted((r["y"], r["wy"]) for r in neighbourhood.windows_of(rows, F.col("h"), F.col("w"), 4, 0.25).collect())
    assert got == [(0, 0), (9, 6), (9, 9), (n - 9, n - 11), (n - 1, n - 4)]


def test_scored_windows_blend_to_the_scorer(spark):
    """A scorer that looks at single pixels gives the same whatever the windows."""
    df = image(spark, np.random.default_rng(6).integers(0, 255, (40, 33, 3))).withColumns({"h": F.lit(40), "w": F.lit(33)})
    out = scoring.score_windows(df, ["r", "g", "b"], lambda im: im * 2.0, roi=16, overlap=0.25)
    both = out.join(df, ["slide_id", "y", "x"])
    assert both.count() == 40 * 33
    assert both.where("abs(z_epi - 2 * r) > 1e-4 or abs(z_bg - 2 * b) > 1e-4").count() == 0


def test_segment_resizes_and_masks(spark):
    out = segment(sources.synthetic_raster(spark, 48, 48), scoring.placeholder_scorer, roi=32, output_size=(24, 30))
    assert out.count() == 720 and {r[0] for r in out.select("label").distinct().collect()} <= {0, 1, 2}


def test_images_and_tile_store(spark, tmp_path):
    values = np.random.default_rng(7).integers(0, 255, (20, 30, 3)).astype(np.uint8)
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.ppm").write_bytes(b"P6\n# made here\n30 20\n255\n" + values.tobytes())
    px = sources.read_images(spark, str(tmp_path / "in/*.ppm"))
    assert (array(px, "g", (20, 30)) == values[..., 1]).all()
    sources.write_tiles(px, str(tmp_path / "tiles"), tile=8)
    part = sources.read_region(spark, str(tmp_path / "tiles"), "a.ppm", 0, 5, 25, 10, 20)
    got = array(part.withColumns({"y": F.col("y") - 5, "x": F.col("x") - 10}), "b", (20, 10))
    assert (got[:15] == values[5:, 10:20, 2]).all() and (got[15:] == 255).all()
    levels = spark.createDataFrame([("a.ppm", 0, 30, 20)], "slide_id string, level_idx int, size_x int, size_y int")
    assert sources.read_thumbnail(spark, str(tmp_path / "tiles"), levels, "a.ppm").count() == 600
    with pytest.raises(ValueError):
        sources.read_thumbnail(spark, str(tmp_path / "tiles"), levels, "b")
    sources.write_labels(sources.all_background(px), str(tmp_path / "labels"))
    assert spark.read.parquet(str(tmp_path / "labels")).where("label = 0").count() == 600


def test_parsing(spark):
    one = spark.range(1)
    got = one.select(
        parsing.meter_line(F.lit("7, 1.5 , 3\nx")).alias("a"), parsing.meter_line(F.lit("7, x, 3")).alias("b"), parsing.memory_mib(F.lit("8 GB")).alias("c"),
        parsing.memory_mib(F.lit("1536 MB")).alias("d"), parsing.memory_mib(F.lit("none")).alias("e"), parsing.address(F.lit("wss://u:p@h.example:8443/a/b?q")).alias("f"),
        parsing.address(F.lit("host")).alias("g"), parsing.physical_size(F.lit("-1"), F.lit("0.5")).alias("h"), parsing.safe_double(F.lit("x"), 2.0).alias("i"),
    ).first()
    assert tuple(got["a"]) == (7.0, 1.5, 3.0) and tuple(got["b"]) == (None, None, None)
    assert (got["c"], got["d"], got["e"], got["h"], got["i"]) == (8192, 1536, None, 0.5, 2.0)
    assert tuple(got["f"]) == ("wss", "h.example", 8443, "/a/b") and tuple(got["g"]) == ("", "host", 80, "/")
    with pytest.raises(PySparkException):
        one.select(parsing.lookup(F.lit("v9"), {"v1": "a"}, "v1")).collect()


def test_bands(spark):
    df = spark.createDataFrame([([1],), ([1, 2],), ([1, 2, 3, 4],), (None,)], "b array<int>")
    assert [r[0] for r in df.select(pixel.as_rgb(F.col("b"))).collect()] == [[1, 1, 1], None, [1, 2, 3], None]


def test_patches_per_call():
    assert scoring.patches_per_call(512, "cuda") == 32 and scoring.patches_per_call(2048) == 1 and scoring.patches_per_call(1) == 1024
