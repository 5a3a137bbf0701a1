"""Masks by rows of blocks against the pixel-wise operators."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.operators import blocks
from rasterloom.operators.background import detect_background
from rasterloom.plans import queries as raster
from rasterloom.sources.raster import synthetic_raster

from .conftest import rows
from .test_raster import image


@pytest.mark.parametrize("cell", [16, 64, 256])
def test_blocks_find_what_pixels_find(spark, cell):
    discs = synthetic_raster(spark, 96, 120)
    other = discs.select(F.lit("plain").alias("slide_id"), "y", "x", F.lit(252).alias("r"), F.lit(251).alias("g"), F.col("b"))
    px = discs.unionByName(other)
    found = blocks.block_pixels(blocks.background_blocks(px, cell=cell), cell=cell)
    want = detect_background(px).select("slide_id", "y", "x", "background")
    assert rows(found) == rows(want)
    assert found.where("background").count() > 1000 and found.where("not background").count() > 1000


def test_noise_by_small_blocks(spark):
    rng = np.random.default_rng(4)
    values = rng.choice([240, 255, 90], (37, 53), p=[0.4, 0.35, 0.25])[..., None].repeat(3, -1)
    px = image(spark, values)
    found = blocks.block_pixels(blocks.background_blocks(px, least_area=9, cell=8, window=5), cell=8)
    want = detect_background(px, least_area=9, window=5).select("slide_id", "y", "x", "background")
    assert rows(found) == rows(want)
    assert 0 < found.where("background").count() < 37 * 53


def test_a_part_winds_through_many_blocks(spark):
    flags = np.zeros((40, 40), bool)
    flags[::4] = True
    for k, y in enumerate(range(0, 36, 4)):
        flags[y : y + 4, 39 if k % 2 == 0 else 0] = True
    flags[2, 5:8] = True  # and a small one
    grid = np.zeros((40, 40), bool)
    table = [("s", cy, cx, blocks._bits(flags[cy * 8 : cy * 8 + 8, cx * 8 : cx * 8 + 8])) for cy in range(5) for cx in range(5)]
    df = spark.createDataFrame(table, "slide_id string, cy int, cx int, white binary")
    for r in blocks.large_block_parts(df, least=100, cell=8).collect():
        grid[r["cy"] * 8 : r["cy"] * 8 + 8, r["cx"] * 8 : r["cx"] * 8 + 8] = blocks._flags(r["kept"], 8)
    flags[2, 5:8] = False
    assert (grid == flags).all()


def test_odd_pixels(spark):
    schema = "slide_id string, y int, x int, r int, g int, b int, extra.name string"
    schema = schema.replace("extra.name", "`extra.name`")
    odd = [("s", 0, 0, 255, 255, 255, "a"), ("s", 0, 0, 255, 255, 255, "b"), ("s", 0, 1, 10, 10, 10, None), ("s", 0, 1, 255, 255, 255, None), ("s", 1, 1, None, None, None, None),
           (None, 0, 0, 255, 255, 255, None), ("s", None, 0, 255, 255, 255, None), ("s", -1, 0, 255, 255, 255, None)]
    found = blocks.block_pixels(blocks.background_blocks(spark.createDataFrame(odd, schema), least_area=2, cell=4, window=1), cell=4)
    assert {(r["y"], r["x"]): r["background"] for r in found.collect()} == {(0, 0): True, (0, 1): True, (1, 1): False}
    empty = blocks.background_blocks(spark.createDataFrame([], schema))
    assert blocks.block_pixels(empty).collect() == []
    with pytest.raises(ValueError):
        blocks.background_blocks(empty, cell=512)


def test_strips_are_a_small_part(spark):
    px = synthetic_raster(spark, 96, 120).select("slide_id", F.expr("cast(y div 24 as int)").alias("cy"), F.expr("cast(x div 24 as int)").alias("cx"), F.expr("(y % 24) * 24 + x % 24").cast("int").alias("at"), F.lit(7).alias("code"))
    packed = blocks._packed(px.repartition(3), "slide_id", "string")
    assert packed.agg(F.sum(F.length("at") + F.length("code"))).first()[0] == 3 * 96 * 120
    sent = blocks.with_halo(packed, 24, 4).groupBy((F.abs("dy") + F.abs("dx") > 0).alias("border")).agg(F.sum(F.length("strip")).alias("n"))
    sent = {r["border"]: r["n"] for r in sent.collect()}
    assert sent[False] == 96 * 120 and sent[True] < 0.8 * 96 * 120  # four of 24 rows or columns to a side


def test_query_against_sql(same):
    same(raster.queries()["background_blocks"], raster.oracle_sql()["background_blocks"])
