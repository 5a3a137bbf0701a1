"""Labels of arriving tiles: stopped, broken off and started again, and against SQL."""

from __future__ import annotations

import os
import shutil
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from rasterloom.operators import scoring, stats
from rasterloom.operators.grid import Grid, tile_grid
from rasterloom.plans import queries as raster
from rasterloom.sources.raster import synthetic_raster
from rasterloom.streaming import arrivals

from .conftest import SF_DIR, rows


def test_query_against_sql(same):
    same(raster.queries()["arriving_labels"], raster.oracle_sql()["arriving_labels"])


def test_restart_scores_nothing_twice(spark, tmp_path, monkeypatch):
    tiles = raster._packed_tiles(spark, SF_DIR).where("oy0 < 60")
    made, source, output = tmp_path / "made", tmp_path / "in", str(tmp_path / "out")
    tiles.repartition(4, "oy0", "ox0").write.parquet(str(made))
    files = sorted(made.glob("part-*"))
    source.mkdir()
    stored = spark.read.parquet(str(made))

    def arrive(names: list[Path], again: str = "") -> None:
        for f in names:
            shutil.copy(f, source / (again + f.name))

    def run() -> None:
        arrivals.label_arrivals(spark, str(source), output, str(tmp_path / "progress"), raster.threshold_scorer, files_per_batch=1).awaitTermination()

    arrive(files[:1])
    run()
    first = {p: os.stat(p).st_mtime_ns for p in Path(output).rglob("batch=0/*.parquet")}
    assert first

    def broken(*_):
        raise RuntimeError("lost before the mark")

    arrive(files[1:3])
    with monkeypatch.context() as patch:
        patch.setattr(arrivals, "_mark", broken)
        with pytest.raises(StreamingQueryException):
            run()
    half = arrivals.read_arrivals(spark, output)
    assert rows(half) == rows(arrivals.label_tiles(spark.read.parquet(str(files[0])), raster.threshold_scorer))  # labels without mark don't count
    arrive(files[3:])
    arrive(files[:2], "again-")
    run()
    assert first == {p: os.stat(p).st_mtime_ns for p in Path(output).rglob("batch=0/*.parquet")}
    assert rows(arrivals.read_arrivals(spark, output)) == rows(arrivals.label_tiles(stored, raster.threshold_scorer))
    done = arrivals.committed(spark, output)
    assert done.count() == done.select(*arrivals.KEY).distinct().count() == stored.count()


def test_tiles_by_rows_as_by_pixels(spark):
    """What a task does with a packed tile is what the operators on pixel rows do."""
    px = synthetic_raster(spark, 96, 120).toDF("slide_id", "y", "x", *arrivals.CHANNELS)
    tiles = tile_grid(px.select("slide_id").distinct().withColumns({"h": F.lit(96), "w": F.lit(120)}), Grid(48, 8)).drop("h", "w")
    inside = scoring.tiles_of(px, tiles, 48, 40).withColumn("tile", F.concat_ws("/", "ri", "ci")).cache()
    found = arrivals.label_tiles(arrivals.pack_tiles(inside), scoring.placeholder_scorer, roi=20, overlap=0.25)
    local = inside.select("tile", (F.col("y") - F.col("oy0")).alias("y"), (F.col("x") - F.col("ox0")).alias("x"), *arrivals.CHANNELS, "oh", "ow")
    ready = stats.with_slide(stats.normalise(local.drop("oh", "ow"), arrivals.CHANNELS, "tile"), local.select("tile", "oh", "ow").distinct(), "tile")
    logits = scoring.score_windows(ready, arrivals.CHANNELS, scoring.placeholder_scorer, 20, 0.25, height="oh", width="ow", by="tile")
    placed = scoring.labels(logits, by="tile").join(tiles.withColumn("tile", F.concat_ws("/", "ri", "ci")), "tile")
    want = scoring.keep_part(placed.withColumns({"y": F.col("y") + F.col("oy0"), "x": F.col("x") + F.col("ox0")})).select("slide_id", "y", "x", "label")
    assert rows(found) == rows(want)
    assert found.select("label").distinct().count() > 1
    assert "Exchange" not in arrivals.label_tiles(spark.createDataFrame([], arrivals.TILES), scoring.placeholder_scorer)._jdf.queryExecution().executedPlan().toString()


def test_odd_tiles(spark):
    assert arrivals.label_tiles(spark.createDataFrame([], arrivals.TILES), raster.threshold_scorer).collect() == []
    one = (7, 9, 2, 2, 0, 0, 2, 1)
    full = [bytes([0, 255, 0, 9])] * 3
    table = [("s", *one, *full), (None, *one, *full), ("t", *one, None, *full[1:]), ("u", *one, *[bytes(4)] * 3)]
    found = arrivals.label_tiles(spark.createDataFrame(table, arrivals.TILES), raster.threshold_scorer)
    assert {(r["slide_id"], r["y"], r["x"]) for r in found.collect()} == {(s, y, 9) for s in "su" for y in (7, 8)}
    assert found.where(F.col("slide_id") == "u").agg(F.max("label")).first()[0] == 0
