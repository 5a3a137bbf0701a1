"""Rank selection and closed-form eigenvectors against numpy."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions.symmetric import eigenvalues, main_axes
from rasterloom.operators import ranks, stats


def test_rates_of_one_long_series(spark):
    """A series lies in many parts, and each part's first sample compares with the part before."""
    rng = np.random.default_rng(7)
    rows = [(g, int(k), float(rng.integers(0, 400)), float(rng.integers(0, 50))) for g, n in (("long", 3000), ("short", 3), ("one", 1), (None, 40)) for k in range(n)]
    df = spark.createDataFrame([*rows, ("short", 9, None, 1.0)], "g string, k int, t double, v double").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = stats.lag_rate(df, "t", "v", ["g"], ["k"], scale=10.0, start=(-1.0, 5.0))
        got = {(r["g"], r["k"]): r["rate"] for r in found.collect()}
        spread = found.groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {("short", 9): None}
    for g in {r[0] for r in rows}:
        last = (-1.0, 1.0 if g == "short" else 5.0)  # what follows a sample without a time compares with the start
        for _, k, t, v in sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[1])):
            want[g, k] = 10.0 * (v - last[1]) / (t - last[0]) if t > last[0] else 0.0
            last = (t, v)
    assert got == pytest.approx(want) and spread > 1

ODD = [0.0, 5e-324, -5e-324, 2.0**-1022, -(2.0**-1022), 2.2250738585072009e-308, 1.0, -1.0, 1.9999999999999998, 2.0, 2.0000000000000004, 1e308, -1e308, 1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 1e-300]


def test_ordered_bits_are_the_bits(spark):
    rng = np.random.default_rng(3)
    near = [float(np.nextafter(2.0**k, s)) for k in range(-60, 60) for s in (0, np.inf)] + [2.0**k for k in range(-1074, 1024, 7)]
    wild = [x for x in (struct.unpack("<d", rng.bytes(8))[0] for _ in range(5000)) if x == x]
    values = ODD + near + wild
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", ranks.ordered_bits(F.col("v")).alias("k")).collect()
    for r in got:
        bits = struct.unpack("<q", struct.pack("<d", abs(r["v"])))[0]
        assert r["k"] == (-bits if r["v"] < 0 else bits), r["v"]


@pytest.mark.parametrize("limit", [1, 40, 1 << 16])
def test_percentiles_of_any_bucket_size(spark, monkeypatch, limit):
    """Narrowing by histograms finds the same ranks as sorting, also where values share most bits."""
    monkeypatch.setattr(ranks.quantiles, "__defaults__", (limit,))
    rng = np.random.default_rng(4)
    sets = {
        "wide": rng.standard_normal(900) * 10.0 ** rng.integers(-200, 200, 900), "close": 1.0 + rng.integers(0, 300, 700) * 2.0**-52, "same": np.full(50, -3.5),
        "two": np.array([1.0, 2.0]), "one": np.array([7.0]), "whole": rng.integers(-9, 9, 500).astype(float),
    }
    rows = [(k, float(x)) for k, v in sets.items() for x in v] + [("none", None), ("none", float("nan")), ("same", None)]
    ps = (0.0, 0.01, 0.37, 0.5, 0.99, 1.0)
    got = {r["slide_id"]: r["v_p"] for r in stats.percentiles(spark.createDataFrame(rows, "slide_id string, v double"), ["v"], ps).collect()}
    assert set(got) == set(sets)
    for k, v in sets.items():
        assert got[k] == pytest.approx(np.percentile(v, [100 * p for p in ps]).tolist(), rel=1e-12)


def test_one_large_slide_is_dealt_evenly(spark):
    """Of one slide of distinct values no task sorts more than the stated number, and ranks are exact."""
    n = 300_000
    rows = spark.range(n).select(F.lit("a").alias("slide_id"), ((F.col("id") * 7919) % n / F.lit(3.0)).alias("v"))
    got = stats.percentiles(rows, ["v"], (0.01, 0.5, 0.99)).first()["v_p"]
    assert got == pytest.approx([p * (n - 1) / 3 for p in (0.01, 0.5, 0.99)], rel=1e-12)


def test_main_axes_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(200):
        a = rng.standard_normal((3, 3)) * 10.0 ** rng.integers(-4, 4)
        rows.append(a @ a.T)
    upper = [(i, [float(m[r, c]) for r, c in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))]) for i, m in enumerate(rows)]
    got = spark.createDataFrame(upper, "i int, m array<double>").select("i", eigenvalues(F.col("m")).alias("e"), main_axes(F.col("m")).alias("x")).collect()
    for r in got:
        values, axes = np.linalg.eigh(rows[r["i"]])
        assert np.allclose(r["e"], values[::-1], rtol=1e-9, atol=1e-9 * values[2])
        for mine, want in ((r["x"]["first"], axes[:, 2]), (r["x"]["second"], axes[:, 1])):
            assert np.allclose(mine, want * (1 if want.sum() >= 0 else -1), atol=1e-5)


def test_axes_of_degenerate_matrices(spark):
    """Equal eigenvalues, the identity, zero and nulls have a defined result: unit vectors at right angles, in the right space."""
    u = np.array([1.0, 2.0, -2.0]) / 3
    flat, line = np.eye(3) - np.outer(u, u), np.outer(u, u)
    made = {"flat": flat, "line": line, "identity": np.eye(3), "zero": np.zeros((3, 3)), "diagonal": np.diag([1.0, 5.0, 3.0])}
    rows = [(k, [float(m[r, c]) for r, c in ((0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2))]) for k, m in made.items()]
    rows += [("null", [1.0, None, 0.0, 1.0, 0.0, 1.0]), ("nan", [1.0, float("nan"), 0.0, 1.0, 0.0, 1.0])]
    got = {r["k"]: r["x"] for r in spark.createDataFrame(rows, "k string, m array<double>").select("k", main_axes(F.col("m")).alias("x")).collect()}
    assert got["null"] is None and got["nan"] is None
    for k, m in made.items():
        first, second = np.array(got[k]["first"]), np.array(got[k]["second"])
        assert np.allclose([first @ first, second @ second, first @ second], [1, 1, 0], atol=1e-9)
        values = np.linalg.eigvalsh(m)
        assert np.allclose(m @ first, values[2] * first, atol=1e-9) and np.allclose(m @ second, values[1] * second, atol=1e-9)
    assert np.allclose(got["diagonal"]["first"], [0, 1, 0]) and np.allclose(got["diagonal"]["second"], [0, 0, 1])
