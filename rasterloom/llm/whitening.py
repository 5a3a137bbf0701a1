"""Whitening of vectors in two passes: exact integer sums, then centred outer products."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir
from .common import gives_back

SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues below this share of the largest count as no variance.
_FLAT = 1e-12
_ROWS = 4096


class Whitening(NamedTuple):
    """``n`` vectors of the fit list, their sums, and a column of ``axes`` a component."""

    n: int
    sums: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def scaled(self) -> np.ndarray:
        """Axes over the standard deviation; not a number for a component without variance."""
        top = self.variances.max(initial=0.0)
        return self.axes / np.sqrt(np.where(self.variances > _FLAT * top, self.variances, np.nan))


def usable(vector: Column) -> Column:
    """Not null, not empty, and without components that are null or not finite."""
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector.cast("array<double>"), odd), F.lit(False))


def whole_numbers(vector: Column) -> Column:
    """Each component as a whole number: 64 times it, rounded down, and a million more."""
    return F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")) + F.lit(SHIFT))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - sums`` in whole numbers: n times the distance from the mean, without rounding."""
    return x * n - sums


def _products(fit: DataFrame, of, size: int) -> np.ndarray:
    """The sum over the fit list of outer products of ``of(x)``: one matrix a task, merged as a tree."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                rows = of(_matrix(batch.slice(at, _ROWS), "x"))
                total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    parts = fit.select("x").mapInArrow(run, "m binary").rdd.map(lambda r: np.frombuffer(r[0]).reshape(size, size))
    return parts.treeAggregate(np.zeros((size, size)), lambda a, b: a + b, lambda a, b: a + b)


def fit_list(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """``x``: every distinct vector of whole numbers once, written.

    Copies of a vector meet on the map side first, so a vector of which there are very many is one
    row a task. Vectors of another length than the most common (the longest of ties) are left out.
    """
    x = vectors.where(usable(F.col(f"`{vector_col}`"))).select(whole_numbers(F.col(f"`{vector_col}`")).alias("x"))
    every = materialise(x.distinct(), shared_dir(vectors.sparkSession), "fit")
    size = _length(every)
    return every.where(F.size("x") == size)


def _length(every: DataFrame) -> int:
    lengths = every.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return top["d"] if top else 0


def fit(distinct: DataFrame, components: int = 16) -> Whitening | None:
    """The first ``components`` axes of the list's covariance by falling variance; None without vectors.

    The first pass adds whole numbers, so sums are exact in any order; the second adds products of
    rows centred in whole numbers. What reaches the driver is a row of sums and a matrix of the
    vectors' length squared, whatever the number of rows. The sign of an axis is fixed by its
    largest entry, so it doesn't change from run to run.
    """
    first = distinct.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first["d"]
    total = distinct.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(d)]).first()
    n, sums = total["n"], np.array([int(total[f"s{i}"]) for i in range(d)], np.int64)
    scatter = _products(distinct, lambda x: centred(x, n, sums) / n, d) / n
    values, axes = np.linalg.eigh((scatter + scatter.T) / 2)
    axes, values = axes[:, ::-1][:, :components], np.maximum(values[::-1][:components], 0.0)
    axes = axes * np.where(axes[np.abs(axes).argmax(0), range(axes.shape[1])] < 0, -1.0, 1.0)
    return Whitening(n, sums, axes, values, float(np.trace(scatter)))


def identity_error(distinct: DataFrame, found: Whitening) -> float:
    """How far the covariance of the whitened list is from the identity, in its largest entry.

    Components without variance don't count; without any other the error is 0.
    """
    live = np.isfinite(found.scaled).all(0)
    if not live.any():
        return 0.0
    n, sums, scaled = found.n, found.sums, np.ascontiguousarray(found.scaled[:, live])
    product = _products(distinct, lambda x: (centred(x, n, sums) / n) @ scaled, scaled.shape[1]) / n
    return float(np.abs(product - np.eye(len(product))).max())


def _deviations(apart: np.ndarray) -> list[int | None]:
    """Sums of squares of whole numbers; null where one needs more than 63 bits."""
    if not apart.size or int(np.abs(apart).max()) ** 2 * apart.shape[1] < 1 << 63:
        return (apart * apart).sum(1).tolist()
    sums = [sum(int(v) ** 2 for v in row) for row in apart]
    return [s if s < 1 << 63 else None for s in sums]


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``, a row a vector and component.

    Rows whose vector is null, empty, or has components that are null or not finite are left out,
    and those of another length than most. Repeated rows and identifiers, and null
    ones, each give their rows, but a vector counts once in the fit. Components without variance
    have a null ``whitened``, and share 0. An empty table gives an empty one. Components of equal
    variance come in the order of the solver. Other columns of any name don't matter.
    """
    spark = vectors.sparkSession
    kind = vectors.select(F.col(f"`{id_col}`").alias("id")).schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    distinct = fit_list(vectors, vector_col)
    found = fit(distinct, components)
    if found is None:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    shared = spark.sparkContext.broadcast((found, identity_error(distinct, found)))  # a matrix of length x components
    d = len(found.sums)

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, error = shared.value
        k = model.axes.shape[1]
        share = model.variances / model.trace if model.trace > 0 else np.zeros(k)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                apart = centred(_matrix(some, "x"), model.n, model.sums)
                white = (apart / model.n) @ model.scaled
                m = len(apart)
                yield pa.RecordBatch.from_arrays([
                    some.column(0).take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n)), pa.array(_deviations(apart), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(white.reshape(-1), from_pandas=True), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error)),
                ], ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    vector = F.col(f"`{vector_col}`")
    rows = vectors.where(usable(vector) & (F.size(vector) == d)).select(F.col(f"`{id_col}`").alias("id"), whole_numbers(vector).alias("x"))
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
