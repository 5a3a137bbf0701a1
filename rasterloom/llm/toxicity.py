"""Toxicity scores by a factorization machine over hashed terms.

score = sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j>) over a text's distinct terms: the pairwise
part learns combinations (an insult together with a mention of a group) that a linear model adds
up term by term. The model is fitted on a bounded sample of labelled rows; every text is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import materialise, shared_dir
from .common import _ALPHABET, _SPACE, Words, as_strings, by_bytes, gives_back

BITS = 18
HEADS = (4, 5)  # besides whole words, their first so many bytes are terms: stems of inflected words
_BREAKS = _SPACE.copy()
_BREAKS[[b for b in range(128) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123 or b == 39)]] = True


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """The rows that never train: crc32 of the identifier as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _terms(strings: pa.Array, active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the distinct hashed terms of each text; ``active``: only these buckets."""
    words = Words(strings, _ALPHABET, _BREAKS)
    row = np.repeat(np.arange(words.n), np.diff(words.first))
    found = [(row, words.hash)] + [(row[i], h) for i, h in map(words.heads, HEADS)]
    row = np.concatenate([r for r, _ in found])
    bucket = (np.concatenate([h for _, h in found]) >> np.uint64(64 - BITS)).astype(np.int64)
    if active is not None:
        hit = active[bucket]
        bucket, row = bucket[hit], row[hit]
    key = np.unique((row << BITS) | bucket)
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class FactorizationMachine:
    bias: float
    terms: np.ndarray  # (m,) sorted buckets of the terms that the model knows
    weights: np.ndarray  # (m,) float32
    factors: np.ndarray  # (m, k) float32

    @cached_property
    def active(self) -> np.ndarray:
        out = np.zeros(1 << BITS, bool)
        out[self.terms] = True
        return out

    def scores(self, strings: pa.Array) -> np.ndarray:
        row, bucket = _terms(strings, self.active)
        at = np.searchsorted(self.terms, bucket)
        n = len(strings)
        v = self.factors[at].astype(np.float64)
        z = self.bias + np.bincount(row, self.weights[at], n)
        for f in range(v.shape[1]):
            z += 0.5 * (np.bincount(row, v[:, f], n) ** 2 - np.bincount(row, v[:, f] ** 2, n))
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _constant(rate: float, k: int) -> FactorizationMachine:
    rate = min(max(rate, 1e-9), 1 - 1e-9)
    return FactorizationMachine(float(np.log(rate / (1 - rate))), np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros((0, k), np.float32))


def _fit(
    row: np.ndarray, t: np.ndarray, kept: np.ndarray, y: np.ndarray, stands_for: np.ndarray, k: int, epochs: int, seed: int,
) -> FactorizationMachine:
    """Adam on the logistic loss over the whole (bounded) sample.

    Row ``row[i]`` holds term ``kept[t[i]]``. Each row counts in the loss by the number of rows
    that it ``stands_for``, so that scores are those of the labels' own class rate, whatever part
    of a class was drawn.
    """
    n, m = len(y), len(kept)
    part = stands_for / stands_for.sum()
    rate, l2 = float(part @ y), 3e-4
    p = {
        "b": np.array([np.log(rate / (1 - rate))]),
        "w": np.zeros(m),
        "v": np.random.default_rng(seed).normal(0, 0.01, (k, m)),
    }
    first, second = ({a: np.zeros_like(x) for a, x in p.items()} for _ in range(2))
    for step in range(1, epochs + 1):
        q = [np.bincount(row, p["v"][f][t], n) for f in range(k)]
        z = p["b"][0] + np.bincount(row, p["w"][t], n)
        for f in range(k):
            z += 0.5 * (q[f] ** 2 - np.bincount(row, p["v"][f][t] ** 2, n))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * part
        gr = g[row]
        own = np.bincount(t, gr, m)
        grads = {"b": np.array([g.sum()]), "w": own + l2 * p["w"], "v": p["v"]}
        if k:
            grads["v"] = np.stack(
                [np.bincount(t, gr * q[f][row], m) - p["v"][f] * own + 5 * l2 * p["v"][f] for f in range(k)]
            )
        for a in p:
            first[a] = 0.9 * first[a] + 0.1 * grads[a]
            second[a] = 0.99 * second[a] + 0.01 * grads[a] ** 2
            rate_a = 0.02 if a == "v" else 0.06
            p[a] = p[a] - rate_a * (first[a] / (1 - 0.9**step)) / (np.sqrt(second[a] / (1 - 0.99**step)) + 1e-6)
    return FactorizationMachine(float(p["b"][0]), kept, p["w"].astype(np.float32), p["v"].T.astype(np.float32))


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    max_rows: int = 12_000, k: int = 4, epochs: int = 120, min_docs: int = 3, min_chi2: float = 12.0, seed: int = 7,
) -> FactorizationMachine:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold, half of each class at
    most, taken by a hash of the identifier; the loss weighs the classes by their full counts.

    Terms in fewer than ``min_docs`` rows of the sample, or whose presence is not tied to the
    label (chi-square below ``min_chi2``), are left out: most words of a corpus are rare, and a
    model that may use them all learns its sample by heart. Terms are counted by Spark; the driver
    gets the kept ones (at most ``2**BITS``) and, of each row, those that it holds.

    Null labels and identifiers don't train; an identifier with several labels counts by the
    largest. Null texts are empty, repeated documents train as often as they occur. Without rows
    of both classes the model is constant: the mean label, 0 if there is none.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    usable = usable.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("_y"))
    sizes = {r["_y"]: r["n"] for r in usable.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not {0, 1} <= set(sizes):
        return _constant(float(max(sizes, default=0)), k)
    share = {y: min(1.0, max_rows / 2 / n) for y, n in sizes.items()}
    draw = F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(1_000_000)) / 1e6
    chosen = usable.where(F.when(F.col("_y") == 1, draw < share[1]).otherwise(draw < share[0]))
    picked = chosen.orderBy(draw, "_id").limit(max_rows)  # the same rows however the table is dealt

    @gives_back
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_strings(batch, "t")
            for a, b in by_bytes(texts):
                row, term = _terms(texts.slice(a, b - a))
                ptr = np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32)
                terms = pa.ListArray.from_arrays(pa.array(ptr), pa.array(term.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), terms], names=["y", "terms"])

    # at most max_rows pairs of numbers: a broadcast of bounded size
    joined = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("t")).join(F.broadcast(picked), "_id")
    sample = joined.select("_y", "t").mapInArrow(hashed, "y int, terms array<int>")
    sample = materialise(sample, shared_dir(docs.sparkSession), "sample")
    found = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not {0, 1} <= set(found):
        return _constant(float(max(found, default=0)), k)
    ones, n = found[1], found[0] + found[1]
    counts = sample.select("y", F.explode("terms").alias("term")).groupBy("term")
    counts = counts.agg(F.count(F.lit(1)).cast("double").alias("c"), F.sum("y").cast("double").alias("hits"))
    chi2 = F.lit(float(n)) * F.pow(F.col("hits") * n - F.col("c") * ones, 2) / (F.col("c") * (n - F.col("c")) * float(ones) * (n - ones))
    tied = counts.where((F.col("c") >= min_docs) & (F.col("c") < n)).where(chi2 >= min_chi2)
    kept = np.sort(tied.select("term").toPandas()["term"].to_numpy(np.int64))
    shared = docs.sparkSession.sparkContext.broadcast(kept)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = shared.value
        index = np.full(1 << BITS, -1, np.int32)
        index[terms] = np.arange(len(terms), dtype=np.int32)
        for batch in batches:
            lists = batch.column(1)
            at = index[np.asarray(lists.flatten(), dtype=np.int64)]
            bounds = np.concatenate(([0], np.cumsum(at >= 0)))[np.asarray(lists.offsets) - lists.offsets[0].as_py()]
            some = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(at[at >= 0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), some], names=["y", "terms"])

    rows = sample.mapInArrow(known, "y int, terms array<int>").toArrow()
    shared.destroy()
    y = np.asarray(rows.column("y"), dtype=np.float64)
    terms = np.concatenate([np.asarray(c.flatten()) for c in rows.column("terms").chunks])
    row = np.repeat(np.arange(len(y)), np.asarray(pa.compute.list_value_length(rows.column("terms"))))
    drawn = {r["_y"]: r["n"] for r in picked.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    stands_for = np.where(y == 1, sizes[1] / drawn[1], sizes[0] / drawn[0])
    return _fit(row, terms, kept, y, stands_for, k, epochs, seed)


def score(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` for every row; null and empty texts get the model's constant part."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_strings(batch, "t")
            for a, b in by_bytes(texts):
                s = shared.value.scores(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(s)], names=[id_col, "score"])

    return docs.select(F.col(id_col), F.col(text_col).alias("t")).mapInArrow(run, T.StructType([T.StructField(id_col, kind), T.StructField("score", T.DoubleType())]))


def keep_clean(docs: DataFrame, model: FactorizationMachine, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score below ``threshold``.

    Every row is judged by its whole text alone, so equal rows stay or go together, null
    identifiers and extra columns don't matter, and an empty table stays empty. Null and empty
    texts have the model's constant part as score: they stay unless most labels are toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_strings(batch, f"c{place}")
            for a, b in by_bytes(texts):
                yield batch.slice(a, b - a).filter(pa.array(shared.value.scores(texts.slice(a, b - a)) < threshold))

    place = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names may hold dots
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
