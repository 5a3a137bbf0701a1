"""Nearest neighbours by shifted space-filling curves.

Vectors are projected to few dimensions by several rotations, each with its own shift, and ordered
along a Hilbert curve. Quantiles cut every ordering into blocks of neighbouring keys; a query is
compared, in double precision on the original vectors, with the blocks around its own, and the
finds of all orderings are merged. How many orderings and blocks a recall takes depends on the
data, so it is measured: a bounded sample of queries is compared with every vector, and the
cheapest setting that reaches the wanted recall is used. Where no narrow window reaches it (vectors
without structure have none) the window covers all blocks and the search is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir

DIMS, DEPTH, TIE_BITS = 6, 6, 26
#: Queries that one task holds beside a block; a block that more ask for is dealt to several tasks.
CHUNK = 2048


def hilbert(points: np.ndarray, depth: int) -> np.ndarray:
    """Hilbert index of integer ``points`` (n, d) in [0, 2**depth), by Skilling's transposition."""
    x = points.astype(np.int64).T.copy()
    d, top = len(x), 1 << (depth - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t ^= np.where((x[d - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(depth - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


@dataclass
class Curves:
    """What is fitted on the bounded sample: projections, shifts and the cuts between blocks."""

    centre: np.ndarray
    planes: list[np.ndarray]
    low: list[np.ndarray]
    width: list[np.ndarray]
    largest: float
    cuts: list[np.ndarray]

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        """One more coordinate makes the largest inner product the smallest distance."""
        norm = np.sqrt((x**2).sum(1, keepdims=True))
        if query:
            return np.hstack([x * (self.largest / np.maximum(norm, 1e-300)), np.zeros_like(norm)])
        return np.hstack([x, np.sqrt(np.maximum(self.largest**2 - norm**2, 0))])

    def keys(self, x: np.ndarray, ties: np.ndarray, curve: int, query: bool) -> np.ndarray:
        y = (self.lift(x, query) - self.centre) @ self.planes[curve]
        cell = np.clip((y - self.low[curve]) / self.width[curve] * (1 << DEPTH), 0, (1 << DEPTH) - 1)
        # equal keys are spread by a hash, so that no block holds more than its share
        return (hilbert(cell.astype(np.int64), DEPTH) << TIE_BITS) | (ties & ((1 << TIE_BITS) - 1))

    def blocks(self, x: np.ndarray, ties: np.ndarray, curve: int, query: bool) -> np.ndarray:
        return np.searchsorted(self.cuts[curve], self.keys(x, ties, curve, query), "right")


def _fit(sample: np.ndarray, largest: float, curves: int, blocks: int, seed: int) -> Curves:
    rng = np.random.default_rng(seed)
    model = Curves(np.zeros(sample.shape[1] + 1), [], [], [], largest, [])
    lifted = model.lift(sample, False)
    model.centre = lifted.mean(0)
    _, spread, axes = np.linalg.svd(lifted - model.centre, full_matrices=False)
    ties = rng.integers(0, 1 << TIE_BITS, len(sample))
    d = min(DIMS, len(spread))
    for c in range(curves):
        plane = axes.T @ (spread[:, None] * rng.normal(size=(len(spread), d)))
        plane, _ = np.linalg.qr(plane)
        y = (lifted - model.centre) @ plane
        low, high = np.quantile(y, 0.01, 0), np.quantile(y, 0.99, 0)
        width = np.maximum((high - low) * 1.25, 1e-12)
        model.planes.append(plane)
        model.low.append(low - rng.uniform(0, 0.2, d) * width)
        model.width.append(width)
        keys = np.sort(model.keys(sample, ties, c, False))
        model.cuts.append(keys[(np.arange(1, blocks) * len(keys)) // blocks] if len(keys) else np.zeros(0, np.int64))
    return model


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The columns of the ``k`` largest of each row, ties to the smaller id; row and column indices."""
    n = scores.shape[1]
    if n > k:
        edge = np.partition(scores, n - k, axis=1)[:, n - k]
        row, col = np.nonzero(scores >= edge[:, None])
    else:
        row, col = np.nonzero(np.ones_like(scores, bool))
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[place < k]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64) if len(column) else np.zeros((0, 0))


def nearest(
    vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", recall: float = 0.95,
    curves: int = 8, block_rows: int = 4096, least_blocks: int = 32, sample_rows: int = 20_000, probe_queries: int = 96, seed: int = 5,
) -> DataFrame:
    """``query_id, rank, <id_col>, score``: the ``k`` largest inner products of each query row.

    ``is_query``: a boolean column. Candidates are all rows but the query itself; ties go to the
    smaller identifier. Vectors that are null, zero, of another length than most, or hold null or
    non-finite components take no part, nor do rows without identifier. Equal vectors are searched
    once: each distinct vector carries its ``k + 1`` smallest identifiers. The projections and cuts
    are fitted on at most ``sample_rows`` vectors, the window on ``probe_queries`` queries against
    all vectors; every vector is indexed. Other columns are ignored.
    """
    spark = vectors.sparkSession
    folder = shared_dir(spark)
    x = F.col(vector_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), x.alias("x"), is_query.alias("is_query")).where(F.col("id").isNotNull() & F.col("x").isNotNull())
    fine = F.expr("forall(x, e -> e is not null and not isnan(e) and abs(e) < double('infinity')) and exists(x, e -> e <> 0)")
    usable = usable.where(fine).withColumn("x", F.expr("transform(x, e -> e + 0D)"))
    length = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    if length is None:
        return empty
    usable = usable.where(F.size("x") == length["d"])
    first = Window.partitionBy("x").orderBy("id")
    ranked = usable.select("x", "id").distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    classes = ranked.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.col("ids")[0].alias("cls"), "x", "ids", F.xxhash64("x").alias("tie"))
    classes = materialise(classes, folder, "classes")
    asked = materialise(usable.where("is_query").select("x", F.col("id").alias("query_id")).distinct(), folder, "asked")
    queries = asked.groupBy("x").agg(F.min("query_id").alias("q"), F.count(F.lit(1)).alias("n")).withColumn("tie", F.xxhash64("x"))
    queries = materialise(queries, folder, "queries")

    shape = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("sqrt(aggregate(x, 0D, (s, e) -> s + e * e))")).alias("largest")).first()
    total = shape["n"]
    if not total or not queries.limit(1).count():
        return empty
    blocks = max(least_blocks, -(-total // block_rows))
    by_hash = F.pmod(F.xxhash64("tie", F.lit(seed)), F.lit(1_000_000))
    sample = classes.where(by_hash < 1_000_000 * min(1.0, sample_rows / total)).limit(sample_rows).select("x").toPandas()
    model = _fit(_matrix(sample["x"]) if len(sample) else _matrix(classes.limit(sample_rows).toPandas()["x"]), shape["largest"], curves, blocks, seed)
    asked_n = queries.count()
    probe = queries.where(by_hash < 1_000_000 * min(1.0, 4 * probe_queries / asked_n)).orderBy("tie").limit(probe_queries).select("q", "x", "tie").toPandas()
    used, reach = _calibrate(classes, probe, model, k, recall, curves, blocks)

    shared = spark.sparkContext.broadcast(model)
    out = "curve int, block int, kind int, cls long, x array<double>, chunk int"
    # a window of 2 * reach + 1 blocks asks each block for that part of all queries, on average
    chunks = max(1, -(-asked_n * min(2 * reach + 1, blocks) // (blocks * CHUNK)))

    def deal(query: bool):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                if not len(f):
                    continue
                m, ties = _matrix(f["x"]), f["tie"].to_numpy(np.int64)
                own = ((ties >> TIE_BITS) % chunks).astype(np.int32)
                for c in range(used):
                    b = shared.value.blocks(m, ties, c, query)
                    # a query goes to its chunk of every block around it, a row to all chunks of its block
                    places = [(b + step, own) for step in range(-reach, reach + 1)] if query else [(b, np.full_like(own, i)) for i in range(chunks)]
                    for at, chunk in places:
                        ok = (at >= 0) & (at < blocks)
                        yield pd.DataFrame({
                            "curve": c, "block": at[ok].astype(np.int32), "kind": int(query), "cls": f["cls"].to_numpy()[ok], "x": f["x"][ok], "chunk": chunk[ok],
                        })

        return run

    rows = classes.select("cls", "x", "tie").mapInPandas(deal(False), out)
    seekers = queries.select(F.col("q").alias("cls"), "x", "tie").mapInPandas(deal(True), out)

    def search(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        own, ask = frame[frame["kind"] == 0], frame[frame["kind"] == 1]
        if not len(own) or not len(ask):
            return pd.DataFrame({"q": np.zeros(0, np.int64), "cls": np.zeros(0, np.int64), "score": np.zeros(0)})
        m, ids, q = _matrix(own["x"]), own["cls"].to_numpy(), ask["cls"].to_numpy()
        found = []
        for a in range(0, len(ask), 512):
            s = _matrix(ask["x"].iloc[a : a + 512]) @ m.T
            r, c = _best(s, ids, k + 1)
            found.append(pd.DataFrame({"q": q[a + r], "cls": ids[c], "score": s[r, c]}))
        return pd.concat(found)

    finds = rows.unionByName(seekers).groupBy("curve", "block", "chunk").applyInPandas(search, "q long, cls long, score double")
    finds = finds.groupBy("q", "cls").agg(F.max("score").alias("score"))
    top = Window.partitionBy("q").orderBy(F.desc("score"), "cls")
    finds = finds.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k + 1)
    entries = finds.join(classes.select("cls", "ids"), "cls").select("q", "score", F.explode("ids").alias("id"))
    entries = entries.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("r") <= k + 1)
    lists = entries.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("r", "id", "score"))).alias("found"))
    answer = queries.join(lists, "q").select("x", "found")
    mine = asked.join(answer, "x").select("query_id", F.expr(f"slice(filter(found, e -> e.id <> query_id), 1, {k})").alias("found"))
    return mine.select("query_id", F.posexplode("found").alias("p", "e")).select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.id").alias(id_col), F.col("e.score").alias("score"))


def _calibrate(classes: DataFrame, probe: pd.DataFrame, model: Curves, k: int, recall: float, curves: int, blocks: int) -> tuple[int, int]:
    """The number of curves and the reach in blocks that find ``recall`` of the probes' neighbours."""
    q = _matrix(probe["x"])
    shared = classes.sparkSession.sparkContext.broadcast((model, q))

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted, asked = shared.value
        for f in frames:
            if len(f):
                m, ids = _matrix(f["x"]), f["cls"].to_numpy()
                s = asked @ m.T
                r, c = _best(s, ids, k + 1)
                near, ties = m[c], f["tie"].to_numpy(np.int64)[c]
                places = np.stack([fitted.blocks(near, ties, i, False) for i in range(curves)], 1)
                yield pd.DataFrame({"q": r, "cls": ids[c], "score": s[r, c], "places": places.tolist()})

    found = classes.select("cls", "x", "tie").mapInPandas(scan, "q int, cls long, score double, places array<int>")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "cls")
    truth = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).select("q", "places").toPandas()
    shared.destroy()
    ties = probe["tie"].to_numpy(np.int64)
    home = np.stack([model.blocks(q, ties, c, True) for c in range(curves)], 1)
    gap = np.abs(_matrix(truth["places"]) - home[truth["q"].to_numpy()])
    closest = np.minimum.accumulate(gap, axis=1)
    options = [(blocks, 1, blocks)]  # every block of one curve: the exact search
    for used in range(1, curves + 1):
        need = int(np.quantile(closest[:, used - 1], recall, method="higher"))
        options.append((used * min(2 * need + 1, blocks), used, need))
    _, used, reach = min(options, key=lambda o: (o[0], o[2] < blocks, o[1]))  # exact where nothing costs less
    return used, reach
