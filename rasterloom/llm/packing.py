"""Packing token sequences into fixed-length ones with a distributed grouping genetic algorithm."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir
from .common import as_strings, by_bytes, gives_back
from .tokens import encoder, with_end


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every whole text with ``end_id`` after it.

    Texts over ``capacity`` ids are cut into pieces of ``capacity``; the first takes the rest.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        for batch in batches:
            texts = as_strings(batch, "t")
            for a, b in by_bytes(texts, 4 << 20):
                ids, bounds = with_end(*coder.encode(texts.slice(a, b - a)), end_id)
                ids, total = ids.astype("<u4"), np.diff(bounds)
                count = -(-total // capacity)
                doc = np.repeat(np.arange(b - a), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                first = total - (count - 1) * capacity
                start = np.where(piece == 0, 0, first[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, first[doc], capacity)
                at = (bounds[:-1][doc] + start).tolist()
                crc = [zlib.crc32(ids[i : i + n]) for i, n in zip(at, length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _best_fit(lengths: list[int], items: list[int], bin_of: np.ndarray, free: list[int], capacity: int) -> None:
    """Put ``items`` in order each into the fullest bin that has room; opens bins as needed."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for b, room in enumerate(free):
        if room > 0:
            by_room[room].append(b)
            mask |= 1 << room
    for i in items:
        n = lengths[i]
        fits = mask >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            stack = by_room[room]
            b = stack.pop()
            if not stack:
                mask ^= 1 << room
        else:
            room, b = capacity, len(free)
            free.append(capacity)
        bin_of[i] = b
        room -= n
        free[b] = room
        if room:
            by_room[room].append(b)
            mask |= 1 << room


def _fitness(bin_of: np.ndarray, lengths: np.ndarray, capacity: int) -> float:
    """Fewer bins first, then bins that are full rather than all alike."""
    fill = np.bincount(bin_of, lengths) / capacity
    return -len(fill) + float((fill**2).mean())


def _crossover(one: np.ndarray, other: np.ndarray, lengths: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject whole well-filled bins of ``other`` into ``one``.

    Bins of ``one`` that share an item with them go, and their other items are displaced; best fit
    in decreasing order puts those back.
    """
    fill = np.bincount(other, lengths)
    good = np.flatnonzero(fill >= np.quantile(fill, 0.5))
    chosen = np.zeros(len(fill), bool)
    chosen[rng.choice(good, max(1, int(len(good) * rng.uniform(0.1, 0.6))), replace=False)] = True
    injected = chosen[other]
    broken = np.zeros(one.max() + 1, bool)
    broken[one[injected]] = True
    # besides the duplicates' bins, the emptiest bins are opened again, else nothing can be won
    own = np.bincount(one, lengths)
    broken |= own <= np.quantile(own, 0.02)
    stay = ~injected & ~broken[one]
    child = np.full(len(one), -1, np.int64)
    _, child[stay] = np.unique(one[stay], return_inverse=True)
    base = int(child.max()) + 1
    _, into = np.unique(other[injected], return_inverse=True)
    child[injected] = base + into
    placed = child >= 0
    free = (capacity - np.bincount(child[placed], lengths[placed]).astype(np.int64)).tolist()
    _best_fit(lengths.tolist(), np.flatnonzero(~placed).tolist(), child, free, capacity)
    return child


def _evolve(lengths: np.ndarray, population: list[np.ndarray], capacity: int, generations: int, size: int, rng: np.random.Generator) -> list[np.ndarray]:
    """``lengths`` are in decreasing order. The result is sorted, the best first."""
    floor = -(-int(lengths.sum()) // capacity)
    plain = lengths.tolist()
    while len(population) < size:
        noise = rng.uniform(0, 0.02 * capacity * len(population), len(lengths))
        new = np.full(len(lengths), -1, np.int64)
        _best_fit(plain, np.argsort(-(lengths + noise), kind="stable").tolist(), new, [], capacity)
        population.append(new)
    ranked = sorted(((_fitness(p, lengths, capacity), k, p) for k, p in enumerate(population)), key=lambda x: (-x[0], x[1]))
    serial = len(ranked)
    for _ in range(generations):
        if ranked[0][2].max() + 1 <= floor:
            break
        a, b = rng.choice(len(ranked), 2, replace=False)
        child = _crossover(ranked[min(a, b)][2], ranked[max(a, b)][2], lengths, capacity, rng)
        serial += 1
        ranked = sorted([*ranked, (_fitness(child, lengths, capacity), serial, child)], key=lambda x: (-x[0], x[1]))[:size]
    return [p for _, _, p in ranked]


def pack(
    items: DataFrame, capacity: int, id_col: str = "uid", length_col: str = "length", block_items: int = 16_384,
    islands: int = 2, epochs: int = 2, generations: int = 60, population: int = 8, seed: int = 11, max_tasks: int = 20_000,
) -> DataFrame:
    """``id_col, sequence_id, offset`` for items of 1 to ``capacity``; ``id_col`` must be unique.

    Items that fill a sequence have one to themselves. The others are dealt by a hash into blocks
    of about ``block_items``; each block is packed by ``islands`` populations apart, and between
    ``epochs`` each island's best packing moves to the next island of its block. An island goes through
    ``generations`` an epoch, less only where no packing can need fewer sequences. The best packing
    of a block stays. A block costs at most one part-filled sequence, whatever the corpus size.
    """
    todo = items.where(F.col(length_col) < capacity)
    blocks = max(1, -(-todo.count() // block_items))
    block = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(blocks))
    groups = todo.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(F.struct((-F.col(length_col)).alias("n"), F.col(id_col).alias("u")))).alias("x"))
    # the rows are few and small, but hours of work: a stated number of tasks isn't merged by bytes
    tasks = min(blocks * islands, max_tasks)
    schema = "block long, island int, lengths array<int>, uids array<long>, population array<array<int>>, fitness double"

    def evolve(epoch: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for r in frame.itertuples(index=False):
                    lengths = np.asarray(r.lengths, np.int64)
                    old = [np.asarray(p, np.int64) for p in r.population]
                    rng = np.random.default_rng([seed, epoch, int(r.block), int(r.island)])
                    new = _evolve(lengths, old, capacity, generations, population, rng)
                    yield pd.DataFrame({"block": [r.block], "island": [r.island], "lengths": [r.lengths], "uids": [r.uids], "population": [[p.astype(np.int32) for p in new]], "fitness": [_fitness(new[0], lengths, capacity)]})

        return run

    state = groups.select(
        "block", F.explode(F.array(*[F.lit(i) for i in range(islands)])).alias("island"), F.expr("transform(x, e -> cast(-e.n as int))").alias("lengths"),
        F.expr("transform(x, e -> e.u)").alias("uids"), F.expr("cast(array() as array<array<int>>)").alias("population"), F.lit(0.0).alias("fitness"),
    ).repartition(tasks, "block", "island")
    ring = Window.partitionBy("block").orderBy("island")
    for epoch in range(epochs):
        if epoch:
            elite = F.coalesce(F.lag(F.col("population")[0]).over(ring), F.last(F.col("population")[0]).over(ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            moved = state.withColumn("elite", elite)
            state = moved.withColumn("population", F.concat("population", F.array("elite"))).drop("elite").repartition(tasks, "block", "island")
        state = state.mapInPandas(evolve(epoch), schema)
    best = state.groupBy("block").agg(F.max_by(F.struct("uids", "lengths", F.col("population")[0].alias("bins")), F.struct("fitness", -F.col("island"))).alias("b")).select("block", "b.*")

    @gives_back
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block_id, uids, lengths, bins in zip(*(batch.column(c) for c in ("block", "uids", "lengths", "bins"))):
                u, n, b = (np.asarray(x.values, dtype=np.int64) for x in (uids, lengths, bins))
                order = np.argsort(b, kind="stable")
                u, n, b = u[order], n[order], b[order]
                before = np.cumsum(n) - n
                first = np.concatenate(([True], b[1:] != b[:-1]))
                offset = before - before[np.maximum.accumulate(np.where(first, np.arange(len(b)), 0))]
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(2 * ((block_id.as_py() << 24) + b)), pa.array(offset)], names=[id_col, "sequence_id", "offset"])

    packed = best.select("block", "uids", "lengths", "bins").mapInArrow(place, f"{id_col} long, sequence_id long, offset long")
    full = items.where(F.col(length_col) >= capacity).select(F.col(id_col), (F.col(id_col) * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Null texts count as empty (the end id alone). Repeated rows and null identifiers are packed
    like any other row; extra columns are ignored; an empty table gives an empty result.
    """
    folder = shared_dir(docs.sparkSession)
    found = pieces_of(docs, vocabulary, end_id, capacity, id_col, text_col).withColumn("uid", F.monotonically_increasing_id())
    found = materialise(found, folder, "pieces")
    return found.join(pack(found.select("uid", "length"), capacity, **options), "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
