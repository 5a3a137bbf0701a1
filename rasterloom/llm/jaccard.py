"""Exact set-similarity join on word shingles with a token-group matrix.

Two texts link when the Jaccard similarity of their shingle sets reaches a threshold. Texts with
equal sets are one class, and only classes are compared. Every stage keeps all links:

1. Prefix filter. Under one order of all shingles two linked sets share one of their first
   ``n - ceil(t n) + 1``. Frequent shingles (a bounded list, by Misra-Gries counts over all texts)
   come last in the order, so a passage that many texts share draws no candidates.
2. Sketches. A class's shingles set bits of a map of at least two bits a shingle. A bit that one
   map has and the other lacks is a shingle outside the overlap, which bounds the overlap from
   above; a class that no class on a shingle can link with by that bound leaves the shingle. Most
   texts that merely share a passage end here, and their sets are never shuffled.
3. Groups. A class goes to the group of the smallest shingle it has in common with another class;
   large groups are cut into chunks. A chunk is clustered exactly where it lies, so a family of near
   copies shrinks to a few cells.
4. Matrix. For every prefix shingle the cells that hold it. Cells that meet are paired: first each
   with the shingle's smallest cell, and, once those links are known, all pairs of cells not yet
   connected.
5. Opening. A member q of one cell can link into the other cell only if its overlap with that
   cell's shingle union is at least t |q|. Only where that bound holds the cell is opened and its
   sets are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.graph import components
from ..scratch import materialise, shared_dir
from .common import as_strings, by_bytes, gives_back, mix, shingle_sets

HEAVY_LIMIT = 1 << 20
FILTER_BITS = 23
#: Classes whose sketches are compared in one group; where more meet in pruning, all stay.
SKETCH_RUN = 4096


def _signature(s: np.ndarray) -> int:
    """A 64-bit fingerprint of a set; sets are one class where it is equal."""
    folded = np.bitwise_xor.reduce(mix(s + np.uint64(0x632BE59BD9B4E019)), keepdims=True)
    folded += mix(s ^ np.uint64(0x8CB92BA72F3D8DD7)).sum(keepdims=True)
    return int(mix(folded + np.uint64(len(s))).view(np.int64)[0])


def _sketch(s: np.ndarray, share: int = 2) -> bytes:
    """A bit map of a power of two of bits, at least ``share`` a shingle; halves can be laid on each other."""
    bits = 1 << max(6, (share * len(s) - 1).bit_length())
    at = np.zeros(bits, bool)
    at[s & np.uint64(bits - 1)] = True
    return np.packbits(at, bitorder="little").tobytes()


def _possible(sketches: list[bytes], sizes: np.ndarray, percent: int, done: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each set the others that, by their sketches, can link with it.

    A set that is ``done`` is held only against sets of the next width that aren't: they meet it in
    no other round, while sets of its own width have their own turn.
    """
    width = np.array([len(x) for x in sketches])
    for w in np.unique(width).tolist():
        # sets that can link differ by less than a factor of two, so their maps do by one fold at most
        mine = np.flatnonzero((width == w) | (width == 2 * w))
        n = sizes[mine]
        maps = np.zeros((len(mine), w // 8), np.uint64)
        for k, i in enumerate(mine.tolist()):
            one = np.frombuffer(sketches[i], np.uint64)
            maps[k] = one if width[i] == w else one[: w // 8] | one[w // 8 :]
        todo = np.flatnonzero(width[mine] == w) if len(mine) > 1 else []
        wider = np.flatnonzero(width[mine] == 2 * w)
        for k in todo:
            at = np.arange(len(mine))
            if done[mine[k]]:
                at = wider = wider[~done[mine[wider]]]
                if not len(at):
                    continue
            theirs, m = maps[at], n[at]
            shared = np.minimum(m - np.bitwise_count(theirs & ~maps[k]).sum(1, dtype=np.int64), n[k] - np.bitwise_count(maps[k] & ~theirs).sum(1, dtype=np.int64))
            fits = (100 * shared >= percent * (m + n[k] - shared)) & (at != k)
            if fits.any():
                yield int(mine[k]), mine[at[fits]]


def _may_link(sketches: list[bytes], sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets can, by their sketches, link with another of them."""
    out = np.zeros(len(sizes), bool)
    for i, others in _possible(sketches, sizes, percent, out):
        out[others] = True
        out[i] = True
    return out


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def frequent_shingles(texts: DataFrame, shingle: int, keep: int = 1 << 17, limit: int = HEAVY_LIMIT, least: int = 16) -> np.ndarray:
    """Shingles in more than ``max(least, total / limit)`` texts, by Misra-Gries summaries.

    Each task keeps ``keep`` counters over all its texts; the sums are lower bounds, so at most
    ``limit`` shingles can pass. The list only orders shingles: what it misses costs time, not links.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, size, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0, 0

        def fold() -> None:
            nonlocal keys, counts, held, size
            if held:
                k, c = np.unique(np.concatenate(held), return_counts=True)
                keys, counts = _merge(np.concatenate([keys, k]), np.concatenate([counts, c]))
                if len(keys) > keep:
                    counts = counts - np.partition(counts, len(counts) - keep - 1)[len(counts) - keep - 1]
                    keys, counts = keys[counts > 0], counts[counts > 0]
                held, size = [], 0

        for batch in batches:
            column = as_strings(batch, "t")
            for a, b in by_bytes(column):
                for s in shingle_sets(column.slice(a, b - a), shingle):
                    held.append(s)
                    size += len(s)
                    total += len(s)
                if size > 1_000_000:
                    fold()
        fold()
        some = counts >= 2
        yield pa.RecordBatch.from_arrays([pa.array(np.append(keys[some].view(np.int64), 0)), pa.array(np.append(counts[some], 0)), pa.array(np.append(np.zeros(some.sum(), np.int64), total))], names=["token", "c", "total"])

    folder = shared_dir(texts.sparkSession)
    found = materialise(texts.mapInArrow(run, "token long, c long, total long"), folder, "frequent")
    total = found.agg(F.sum("total")).first()[0] or 0
    heavy = found.groupBy("token").agg(F.sum("c").alias("c")).where(F.col("c") >= max(least, total // limit + 1)).select("token").limit(limit)
    return np.sort(heavy.toPandas()["token"].to_numpy(np.int64).view(np.uint64))


def _scan(texts: DataFrame, heavy: np.ndarray, folder: str, shingle: int, percent: int) -> DataFrame:
    """``id, n, cls, prefix, late, sketch`` of each text; a task gives the last three of a class once.

    ``late`` is the part of the prefix that are frequent shingles.
    """
    shared = texts.sparkSession.sparkContext.broadcast(heavy)

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, met = shared.value, set()
        for batch in batches:
            column = as_strings(batch, "t")
            for a, b in by_bytes(column):
                n, cls, sketches = [], [], []
                rare, rare_ends, late, late_ends = [], [0], [], [0]
                for s in shingle_sets(column.slice(a, b - a), shingle):
                    c = _signature(s) if len(s) else 0
                    n.append(len(s))
                    cls.append(c)
                    few = often = s[:0]
                    sketch = None
                    if len(s) and c not in met:
                        if len(met) > 1_000_000:
                            met.clear()
                        met.add(c)
                        sketch = _sketch(s)
                        p = len(s) - -(-percent * len(s) // 100) + 1
                        few = s[:p]
                        if len(frequent):
                            at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
                            hot = frequent[at] == s
                            if hot.any():
                                few = s[~hot][:p]
                                often = s[hot][: p - len(few)]
                    rare.append(few)
                    rare_ends.append(rare_ends[-1] + len(few))
                    late.append(often)
                    late_ends.append(late_ends[-1] + len(often))
                    sketches.append(sketch)
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), pa.array(np.concatenate(parts).view(np.int64)))
                    for parts, ends in ((rare, rare_ends), (late, late_ends))
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), *lists, pa.array(sketches, pa.binary())],
                    names=["id", "n", "cls", "prefix", "late", "sketch"],
                )

    found = texts.mapInArrow(run, "id long, n long, cls long, prefix array<long>, late array<long>, sketch binary")
    found = materialise(found, folder, "prefixes")
    shared.destroy()
    return found


def _meeting_often(tokens: DataFrame) -> DataFrame:
    """What ``_meeting`` gives, for shingles that a great part of all classes may hold.

    Repeated rows go first (the key is the whole row), a shingle's first class is a minimum that
    tasks take ahead of the shuffle, and the join that brings it back can be split by row count.
    """
    once = tokens.distinct()
    first = once.groupBy("token").agg(F.min(F.struct("n", "cls"))["cls"].alias("leader"), F.count(F.lit(1)).alias("k"))
    return once.join(first.where("k > 1").select("token", "leader"), "token").select("token", "n", "cls", "leader")


def _meeting(tokens: DataFrame) -> DataFrame:
    """Of ``token, n, cls`` the rows whose token two classes hold, with the token's first class.

    Rows arrive sorted by token and size, and one row is carried from batch to batch, so a token
    that very many classes hold takes no memory.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = None  # token, n, cls and leader of the row before; whether it was given out
        for batch in batches:
            t, n, c = (np.asarray(batch.column(i), dtype=np.int64) for i in range(3))
            if not len(t):
                continue
            begin = 0
            if carry is not None:
                t, n, c = (np.concatenate(([v], x)) for v, x in zip(carry[:3], (t, n, c)))
                begin = 1
            same = np.concatenate(([False], (t[1:] == t[:-1]) & (c[1:] == c[:-1])))
            start = np.concatenate(([True], t[1:] != t[:-1]))
            run_of = np.cumsum(start) - 1
            firsts = np.flatnonzero(start)
            leader = c[firsts][run_of]
            if carry is not None:
                leader[run_of == 0] = carry[3]
            other = c != leader
            crowded = np.bincount(run_of, other & ~same, len(firsts)) > 0
            give = crowded[run_of] & ~same
            if begin:
                give[0] = crowded[0] and not carry[4]
                if carry[4]:  # the run is known to be crowded
                    give[1:] |= (run_of[1:] == 0) & ~same[1:]
            last = int(run_of[-1])
            out = bool(crowded[last]) or bool(last == 0 and begin and carry[4])
            carry = (t[-1], n[-1], c[-1], leader[-1], out)
            yield pa.RecordBatch.from_arrays([pa.array(x[give]) for x in (t, n, c, leader)], names=["token", "n", "cls", "leader"])

    return tokens.repartition("token").sortWithinPartitions("token", "n", "cls").mapInArrow(run, "token long, n long, cls long, leader long")


def _prune(meeting: DataFrame, sketches: DataFrame, folder: str, percent: int) -> DataFrame:
    """``token, n, cls, leader``: the classes that may link, by a key that all classes on a shingle share.

    The key is the shingle's first class, so the many shingles of one passage are one key; where
    that gathers more than ``SKETCH_RUN`` classes the shingles themselves stay keys. Within a key a
    class needs another of fitting size and sketch. Where still more meet, all rows stay.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (token,), rows in _runs(batches, 1):
            kept = np.flatnonzero(_may_link([r[3] for r in rows], np.array([r[0] for r in rows]), percent))
            if len(kept):
                cols = list(zip(*(rows[i][:3] for i in kept)))
                yield pa.RecordBatch.from_arrays([pa.array([token] * len(kept), pa.int64()), *(pa.array(c, pa.int64()) for c in cols)], names=["token", "n", "cls", "leader"])

    def fitting(rows: DataFrame) -> DataFrame:
        # rows are counted by key and size first: what a window takes are the sizes that occur on a key
        sizes = rows.groupBy("token", "n").agg(F.count(F.lit(1)).alias("m"))
        order = Window.partitionBy("token").orderBy("n")
        sizes = sizes.withColumn("below", F.lag("n").over(order)).withColumn("above", F.lead("n").over(order))
        sizes = sizes.where(f"m > 1 or 100 * below >= {percent} * n or 100 * n >= {percent} * above")
        sizes = sizes.withColumn("k", F.sum("m").over(Window.partitionBy("token"))).select("token", "n", "k")
        return rows.join(sizes, ["token", "n"]).select("token", "n", "cls", "leader", "k")

    led = materialise(meeting.select(F.col("leader").alias("token"), "n", "cls", "leader").distinct(), folder, "led")
    wide = materialise(led.groupBy("leader").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > SKETCH_RUN).select("leader"), folder, "wide")
    # wide leaders are few: each has thousands of rows
    rows = led.join(wide, "leader", "left_anti").unionByName(meeting.join(wide, "leader", "left_semi").select("token", "n", "cls", "leader"))
    runs = materialise(fitting(rows), folder, "runs")
    small = runs.where(F.col("k") <= SKETCH_RUN).join(sketches, "cls").select("token", "n", "cls", "leader", "sketch")
    schema = "token long, n long, cls long, leader long"
    may = small.repartition("token").sortWithinPartitions("token", "n", "cls").mapInArrow(run, schema)
    return materialise(may.unionByName(runs.where(F.col("k") > SKETCH_RUN).select("token", "n", "cls", "leader")), folder, "may-link")


def _sets(texts: DataFrame, wanted: DataFrame, folder: str, shingle: int) -> DataFrame:
    """``cls, n, tokens`` (binary) of the wanted classes, from a second look at the texts.

    A bit map of fixed size, made from all wanted classes, spares the others the shuffle.
    """
    slot = F.pmod(F.col("cls"), F.lit(1 << FILTER_BITS))
    bits = wanted.select(slot.alias("s")).distinct().groupBy(F.shiftright("s", 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(s & 31 as int))")).alias("bits")).toPandas()
    table = np.zeros(1 << (FILTER_BITS - 5), np.int64)
    table[bits["word"].to_numpy(np.int64)] = bits["bits"].to_numpy(np.int64)
    shared = texts.sparkSession.sparkContext.broadcast(table)

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, met = shared.value, set()
        for batch in batches:
            column = as_strings(batch, "t")
            for a, b in by_bytes(column):
                cls, n, sets = [], [], []
                for s in shingle_sets(column.slice(a, b - a), shingle):
                    if len(s):
                        c = _signature(s)
                        at = c % (1 << FILTER_BITS)
                        if (int(words[at >> 5]) >> (at & 31)) & 1 and c not in met:
                            met.add(c)
                            cls.append(c)
                            n.append(len(s))
                            sets.append(s.tobytes())
                            if len(met) > 1_000_000:
                                met.clear()
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(n, pa.int64()), pa.array(sets, pa.binary())], names=["cls", "n", "tokens"])

    found = texts.mapInArrow(run, "cls long, n long, tokens binary")
    found = found.join(wanted, "cls", "left_semi").groupBy("cls", "n").agg(F.first("tokens").alias("tokens"))
    found = materialise(found, folder, "sets")
    shared.destroy()
    return found


def _overlaps(sets: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set the sizes of its intersections with all sets."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    token = np.cumsum(np.concatenate(([0], flat[order][1:] != flat[order][:-1])))
    code = np.empty(len(flat), np.int64)
    code[order] = token
    count = np.bincount(token)
    begin, held = np.cumsum(count) - count, owner[order]
    at = 0
    for s in sets:
        mine = code[at : at + len(s)]
        at += len(s)
        k = count[mine]
        shift = np.repeat(begin[mine] - (np.cumsum(k) - k), k)
        yield np.bincount(held[shift + np.arange(k.sum())], minlength=len(sets))


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows of a sorted stream by equal leading columns."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _root(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def _cluster(chunks: DataFrame, percent: int) -> DataFrame:
    """``cls, n, cell``: the connected parts of each chunk, named by their smallest class."""

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, 2):
            ids, sizes = [r[0] for r in rows], np.array([r[1] for r in rows])
            up = list(range(len(rows)))
            if len(rows) > 1:
                for i, both in enumerate(_overlaps([np.frombuffer(r[2], np.uint64) for r in rows])):
                    for j in np.flatnonzero(100 * both[:i] >= percent * (sizes[:i] + sizes[i] - both[:i])).tolist():
                        a, b = _root(up, i), _root(up, j)
                        up[max(a, b)] = min(a, b)
            least: dict[int, int] = {}
            for i, c in enumerate(ids):
                r = _root(up, i)
                least[r] = min(c, least.get(r, c))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes), pa.array([least[_root(up, i)] for i in range(len(ids))], pa.int64())], names=["cls", "n", "cell"])

    dealt = chunks.repartition("grp", "chunk").sortWithinPartitions("grp", "chunk", "n", "cls").select("grp", "chunk", "cls", "n", "tokens")
    return dealt.mapInArrow(run, "cls long, n long, cell long")


def _open(pairs: DataFrame, members: DataFrame, sets: DataFrame, percent: int, share: int = 32) -> DataFrame:
    """Of cell pairs ``a, b`` those with a link between members.

    The larger cell of a pair is opened once for ``share`` others, which pass it one by one.
    """

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, one, union, linked = None, [], None, None
        for batch in batches:
            found = []
            for hub, salt, side, cell, tokens in zip(*(batch.column(i) for i in range(5))):
                hub, salt, cell, q = hub.as_py(), salt.as_py(), cell.as_py(), np.frombuffer(tokens.as_py(), np.uint64)
                if (hub, salt) != key:
                    key, one, union, linked = (hub, salt), [], None, None
                if side.as_py() == 0:
                    one.append(q)
                    continue
                if cell == linked or not one:
                    continue
                if union is None:
                    union = np.unique(np.concatenate(one)) if len(one) > 1 else one[0]
                at = np.minimum(np.searchsorted(union, q), len(union) - 1)
                if 100 * int((union[at] == q).sum()) < percent * len(q):
                    continue  # no set of the group can share enough with q
                for s in one:
                    if 100 * min(len(s), len(q)) >= percent * max(len(s), len(q)):
                        at = np.minimum(np.searchsorted(s, q), len(s) - 1)
                        both = int((s[at] == q).sum())
                        if 100 * both >= percent * (len(s) + len(q) - both):
                            linked = cell
                            found.append((hub, cell))
                            break
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    size = members.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    sized = pairs.join(size.select(F.col("cell").alias("a"), F.col("m").alias("ma")), "a").join(size.select(F.col("cell").alias("b"), F.col("m").alias("mb")), "b")
    turned = F.col("mb") > F.col("ma")
    sized = sized.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("hub"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("cell"))
    parts = sized.groupBy("hub").agg(F.expr(f"cast(ceil(count(1) / {share}) as long)").alias("parts"))
    dealt = sized.join(parts, "hub").select("hub", F.pmod(F.xxhash64("cell"), F.col("parts")).alias("salt"), F.lit(1).alias("side"), "cell")
    sides = dealt.unionByName(dealt.select("hub", "salt", F.lit(0).alias("side"), F.col("hub").alias("cell")).distinct())
    rows = sides.join(members.select("cell", "cls"), "cell").join(sets, "cls").select("hub", "salt", "side", "cell", "tokens")
    return rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "side", "cell").mapInArrow(run, "a long, b long")


def _apart_pairs(known: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: pairs of cells with a key in common that aren't connected yet and may link.

    Of ``known(token, cell, lo, hi, comp)``. Only pairs that finer sketches of their members let
    pass are given out. The members of a key are dealt into parts of about ``SKETCH_RUN``, and any
    two parts meet in a group of their own, so a key of any size is compared in bounded groups.
    """

    @gives_back
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_sketch(np.frombuffer(x.as_py(), np.uint64), 8) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["cls", "n", "sketch"])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, 3):
            cell, comp, sizes = (np.array([r[i] for r in rows]) for i in range(3))
            pairs = set()
            for i, others in _possible([r[3] for r in rows], sizes, percent, np.zeros(len(rows), bool)):
                for c in cell[others[comp[others] != comp[i]]].tolist():
                    pairs.add((min(c, int(cell[i])), max(c, int(cell[i]))))
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*sorted(pairs))], names=["a", "b"])

    held = known.join(members.groupBy("cell").agg(F.count(F.lit(1)).alias("m")), "cell").groupBy("token").agg(F.sum("m").alias("k"))
    sized = known.join(held, "token")
    maps = sets.select("cls", "n", "tokens").mapInArrow(sketched, "cls long, n long, sketch binary")
    parts = F.expr(f"cast(ceil(k / {SKETCH_RUN}) as long)")
    dealt = sized.join(members.select("cell", "cls"), "cell").withColumn("part", F.pmod(F.xxhash64("cls"), parts))
    dealt = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    dealt = dealt.select("token", F.least("part", "with").alias("p"), F.greatest("part", "with").alias("q"), "cls", "cell", "comp")
    rows = dealt.join(maps, "cls").select("token", "p", "q", "cell", "comp", "n", "sketch")
    near = rows.repartition("token", "p", "q").sortWithinPartitions("token", "p", "q", "n", "cell")
    return near.mapInArrow(run, "a long, b long").distinct()


def one_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are their component's first.

    Rows, not identifiers, are told apart, so exactly one row of every component stays: that with
    the smallest identifier (a null one comes last), of rows that share it any one. Rows without
    words (null or empty texts) have nothing in common and all stay. Very long texts are compared
    whole; extra columns don't matter; an empty table stays empty.
    """
    folder = shared_dir(docs.sparkSession)
    key = "_row"
    while key in docs.columns:
        key += "_"
    rows = materialise(docs.withColumn(key, F.monotonically_increasing_id()), folder, "rows")
    linked = materialise(jaccard_components(rows, key, **options), folder, "linked")
    crowded = linked.where(F.col(key) != F.col("component_id")).select("component_id").distinct()
    grouped = linked.join(crowded, "component_id", "left_semi").select(F.col(key).alias("_k"), "component_id")
    known = rows.select(F.col(key).alias("_k"), F.col(id_col).isNull().alias("_none"), F.col(id_col).alias("_id"))
    named = materialise(grouped.join(known, "_k"), folder, "named")
    first = named.groupBy("component_id").agg(F.min(F.struct("_none", "_id", "_k"))["_k"].alias("_k"))
    gone = named.select("_k").join(first.select("_k"), "_k", "left_anti")
    gone = materialise(gone.withColumnRenamed("_k", key), folder, "gone")
    return rows.join(gone, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, shingle: int = 5, chunk_classes: int = 256,
) -> DataFrame:
    """One row per document: ``id_col, n_shingles, component_id``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased; a document's set holds its
    distinct runs of ``shingle`` words, or its whole sequence where it has fewer. Documents link
    when ``100 |A n B| >= percent |A u B|``; ``component_id`` is the smallest identifier reachable
    by links. Documents without words (null or empty text) link with nothing, not with each other
    either, and are their own component. Null identifiers never are a ``component_id`` unless the
    component has no other. Repeated rows are returned each. Shingles and sets are compared by
    64-bit hashes. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))
    heavy = frequent_shingles(texts.select("t"), shingle)
    found = _scan(texts, heavy, folder, shingle, percent)
    rare, late = (found.select(F.explode(c).alias("token"), "n", "cls") for c in ("prefix", "late"))
    meeting = materialise(_meeting(rare).unionByName(_meeting_often(late)), folder, "meeting")
    sketches = found.where(F.col("sketch").isNotNull()).groupBy("cls").agg(F.first("sketch").alias("sketch"))
    meeting = _prune(meeting, sketches, folder, percent)
    label = _labels(texts, meeting, folder, shingle, percent, chunk_classes)

    ids = found.where("n > 0").groupBy("cls").agg(F.min("id").alias("least"))
    if label is not None:
        named = ids.join(label, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        roots = named.groupBy("comp").agg(F.min("least").alias("least"))
        ids = named.select("cls", "comp").join(roots, "comp").select("cls", "least")
    empty = F.when(F.col("n") > 0, F.col("cls"))
    out = found.select("id", "n", empty.alias("cls")).join(ids, "cls", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"))


def _labels(texts: DataFrame, meeting: DataFrame, folder: str, shingle: int, percent: int, chunk_classes: int) -> DataFrame | None:
    """``cls, comp`` of the classes that meet another; None if none does."""
    if not meeting.limit(1).count():
        return None
    group = meeting.groupBy("cls").agg(F.min(F.struct("token", "leader")).alias("g")).select("cls", F.col("g.leader").alias("grp"))
    group = materialise(group, folder, "groups")
    sets = _sets(texts, group.select("cls"), folder, shingle)
    sizes = group.groupBy("grp").agg(F.expr(f"cast(ceil(count(1) / {chunk_classes}) as long)").alias("parts"))
    chunk = F.pmod(F.xxhash64("cls"), F.col("parts")).alias("chunk")
    chunks = group.join(sizes, "grp").select("cls", "grp", chunk).join(sets, "cls")
    members = materialise(_cluster(chunks, percent), folder, "cells")
    matrix = meeting.select("token", "cls", "n").join(members.select("cls", "cell"), "cls").groupBy("token", "cell").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    crowded = matrix.groupBy("token").agg(F.min(F.struct("lo", "hi", "cell")).alias("first"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    fits = lambda a, b: (F.col(f"{a}.hi") * 100 >= F.col(f"{b}.lo") * percent) & (F.col(f"{b}.hi") * 100 >= F.col(f"{a}.lo") * percent)
    matrix = materialise(matrix.join(crowded, "token"), folder, "matrix")
    star = matrix.withColumn("me", F.struct("lo", "hi", "cell")).where("cell <> first.cell").where(fits("me", "first"))
    star = star.select(F.least("cell", "first.cell").alias("a"), F.greatest("cell", "first.cell").alias("b")).distinct()
    star = materialise(star, folder, "star")
    links = materialise(_open(star, members, sets, percent), folder, "star-links")
    cells = members.select("cell").distinct()
    if links.limit(1).count():
        joined = components(links, folder, "star-components").select(F.col("node").alias("cell"), F.col("root").alias("comp"))
        cells = materialise(cells.join(joined, "cell", "left").select("cell", F.coalesce("comp", "cell").alias("comp")), folder, "star-cells")
    else:
        cells = cells.select("cell", F.col("cell").alias("comp"))
    known = matrix.select("token", "cell", "lo", "hi").join(cells, "cell")
    apart = known.groupBy("token").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("token")
    known = materialise(known.join(apart, "token", "left_semi"), folder, "apart")
    rest = _apart_pairs(known, members, sets, percent).join(star, ["a", "b"], "left_anti")
    more = materialise(_open(rest, members, sets, percent), folder, "rest-links")
    if more.limit(1).count():
        ends = more.join(cells.select(F.col("cell").alias("a"), F.col("comp").alias("ca")), "a").join(cells.select(F.col("cell").alias("b"), F.col("comp").alias("cb")), "b")
        last = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")), folder, "rest-components")
        cells = cells.join(last.select(F.col("node").alias("comp"), "root"), "comp", "left").select("cell", F.coalesce("root", "comp").alias("comp"))
    return members.select("cls", "cell").join(cells, "cell").select("cls", "comp")
