"""Where the tokens of two tokenizers end together.

Tasks tokenise blocks of texts and cut each distinct part into groups by array operations; what is
counted over the corpus is counted by grouping and joining.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise, shared_dir
from .common import as_strings, by_bytes, gives_back, string_bytes
from .pieces import SPACE, piece_encoder
from .tokens import UNSURE, encoder

#: Pairs of ids that are broadcast, at most; the others are joined by a shuffle.
BROADCAST_PAIRS = 500_000
#: Parts whose ids a worker remembers for each tokenizer: two of them share its memory here.
MEMORY = 240_000


def _byte_alphabet() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class TokenBytes:
    """The bytes of every id of a vocabulary, to be put together for many ids at once."""

    def __init__(self, each: list[bytes]):
        self.size = np.array([len(x) for x in each], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(each), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        before = np.cumsum(size) - size
        return self.data[np.repeat(self.start[ids] - before, size) + np.arange(size.sum())]


_bytes: dict[str, TokenBytes] = {}
_numbers: dict[int, TokenBytes] = {}


def _word_bytes(path: str) -> TokenBytes:
    if path not in _bytes:
        tokenizer, table = encoder(path, True, True, MEMORY).tokenizer, _byte_alphabet()
        texts = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
        _bytes[path] = TokenBytes([bytes(table[c] for c in t) if all(c in table for c in t) else t.encode() for t in texts])
    return _bytes[path]


def _piece_bytes(path: str) -> TokenBytes:
    if path not in _bytes:
        p = piece_encoder(path, MEMORY)
        single = {i: bytes([b]) for b, i in p.byte.items()}
        _bytes[path] = TokenBytes([single.get(i, (t or "").replace(SPACE, " ").encode()) for i, t in enumerate(p.pieces)])
    return _bytes[path]


def _decimals(n: int) -> TokenBytes:
    """The decimal forms of the ids below ``n``, with a byte behind each."""
    if n not in _numbers:
        _numbers[n] = TokenBytes([b"%d," % i for i in range(n)])
    return _numbers[n]


def _sizes(ids: np.ndarray, counts: np.ndarray, table: TokenBytes) -> np.ndarray:
    """The bytes of each text."""
    upto = np.concatenate(([0], np.cumsum(table.size[ids])))
    return np.diff(upto[np.concatenate(([0], np.cumsum(counts)))])


def _parts(texts: pa.Array) -> pa.ListArray:
    """Each text cut before its spaces where both tokenizers certainly cut, else in one part."""
    unsure = pc.or_(pc.match_substring_regex(texts, UNSURE), pc.match_substring_regex(texts, f"{SPACE}|\\x00"))
    if not pc.any(unsure).as_py():
        return pc.split_pattern(texts, " ")
    odd = np.asarray(unsure)
    easy = pc.split_pattern(texts.filter(pc.invert(unsure)), " ")
    some = texts.filter(unsure)
    hard = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1), pa.int32()), some)
    place = np.empty(len(texts), np.int64)
    place[~odd], place[odd] = np.arange(len(easy)), len(easy) + np.arange(len(some))
    return pa.concat_arrays([easy, hard]).take(pa.array(place))


def _groups(a: np.ndarray, a_counts: np.ndarray, a_table: TokenBytes, b: np.ndarray, b_counts: np.ndarray, b_table: TokenBytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """For parts whose two sides have the same bytes: their groups as text, each with ``;`` behind it,
    the packed ids of tokens that end together, and the number of these in each part.

    All parts lie on one line of bytes, so where both sides end is read off two bit maps of it.
    """
    a_ends, b_ends = np.cumsum(a_table.size[a]), np.cumsum(b_table.size[b])
    ends_a, ends_b = (np.zeros(int(a_ends[-1]) + 1 if len(a) else 1, bool) for _ in range(2))
    ends_a[a_ends], ends_b[b_ends] = True, True
    a_cut, b_cut = ends_b[a_ends], ends_a[b_ends]
    a_last, b_last = np.flatnonzero(a_cut), np.flatnonzero(b_cut)
    pairs = a[a_last].astype(np.int64) << 32 | b[b_last]
    bounds = np.concatenate(([0], np.cumsum(a_counts)))
    n_pairs = np.diff(np.concatenate(([0], np.cumsum(a_cut)))[bounds])
    # the tokens in the order of the text: a group's of A, then its of B
    b_first = np.concatenate(([0], b_last + 1))
    a_place = np.arange(len(a)) + b_first[np.cumsum(a_cut) - a_cut]
    b_place = np.arange(len(b)) + (a_last + 1)[np.cumsum(b_cut) - b_cut]
    ids, behind = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
    ids[a_place], ids[b_place] = a, b
    behind[a_place[a_last]], behind[b_place[b_last]] = ord("|"), ord(";")
    decimals = _decimals(max(len(a_table.size), len(b_table.size)))
    text, upto = decimals.join(ids), np.cumsum(decimals.size[ids])
    text[upto - 1] = behind
    offsets = np.concatenate(([0], upto))[bounds + np.concatenate(([0], np.cumsum(b_counts)))]
    return pa.Array.from_buffers(pa.binary(), len(a_counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(text)]), pairs, n_pairs


def align(docs: DataFrame, words: str, model: str, id_col: str = "doc_id", text_col: str = "text", block: int = 1 << 21) -> DataFrame:
    """``id, n_a, n_b, groups, pairs``, a row a text.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: the ids of both sides, group by group; ``pairs`` are the
    packed ids of tokens that end together. A encodes by the byte-level vocabulary ``words``, strings
    of special tokens as plain text; B by ``model``. Offsets where tokens of both sides end cut a text
    into groups; the last tokens of a group's two sides end together, and no others do.

    A part is a space and what follows up to the next space, so both tokenizers end a token with it
    (texts with spaces in a row or other odd ones are one part). Each distinct part of about ``block``
    bytes of texts is aligned once; a text's groups are those of its parts. Null and empty texts, and
    those that a side does not give back byte for byte, have no tokens.
    """
    kind = docs.select(F.col(f"`{id_col}`").alias("id")).schema["id"].dataType.simpleString()

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = ((encoder(words, True, True, MEMORY), _word_bytes(words)), (piece_encoder(model, MEMORY), _piece_bytes(model)))
        for batch in batches:
            every = as_strings(batch, "text")
            for lo, hi in by_bytes(every, block):
                lists = _parts(every.slice(lo, hi - lo))
                bounds = np.asarray(lists.offsets, dtype=np.int64)
                bounds = bounds - bounds[0]
                flat = lists.flatten().dictionary_encode()
                parts, code = flat.dictionary, np.asarray(flat.indices)
                want = string_bytes(pc.binary_join_element_wise(pa.scalar("", parts.type), parts, " "))
                good, found = np.asarray(pc.binary_length(parts)) > 0, []
                for encode, table in sides:
                    ids, counts = encode.encode(parts)
                    good = good & _same(table.join(ids), _sizes(ids, counts, table), *want)
                    found.append((ids, counts, table))
                sides_of = [x for ids, counts, table in found for x in (ids[np.repeat(good, counts)], counts * good, table)]
                groups, pairs, n_pairs = _groups(*sides_of)
                # a text without a part that a side does not give back has its parts' groups, others none
                bad = np.concatenate(([0], np.cumsum(~good[code])))
                keep = bad[bounds[1:]] == bad[bounds[:-1]]
                code = code[np.repeat(keep, np.diff(bounds))]
                bounds = np.concatenate(([0], np.cumsum(np.diff(bounds) * keep)))
                total = lambda x: np.concatenate(([0], np.cumsum(x[code])))[bounds]
                text = groups.take(pa.array(code))
                start = np.asarray(np.frombuffer(text.buffers()[1], np.int32, len(code) + 1))[bounds]
                text = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(start), text.buffers()[2]])
                each = n_pairs[code]
                source = np.repeat((np.cumsum(n_pairs) - n_pairs)[code] - (np.cumsum(each) - each), each) + np.arange(each.sum())
                linked = pa.ListArray.from_arrays(pa.array(total(n_pairs), pa.int32()), pa.array(pairs[source]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(np.diff(total(x))) for x in (sides_of[1], sides_of[4])), pc.binary_slice(text, 0, -1).cast(pa.string()), linked],
                    ["id", "n_a", "n_b", "groups", "pairs"],
                )

    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return plain.mapInArrow(run, f"id {kind}, n_a long, n_b long, groups string, pairs array<long>")


def _same(got: np.ndarray, sizes: np.ndarray, want: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts have the wanted bytes."""
    same = sizes == np.diff(offsets)
    if same.all() and len(got) == len(want):
        differ = np.flatnonzero(got != want)
        same[np.searchsorted(offsets, differ, "right") - 1] = False
        return same
    begin = np.cumsum(sizes) - sizes
    for k in np.flatnonzero(same):
        same[k] = np.array_equal(got[begin[k] : begin[k] + sizes[k]], want[offsets[k] : offsets[k + 1]])
    return same


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n, best`` of a column ``pairs`` of packed id pairs: how often each occurs, and whether
    no pair of the same B id occurs oftener. Counted on the map side before anything is shuffled."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts, shared_dir(rows.sparkSession), "pairs")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, most: int) -> tuple[int, bool]:
    """From which count on at most ``most`` pairs occur, and whether rarer ones are left."""
    size = F.length(F.bin("n"))  # one row for each power of two
    sizes = sorted(((r["s"], r["k"]) for r in counts.groupBy(size.alias("s")).agg(F.count(F.lit(1)).alias("k")).collect()), reverse=True)
    least, total = 1 << 63, 0
    for s, k in sizes:
        total += k
        if total > most:
            return min(least, (1 << 63) - 1), True
        least = 1 << (s - 1)
    return 1, False


def score_links(rows: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``row, n_best, count_sum`` of ``rows(row, pairs)``, rows without links left out.

    A link counts what its pair counts in the whole corpus; it is best if no pair of its B id
    counts more. Pairs that occur often, at most ``broadcast_pairs`` of them, meet their counts
    where they are; the others, none of which is frequent, by a shuffle.
    """
    counts = materialise(pair_counts(rows), shared_dir(rows.sparkSession), "counts")
    least, more = _frequent(counts, broadcast_pairs)
    each = rows.select("row", F.explode("pairs").alias("pair"))
    hot = counts.where(F.col("n") >= F.lit(least))
    met = each.join(F.broadcast(hot), "pair", "left" if more else "inner")
    if more:
        rare = met.where("n is null").select("row", "pair").join(counts.where(F.col("n") < F.lit(least)), "pair")
        met = met.where("n is not null").select("row", "pair", "n", "best").unionByName(rare.select("row", "pair", "n", "best"))
    return met.groupBy("row").agg(F.count_if("best").alias("n_best"), F.sum("n").alias("count_sum"))


def align_documents(docs: DataFrame, words: str, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, a row a row of ``docs``.

    Null and empty texts and texts that a tokenizer does not give back have zeros and an empty
    digest. Repeated rows and identifiers are rows of their own and count each time; null
    identifiers are kept; ties for a B id's highest count are all best; other columns of any name
    don't matter; an empty table gives an empty one. What a text of any length needs is its arrays.
    """
    found = align(docs, words, model, id_col, text_col)
    size = F.size("pairs").cast("long")  # a group has one link
    digest = F.when(F.size("pairs") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    rows = found.select(F.monotonically_increasing_id().alias("row"), "id", "n_a", "n_b", size.alias("n_groups"), size.alias("n_links"), digest, "pairs")
    rows = materialise(rows, shared_dir(docs.sparkSession), "links")
    scored = score_links(rows.select("row", "pairs"))
    out = rows.drop("pairs").join(scored, "row", "left")
    whole = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", *whole, "groups_sha256")
