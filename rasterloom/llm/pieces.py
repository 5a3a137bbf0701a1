"""SentencePiece encoding of the merge type, by backtracking, and decoding.

Merging picks the best-scored pair of neighbours again and again. Its result is the one sequence of
pieces whose neighbours are all compatible: merging the text of the two again gives just the two.
So a text is read from the left by longest matches; a piece that doesn't fit the one before gives
way to the next shorter one, and a position from which nothing fits is marked and never tried twice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_strings, by_bytes, gives_back, string_bytes

SPACE = "▁"  # how pieces write a space
_CUT = "\x00"
_LOW = float("-inf")
#: Parts of a text that no piece reaches across: a word with the spaces before it, spaces, line ends.
_PARTS = rf"({SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+)"


class PieceEncoder:
    """``encode`` gives the ids of texts as one flat array with the number of ids of each text.

    For models of the merge type whose normaliser only escapes spaces and adds one in front, and
    whose unknown characters become bytes; others are an error. Parts that repeat are encoded once.
    ``memory`` bounds the parts and the checked neighbours that are remembered, not what is encoded.
    """

    def __init__(self, path: str, memory: int = 500_000):
        import ahocorasick
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(p.get_piece_size())
        texts = [p.id_to_piece(i) for i in every]
        self.byte = {int(texts[i][3:5], 16): i for i in every if p.is_byte(i)}
        self.pieces = [None if p.is_control(i) or p.is_unknown(i) or p.is_byte(i) else texts[i] for i in every]
        self.id = {t: i for i, t in enumerate(self.pieces) if t}
        self.score = [p.get_score(i) for i in every]
        self.memory = memory
        if len(self.byte) != 256 or any(p.is_unused(i) for i in every):
            raise ValueError("only models with bytes for unknown characters and no unused pieces")
        if any(c not in self.id for t in self.id for c in t) or any("\n" in t or SPACE in t.lstrip(SPACE) for t in self.id):
            raise ValueError("only models whose pieces are made of other pieces and begin at spaces")
        if p.normalize(" Äﬁ  b ") != SPACE + f" Äﬁ  b ".replace(" ", SPACE):
            raise ValueError("only models that add a space and change nothing else")
        #: bytes of each id's text
        self.width = np.array([1 if p.is_byte(i) else 0 if t is None else len(t.replace(SPACE, " ").encode()) for i, t in enumerate(self.pieces)])
        self.automaton = ahocorasick.Automaton()
        #: the longest piece that each prefix of a piece begins with
        self.match: dict[str, int] = {}
        for t, i in self.id.items():
            self.automaton.add_word(t, i)
            longest = self.id[t[0]]
            for n in range(1, len(t) + 1):
                longest = self.match[t[:n]] = self.id.get(t[:n], longest)
        self.widest = max(map(len, self.id))
        self.single = {t for t in self.id if len(t) == 1}
        self.size = [len(t or "") for t in self.pieces]
        #: the longest piece that is a proper prefix, or -1
        self.shorter = [next((self.id[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.id), -1) if t else -1 for t in self.pieces]
        self.step = len(self.pieces) + 1
        #: marks that share no piece with a letter or digit before them, by their byte
        self.tails = np.full(128, -1, np.int32)
        after = {b for t in self.id for a, b in zip(t, t[1:]) if a.isalnum()}
        marks = [c for c in ".,;:!?&#$%*" if c in self.id and c not in after]
        for c in marks:
            self.tails[ord(c)] = self.id[c]
        self.marked = rf"[\pL\pN][{re.escape(''.join(marks))}]$" if marks else "^$^"
        self.rank = {t: self.score[i] for t, i in self.id.items()}
        self.checked: dict[int, bool] = {}
        self.histories: dict[int, tuple | None] = {}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.start, self.length, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: the best score first, the leftmost of equal ones."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.id.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _history(self, piece: int) -> tuple[list[float], list[str], list[str]] | None:
        """The scores by which a piece's characters merge, in order, and its first and its last part before
        each merge; None if they don't become the piece. The last score is below all."""
        rank, parts = self.rank, list(self.pieces[piece])
        near = [rank.get(x + y, _LOW) for x, y in zip(parts, parts[1:])]
        scores, firsts, lasts = [], [parts[0]], [parts[-1]]
        while near:
            best = max(near)
            if best == _LOW:
                return None
            k = near.index(best)  # the leftmost of equal ones
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del near[k]
            if k:
                near[k - 1] = rank.get(parts[k - 1] + parts[k], _LOW)
            if k < len(near):
                near[k] = rank.get(parts[k] + parts[k + 1], _LOW)
            scores.append(best)
            firsts.append(parts[0])
            lasts.append(parts[-1])
        return [*scores, _LOW], firsts, lasts

    def _steps(self, piece: int) -> tuple[list[float], list[str], list[str]] | None:
        if piece not in self.histories:
            self.histories[piece] = self._history(piece)
        return self.histories[piece]

    def _apart(self, before: int, piece: int) -> bool:
        """Each side merges as it does alone for as long as no better pair lies across the border."""
        right = self._steps(piece)
        left = self._steps(before) if before >= 0 else None
        if before < 0 or left is None or right is None:
            return before < 0 and right is not None
        rank, (on_left, _, lasts), (on_right, firsts, _) = self.rank, left, right
        i = j = 0
        while True:
            across, a, b = rank.get(lasts[i] + firsts[j], _LOW), on_left[i], on_right[j]
            if a >= b:  # of equal scores the leftmost pair merges
                if across > a:
                    return False
                if a == _LOW:
                    return True
                i += 1
            else:
                if across >= b:
                    return False
                j += 1

    def fits(self, before: int, piece: int) -> bool:
        """Whether merging leaves ``before`` and ``piece`` as they are, side by side (-1: nothing before)."""
        found = self._apart(before, piece)
        if len(self.checked) >= self.memory:
            self.checked.clear()
        self.checked[before * self.step + piece] = found
        return found

    def _backtrack(self, text: str) -> list[int]:
        """The pieces of a part without unknown characters; longest matches are sought where a piece ends."""
        size, shorter, checked, step = self.size, self.shorter, self.checked, self.step
        prefix, match, widest, end = self.automaton.longest_prefix, self.match, self.widest, len(text)
        out: list[int] = []
        failed = None  # a bit a position from which nothing fits
        at, before, piece = 0, -1, match[text[: prefix(text[:widest])]]
        while True:
            to = at + size[piece]
            if failed is None or not failed[to >> 3] & 1 << (to & 7):
                good = checked.get(before * step + piece)
                if good is None:
                    good = self.fits(before, piece)
                if good:
                    out.append(piece)
                    if to == end:
                        return out
                    at, before = to, piece
                    piece = match[text[to : to + prefix(text[to : to + widest])]]
                    continue
            piece = shorter[piece]
            while piece < 0:  # nothing fits here: the piece before gives way
                if not out:
                    raise AssertionError("no sequence of pieces gives this text")
                failed = failed or bytearray(end // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                at, before, piece = at - size[last], out[-1] if out else -1, shorter[last]

    def part(self, text: str) -> list[int]:
        """The ids of a part in which spaces are escaped."""
        if self.single.issuperset(text):
            return self._backtrack(text) if text else []
        out, begin = [], 0
        for at in [*(k for k, c in enumerate(text) if c not in self.single), len(text)]:  # unknown characters, and the end
            if begin < at:
                out += self._backtrack(text[begin:at])
            if at < len(text):
                out += [self.byte[b] for b in text[at].encode()]
            begin = at + 1
        return out

    def _split(self, texts: pa.Array) -> pa.Array:
        """Each text's parts; joined they are the text with spaces escaped and one in front."""
        escaped = pc.replace_substring(pc.binary_join_element_wise(pa.scalar("", texts.type), texts, " "), " ", SPACE)
        escaped = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar("", texts.type), escaped)
        odd = pc.or_(pc.match_substring(escaped, SPACE * 2), pc.match_substring(escaped, _CUT))
        if pc.any(odd).as_py():  # spaces in a row stay together
            find = re.compile(_PARTS).findall
            easy = self._cut(escaped.filter(pc.invert(odd)))
            hard = pa.array([find(t) for t in escaped.filter(odd).to_pylist()], easy.type)
            both, is_odd = pa.concat_arrays([easy, hard]), np.asarray(odd)
            place = np.empty(len(texts), np.int64)
            place[~is_odd], place[is_odd] = np.arange(len(easy)), len(easy) + np.arange(len(hard))
            return both.take(pa.array(place))
        return self._cut(escaped)

    def _cut(self, escaped: pa.Array) -> pa.Array:
        lines = pc.replace_substring(escaped, "\n", f"{_CUT}\n{_CUT}")
        return pc.split_pattern(pc.replace_substring(lines, SPACE, _CUT + SPACE), _CUT)

    def _learn(self, parts: list[str]) -> np.ndarray:
        """Where the ids of parts lie in the pool."""
        if len(self.known) + len(parts) > self.memory:
            self._forget()
        at = list(map(self.known.get, parts))
        missing = list(dict.fromkeys([w for w, k in zip(parts, at) if k is None]))
        if missing:
            part, ids, length = self.part, [], []
            for k, w in enumerate(missing, len(self.known)):
                found = part(w)
                ids += found
                length.append(len(found))
                self.known[w] = k
            length = np.array(length, np.int64)
            self.start = np.append(self.start, len(self.pool) + np.cumsum(length) - length)
            self.length = np.append(self.length, length)
            self.pool = np.append(self.pool, np.array(ids, np.int32))
            at = [self.known[w] if k is None else k for w, k in zip(parts, at)]
        return np.array(at, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Empty texts have no ids."""
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        lists = self._split(texts)
        bounds = np.asarray(lists.offsets, dtype=np.int64)
        bounds = bounds - bounds[0]
        flat = lists.flatten().dictionary_encode()
        parts, code = flat.dictionary, np.asarray(flat.indices)
        marked = np.asarray(pc.match_substring_regex(parts, self.marked))
        data, offsets = string_bytes(parts)
        mark = np.full(len(parts), -1, np.int32)
        mark[marked] = self.tails[data[offsets[1:][marked] - 1]]
        bare = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(parts, 0, -1), parts)
        at = self._learn(bare.to_pylist())
        # ids of the distinct parts of these texts in one pool, their marks behind them
        stem = self.length[at]
        length = stem + marked
        begin, first = np.cumsum(length) - length, np.cumsum(stem) - stem
        pool = np.empty(length.sum(), np.int32)
        pool[np.repeat(begin - first, stem) + np.arange(stem.sum())] = self.pool[np.repeat(self.start[at] - first, stem) + np.arange(stem.sum())]
        pool[(begin + stem)[marked]] = mark[marked]
        start, length = begin[code], length[code]
        ends = np.concatenate(([0], np.cumsum(length)))
        source = np.repeat(start - ends[:-1], length) + np.arange(ends[-1])
        return pool[source], np.diff(ends[bounds])


_encoders: dict[tuple, PieceEncoder] = {}


def piece_encoder(path: str, memory: int = 500_000) -> PieceEncoder:
    """This worker's encoder for a model file; it lasts as long as the worker."""
    key = (path, memory)
    if key not in _encoders:
        _encoders[key] = PieceEncoder(path, memory)
    return _encoders[key]


def list_array(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(flat, pa.int32()))


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids``: the ids of every whole text, without begin or end; a row a row of ``docs``.

    Null texts count as empty and have no ids. Rows are independent: repeated rows, repeated or null
    identifiers and other columns of any name make no difference, an empty table gives an empty
    one, and a very long text is only as costly as its length (a part without spaces is linear too).
    A narrow pass: nothing is shuffled.
    """
    kind = docs.select(F.col(f"`{id_col}`").alias("id")).schema["id"].dataType.simpleString()

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(model)
        for batch in batches:
            texts = as_strings(batch, "text")
            for a, b in by_bytes(texts, 1 << 21):
                ids, counts = encoder.encode(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), list_array(ids, counts)], ["id", "ids"])

    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return plain.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode_pieces(tokens: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``tokens`` with the text of its ids, by the library; no ids or null give the empty text."""
    schema = tokens.withColumn(text_col, F.lit("")).schema
    place = tokens.columns.index(ids_col)

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = piece_encoder(model).processor
        for batch in batches:
            ids = batch.column(place)
            for a, b in _by_ids(ids):
                some = _id_lists(ids.slice(a, b - a))
                texts = pa.array(processor.decode(some, num_threads=1) if some else [], pa.string())
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), texts], schema.names)

    return tokens.mapInArrow(run, schema)


def _id_lists(ids: pa.Array) -> list[list[int]]:
    """``to_pylist`` with null as no ids, by slices of one list: no Arrow scalar is made for each id."""
    flat = ids.flatten()
    if flat.null_count:
        return [x or [] for x in ids.to_pylist()]
    every, ends = flat.to_numpy().tolist(), np.cumsum(pc.fill_null(pc.list_value_length(ids), 0)).tolist()
    return [every[a:b] for a, b in zip([0, *ends], ends)]


def _by_ids(ids: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(ids), 0)))
    at = 0
    while at < len(ids):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield at, to
        at = to


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids, ","), 256)
