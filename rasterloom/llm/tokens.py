"""Token ids of whole texts by the ``tokenizers`` library, with each distinct word encoded once.

Words repeat, and byte-pair merges are the costly part, so texts are split where the tokenizer's
own pre-tokenizer always splits, only words not yet seen by this worker go through the library,
and ids are put together by array indexing. Texts in which that split isn't certain are encoded
whole, so ids are always the library's.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import string_bytes

#: Unicode white space next to a space: there a space need not begin a token of its own.
_WS = r"[\t\n\x0b\x0c\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNSURE = rf"(?:^ | $|{_WS} | {_WS})"
_SEPARATOR = "\x01"


class WordEncoder:
    """``encode`` gives the ids of texts as one flat array with the number of ids of each text.

    The kind of the tokenizer follows from its file: byte-level ones whose tokens carry a leading
    space are split before single spaces; those that drop white space are split at it.
    ``plain``: the strings of special tokens are ordinary text. ``lead``: every text is encoded as
    if a space stood before it (for tokenizers of the first kind).
    """

    def __init__(self, path: str, memory: int = 500_000, plain: bool = False, lead: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: strings that are one token wherever they stand; texts with them are encoded whole
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.tokenizer.encode_special_tokens = plain
        self.added = [(t.content, t.normalized) for t in added if not (plain and t.special)]
        self.lead = lead
        self.memory = memory
        tok = self.tokenizer
        spaced = tok.encode(" a", add_special_tokens=False).ids
        self.spaced = spaced != tok.encode("a", add_special_tokens=False).ids
        if self.spaced:
            self.opens = np.array([(tok.id_to_token(i) or "").startswith("Ġ") for i in range(tok.get_vocab_size())])
        else:
            self.closes = np.array([(tok.id_to_token(i) or "").endswith("</w>") for i in range(tok.get_vocab_size())])
            mark = tok.encode(_SEPARATOR, add_special_tokens=False).ids
            self.mark = mark[0] if len(mark) == 1 else None
        plain = lambda x: tok.encode(x, add_special_tokens=False).ids
        self.folds = plain("AbZ") == plain("abz")
        #: ids of marks that are tokens of their own after a letter or digit, else -1
        self.tails = np.full(256, -1, np.int32)
        for c in ".,;:!?":
            if len(plain(c)) == 1 and all(plain(w + c) == plain(w) + plain(c) for w in ("q", "zq", "7", "word", " word")):
                self.tails[ord(c)] = plain(c)[0]
        #: how the model itself merges a word of letters, where nothing happens to it before that
        front, alphabet = "Ġ" if self.spaced else "", "abcdefghijklmnopqrstuvwxyz"
        alphabet += "" if self.folds else alphabet.upper()
        shown = alphabet if tok.normalizer is None else tok.normalizer.normalize_str(alphabet)
        split = tok.pre_tokenizer.pre_tokenize_str(" " * self.spaced + shown) if tok.pre_tokenizer else []
        model, probes = tok.model, ["a", "zq", "word", "tion", alphabet, alphabet[::-1]]
        alike = shown == alphabet and [x for x, _ in split] == [front + alphabet] and not getattr(model, "dropout", None)
        alike = alike and all([t.id for t in model.tokenize(front + w)] == plain(" " * self.spaced + w) for w in probes)
        self.front, self.merge = front, model.tokenize if alike else None
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _plain(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids of distinct words in one pool, and where each word's lie in it.

        A word is looked up by its lower-case form (where the tokenizer folds) without a mark at its end.
        """
        base = pc.ascii_lower(words) if self.folds else words
        marked = np.asarray(pc.match_substring_regex(base, "[A-Za-z0-9][.,;:!?]$"))
        data, offsets = string_bytes(base)
        last = np.zeros(len(words), np.int64)
        last[marked] = data[offsets[1:][marked] - 1]
        marked &= self.tails[last] >= 0
        bare = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(base, 0, -1), base).dictionary_encode()
        bases = bare.dictionary.to_pylist()
        if len(self.known) + len(bases) > self.memory:
            self._forget()
        known = self.known
        at = list(map(known.get, bases))
        missing = [w for w, k in zip(bases, at) if k is None]
        if missing:
            self._encode_words(missing)
            at = [known[w] if k is None else k for w, k in zip(bases, at)]
        at = np.array(at, np.int64)[np.asarray(bare.indices)]
        stem = self.length[at]
        length = stem + marked
        begin, first = np.cumsum(length) - length, np.cumsum(stem) - stem
        pool, every = np.empty(length.sum(), np.int32), np.arange(stem.sum())
        pool[np.repeat(begin - first, stem) + every] = self.ids[np.repeat(self.start[at] - first, stem) + every]
        pool[(begin + stem)[marked]] = self.tails[last[marked]]
        return pool, begin, length

    def _encode_words(self, words: list[str]) -> None:
        letters = [w for w in words if w.isascii() and w.isalpha()]
        if letters and self.merge is not None:
            merge, front, length, ids = self.merge, self.front, [], []
            for w in letters:
                found = merge(front + w)
                length.append(len(found))
                ids += [t.id for t in found]
            self._keep(letters, np.array(ids, np.int32), np.array(length, np.int64))
            words = [w for w in words if not (w.isascii() and w.isalpha())] if len(letters) < len(words) else []
            if not words:
                return
            letters = []
        if self.spaced:
            chunks = ["".join([" " + w for w in words[i : i + 1000]]) for i in range(0, len(words), 1000)]
            ids = np.concatenate([np.array(x, np.int32) for x in self._plain(chunks)])
            at = np.flatnonzero(self.opens[ids])
            length = np.diff(np.append(at, len(ids)))
        elif len(letters) == len(words):  # a word of letters ends at the one token that closes it
            chunks = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
            ids = np.concatenate([np.array(x, np.int32) for x in self._plain(chunks)])
            length = np.diff(np.concatenate(([-1], np.flatnonzero(self.closes[ids]))))
        elif letters:
            self._encode_words(letters)
            return self._encode_words([w for w in words if not (w.isascii() and w.isalpha())])
        elif self.mark is not None and not any(_SEPARATOR in w for w in words):
            join = f" {_SEPARATOR} ".join
            chunks = [join(words[i : i + 1000]) + f" {_SEPARATOR}" for i in range(0, len(words), 1000)]
            ids = np.concatenate([np.array(x, np.int32) for x in self._plain(chunks)])
            marks = np.flatnonzero(ids == self.mark)
            length = np.diff(np.concatenate(([-1], marks))) - 1
            ids = ids[ids != self.mark]
        else:
            each = self._plain(words)
            length = np.array([len(x) for x in each], np.int64)
            ids = np.array([y for x in each for y in x], np.int32)
        if len(length) != len(words):
            each = self._plain([" " + w for w in words] if self.spaced else words)
            length = np.array([len(x) for x in each], np.int64)
            ids = np.array([y for x in each for y in x], np.int32)
        self._keep(words, ids, length)

    def _keep(self, words: list[str], ids: np.ndarray, length: np.ndarray) -> None:
        begin = len(self.ids) + np.concatenate(([0], np.cumsum(length)[:-1]))
        for k, w in enumerate(words, len(self.known)):
            self.known[w] = k
        self.start, self.length = np.append(self.start, begin), np.append(self.length, length)
        self.ids = np.append(self.ids, ids)

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids and counts of texts whose split at single spaces is certain."""
        lists = pc.split_pattern(texts, " ")
        bounds = np.asarray(lists.offsets, dtype=np.int64)
        flat = lists.flatten().dictionary_encode()
        code = np.asarray(flat.indices)
        pool, start, length = self._words(flat.dictionary)
        start, length = start[code], length[code]
        bounds = bounds - bounds[0]
        if self.spaced and not self.lead:  # the first word of a text has no space before it
            head = bounds[:-1]
            each = self._plain(flat.dictionary.take(pa.array(code[head])).to_pylist())
            length[head] = [len(x) for x in each]
            start[head] = len(pool) + np.concatenate(([0], np.cumsum(length[head])[:-1]))
            pool = np.append(pool, np.array([y for x in each for y in x], np.int32))
        ends = np.concatenate(([0], np.cumsum(length)))
        source = np.repeat(start - ends[:-1], length) + np.arange(ends[-1])
        return pool[source], np.diff(ends[bounds])

    def _certain(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self._split(texts if self.spaced else pc.replace_substring(texts, "\n", " "))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        unsure = pc.match_substring_regex(texts, UNSURE) if self.spaced else pa.array(np.zeros(len(texts), bool))
        for content, normalised in self.added:
            unsure = pc.or_(unsure, pc.match_substring(texts, content, ignore_case=normalised))
        if not pc.any(unsure).as_py():
            return self._certain(texts)
        odd = np.asarray(unsure)
        front = " " if self.lead else ""
        whole = [np.array(x, np.int32) for x in self._plain([front + t for t in texts.filter(unsure).to_pylist()])]
        counts = np.zeros(len(texts), np.int64)
        counts[odd] = [len(x) for x in whole]
        ids, some = self._certain(texts.filter(pc.invert(unsure))) if not odd.all() else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        counts[~odd] = some
        out = np.empty(counts.sum(), np.int32)
        is_odd = np.repeat(odd, counts)
        out[~is_odd] = ids
        out[is_odd] = np.concatenate(whole)
        return out, counts


_encoders: dict[tuple, WordEncoder] = {}


def encoder(path: str, plain: bool = False, lead: bool = False, memory: int = 500_000) -> WordEncoder:
    """This worker's encoder for a vocabulary file; it lasts as long as the worker."""
    key = (path, plain, lead, memory)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, memory, plain, lead)
    return _encoders[key]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end_id`` after each text, and the bounds of each text."""
    bounds = np.concatenate(([0], np.cumsum(counts + 1)))
    out = np.full(bounds[-1], end_id, np.uint32)
    keep = np.ones(bounds[-1], bool)
    keep[bounds[1:] - 1] = False
    out[keep] = ids
    return out, bounds
