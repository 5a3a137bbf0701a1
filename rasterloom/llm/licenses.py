"""Licence scans: winnowed fingerprints pick candidates, banded alignment measures them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _ALPHABET, Words, as_strings, by_bytes, mix, string_bytes
from .toxicity import _BREAKS

# The wording of public licence notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "mit-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "bsd-2-clause-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "isc-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "gpl-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}


def _grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``k`` words, and which of them lie within one text."""
    h, n = words.hash, max(0, len(words.hash) - k + 1)
    g = np.zeros(n, np.uint64)
    for i in range(k):
        g = g * np.uint64(0xC2B2AE3D27D4EB4F) + h[i : i + n]
    row = np.repeat(np.arange(words.n), np.diff(words.first))
    return mix(g + np.uint64(k)), row[:n] == row[k - 1 : k - 1 + n] if n else np.zeros(0, bool)


def _winnow(words: Words, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the fingerprints: the least gram of each window of grams.

    Any run of ``k + window - 1`` words that two texts share has a fingerprint in common. A text
    with fewer grams than a window keeps its least one.
    """
    g, inside = _grams(words, k)
    picked = np.zeros(len(g), bool)
    if len(g) >= window:
        view = np.lib.stride_tricks.sliding_window_view(g, window)
        whole = inside[: len(view)] & inside[window - 1 :]
        first, last = words.first[:-1], words.first[1:]
        row = np.repeat(np.arange(words.n), np.diff(words.first))
        whole &= row[: len(view)] == row[window - 1 : window - 1 + len(view)]
        picked[np.flatnonzero(whole) + view[whole].argmin(1)] = True
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if 0 < b - a - k + 1 < window:
            picked[a + int(g[a : b - k + 1].argmin())] = True
    at = np.flatnonzero(picked & inside)
    return at, g[at]


def align(template: list[int], text: list[int], diagonal: int, band: int) -> tuple[int, int, int]:
    """Banded local alignment (match 2, else -1): matched words, and the span in ``text``.

    ``text[j]`` meets ``template[i]`` only where ``j - i`` is within ``band`` of ``diagonal``.
    """
    low, width = diagonal - band, 2 * band + 1
    zero = (0, 0, -1, -1)
    best, above = zero, [zero] * (width + 1)
    for i, t in enumerate(template):
        row, left = [], zero
        for d in range(width):
            j = i + low + d
            if j < 0 or j >= len(text):
                cell = zero
            else:
                s, m, a, _ = above[d]
                hit = text[j] == t
                cell = (s + (2 if hit else -1), m + hit, a if a >= 0 else j, j)
                s, m, a, e = above[d + 1]
                if s - 1 > cell[0]:
                    cell = (s - 1, m, a, e)
                s, m, a, e = left
                if s - 1 > cell[0]:
                    cell = (s - 1, m, a, e)
                if cell[0] <= 0:
                    cell = zero
                elif cell[0] > best[0]:
                    best = cell
            row.append(cell)
            left = cell
        above = [*row, zero]
    return best[1], best[2], best[3] + 1


def _may_match(template: np.ndarray, text: np.ndarray, free: np.ndarray, diagonal: int, band: int, least: float) -> bool:
    """Whether ``least`` words of the template stand ``free`` in ``text`` within ``band`` of ``diagonal``: no alignment matches more."""
    low = diagonal - band
    padded = np.zeros(len(template) + 2 * band, np.uint64)
    there = np.zeros(len(padded), bool)
    a, b = max(0, low), min(len(text), low + len(padded))
    if a >= b:
        return False
    padded[a - low : b - low], there[a - low : b - low] = text[a:b], free[a:b]
    view = np.lib.stride_tricks.sliding_window_view
    met = (view(padded, 2 * band + 1) == template[:, None]) & view(there, 2 * band + 1)
    return int(met.any(1).sum()) >= least


def _matches(template: list[int], text: np.ndarray, found: list[tuple[int, int]], band: int, least_coverage: float) -> Iterator[tuple[int, int, int]]:
    """Matched words and span of each place where the template stands.

    ``found``: (diagonal, position) of common fingerprints. Each diagonal is aligned until nothing
    is found near it; the words of a match are taken, so that its neighbours are found by themselves.
    """
    body, least = np.array(template, np.uint64), least_coverage * len(template)
    free = np.ones(len(text), bool)
    at: dict[int, list[int]] = defaultdict(list)
    for d, p in found:
        at[d].append(p)
    for d in sorted(at):
        while any(free[p] for p in at[d]):
            begin, end = max(0, d - 2 * band), min(len(text), d + len(template) + 2 * band)
            part, open_ = text[begin:end], free[begin:end]
            if not _may_match(body, part, open_, d - begin, band, least):
                break
            # a taken word equals none of the template's
            matched, s, e = align(template, [x if ok else -1 for x, ok in zip(part.tolist(), open_.tolist())], d - begin, band)
            if not matched or matched < least:
                break
            free[begin + s : begin + e] = False
            yield matched, begin + s, begin + e


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text",
    k: int = 3, window: int = 3, band: int = 8, least_coverage: float = 0.75,
) -> DataFrame:
    """A row a match: ``id_col, license, coverage, start_word, end_word, start_char, end_char``.

    Words are runs of letters and digits, A-Z lower-cased. The templates' fingerprints (k words,
    winnowed) form an inverted index of fixed size that every task holds; texts are winnowed alike,
    and the template is aligned along each diagonal of common fingerprints, again until no match is
    left there; of templates of few words every pair of words is a fingerprint.
    ``coverage`` is the part of the template's words matched; matches below ``least_coverage`` are
    left out. One pass, no shuffle: long texts, copies and hot sources need nothing special. Null
    and empty texts match nothing; repeated rows are reported each.
    """
    names = sorted(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(pa.array([templates[n] for n in names]), _ALPHABET, _BREAKS)
        bodies = [known.hash[a:b].tolist() for a, b in zip(known.first, known.first[1:])]
        # what is left of a changed short line can be without a whole window: every gram of its counts
        short = [len(x) < 4 * (k + window - 1) for x in bodies]
        tables = []
        for size, width, which in ((k, window, False), (min(k, 2), 1, True)):
            index: dict[int, list[tuple[int, int]]] = defaultdict(list)
            for p, g in zip(*(x.tolist() for x in _winnow(known, size, width))):
                t = int(np.searchsorted(known.first, p, "right")) - 1
                if short[t] == which:
                    index[g].append((t, p - int(known.first[t])))
            tables.append((size, width, index, np.sort(np.array(list(index), np.uint64))))
        for batch in batches:
            texts = as_strings(batch, "t")
            for a, b in by_bytes(texts):
                part = texts.slice(a, b - a)
                w = Words(part, _ALPHABET, _BREAKS)
                near: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
                for size, width, index, keys in tables:
                    if not len(keys):
                        continue
                    pos, g = _winnow(w, size, width)
                    hit = keys[np.minimum(np.searchsorted(keys, g), len(keys) - 1)] == g
                    for p, mark in zip(pos[hit].tolist(), g[hit].tolist()):
                        doc = int(np.searchsorted(w.first, p, "right")) - 1
                        for t, q in index[mark]:
                            near[doc, t].append((p - int(w.first[doc]) - q, p - int(w.first[doc])))
                data, offsets = string_bytes(part)
                rows = []
                for (doc, t), found in near.items():
                    first, last = int(w.first[doc]), int(w.first[doc + 1])
                    for matched, s, e in _matches(bodies[t], w.hash[first:last], found, band, least_coverage):
                        head = data[offsets[doc] : w.start[first + s]].tobytes()
                        body = data[w.start[first + s] : w.end[first + e - 1]].tobytes()
                        c = len(head.decode())
                        rows.append((doc, names[t], matched / len(bodies[t]), s, e, c, c + len(body.decode())))
                rows.sort()
                if rows:
                    cols = list(zip(*rows))
                    ids = batch.column(0).slice(a, b - a).take(pa.array(cols[0]))
                    rest = [pa.array(c, kind) for c, kind in zip(cols[1:], (pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()))]
                    yield pa.RecordBatch.from_arrays([ids, *rest], names=[id_col, "license", "coverage", "start_word", "end_word", "start_char", "end_char"])

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.mapInArrow(run, f"{id_col} long, license string, coverage double, start_word int, end_word int, start_char int, end_char int")
