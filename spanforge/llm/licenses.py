"""License scans: MinHash bands over overlapping text windows find templates, exact shingle containment verifies them."""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import pieces, texts

#: Public license notices and texts.
TEMPLATES = {
    "apache-2.0 line": "Licensed under the Apache License, Version 2.0",
    "apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "mit line": "Released under the MIT License",
    "mit text": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), '
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE."
    ),
    "gpl-3.0 line": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope "
        "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
        "See the GNU General Public License for more details."
    ),
    "cc-by-nc-4.0 line": "Licensed under CC BY-NC 4.0",
    "cc-by-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "bsd-3-clause text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission."
    ),
    "isc text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies."
    ),
}

#: Lower case letters, digits and all bytes above ASCII make words; the rest parts them.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
SHINGLE = 5
_STEP = np.uint64(0x100000001B3)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def shingle_codes(words: list[bytes]) -> np.ndarray:
    """A 64-bit code of each run of five words."""
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    n = len(words) - SHINGLE + 1
    code = np.zeros(max(n, 0), np.uint64)
    for i in range(SHINGLE if n > 0 else 0):
        code = (code ^ h[i : i + n]) * _STEP
        code ^= code >> np.uint64(29)
    return code


def collision_probability(similarity: float, rows: int, bands: int) -> float:
    return 1 - (1 - similarity**rows) ** bands


def bands_for(similarity: float, rows: int, least: float) -> int:
    """Bands that make sets of this similarity meet with a probability of ``least`` or more."""
    return max(1, math.ceil(math.log(1 - least) / math.log(1 - similarity**rows)))


@dataclass(frozen=True)
class Scan:
    """A template is found where ``containment`` of its shingles lie within ``room`` times its length.

    ``rows`` and ``found`` (probability of meeting a template that just passes) set the bands.
    """

    containment: float = 0.8
    room: float = 1.25
    rows: int = 2
    found: float = 0.999
    seed: int = 9


def window_size(shingles: int) -> int:
    """Least of 2, 3, 4, 6, 8, 12, ... shingles that a template fills to at most three quarters, so that
    windows at a quarter's stride hold all of it."""
    size = 2
    while size * 3 < shingles * 4:
        size = size * 3 // 2 if size & (size - 1) == 0 and size > 2 else 3 if size == 2 else size * 4 // 3
    return size


class Templates:
    """Shingles of all templates, and their signatures' bands by window size."""

    def __init__(self, templates: dict[str, str], scan: Scan):
        self.scan, self.names = scan, []
        self.exact: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.length: list[int] = []  # shingles, in order
        self.different: list[int] = []
        self.size: list[int] = []
        every = []
        for name, text in templates.items():
            words = words_of(text.encode())
            runs = [b" ".join(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)]
            if not runs:
                raise ValueError(f"{name} has fewer than {SHINGLE} words")
            t = len(self.names)
            self.names.append(name)
            for k, run in enumerate(dict.fromkeys(runs)):
                self.exact[run].append((t, k))
            self.length.append(len(runs))
            self.different.append(len(set(runs)))
            self.size.append(window_size(len(runs)))
            every.append(np.unique(shingle_codes(words)))
        # the least similar window that may hold a match: the template partly there, the window otherwise foreign
        similarity = min(scan.containment * d / (s + (1 - scan.containment) * d) for d, s in zip(self.different, self.size, strict=True))
        self.bands = bands_for(similarity, scan.rows, scan.found)
        r = np.random.default_rng(scan.seed)
        self.a = r.integers(0, 1 << 63, self.bands * scan.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = r.integers(0, 1 << 63, self.bands * scan.rows, dtype=np.uint64)
        self.index: dict[tuple, set[int]] = defaultdict(set)
        for t, codes in enumerate(every):
            for k, key in enumerate(self.keys(codes)):
                self.index[self.size[t], k, key].add(t)
        self.codes = np.unique(np.concatenate(every))
        self.sketch = np.zeros(1 << 20, bool)
        self.sketch[(self.codes >> np.uint64(44)).astype(np.int64)] = True
        self.sizes = sorted(set(self.size))

    def keys(self, codes: np.ndarray) -> list[bytes]:
        """The bands of a set of shingles: rows of least hashes."""
        mixed = codes[:, None] * self.a + self.b
        mixed ^= mixed >> np.uint64(31)
        least = (mixed * _STEP).min(0)
        return [x.tobytes() for x in least.reshape(self.bands, self.scan.rows)]

    def retrieve(self, codes: np.ndarray, hits: np.ndarray) -> set[tuple[int, int, int]]:
        """(template, start, end) of windows that share a band with a template.

        Windows are spans of each size at a quarter's stride. One without any template shingle has no
        least hash in common with a template, so only windows around ``hits`` are signed.
        """
        found = set()
        for size in self.sizes:
            stride = max(1, size // 4)
            first, last = np.maximum(0, -(-(hits - size + 1) // stride)), hits // stride
            starts = np.unique(np.concatenate([np.arange(f, n + 1) for f, n in zip(first, last, strict=True)])) * stride
            for s in starts.tolist():
                for k, key in enumerate(self.keys(codes[s : s + size])):
                    for t in self.index.get((size, k, key), ()):
                        found.add((t, s, s + size))
        return found

    def scan_words(self, words: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(template, first word, words, shingles matched) of verified matches, the best of overlapping ones."""
        codes = shingle_codes(words)
        maybe = np.flatnonzero(self.sketch[(codes >> np.uint64(44)).astype(np.int64)])
        hits = maybe[np.isin(codes[maybe], self.codes)]
        if not len(hits):
            return []
        places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i in hits.tolist():
            for t, k in self.exact.get(b" ".join(words[i : i + SHINGLE]), ()):
                places[t].append((i, k))
        spans: dict[int, list[list[int]]] = defaultdict(list)
        for t, s, e in sorted(self.retrieve(codes, hits)):
            wide = math.ceil(self.scan.room * self.length[t])
            if spans[t] and s - wide <= spans[t][-1][1]:
                spans[t][-1][1] = max(spans[t][-1][1], e + wide)
            else:
                spans[t].append([s - wide, e + wide])
        out = []
        for t, regions in spans.items():
            for s, e in regions:
                out += self._verified(t, [p for p in places[t] if s <= p[0] < e])
        return sorted(out, key=lambda m: (m[1], m[0]))

    def _verified(self, t: int, places: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
        """Spans of at most ``room`` times the template that hold enough of its shingles; of those that overlap the fullest, then the first."""
        most, need = math.ceil(self.scan.room * self.length[t]), self.scan.containment * self.different[t]
        inside: dict[int, int] = defaultdict(int)
        good, j = [], 0
        for i, (at, _) in enumerate(places):
            while j < len(places) and places[j][0] < at + most:
                inside[places[j][1]] += 1
                j += 1
            n = sum(v > 0 for v in inside.values())
            if n >= need - 1e-9:
                good.append((-n, at, places[j - 1][0] - at + SHINGLE))
            inside[places[i][1]] -= 1
        taken: list[tuple[int, int, int, int]] = []
        for n, at, length in sorted(good):
            if all(at + length <= a or at >= a + w for _, a, w, _ in taken):
                taken.append((t, at, length, -n))
        return taken

    def scan_text(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """Matches of a whole text; very long ones are read in parts that overlap by more than any match."""
        over, before, tail, out = math.ceil(2 * self.scan.room * max(self.length)) + 2 * SHINGLE, 0, [], []
        for part in pieces(text):
            words = tail + words_of(part)
            for t, at, n, k in self.scan_words(words):
                if not any(t == x[0] and before + at < x[1] + x[2] and x[1] < before + at + n for x in out):
                    out.append((t, before + at, n, k))
                else:
                    i = next(i for i, x in enumerate(out) if t == x[0] and before + at < x[1] + x[2] and x[1] < before + at + n)
                    if k > out[i][3]:
                        out[i] = (t, before + at, n, k)
            before += max(0, len(words) - over)
            tail = words[-over:]
        return out


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None, scan: Scan = Scan()) -> DataFrame:
    """``key, n_matches, licenses, containment, matches``: one row per row of ``docs``.

    ``licenses`` names the templates found, sorted and joined by commas; ``containment`` is the
    greatest share of a template's five-word shingles found; ``matches`` holds template, first word,
    words and containment of each match. A null or empty text has none; null keys and repeated rows
    give a row each; an empty table gives an empty one; other columns are not read. A text is read
    whole, by the task that holds it, so passages shared by many documents move nothing.
    """
    chosen = TEMPLATES if templates is None else templates
    fields = [("template", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("containment", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(chosen, scan) if chosen else None
        for b in batches:
            found = [[{"template": known.names[t], "first_word": at, "n_words": n, "containment": k / known.different[t]} for t, at, n, k in known.scan_text(x)] if known else [] for x in texts(b.column(1))]
            cols = [
                b.column(0), pa.array([len(f) for f in found], pa.int64()), pa.array([",".join(sorted({m["template"] for m in f})) for f in found], pa.string()),
                pa.array([max((m["containment"] for m in f), default=0.0) for f in found], pa.float64()), pa.array(found, pa.list_(pa.struct(fields))),
            ]
            yield pa.RecordBatch.from_arrays(cols, names=[key, "n_matches", "licenses", "containment", "matches"])

    kind = docs.schema[key].dataType.simpleString()
    matches = "matches array<struct<template:string,first_word:bigint,n_words:bigint,containment:double>>"
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_matches long, licenses string, containment double, {matches}")
